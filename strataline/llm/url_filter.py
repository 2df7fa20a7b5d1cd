"""URL filters with DataFrame functions only: each URL is expanded into expressions (a suffix of its
host with a prefix of its path), these are joined with the rules on a short prefix of their
digest, and the full digest confirms a hit before the longest rule decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.licenses import LOWER, UPPER
from strataline.llm.storage import stored

#: Hex digits of a digest that are joined on: 32 bits.
PREFIX_DIGITS = 8
#: With at most so many distinct prefixes in the rules, other expressions of a URL are sorted out
#: before they become rows; with more, all expressions are joined, spread by SALTS.
LISTED_PREFIXES = 10_000
SALTS = 16
#: What a URL without a fitting rule gets.
DEFAULT_VERDICT = "allow"

#: The rules of the registered query, as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty for null and for URLs without one."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """Up to the first `/`, `?`, `#` or the end, A-Z lower-cased; port and user stay in it."""
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def prepared_rules(rules: DataFrame) -> DataFrame:
    """(host_labels, path_length, open_length, digest, prefix, code), one row per host and path.

    `code` orders rules that fit one URL: by length, then by length of the host, block before
    allow for the same rule given twice. It tells both lengths and the verdict, so that no rule
    text has to travel. `open_length` is the length of a path that does not end in `/`.
    """
    host = F.translate(F.col("host").cast("string"), UPPER, LOWER)
    path = F.coalesce(F.col("path").cast("string"), F.lit(""))
    kept = rules.select(host.alias("host"), path.alias("path"), F.col("verdict").alias("verdict"))
    usable = F.col("host").isNotNull() & F.col("verdict").isin("allow", "block") & F.col("path").rlike("^(/|$)")
    usable &= ~F.col("host").rlike("[/?#]")
    one = kept.where(usable).groupBy("host", "path").agg(F.max((F.col("verdict") == "block").cast("long")).alias("block"))
    host_length, path_length = F.length("host").cast("long"), F.length("path").cast("long")
    code = (host_length + path_length) * F.lit(1 << 32) + host_length * 2 + F.col("block")
    return one.select(
        F.size(F.split("host", r"\.")).alias("host_labels"),
        path_length.alias("path_length"),
        F.when(~F.col("path").endswith("/"), path_length).alias("open_length"),
        _digest(F.concat("host", "path")).alias("digest"),
        code.alias("code"),
    ).withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))


def expressions(host: Column, path: Column, labels: int, longest: int, open_lengths: list[int]) -> Column:
    """The (prefix, digest) of all expressions of a URL that some rule could have.

    Suffixes of the host at label boundaries, up to as many labels as a rule has; prefixes of
    the path that end in `/` or are as long as a rule's path that does not, up to the longest.
    """
    parts = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda k: F.array_join(F.slice(parts, -k, k), ".")
    )
    is_end = lambda i: (i > 0) & (F.substr(path, i, F.lit(1)) == "/")
    ends = F.filter(
        F.sequence(F.lit(0), F.least(F.length(path), F.lit(longest))), lambda i: is_end(i) | i.isin(open_lengths) if open_lengths else is_end(i)
    )
    digests = F.flatten(F.transform(suffixes, lambda h: F.transform(ends, lambda i: _digest(F.concat(h, F.substr(path, F.lit(1), i))))))
    return F.transform(digests, lambda d: F.struct(F.substring(d, 1, PREFIX_DIGITS).alias("prefix"), d.alias("digest")))


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of `pages`.

    `rules` has host, path and verdict (allow or block). A rule fits its host and all subdomains
    if the URL's path starts with the rule's; of the rules that fit, the longest (host and path
    together) wins, then the one with the longer host; a rule given with both verdicts blocks.
    `rule` is the winner's host and path, null without one, where the verdict is
    DEFAULT_VERDICT. A null URL or one without `://` has an empty host and path, and no rule.
    Rules without a host, with another verdict or a path that does not begin with `/` are left
    out. Repeated rows are reported each; a null page_id stays null; other columns are not read;
    an empty table gives an empty result, and without rules every URL gets the default.

    One scan of the URLs, without a shuffle, leaves host, path and those expressions whose short
    prefix a rule has; only URLs with such an expression are joined and grouped. Salts spread the
    URLs of a very frequent host where the rules are too many to be listed.
    """
    rules = stored(prepared_rules(rules), "url-rules")
    shape = rules.agg(F.max("host_labels"), F.max("path_length"), F.collect_set("open_length")).first()
    labels, longest, open_lengths = shape[0] or 0, int(shape[1] or 0), [int(n) for n in shape[2]]  # a number per length of a path
    listed = [r[0] for r in rules.select("prefix").distinct().limit(LISTED_PREFIXES + 1).collect()]
    if len(listed) > LISTED_PREFIXES:
        listed = None

    split = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not labels:
        return split.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(DEFAULT_VERDICT)})
    found = expressions(F.col("host"), F.col("path"), labels, longest, open_lengths)
    if listed is not None:
        found = F.filter(found, lambda e: e["prefix"].isin(listed))
    scanned = split.withColumn("found", found).withColumn("row_id", F.monotonically_increasing_id())
    scanned = stored(scanned, "urls")

    keys = ["row_id", "page_id", "host", "path"]
    hits = scanned.where(F.size("found") > 0).select(*keys, F.explode("found").alias("hit")).select(*keys, "hit.*")
    known = rules.select("prefix", F.col("digest").alias("rule_digest"), "code")
    on = ["prefix"]
    if listed is None:
        hits = hits.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int"))
        known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on = ["prefix", "salt"]
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.col("code"))
    best = hits.join(known, on, "left").groupBy(*keys).agg(F.max(confirmed).alias("code"))
    none = scanned.where(F.size("found") == 0).select(*keys, F.lit(None).cast("long").alias("code"))

    length = F.shiftright("code", 32)
    host_length = F.shiftright(F.col("code").bitwiseAND((1 << 32) - 1), 1)
    rule = F.concat(F.substr("host", F.length("host") - host_length + 1), F.substr("path", F.lit(1), (length - host_length).cast("int")))
    verdict = F.when(F.col("code").isNull(), DEFAULT_VERDICT).when(F.col("code").bitwiseAND(1) == 1, "block").otherwise("allow")
    return best.unionByName(none).select("page_id", "host", "path", F.when(F.col("code").isNotNull(), rule).alias("rule"), verdict.alias("verdict"))


def oracle() -> str:
    """The same verdicts as DuckDB SQL, by comparing every URL with every one of the five rules."""
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    return rf"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {values}),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
),
cut AS (
  SELECT row_number() OVER () AS row_id, page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
),
best AS (
  SELECT row_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY row_id
)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT_VERDICT}') AS verdict FROM cut LEFT JOIN best USING (row_id)
"""
