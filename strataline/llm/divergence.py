"""How the sources of a language differ in their terms, with late materialisation of strings.

What is counted and joined are fixed-width digests of terms. The distinct strings of a digest show
whether it stands for one term; a digest of several is split by string and counted anew. Strings
are joined back for the rows of the result alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.llm.caches import in_worker
from strataline.llm.licenses import LOWER, UPPER
from strataline.llm.resampling import pieces_of
from strataline.llm.storage import bounded_batches, stored
from strataline.operators.fingerprints import filter_of, may_hold

#: What a term is, in how many documents of a language it must be, the scale of a
#: share, and how many terms of a group are reported.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200

#: Terms of groups that a task adds up before it hands them on, and rows of an output batch.
HELD_TERMS, OUT_ROWS = 600_000, 20_000
#: Parts into which the groups of one language are dealt when they are joined.
SALTS = 32
DIGEST_BITS = 64
#: Bits of the filter of kept digests: 2 MB in the plan. With very many kept terms it lets all pass.
FILTER_BITS = 1 << 24

#: A-Z lower-cased; bytes that are in no term become blanks.
_AS_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def partial_counts(texts: DataFrame) -> DataFrame:
    """(lang_key, group_key, term, n, df): occurrences and documents, added up within each task."""

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, group), (n, df) in held.items():
            terms = list(n)
            for i in range(0, len(terms), OUT_ROWS):
                part = terms[i : i + OUT_ROWS]
                size = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.int64()), size), pa.repeat(pa.scalar(group, pa.int64()), size), pa.array(part, pa.binary()),
                        pa.array([n[t] for t in part], pa.int64()), pa.array([df[t] for t in part], pa.int64()),
                    ],
                    names=["lang_key", "group_key", "term", "n", "df"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, group, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, df = held.setdefault((lang, group), (Counter(), Counter()))
                before, seen = len(n), set()
                for terms in pieces_of(text, _AS_TERMS):
                    n.update(terms)
                    seen.update(terms)
                df.update(seen)
                size += len(n) - before
                if size >= HELD_TERMS:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    return texts.mapInArrow(in_worker(count), "lang_key long, group_key long, term binary, n long, df long")


def keyed_groups(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with 64-bit keys for language and group, and the table of groups.

    The seed of the keys is the first under which no two languages or groups share one.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    named = documents.select(empty("lang"), empty("source"), empty("text"))
    pairs = stored(named.select("lang", "source").distinct(), "divergence-groups")
    for seed in range(16):
        lang_key, group_key = F.xxhash64(F.lit(seed), "lang"), F.xxhash64(F.lit(seed), "lang", F.lit("\0"), "source")
        groups = pairs.select(lang_key.alias("lang_key"), group_key.alias("group_key"), "lang", "source")
        shared = groups.groupBy("group_key").count().where("count > 1").isEmpty()
        if shared and groups.select("lang_key", "lang").distinct().groupBy("lang_key").count().where("count > 1").isEmpty():
            return named.select(lang_key.alias("lang_key"), group_key.alias("group_key"), F.col("text").cast("binary").alias("text")), groups
    raise RuntimeError("no seed gives every language and group a key of its own")


def counted_terms(partial: DataFrame, min_documents: int, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept terms per language, their counts per group, and the string of each kept digest (null
    if it stands for several terms).

    A term is (digest, split): `split` is empty unless the digest stands for several terms.
    """
    digest = F.xxhash64("term") if bits >= 64 else F.xxhash64("term").bitwiseAND((1 << bits) - 1)
    partial = partial.withColumn("digest", digest)
    keys = ["lang_key", "digest"]
    none = F.lit(None).cast("binary").alias("split")
    counts = stored(partial.groupBy("lang_key", "group_key", "digest").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "divergence-counts")
    per_lang = lambda c, by: c.groupBy(*by).agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).where(F.col("df") >= min_documents)
    kept = stored(per_lang(counts, keys).drop("df"), "divergence-kept")

    # Only a digest in enough documents can stand for a kept term, so only their strings travel:
    # a bit filter sorts out nearly all others before the join does.
    likely = partial.where(may_hold(filter_of(kept, "digest", FILTER_BITS), F.col("digest"), FILTER_BITS))
    # Counting them takes a hash table; a least and a largest string would have all rows sorted.
    strings = stored(likely.select(*keys, "term").distinct().join(kept, keys, "left_semi"), "divergence-strings")
    several = strings.groupBy(*keys).count().where("count > 1").select(*keys)
    if several.isEmpty():
        kept = kept.select(*keys, none, "lang_n")
        in_groups = counts.select("group_key", *keys, none, "n")
    else:
        apart = partial.join(several, keys, "left_semi").groupBy("lang_key", "group_key", "digest", F.col("term").alias("split"))
        apart = stored(apart.agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "divergence-apart")
        alone = kept.join(several, keys, "left_anti").select(*keys, none, "lang_n")
        kept = stored(alone.unionByName(per_lang(apart, [*keys, "split"]).drop("df")), "divergence-kept")
        in_groups = counts.join(several, keys, "left_anti").select("group_key", *keys, none, "n")
        in_groups = in_groups.unionByName(apart.select("group_key", *keys, "split", "n"))
        strings = strings.join(several, keys, "left_anti").unionByName(several.select(*keys, F.lit(None).cast("binary").alias("term")))
    return kept, in_groups, strings


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exactly; 1 without terms."""
    wide = lambda c: c.cast("decimal(20,0)")
    exact = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + 1), wide(total + terms))
    return F.when(terms > 0, exact + 1).otherwise(F.lit(1)).cast("long")


def _excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of two shares; whole numbers up to 10^9 + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(
    documents: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, digest_bits: int = DIGEST_BITS
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each group (lang, source) differs.

    Terms are runs of letters (A-Z lower-cased, all other letters and signs above ASCII as they
    are) of whole texts. A language keeps the terms that are in at least `min_documents` of its
    rows. Part `pair` has a row for each other source of the language, with the divergence of the
    group's smoothed term shares from that source's, over all kept terms. Part `term` has the
    `top` terms that the group uses more than its language as a whole. Ranks start at 1 in each
    group and part, by value descending, then by item in the order of its UTF-8 bytes. All
    arithmetic is in whole numbers.

    Null text, lang and source count as empty text; a group without terms takes part in the
    pairs; a language without kept terms has pairs of value 0. Repeated rows count each; other
    columns are not read; an empty table gives an empty result.

    One scan of the texts adds up terms per task. Digests and counts are shuffled, strings only
    for digests in enough documents; terms with the same shares in the same groups are merged
    before pairs of sources are formed, and groups of a language are dealt to SALTS parts, so no
    task has to hold a language or a source.
    """
    bounded_batches(documents.sparkSession)
    texts, groups = keyed_groups(documents)
    partial = stored(partial_counts(texts), "divergence-partial")
    kept, in_groups, strings = counted_terms(partial, min_documents, digest_bits)

    # Terms are equal if digest and split are; a null split must equal a null split.
    same = ["lang_key", "digest", "split"]
    blank = lambda d: d.withColumn("split", F.coalesce("split", F.lit(b"").cast("binary")))
    used = stored(blank(in_groups).join(blank(kept), same), "divergence-used")
    langs = kept.groupBy("lang_key").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = used.groupBy("group_key").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = groups.join(totals, "group_key", "left").join(langs, "lang_key", "left")
    groups = groups.select("lang_key", "group_key", "lang", "source", zero("total"), zero("terms"), zero("lang_total"))
    groups = stored(groups.withColumn("p0", _share(F.lit(0), F.col("total"), F.col("terms"))), "divergence-totals")
    narrow = groups.select("lang_key", "group_key", "total", "terms", "lang_total", "p0")
    p = _share(F.col("n"), F.col("total"), F.col("terms")).alias("p")
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")
    shares = used.join(narrow, ["lang_key", "group_key"]).select("lang_key", "group_key", "digest", "split", "p0", p, q)
    shares = stored(shares, "divergence-shares")

    names = groups.select("group_key", "lang", "source")
    terms = _terms(shares, strings, top).join(names, "group_key")
    pairs = _pairs(shares, narrow).join(names, "group_key")
    other = groups.select(F.col("group_key").alias("other"), F.col("source").alias("item"))
    pairs = pairs.join(other, "other")
    order = Window.partitionBy("group_key").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", "rank"]
    return pairs.select(*columns("pair")).unionByName(terms.select(*columns("term")))


def _terms(shares: DataFrame, strings: DataFrame, top: int) -> DataFrame:
    """(group_key, item, value, rank) of the terms that a group uses most above its language.

    The least value of a group's result follows from counts of its distinct values, so strings
    are joined for the terms that reach it alone.
    """
    above = shares.where("p > q").select("lang_key", "group_key", "digest", "split", _excess(F.col("p"), F.col("q")).alias("value"))
    by_value = above.groupBy("group_key", "value").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("group_key").orderBy(F.desc("value"))
    largest = by_value.withColumn("at", F.row_number().over(order)).where(F.col("at") <= top)
    before = F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    least = largest.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
    least = least.groupBy("group_key").agg(F.min("value").alias("least"))
    near = above.join(least, "group_key").where("value >= least").join(strings, ["lang_key", "digest"])
    item = F.when(F.length("split") > 0, F.col("split")).otherwise(F.col("term")).cast("string")
    order = Window.partitionBy("group_key").orderBy(F.desc("value"), "item")
    named = near.select("group_key", item.alias("item"), "value")
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_key, other, value) for all ordered pairs of sources of a language.

    With p0 the share of a term that a group does not have, the sum over all kept terms is: all
    terms as if absent from both, plus the correction for the terms of either side, plus what is
    left over for terms that both have. The second follows from how often each share occurs in a
    group; only the third needs terms of two groups together.
    """
    left = groups.select("lang_key", "group_key", "p0", "terms")
    left = left.withColumn("salt", F.pmod("group_key", F.lit(SALTS)).cast("int"))
    right = groups.select("lang_key", F.col("group_key").alias("other"), F.col("p0").alias("q0"))
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = left.join(right, ["lang_key", "salt"]).where("group_key <> other")
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    absent = pairs.select("group_key", "other", (F.col("terms") * _excess(p0, q0)).alias("value"))

    often = shares.groupBy("lang_key", "group_key", "p0", "p").agg(F.count(F.lit(1)).alias("n"))
    often = often.withColumn("salt", F.pmod("group_key", F.lit(SALTS)).cast("int"))
    sides = often.join(right, ["lang_key", "salt"]).where("group_key <> other")
    n = F.col("n")
    ours = sides.select("group_key", "other", (n * (_excess(p, q0) - _excess(p0, q0))).alias("value"))
    theirs = sides.select(F.col("other").alias("group_key"), F.col("group_key").alias("other"), (n * (_excess(q0, p) - _excess(q0, p0))).alias("value"))

    # Terms with the same shares in the same groups differ in nothing that counts here.
    entry = F.struct("group_key", "p", "p0")
    profiles = shares.groupBy("lang_key", "digest", "split").agg(F.sort_array(F.collect_list(entry)).alias("profile"))
    profiles = profiles.where(F.size("profile") > 1).groupBy("profile").agg(F.count(F.lit(1)).alias("n"))
    both = profiles.select("n", "profile", F.explode("profile").alias("a")).select("n", "a", F.explode("profile").alias("b"))
    both = both.where("a.group_key <> b.group_key")
    a, a0, b, b0 = F.col("a.p"), F.col("a.p0"), F.col("b.p"), F.col("b.p0")
    rest = _excess(a, b) - _excess(a, b0) - _excess(a0, b) + _excess(a0, b0)
    both = both.select(F.col("a.group_key").alias("group_key"), F.col("b.group_key").alias("other"), (n * rest).alias("value"))
    added = lambda d: d.groupBy("group_key", "other").agg(F.sum("value").alias("value"))
    return added(absent.unionByName(added(ours)).unionByName(added(theirs)).unionByName(added(both)))


def oracle() -> str:
    """The same audit as DuckDB SQL, over the terms themselves and every kept term of every pair."""
    share = lambda n, total, v: f"(1 + ({SCALE}::HUGEINT * ({n} + 1)) // ({total} + {v}))"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS w FROM documents
),
term AS MATERIALIZED (SELECT id, lang, source, unnest(w) AS term FROM docs),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS lang_n FROM term GROUP BY ALL HAVING count(DISTINCT id) >= {MIN_DOCUMENTS}
),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM term SEMI JOIN kept USING (lang, term) GROUP BY ALL
),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
every AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    {share("coalesce(c.n, 0)", "coalesce(t.total, 0)", "l.v")} AS p,
    {share("k.lang_n", "l.lang_total", "l.v")} AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM every a JOIN every b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM every WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= {TOP_TERMS}
"""
