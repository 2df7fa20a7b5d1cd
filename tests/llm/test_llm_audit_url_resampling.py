"""Divergence audit, URL filters and target resampling against plain Python, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from strataline.llm import divergence, queries, resampling, url_filter

LONG = " ".join(f"Word{k % 977} é{k % 13}" for k in range(30_000))
EDGE = [
    (None, None, None, None), (None, "only the null id has these words", None, "s"), (1, "", "en", "s"), (1, "", "en", "s"),
    (2, "a b", "en", "t"), (2, "a b", "en", "t"), (2, "A B a", "en", "s"), (3, LONG, "de", "s"), (4, LONG + " end", "de", "t"),
    (5, " \n\t ", "de", "u"), (6, "!!! 12 ???", "fr", "s"), (7, "x" * 100_000 + " y", "en", "u"), (9, "\x00\x1fé中 中 1a", "en", "t"),
    (10, LONG, "de", "s"), (11, " ".join(["same"] * 50), "en", "s"), (12, " ".join(["same"] * 50), "en", "s"),
]


@pytest.fixture(scope="module")
def edge(spark):
    clash = "row_id long, digest string, n long, lang_key long, weight long, rank int, words string, value long"
    rows = [(i, t, lang, s, 1, "d", 2, 3, 4, 5, "w", 6) for i, t, lang, s in EDGE]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {clash}")


# --- URL filters -------------------------------------------------------------------------------


def plain_parts(url):
    rest = url.partition("://")[2] if url else ""
    host = re.match(r"[^/?#]*", rest).group()
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lowered, re.match(r"[^?#]*", rest[len(host) :]).group()


def plain_verdict(url, rules):
    host, path = plain_parts(url)
    best = None
    for rule_host, rule_path, verdict in rules:
        rule_host, rule_path = rule_host.lower(), rule_path or ""
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            key = (len(rule_host + rule_path), len(rule_host), verdict == "block")
            if best is None or key > best[0]:
                best = (key, rule_host + rule_path, verdict)
    return (host, path, best[1], best[2]) if best else (host, path, None, "allow")


URLS = [
    None, "", "example.com/en/", "http://", "://", "http://Example.COM/en/x?q#f", "https://www.example.com/en/", "http://a.www.example.com/en/a/b",
    "http://example.com", "http://com/", "http://com", "http://xcom/", "http://a.net/es/", "http://a.net/esx/", "ftp://net/fr/ä", "http://a..net/es/1",
    "http://example.com?x=/en/", "http://example.com#/en/", "http://u:p@example.com:80/en/", "http://example.com.", "http://éx.com/en//", "a://b://com/",
    "http://" + "a." * 3_000 + "com/" + "en/" * 30_000, "http://example.com/EN/",
]


def judged(spark, urls, rules):
    rows = [(i, u, 1, "x") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, row_id long, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, table).collect()}


def test_urls_get_the_longest_rule(spark):
    found = judged(spark, URLS, url_filter.RULES)
    assert found == {i: plain_verdict(u, url_filter.RULES) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("listed", [10_000, 0])
def test_many_rules_with_open_paths(spark, monkeypatch, listed):
    monkeypatch.setattr(url_filter, "LISTED_PREFIXES", listed)
    draw = random.Random(5)
    label = lambda: draw.choice(["a", "b", "www", "net", "com", "x1"])
    host = lambda n: ".".join(label() for _ in range(n))
    path = lambda: "".join(draw.choice(["/", "/en", "/e", "x", "/fr/"]) for _ in range(draw.randrange(4)))
    rules = {(host(draw.randrange(1, 4)), p, draw.choice(["allow", "block"])) for p in (path() for _ in range(200)) if p[:1] in ("", "/")}
    urls = [f"http://{host(draw.randrange(1, 5))}/{path()}"[: draw.randrange(8, 60)] for _ in range(400)] + ["http://hot.a.com/en/"] * 300
    found = judged(spark, urls, sorted(rules))
    assert found == {i: plain_verdict(u, sorted(rules)) for i, u in enumerate(urls)}


def test_a_shared_short_prefix_is_no_hit(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "PREFIX_DIGITS", 1)
    urls = [f"http://h{i}.com/{i}/" for i in range(300)]
    rules = [(f"h{i}.com", f"/{i}/", "block") for i in range(0, 300, 7)]
    assert judged(spark, urls, rules) == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_url_rules_that_do_not_count(spark):
    rules = [(None, "/", "block"), ("a.com", "x", "block"), ("b.com", "/", "maybe"), ("c.com", None, "allow"), ("c.com", "", "block"), ("C.com", "/", "block")]
    found = judged(spark, ["http://a.com/x", "http://b.com/", "http://c.com", "http://c.com/", "http://c.com/"], rules)
    assert [found[i][2:] for i in range(5)] == [(None, "allow"), (None, "allow"), ("c.com", "block"), ("c.com/", "block"), ("c.com/", "block")]
    assert judged(spark, ["http://a.com/"], rules[:3])[0] == ("a.com", "/", None, "allow")
    assert judged(spark, [], url_filter.RULES) == {}


def test_url_filter_has_no_python_in_its_plan(spark, data_folder):
    plan = queries.op12_url_filters(spark, data_folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


# --- target resampling -------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def plain_features(text):
    words = WORD.findall(lowered(text))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resampling(documents, target, percent=5, min_words=20):
    bucket = lambda run: zlib.crc32(run.encode()) % 10_000
    runs = [(i, *plain_features(t)) for i, t in documents]
    raw = Counter(bucket(r) for *_, found in runs for r in found)
    wanted = Counter(bucket(r) for t in target for r in plain_features(t)[1])
    all_raw, all_wanted = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (all_raw + 10_000) / ((raw[b] + 1) * (all_wanted + 10_000))))
    rows = []
    for i, n_words, found in runs:
        weight = sum(gain(bucket(r)) for r in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def sorted_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_resampling_matches_plain_python(spark, data_folder):
    engine = duckdb.connect()
    documents = engine.execute(f"SELECT doc_id, text FROM '{data_folder}/documents.parquet'").fetchall()
    target = [r[0] for r in engine.execute(f"SELECT text FROM '{data_folder}/benchmark.parquet'").fetchall()]
    assert sorted_rows(queries.op13_target_resampling(spark, data_folder)) == plain_resampling(documents, target)


def test_resampling_edge_rows(spark, edge):
    target = spark.createDataFrame([(1, "a b é中"), (2, None), (3, "")], "item_id long, text string")
    found = resampling.resample(edge, target, percent=50, min_words=2)
    expected = plain_resampling([(r[0], r[1]) for r in EDGE], ["a b é中", None, ""], 50, 2)
    assert sorted_rows(found) == expected
    nothing = resampling.resample(edge.limit(0), target)
    assert nothing.columns == ["doc_id", "n_features", "weight", "score", "rank"] and nothing.collect() == []
    without_target = resampling.resample(edge, target.limit(0), percent=50, min_words=2)
    assert sorted_rows(without_target) == plain_resampling([(r[0], r[1]) for r in EDGE], [], 50, 2)
    assert all(r["rank"] is None for r in resampling.resample(edge, target, percent=0).collect())


@pytest.mark.parametrize("block_words, block_bytes", [(100_000, 1 << 20), (3, 5), (1, 1)])
def test_any_vocabulary_and_block_size_gives_the_same_buckets(monkeypatch, block_words, block_bytes):
    monkeypatch.setattr(resampling, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block_bytes)
    draw = random.Random(3)
    known = ["the", "of", "é", "中中", "x" * 62, "y" * 63, "z" * 5_000, "a1", "q"]
    texts = [" ".join(draw.choice(known) for _ in range(draw.randrange(60))) for _ in range(20)] + ["", None, "One", "ONE two", "-"]
    pairs = [(a.encode(), b.encode()) for a in known for b in known]
    vocabularies = [resampling.Vocabulary.of([], []), resampling.Vocabulary.of([w.encode() for w in known[:6]], pairs[:40])]
    expected = defaultdict(Counter)
    for i, text in enumerate(texts):
        expected[i].update(zlib.crc32(r.encode()) % 10_000 for r in plain_features(text)[1])
    for vocabulary in vocabularies:
        found, words = defaultdict(Counter), Counter()
        for word_owner, owner, bucket in resampling.bucket_blocks([t and t.encode() for t in texts], vocabulary):
            words.update(word_owner.tolist())
            for i, b in zip(owner.tolist(), bucket.tolist(), strict=True):
                found[i][b] += 1
        assert {i: c for i, c in expected.items() if c} == dict(found)
        assert [words[i] for i in range(len(texts))] == [plain_features(t)[0] for t in texts]


def test_checksum_arithmetic():
    tables = resampling._shift_tables(63)
    draw = random.Random(1)
    for n in (0, 1, 5, 62, 63):
        a, b = draw.randbytes(9), draw.randbytes(n)
        moved = resampling._followed(np.array([zlib.crc32(a)], np.uint32), np.array([n]), tables)
        assert int(moved[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


# --- divergence audit --------------------------------------------------------------------------

TERM = re.compile(divergence.TERM)


def plain_divergence(rows, min_documents=3, top=200):
    by_group, documents = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall(lowered(text))
        by_group[lang or "", source or ""].update(found)
        documents[lang or ""].update(set(found))
    out = []
    for lang in documents:
        kept = [t for t, n in documents[lang].items() if n >= min_documents]
        groups = {s: c for (g, s), c in by_group.items() if g == lang}
        whole = sum(groups.values(), Counter())

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        shares, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s, p in shares.items():
            pair = [(sum((p[t] - o[t]) ** 2 // o[t] for t in kept), other) for other, o in shares.items() if other != s]
            term = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] and p[t] > q[t]]
            for part, items, limit in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(items[:limit], 1)]
    return sorted(out)


@pytest.mark.parametrize("bits, top, held", [(64, 200, 300_000), (64, 3, 50), (5, 200, 300_000), (1, 7, 50)])
def test_divergence_matches_plain_python(spark, data_folder, monkeypatch, bits, top, held):
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    documents = spark.read.parquet(f"{data_folder}/documents.parquet").where("doc_id < 60" if bits < 64 else "true")
    rows = [(r.text, r.lang, r.source) for r in documents.collect()]
    found = divergence.divergence(documents, top=top, digest_bits=bits)
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence(rows, top=top)


@pytest.mark.parametrize("bits", [64, 2])
def test_divergence_edge_rows(spark, edge, bits):
    found = divergence.divergence(edge, digest_bits=bits)
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence([r[1:] for r in EDGE])
    nothing = divergence.divergence(edge.limit(0))
    assert nothing.columns == ["lang", "source", "part", "item", "value", "rank"] and nothing.collect() == []


def test_divergence_sorts_no_strings_to_tell_digests_apart(spark, monkeypatch):
    plans, keep = [], divergence.stored
    explained = lambda d: d._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(divergence, "stored", lambda d, name: plans.append(explained(d)) or keep(d, name))
    rows = [(f"one two {w}", "en", s) for s in ("a", "b") for w in ("three", "four") for _ in range(3)]
    documents = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(tuple(r) for r in divergence.divergence(documents).collect()) == plain_divergence(rows)
    assert plans and not any("SortAggregate" in p for p in plans)


def test_divergence_ties_go_by_bytes(spark):
    rows = [(f"z é ü Z {w} {w}", "en", s) for s in ("a", "b") for w in ("ä", "b", "c", "B") for _ in range(2)] + [("only", "en", "c")] * 5
    documents = spark.createDataFrame(rows, "text string, lang string, source string")
    for top in (1, 2, 3, 200):
        found = divergence.divergence(documents, top=top)
        assert sorted(tuple(r) for r in found.collect()) == plain_divergence(rows, top=top)


def test_divergence_counts_beyond_ten_billion(spark):
    big = 10**12
    shares = spark.range(1).select(divergence._share(*(divergence.F.lit(v).cast("long") for v in (big - 1, 10 * big, 5 * big))).alias("p"))
    assert shares.first().p == 1 + 10**9 * big // (15 * big)
