"""Scores and keys recomputed in plain Python; long and repetitive inputs."""

from __future__ import annotations

import math
import re
import struct
from collections import Counter
from itertools import combinations

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from strataline.llm import decontaminate, pii, quality, queries, token_files, toxicity


@pytest.fixture(scope="module")
def tables(data_folder):
    engine = duckdb.connect()
    return {n: engine.execute(f"SELECT * FROM '{data_folder}/{n}.parquet'").fetchall() for n in ("documents", "labels")}


def test_toxicity_score_is_bias_weights_and_all_pairs(spark, data_folder, tables):
    documents, labels = (queries.table(spark, data_folder, n) for n in ("documents", "labels"))
    machine = toxicity.train(documents, labels)
    weights, factors = machine.weights.astype(float).tolist(), machine.factors.astype(float).tolist()
    assert len(weights) > 20

    def score(text):
        words = set(re.findall(r"\w+", (text or "").lower()))
        forms = {f for w in words for f in [w, *(f"^{w[:k]}" for k in (4, 5, 6) if len(w) >= k)]}
        columns = {int(machine.column[xxhash.xxh64_intdigest(f.encode()) % toxicity.BUCKETS]) for f in forms} - {-1}
        raw = machine.bias + sum(weights[c] for c in columns)
        raw += sum(sum(x * y for x, y in zip(factors[a], factors[b], strict=True)) for a, b in combinations(sorted(columns), 2))
        return 1 / (1 + math.exp(-max(-60, min(60, raw))))

    found = {r.doc_id: (r.score, r.predicted) for r in queries.op4_toxicity(spark, data_folder).collect()}
    for doc_id, text, *_ in tables["documents"]:
        expected = score(text)
        assert found[doc_id][0] == pytest.approx(expected, abs=1e-4)
        assert found[doc_id][1] == int(found[doc_id][0] >= 0.3)


MASK = (1 << 64) - 1


def plain_mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain_run(hashes):
    out = len(hashes)
    for h in hashes:
        out = (out * 0x9E3779B97F4A7C15 + h) & MASK
        out ^= out >> 29
    return plain_mixed(out)


def plain_buckets(text):
    hashes = [xxhash.xxh64_intdigest(u.encode()) for u in re.findall(r"\w+|[^\w\s]+", (text or "").lower())]
    runs = [hashes[i : i + n] for n in (1, 2) for i in range(len(hashes) - n + 1)]
    return Counter(plain_run(r) % quality.BUCKETS for r in runs)


def plain_key(doc_id, text):
    """Gumbel noise from the chained hash of id, text and seed."""
    h = 42
    for part in (struct.pack("<q", doc_id), (text or "").encode() if text is not None else None, struct.pack("<i", quality.SEED)):
        h = h if part is None else xxhash.xxh64_intdigest(part, seed=h)
    return -math.log(-math.log(((h >> 11) + 0.5) / 2**53))


def test_quality_weights_and_keys(spark, data_folder, tables):
    good = {i for i, q, _ in tables["labels"] if q == 1}
    buckets = {r[0]: plain_buckets(r[1]) for r in tables["documents"]}
    raw, target = Counter(), Counter()
    for doc_id, found in buckets.items():
        raw.update(found)
        if doc_id in good:
            target.update(found)

    def logs(counts):
        smooth = quality.SMOOTHING * max(sum(counts.values()) / quality.BUCKETS, 1.0)
        total = sum(counts.values()) + smooth * quality.BUCKETS
        return lambda b: math.log((counts[b] + smooth) / total)

    log_p, log_q = logs(target), logs(raw)
    texts = {r[0]: r[1] for r in tables["documents"]}
    rows = queries.op5_quality(spark, data_folder).collect()
    for r in rows:
        weight = sum(n * (log_p(b) - log_q(b)) for b, n in buckets[r.doc_id].items())
        assert r.log_weight == pytest.approx(weight, rel=1e-9, abs=1e-6)
        assert r.key == pytest.approx(weight + plain_key(r.doc_id, texts[r.doc_id]), rel=1e-9, abs=1e-6)
    k = round(len(good) / len(tables["labels"]) * len(rows))
    ranked = sorted((r.key for r in rows), reverse=True)
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in rows if r.key >= ranked[k - 1]}


def test_equal_rows_spread_over_shards(spark):
    hot = spark.range(6000).selectExpr("7L AS doc_id", "'the same text' AS text")
    others = spark.range(3000).selectExpr("id AS doc_id", "concat('text of ', id) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # shards this small would be joined
    try:
        files = token_files.write_token_files(hot.unionByName(others).repartition(6), "byte_bpe_50k.json", end_id=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = [n_docs for _, _, n_docs, *_ in files.shards]
    assert len(rows) == 4 and max(rows) < 2 * 9000 / 4
    read = token_files.read_token_files(spark, files)
    assert read.count() == 9000
    ends = read.select("start", (F.col("start") + F.col("n_tokens")).alias("end"))
    assert ends.agg(F.max("end")).first()[0] == read.agg(F.sum("n_tokens")).first()[0]
    assert ends.select("start").distinct().count() == 9000


def test_contamination_of_long_repetitive_texts(spark):
    """A long text that repeats an item's words has very many diagonals: its words travel once per item."""
    unit = [f"w{k}" for k in range(40)]
    item = " ".join(unit * 25)
    long_text = " ".join(unit * 2_500)
    texts = [(1, long_text), (2, "clean " + " ".join(f"v{k}" for k in range(100_000))), (3, " ".join(f"x{k}" for k in range(50)) + " " + " ".join(unit))]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, item + f" tail{i}") for i in range(12)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.start_word, r.n_words, r.n_equal) for r in decontaminate.contaminated(documents, benchmark).collect()}
    assert {k[0] for k in found} == {1, 3} and len(found) == 24
    assert all(found[(1, i)] == (0, 1000, 1000) for i in range(12))
    assert all(found[(3, i)] == (50, 40, 40) for i in range(12))


def test_a_very_long_text_goes_through_every_scan(spark):
    """20 MB in one text, among short ones."""
    words = " ".join(f"word{k % 9973} and" for k in range(1_400_000))
    documents = spark.createDataFrame([(1, words + " mail a.b@c.org"), (2, "short text"), (3, None)], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.find_personal_data(documents).collect()}
    assert "email" in spans[1] and spans[3] == ""
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(documents, labels).count() == 3
    assert quality.select_quality(documents, labels).count() == 3
