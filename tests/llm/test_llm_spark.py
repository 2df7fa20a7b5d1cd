"""The operators on Spark: edge cases with a defined result, and brute force on the smallest tables."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_llm_pure import naive_base
from tokenizers import Tokenizer

import corpus_pipeline
from strataline.llm import decontaminate, embeddings, jaccard, licenses, packing, pii, quality, queries, token_files, toxicity, warc
from strataline.llm.components import components
from strataline.llm.words import split_words

LONG = " ".join(f"word{k % 977}" for k in range(30_000))
#: Names that the operators use inside, as columns of the input.
CLASH = "row_key long, class string, score double, toxicity double, n long, start long, ids string"
EDGE = [
    (None, None), (None, "only the null id has these words here"), (1, ""), (1, ""), (2, "a b"), (2, "a b"), (3, LONG), (4, LONG + " end"),
    (5, " \n\t "), (6, "!!! ???"), (7, "the mit license, the MIT License and a.b@c.org"), (8, "the mit license, the MIT License and a.b@c.org"),
    (9, "\x00\x1fé中 +1 (415) 555-1234"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en", "s", len(t or ""), 7, "c", 0.5, 0.5, 1, 2, "x") for i, t in EDGE]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


@pytest.fixture(scope="module")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="module")
def tables(data_folder):
    engine = duckdb.connect()
    return {n: engine.execute(f"SELECT * FROM '{data_folder}/{n}.parquet'").fetchall() for n in ("documents", "benchmark", "pages", "embeddings", "labels")}


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 7 == 0)) for i in range(1, 60)] + [(1, None, None), (2, 5, 5), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def crc(ids) -> int:
    return zlib.crc32(array("I", ids).tobytes())


def test_packing_edges(spark, edge, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.pack_documents(edge, path).collect()
    expected = Counter((i, len(ids := tokenizer.encode(t or "", add_special_tokens=False).ids + [1]), crc(ids)) for i, t in EDGE)
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append((p.offset, p.length))
        assert len(p.ids) == 4 * p.length
    for some in windows.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(p.length for p in pieces) == sum(n * k for (_, n, _), k in expected.items())
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(i for i, _ in EDGE)
    assert packing.pack_documents(nothing, path).count() == 0


def test_packing_fills_windows(spark, data_folder):
    rows = queries.op1_packing(spark, data_folder).collect()
    total = sum(r.length for r in rows)
    assert total / (2048 * len({r.sequence_id for r in rows})) > 0.96


def test_token_files_round_trip(spark, edge, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    files = token_files.write_token_files(edge, path)
    back = token_files.read_token_files(spark, files).collect()
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for k, (_, t) in enumerate(EDGE)}
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in back) == Counter((EDGE[k][0], len(v), array("I", v).tobytes()) for k, v in ids.items())
    at = 0
    for r in sorted(back, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    in_order = [r.doc_id for r in sorted(back, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda i: (i is not None, i or 0))
    assert [x.tolist() for x in token_files.read_document(files, 7)] == [ids[10]]
    assert token_files.read_document(files, 99) == []
    empty = token_files.write_token_files(nothing, path)
    assert empty.shards == [] and token_files.read_token_files(spark, empty).count() == 0


def test_token_files_check_their_dictionary(spark, edge):
    files = token_files.write_token_files(edge.where("doc_id = 2"), public_tokenizers.path("byte_bpe_50k.json"))
    with pytest.raises(ValueError):
        token_files._open_shard(files.shards[0][1], b"another")


def brute_links(texts, threshold=0.8):
    sets = []
    for t in texts:
        w = split_words(t)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else None)
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s or ():
            holders[x].append(k)
    shared = Counter((a, b) for some in holders.values() for x, a in enumerate(some) for b in some[x + 1 :])
    return [(a, b) for (a, b), n in shared.items() if n / (len(sets[a]) + len(sets[b]) - n) >= threshold - 1e-12]


def brute_classes(ids, links):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    members = defaultdict(list)
    for k in range(len(ids)):
        members[find(k)].append(ids[k])
    degree = Counter(x for link in links for x in link)
    low = {k: min((i for i in some if i is not None), default=None) for k, some in members.items()}
    return Counter((ids[k], low[find(k)] if low[find(k)] is not None else ids[k], degree[k]) for k in range(len(ids)))


def near_copies(seed: int = 1) -> list[tuple[int, str]]:
    """A group of many near-copies, groups of few, and singles."""
    random_ = random.Random(seed)
    word = lambda: "".join(random_.choice("abcdefgh") for _ in range(4))
    rows = []
    for size in (40, 6, 3, 2, 1, 1):
        base = [word() for _ in range(random_.randint(30, 120))]
        for _ in range(size):
            text = list(base)
            for _ in range(random_.randint(0, 3)):
                text[random_.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_jaccard_join_against_brute_force(spark, tables, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BUCKET_BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", block)
    rows = near_copies() + [(1000 + r[0], r[1]) for r in tables["documents"]] if block == 1024 else near_copies()
    found = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    expected = brute_classes([i for i, _ in rows], brute_links([t for _, t in rows]))
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_jaccard_join_edges(spark, edge, nothing):
    found = Counter(tuple(r) for r in jaccard.jaccard_join(edge).collect())
    assert found == brute_classes([i for i, _ in EDGE], brute_links([t for _, t in EDGE]))
    assert jaccard.jaccard_join(nothing).count() == 0
    kept = jaccard.one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 5, 6, 7, 9]
    assert jaccard.one_of_each(nothing).count() == 0


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 200), (200, 100), (100, 100), (None, 5)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_toxicity_edges(spark, edge, nothing, labels):
    scored = toxicity.score_toxicity(edge, labels)
    rows = scored.collect()
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and len(rows) == len(EDGE)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert toxicity.score_toxicity(nothing, labels).count() == 0
    assert {r.score for r in toxicity.score_toxicity(edge, labels.limit(0)).collect()} == {0.5}
    assert toxicity.without_toxic(edge, labels).columns == edge.columns
    assert toxicity.without_toxic(edge, labels.limit(0)).count() == len(EDGE)


def test_toxicity_on_held_out_rows(spark, data_folder, labels):
    random_ = random.Random(6)
    rows, marks = [], []
    for i in range(900):
        toxic = int(random_.random() < 0.3)
        words = [random_.choice(["plain", "text", "of", "some", "words", "here", "more"]) for _ in range(60)]
        if toxic:
            words[random_.randrange(60)] = random_.choice(["scumbag", "scumlike", "scummy"])
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), dict(marks)
    scored = toxicity.score_toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).where("held_out").collect()
    assert sum(r.predicted == truth[r.doc_id] for r in scored) >= 0.97 * len(scored)


def test_toxicity_training_rows_are_bounded(spark, monkeypatch):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2][:40]
    rows = [(i, f"text of {i}") for i in ids] + [(ids[0], "text again")] * 3000
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda terms, marks: sizes.append(len(terms)))
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert sizes == [41]
    many = rows[:40] + [(ids[0], f"another text {k}") for k in range(3000)]
    toxicity.train(spark.createDataFrame(many, "doc_id long, text string"), labels, rows=50)
    assert 0 < sizes[1] <= 100


def test_quality_edges_and_share(spark, edge, nothing, labels, data_folder, tables):
    found = quality.select_quality(edge, labels)
    assert found.columns == ["doc_id", "log_weight", "key", "kept"] and found.count() == len(EDGE)
    assert quality.select_quality(nothing, labels).count() == 0
    assert all(r.kept and r.log_weight == 0 for r in quality.select_quality(edge, labels.limit(0)).collect())
    rows = queries.op5_quality(spark, data_folder).collect()
    good = {i for i, q, _ in tables["labels"] if q == 1}
    share = len(good) / len(tables["labels"])
    k = round(share * len(rows))
    bound = sorted((r.key for r in rows), reverse=True)[k - 1]
    assert all(r.kept == (r.key >= bound) for r in rows)
    mean = lambda some: sum(some) / len(some)
    bad = {i for i, q, _ in tables["labels"] if q == 0}
    assert mean([r.kept for r in rows if r.doc_id in good]) > mean([r.kept for r in rows if r.doc_id in bad])


@pytest.mark.parametrize("k", [0, 1, 5, 499, 500, 900])
def test_least_kept_is_exact(spark, k):
    random_ = random.Random(k)
    values = [random_.gauss(0, 1) ** 5 for _ in range(480)] + [0.25] * 20
    bound = quality.least_kept(spark.createDataFrame([(v,) for v in values], "key double"), "key", k)
    expected = None if k == 0 else float("-inf") if k >= 500 else sorted(values, reverse=True)[k - 1]
    assert bound == expected


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_MEMBERS", 16)
    monkeypatch.setattr(embeddings, "SQUARE", 5)
    random_ = np.random.default_rng(4)
    centres = random_.standard_normal((12, 20))
    rows = [(k, (centres[k % 12] + random_.standard_normal(20) * 0.09).tolist(), int(k % 3)) for k in range(120)]
    rows += [(200, rows[0][1], 0), (201, [2 * x for x in rows[0][1]], 0), (202, rows[0][1], 1), (203, rows[0][1], None)]
    rows += [(204, None, 0), (205, [], 0), (206, [0.0] * 20, 0), (207, [float("nan")] * 20, 0), (208, [None] * 20, 0)]
    rows += [(209, [float("inf")] + [1.0] * 19, 0), (210, [1.0, 2.0], 0), (211, [1.0, 2.0], 0), (None, rows[1][1], 1), (1, rows[1][1], 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, class int")
    usable = [k for k, (_, v, lab) in enumerate(rows) if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in usable}
    links = [(a, b) for x, a in enumerate(usable) for b in usable[x + 1 :] if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    expected = brute_classes([r[0] for r in rows], links)
    found = embeddings.near_duplicates(df).collect()
    assert Counter((r.vec_id, r.component_id, r.n_links) for r in found) == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_licenses_edges(spark, edge, nothing):
    rows = {(r.doc_id, r.n_words): r for r in licenses.scan_licenses(edge).collect()}
    lower = str.maketrans(licenses.UPPER, licenses.LOWER)
    assert set(rows) == {(i, len(re.findall(licenses.WORD, (t or "").translate(lower)))) for i, t in EDGE}
    r = rows[7, 11]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (2, 1, 4, "mit", "mit", 1.0)
    r = rows[1, 0]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (0, None, None, "", "", 0.0)
    assert licenses.scan_licenses(nothing).count() == 0


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Permission is hereby granted, free of charge, to ANY person obtaining a copy of this software and associated documentation files", "mit"),
        ("permission is hereby granted free of any charge to any person obtaining a copy of this software and associated documentation files", "mit"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("x licensed under the apache license, version 2.0 y", "apache"),
        ("mit the license", ""),
    ],
)
def test_license_notices(spark, text, labels):
    assert licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().labels == labels


@pytest.mark.parametrize(
    ("text", "label", "score"),
    [
        ("all rights all rights", "", 0.5),
        ("rights reserved rights reserved", "", 0.5),
        ("all rights all rights all rights all rights", "", 0.5),
        ("all rights reserved all rights reserved", "reserved", 1.0),
        ("cc by cc by cc by cc by 4", "", 0.4),
    ],
)
def test_license_notices_count_each_place_once(spark, text, label, score):
    row = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.labels, row.score) == (label, score)


def test_license_notices_with_one_changed_word(spark):
    rows, expected = [], {}
    for notice, label in licenses.NOTICES.items():
        words = notice.split()
        keys = [f"{a} {b}" in licenses.KEY_PAIRS for a, b in zip(words, words[1:], strict=False)]
        for k in range(len(words)):
            forms = [[*words[:k], "qq", *words[k + 1 :]], [*words[:k], *words[k + 1 :]]]  # replaced, left out
            if k:
                forms.append([*words[:k], "qq", *words[k:]])  # put in
            for kind, form in enumerate(forms):
                broken = range(max(0, k - 1), k if kind == 2 else min(k + 1, len(keys)))
                whole = {**licenses.BASE_PHRASES, **licenses.NOTICES}
                found = {n for p, n in whole.items() if p in " ".join(form)}
                left = 1 - len(broken) / len(keys)
                if left >= licenses.COVERAGE or (len(words) >= 5 and not any(keys[i] for i in broken)):
                    found.add(label)
                expected[len(rows)] = ",".join(sorted(found))
                rows.append((len(rows), " ".join(form)))
    scanned = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in scanned} == expected
    texts = ["licensed under the cc by 4 0", "licensed under cc by sa 4 0", "licensed under cc by nc sa 4 0", "licensed under cc by nd 4 0"]
    texts += ["licensed under the gnu general public license", "licensed with a creative commons attribution noncommercial"]
    scanned = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.labels for r in sorted(scanned)] == ["cc-by", "cc-by-sa", "", "", "gpl", "cc-by-nc"]


def test_licenses_with_many_templates(spark, edge, monkeypatch):
    listed = Counter(tuple(r) for r in licenses.scan_licenses(edge).collect())
    monkeypatch.setattr(licenses, "LISTED_PAIRS", 0)
    assert Counter(tuple(r) for r in licenses.scan_licenses(edge).collect()) == listed


def test_personal_data_edges(spark, edge, nothing, data_folder):
    rows = pii.find_personal_data(edge).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(EDGE)
    for r in rows:
        assert r.base == pii.joined(naive_base(r.text or ""))
        assert set(r.base.split(",")) <= set(r.spans.split(",")) | {""}
        assert r.redacted is None if r.text is None else "@c.org" not in r.redacted
    assert pii.find_personal_data(nothing).count() == 0
    out = pii.redact(edge)
    assert out.columns == edge.columns
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)
    for r in queries.op8_personal_data(spark, data_folder).join(spark.read.parquet(f"{data_folder}/documents.parquet"), "doc_id").collect():
        base = naive_base(r.text)
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert r.n_spans == len([x for x in r.spans.split(",") if x]) >= len(base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]


def test_archives(spark, tables):
    rows = [(i, u, h) for i, u, h in tables["pages"]]
    rows += [(900, "u", "same"), (901, None, "same"), (902, "u", "same"), (902, "u", "same"), (903, "u", None), (904, "u", ""), (None, "u", "same"), (None, "u", "alone")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    back = warc.read_archives(spark, warc.write_archives(pages)).collect()
    largest = defaultdict(list)
    for i, _, h in rows:
        largest[h or ""].append(i)
    largest = {h: max((i for i in some if i is not None), default=None) for h, some in largest.items()}
    expected = Counter()
    for i, _, h in rows:
        data, top = (h or "").encode(), largest[h or ""]
        again = top is not None and i != top
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected[i, len(data), digest, "revisit" if again else "response", top if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back) == expected
    assert all(bytes(r.payload).decode() in largest for r in back if r.record_type == "response")
    kept = warc.read_archives(spark, warc.write_archives(pages, revisit_bytes=5)).where("record_type = 'revisit'")
    assert kept.count() == 0
    assert warc.write_archives(pages.limit(0)) == [] and warc.read_archives(spark, []).count() == 0


def test_contamination(spark, edge, nothing, tables):
    items = tables["benchmark"]
    planted = " ".join(split_words(items[3][1]))
    swapped = planted.split()
    swapped[6::7] = ["changed"] * len(swapped[6::7])
    rows = [(r[0], r[1]) for r in tables["documents"]] + [(5000, f"so {planted} it"), (5001, " ".join(["x", *swapped, "y"])), (5002, "a tiny one"), (5003, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (77, "a tiny one"), (78, ""), (79, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    runs = defaultdict(set)
    for i, t in items:
        w = split_words(t)
        for k in range(len(w) - 9):
            runs[tuple(w[k : k + 10])].add(i)
    exact = {(d, i) for d, t in rows for w in [split_words(t)] for k in range(len(w) - 9) for i in runs.get(tuple(w[k : k + 10]), ())}
    assert exact <= found and (5001, items[3][0]) in found and (5002, 77) in found
    assert {d for d, _ in found - exact} <= {5001, 5002}
    left = decontaminate.without_contaminated(docs, bench)
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in found}
    assert decontaminate.contaminated(edge, bench).count() == 0
    assert decontaminate.contaminated(nothing, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_contaminated(edge, bench).columns == edge.columns


def test_contamination_at_the_tolerance(spark):
    items, rows = [], []
    for n in range(5, 17):
        words = [f"w{n}x{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        for k, changed in enumerate(combinations(range(1, n - 1), n // 5)):
            rows.append((1000 * n + k, " ".join(["a", *("other" if i in changed else w for i, w in enumerate(words)), "b"])))
        rows.append((1000 * n + 999, " ".join("other" if 0 < i < n // 5 + 2 else w for i, w in enumerate(words))))  # one too many
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    expected = {(i, i // 1000, 1, i // 1000, i // 1000 - i // 5000) for i, _ in rows if i % 1000 != 999}
    assert {(r.doc_id, r.item_id, r.start_word, r.n_words, r.n_equal) for r in found.collect() if r.doc_id % 1000 != 999 or r.doc_id < 10_000} == expected


def test_contamination_with_many_seeds(spark, tables, monkeypatch):
    docs = spark.createDataFrame([(r[0], r[1]) for r in tables["documents"]][:60], "doc_id long, text string")
    bench = spark.createDataFrame(tables["benchmark"], "item_id long, text string")
    listed = Counter(tuple(r) for r in decontaminate.contaminated(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "LISTED_SEEDS", 0)
    assert Counter(tuple(r) for r in decontaminate.contaminated(docs, bench).collect()) == listed


def test_pipeline_stages(spark, data_folder, edge, nothing):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "personal_data", "packing"]
    for start in (edge, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.stored(stage(spark, docs, data_folder), "test-stage")
            if name != "packing":
                assert out.columns == start.columns
                assert out.count() <= docs.count()
                docs = out
        tokens = sum(r.length for r in out.collect())
        assert tokens == sum({(r.doc_id, r.doc_tokens) for r in out.collect()} and [r.doc_tokens for r in out.where("start = 0").collect()] or [0])


def test_pipeline_over_documents(spark, data_folder, tables):
    pieces = corpus_pipeline.run(spark, data_folder).collect()
    ids = {p.doc_id for p in pieces}
    toxic = {i for i, _, t in tables["labels"] if t == 1}
    texts = {r[0]: r[1] for r in tables["documents"]}
    plain = [i for i in texts if i not in toxic]
    links = brute_links([texts[i] for i in plain])
    partner = {plain[b] for _, b in links} | {plain[a] for a, _ in links}
    leaks = {d for d in texts for i, t in tables["benchmark"] if " ".join(split_words(t)) in " ".join(split_words(texts[d]))}
    assert not ids & leaks
    assert not any(a in ids and b in ids for x, y in links for a, b in [(plain[x], plain[y])])
    labelled = {i for i, _, _ in tables["labels"]}
    clean = {i for i in plain if i in labelled} - partner - leaks
    assert len(clean & ids) >= 0.97 * len(clean)


def test_registered_queries_have_the_contract_columns(spark, data_folder):
    columns = {
        "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op3_token_files": "doc_id start n_tokens ids_crc32",
        "op4_toxicity": "doc_id held_out score predicted",
        "op6_near_embeddings": "vec_id n_links component_id kept",
        "op7_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
        "op8_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans n_spans",
        "op9_warc": "page_id payload_bytes payload_digest record_type refers_to",
        "op11_divergence_audit": "lang source part item value rank",
        "op12_url_filters": "page_id host path rule verdict",
        "op13_target_resampling": "doc_id n_features weight score rank",
    }
    for name, expected in columns.items():
        assert queries.QUERIES[name](spark, data_folder).columns == expected.split()


def test_licenses_agree_with_oracle(spark, data_folder):
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW documents AS SELECT * FROM '{data_folder}/documents.parquet'")
    found = queries.op7_licenses(spark, data_folder)
    expected = engine.execute(licenses.oracle())
    order = [d[0] for d in expected.description]
    key = lambda r: json.dumps(r)
    assert sorted(map(list, expected.fetchall()), key=key) == sorted(([r[c] for c in order] for r in found.collect()), key=key)
