"""The operators' plain parts against brute force: no Spark session."""

from __future__ import annotations

import hashlib
import io
import random
import re
import struct
from array import array
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from strataline.llm import decontaminate, embeddings, jaccard, licenses, packing, pii, quality, token_files, toxicity, warc
from strataline.llm.components import local_roots
from strataline.llm.tokenization import ChunkEncoder, in_groups
from strataline.llm.words import shingle_set, window_hashes, word_hashes

ODD_TEXTS = [
    "", " ", "  ", "a  b", "a\n\nb", " a", "a ", "a\n", "\na", "\n\n\nx y", "x \n y", "\tq w", "a\r\nb c", "  　x",
    "İx \x1c y ΑΣ Σ.", "é́ ́a", "ÀÉ ß Straße", "<|endoftext|> a b<|endoftext|>", "it's  they'll", "x" * 300 + " y",
]


@pytest.fixture(scope="module", params=[("byte_bpe_50k.json", "space_leads"), ("word_bpe_49k.json", "spaces_dropped")])
def chunked(request):
    name, style = request.param
    return ChunkEncoder(name, style)


def whole(encoder: ChunkEncoder, text: str) -> bytes:
    return array("I", encoder.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def test_chunks_encode_as_whole_texts(chunked):
    assert chunked.encode(ODD_TEXTS) == [whole(chunked, t) for t in ODD_TEXTS]
    assert chunked.encode([None]) == [b""]
    assert chunked.encode([]) == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é.\n\t'1ñ中 "), max_size=60))
def test_any_text_encodes_as_a_whole(text):
    for name, style in (("byte_bpe_50k.json", "space_leads"), ("word_bpe_49k.json", "spaces_dropped")):
        encoder = _encoders.setdefault(name, ChunkEncoder(name, style))
        assert encoder.encode([text]) == [whole(encoder, text)]


_encoders: dict[str, ChunkEncoder] = {}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abÅßÿªµ.'!<|\n 9"), max_size=60))
def test_letters_with_marks_encode_as_a_whole(text):
    for name, style in (("byte_bpe_50k.json", "space_leads"), ("word_bpe_49k.json", "spaces_dropped")):
        encoder = _encoders.setdefault(name, ChunkEncoder(name, style))
        assert encoder.encode([text]) == [whole(encoder, text)]


def test_new_words_go_to_the_model_alone(chunked, monkeypatch):
    text = "Zqxa\nvbnmk, plöf wrtz... Xyzzyq vbnmk"
    slowly = []
    for step in ("_bytes", "_bytes_joined"):
        monkeypatch.setattr(chunked, step, lambda some, step=getattr(chunked, step): slowly.extend(some) or step(some))
    assert chunked.direct
    assert chunked.encode([text]) == [whole(chunked, text)]
    assert set(slowly) <= {"Zqxa", ",", "..."}  # the first chunk, as it has no space before it, and marks
    monkeypatch.setattr(chunked, "direct", False)
    chunked.known.clear()
    assert chunked.encode([text]) == [whole(chunked, text)]


def test_batches_are_grouped_in_order(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"text": pa.array([f"{k}" * 10] * 2)}) for k in range(5)]
    monkeypatch.setattr("strataline.llm.tokenization.GROUP_CHARS", 2 * batches[0].nbytes)
    groups = list(in_groups(iter(batches)))
    assert [len(g) for g in groups] == [4, 4, 2]
    assert [t for g in groups for t in g[0].to_pylist()] == [f"{k}" * 10 for k in range(5) for _ in range(2)]
    assert list(in_groups(iter([]))) == []


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr("strataline.llm.tokenization.CACHE_ENTRIES", {"space_leads": 3})
    encoder = ChunkEncoder("byte_bpe_50k.json", "space_leads")
    texts = ["one two three four five", "six one two seven", "eight nine one"] * 3
    assert encoder.encode(texts) == [whole(encoder, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_windows_hold_every_piece_and_stay_below_capacity(sizes):
    sizes = np.array(sizes, np.int64)
    window = packing.balanced(sizes, 64)
    filled = np.bincount(window, weights=sizes) if len(sizes) else np.zeros(0)
    assert len(window) == len(sizes)
    assert (filled <= 64).all()


def test_differencing_balances_opposing_spreads():
    sizes = np.array([8, 7, 6, 5, 4])
    sums = np.bincount(packing.differencing(sizes, 2), weights=sizes)
    assert sorted(sums) == [14, 16]  # Karmarkar-Karp's known answer for this set
    many = np.random.default_rng(1).integers(1, 512, 500)
    for blocks in (False, True):
        sums = np.bincount(packing.differencing(many, 60, blocks), weights=many, minlength=60)
        assert sums.max() - sums.min() <= 16


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 2047, 2048, 2049, 10_000])
def test_cuts_cover_a_document_once(n):
    pieces = packing.cuts(n, 2048, 512)
    assert [i for a, k in pieces for i in range(a, a + k)] == list(range(n))
    assert all(0 < k <= 2048 and (k == 2048 or k <= 512) for _, k in pieces)


def test_shingles_and_windows():
    words = word_hashes("a b c d e f")
    assert len(shingle_set(words, 5)) == 2
    assert len(shingle_set(words[:3], 5)) == 1
    assert len(shingle_set(word_hashes(None), 5)) == 0
    assert window_hashes(words, (0, 2))[1] == window_hashes(word_hashes("b x d"), (0, 2))[0]
    assert window_hashes(words, (0, 2))[1] != window_hashes(word_hashes("d x b"), (0, 2))[0]


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard.least_matches()
    assert len(least) == jaccard.HASHES // jaccard.STEP
    random_ = np.random.default_rng(5)
    kept = trials = 0
    for _ in range(300):
        common = random_.integers(0, 1 << 62, 160, dtype=np.uint64)
        x = np.concatenate([common, random_.integers(0, 1 << 62, 20, dtype=np.uint64)])
        y = np.concatenate([common, random_.integers(0, 1 << 62, 20, dtype=np.uint64)])
        a, b = jaccard.minhash(x)[None], jaccard.minhash(y)[None]
        kept += len(jaccard.surviving(a, b, np.array([0]), np.array([0]), least))
        trials += 1
    assert kept == trials  # similarity 160 / 200
    far = np.stack([jaccard.minhash(random_.integers(0, 1 << 62, 100, dtype=np.uint64)) for _ in range(50)])
    a, b = np.triu_indices(50, 1)
    assert len(jaccard.surviving(far, far, a, b, least)) == 0


def test_shared_counts_equal_set_intersections():
    random_ = random.Random(2)
    sets = [np.unique(np.array(random_.sample(range(60), random_.randint(1, 40)), np.uint64)) for _ in range(12)]
    counts = jaccard._shared_counts(sets[:5], sets[5:], False)
    assert all(counts[i, j] == len(set(sets[i]) & set(sets[5 + j])) for i in range(5) for j in range(7))
    counts = jaccard._shared_counts(sets, sets, True)
    assert all(counts[i, j] == len(set(sets[i]) & set(sets[j])) for i in range(12) for j in range(12) if i != j)
    assert jaccard._shared(sets[0], sets[1]) == len(set(sets[0]) & set(sets[1]))


def test_local_roots_follow_chains():
    assert local_roots(6, np.array([5, 4, 3]), np.array([4, 3, 0])).tolist() == [0, 1, 2, 0, 0, 0]
    assert local_roots(2, np.zeros(0, int), np.zeros(0, int)).tolist() == [0, 1]


def _longest(document, item, diagonal):
    best = 0
    for i in range(len(item)):
        for j in range(i + 1, len(item) + 1):
            if i + diagonal < 0 or j + diagonal > len(document):
                continue
            equal = sum(item[k] == document[k + diagonal] for k in range(i, j))
            if 100 * equal >= round(100 * decontaminate.MIN_EQUAL) * (j - i) and item[i] == document[i + diagonal] and item[j - 1] == document[j - 1 + diagonal]:
                best = max(best, j - i)
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=14), st.lists(st.integers(0, 2), max_size=12), st.integers(-5, 8))
def test_overlap_is_the_longest_stretch(document, item, diagonal):
    start, n, equal = decontaminate.overlap(np.array(document, np.uint64), np.array(item, np.uint64), diagonal)
    # A stretch may lose unequal ends after it is found, so it can be shorter than the longest by them.
    assert n <= _longest(document, item, diagonal) or n == 0
    if n:
        inside = [document[k] == item[k - diagonal] for k in range(start, start + n)]
        assert inside[0] and inside[-1] and sum(inside) == equal and 100 * equal >= 80 * n
    if document and item == document and diagonal == 0:
        assert (start, n) == (0, len(item))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=40))
def test_overlap_loses_no_stretch_to_one_with_unequal_ends(equal):
    item = np.arange(len(equal), dtype=np.uint64)
    document = np.where(equal, item, item + 100)
    assert decontaminate.overlap(document, item, 0)[1] == _longest(document.tolist(), item.tolist(), 0)


def test_overlap_is_not_hidden_by_a_longer_cut_one():
    equal = np.array([*[1] * 9, *[0] * 6, 1, 1, 1, 0, 1, 1, 0, 1, 1, 1, *[0] * 6], bool)
    item = np.arange(len(equal), dtype=np.uint64)
    assert decontaminate.overlap(np.where(equal, item, item + 100), item, 0) == (15, 10, 8)


def _has_seed(n: int, changed: tuple[int, ...]) -> bool:
    """Whether an item of n words shares a seed, on its diagonal, with a text that has it so changed."""
    masks = decontaminate.masks_for(list(range(1, decontaminate.MIN_WORDS)))
    item = np.arange(1, n + 1, dtype=np.uint64)
    document = np.concatenate([[500], item, [501]]).astype(np.uint64)
    document[[i + 1 for i in changed]] += 1000
    known = set(zip(*(x.tolist() for x in decontaminate.seeds(item, decontaminate.item_masks(masks, n))), strict=True))
    return any((s, p - 1) in known for s, p in zip(*(x.tolist() for x in decontaminate.seeds(document, masks)), strict=True))


@pytest.mark.parametrize("n", range(1, 17))
def test_every_overlap_has_a_seed(n):
    for k in range(n // 5 + 1):
        assert all(_has_seed(n, changed) for changed in combinations(range(1, n - 1), k))


def test_longer_overlaps_have_a_seed():
    # With ends changed too: any longer overlap has a part of 10 to 19 words at 80 %, which has one of these.
    assert all(_has_seed(10, changed) for changed in combinations(range(10), 2))
    assert all(_has_seed(15, changed) for changed in combinations(range(15), 3))


def naive_base(text: str) -> list:
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = [int(d) * 2 for d in digits[-2::-2]]
        if 13 <= len(digits) <= 19 and (sum(d - 9 * (d > 9) for d in doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("a.@-+1 24(%é\n)"), max_size=50))
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == naive_base(text)


def _example_texts() -> list[str]:
    random_ = random.Random(4)
    out = []
    for k in range(120):
        digits = "".join(random_.choice("0123456789") for _ in range(15))
        card = next(digits + c for c in "0123456789" if pii.luhn(digits + c))
        out.append(f"word {k} call +1 (4{k % 10}4) 555-{1000 + k} or mail a{k}.b@mail{k % 9}.example.com, pay {card} from 10.0.{k}.7 today")
        out.append(f"order {digits[:7]} at 4.0 key = {digits}ab and 1{k}.5 kg")
    return out


def test_model_adds_spans_and_keeps_base_ones():
    texts = _example_texts()
    model = pii.train(texts)
    found = recovered = 0
    for text in texts:
        base = pii.base_spans(text)
        assert set(base) <= set(pii.all_spans(text, base, model))
        found += len(base)
        cuts = [pii.tokens(text, a, b) for a, b in pii.regions(text)]
        guessed = [s for cut in cuts for s in model.decode(text, cut, pii.candidates(text, cut))]
        recovered += len(set(base) & set(guessed))
    assert recovered > 0.9 * found
    spelled = "write joe [at] mail [dot] example [dot] com or call 415-555-1234 now"
    kinds = {k for k, _, _ in pii.all_spans(spelled, [], model)}
    assert "phone" in kinds
    assert pii.all_spans("version 1.2.3 of 2024-01-01, 12,345 items", [], model) == []
    assert pii.all_spans("", [], model) == []


def test_decoding_is_the_best_of_all_readings():
    model = pii.SemiMarkov()
    random_ = random.Random(9)
    text = "+1 (415) 555-1234 10.0.0.7"
    cut = pii.tokens(text, 0, len(text))
    found = pii.candidates(text, cut)
    for _ in range(20):
        names = {f for some in found.values() for *_, fs in some for f in fs}
        model.weights = {n: random_.uniform(-1, 1.4) for n in names}
        segments = [(i, j, k, model.score(f) - pii.MARGIN) for j, some in found.items() for i, k, f in some]

        @lru_cache
        def best(at: int, segments=tuple(segments)) -> float:
            if at >= len(cut):
                return 0.0
            return max([best(at + 1), *(v + best(j + 1) for i, j, _, v in segments if i == at)])

        spans = model.decode(text, cut, found)
        value = sum(v for i, j, k, v in segments if (k, cut[i][0], cut[j][1]) in spans)
        assert value == pytest.approx(best(0))


def test_redaction_replaces_every_span():
    assert pii.redacted("a b@c.de x +123456789", [("email", 2, 8), ("phone", 11, 21)]) == "a [EMAIL] x [PHONE]"
    assert pii.redacted("0123456789", [("card", 0, 5), ("phone", 3, 8)]) == "[CARD]89"
    assert pii.redacted("", []) == ""


def test_regions_are_bounded_in_time_on_long_runs():
    for text in ("a" * 200_000, "1" * 200_000, "@" * 20_000, "1 " * 50_000, "x." * 100_000):
        assert pii.base_spans(text) is not None
        assert all(a < b for a, b in pii.regions(text))


def test_long_runs_without_spaces_are_read_whole():
    model = pii.SemiMarkov({"phone": 3.0, "card": 2.5, "email": 4.0, "ip": 2.0})
    assert len(pii.all_spans("030-555-1234;" * 30, [], model)) == 30
    assert pii.all_spans("10.0.0.7-1", pii.base_spans("10.0.0.7-1"), model) == [("ip", 0, 8)]
    random_ = random.Random(12)
    parts = ["030-555-1234", "4111.1111.1111.1111", "joe(at)mail(dot)example", "a.b@c.org", "10.0.0.7", "中文字", "x" * 70, "name", ";", ",", '":"', "。", "²", "-", "["]
    for _ in range(60):
        text = "".join(random_.choice(parts) for _ in range(random_.randint(1, 250)))
        cut = pii.tokens(text, 0, len(text))
        whole_run = model.decode(text, cut, pii.candidates(text, cut))
        assert sorted(whole_run, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2])) == pii.all_spans(text, [], model)


def test_warc_round_trip_and_checks():
    dictionary = zstandard.train_dictionary(1024, [f"<html><body>{k} words of page {k}</body>".encode() * 3 for k in range(300)]).as_bytes()
    for d in (dictionary, b""):
        pack = zstandard.ZstdCompressor(**warc._options(d))
        records = [
            warc.record(1, "http://a/\r\nb", b"<html>x</html>", None, False),
            warc.record(2, None, b"<html>x</html>", 1, True),
            warc.record(None, "u", b"", None, False),
        ]
        data = warc.archive_head(d) + b"".join(map(pack.compress, records))
        back = [warc.parse(r) for r in warc.read_records(io.BytesIO(data))]
        digest = warc.digest_text(b"<html>x</html>")
        assert back[0] == (1, "http://a/%0D%0Ab", b"<html>x</html>", 14, digest, "response", None)
        assert back[1] == (2, None, None, 14, digest, "revisit", 1)
        assert back[2][:4] == (None, "u", b"", 0)
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_records(io.BytesIO(data[:-3])))
    assert list(warc.read_records(io.BytesIO(warc.archive_head(b"")))) == []
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(struct.pack("<II", 1, 0))))
    for broken in (records[0][:-1], records[0].replace(b"WARC/1.1", b"WARC/0.1"), records[0].replace(b"<html>x", b"<html>y")):
        with pytest.raises(ValueError):
            warc.parse(broken)
    assert digest == __import__("base64").b32encode(hashlib.sha1(b"<html>x</html>").digest()).decode()


def test_dictionary_of_few_or_no_samples():
    assert token_files.trained([]) == b""
    assert token_files.trained([b"abcd"]) == b"abcd"
    assert token_files.compression(b"") == {}


def test_factorization_machine_learns_pairs():
    random_ = np.random.default_rng(3)
    rows, labels = [], []
    for _ in range(1200):  # neither term alone is telling, both together are
        a, b = random_.integers(0, 2, 2)
        rows.append(np.array([t for t, x in ((10, a), (20, b), (30 + int(random_.integers(0, 5)), 1)) if x], np.int32))
        labels.append(int(a and b))
    machine = toxicity.fit(rows, np.array(labels, np.int32))
    score = lambda terms: machine.score(np.array([machine.column[t] for t in terms if machine.column[t] >= 0], np.int32))
    assert score([10, 20]) > 0.9 > 0.1 > max(score([10]), score([20]), score([]))


def test_factorization_machine_without_two_classes():
    assert toxicity.fit([], np.zeros(0, np.int32)).score(np.zeros(0, np.int32)) == pytest.approx(0.5)
    some = [np.array([1], np.int32)] * 3
    assert toxicity.fit(some, np.zeros(3, np.int32)).score(np.zeros(0, np.int32)) < 0.5


def test_quality_counts_and_ratios():
    counts = quality.bucket_counts("a b a b")
    assert counts.sum() == 4 + 3
    assert quality.bucket_counts(None).sum() == 0
    same = quality.log_ratios(counts.astype(float), counts.astype(float))
    assert np.allclose(same, 0)


def test_quantisation_bounds_hold():
    random_ = np.random.default_rng(8)
    x = random_.standard_normal((200, 70))
    x[100:] = x[:100] + random_.standard_normal((100, 70)) * 0.18
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    codes, scale, error = embeddings.quantised(unit)
    close = embeddings.code_products(codes, codes) * scale[:, None] * scale[None, :]
    bound = error[:, None] * (1 + error[None, :]) + error[None, :]
    assert (np.abs(close - unit @ unit.T) <= bound + 1e-12).all()
    at = np.arange(200)
    a, b = embeddings.links_in_square(unit, (codes, scale, error), at, at, 0.98)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(i, j) for i in range(200) for j in range(i + 1, 200) if unit[i] @ unit[j] >= 0.98}


def test_license_templates_are_words():
    assert licenses.template_pairs({"mit license": "mit"}, {}) == [(0, True, "mit", 1, 0, "mit", "license")]
    with pytest.raises(ValueError):
        licenses.template_pairs({"mit": "mit"}, {})


def test_a_worker_keeps_the_memories_of_one_operator():
    from strataline.llm import caches, tokenization, words

    path = "word_bpe_49k.json"
    assert list(caches.in_worker(lambda batches: batches, "words", "tokens")(iter([1]))) == [1]
    words.word_hashes("some words")
    kept = tokenization.encoder(path, "spaces_dropped")
    list(caches.in_worker(lambda batches: batches, "tokens")(iter(())))
    assert not words._KNOWN and tokenization.encoder(path, "spaces_dropped") is kept
    list(caches.in_worker(lambda batches: batches)(iter(())))
    assert tokenization.encoder.cache_info().currsize == 0


def test_sizes_as_spark_writes_them():
    from strataline.llm.storage import _number

    assert [_number(s) for s in ("512", "67108864b", "64m", "64MB", "1g", "-1")] == [512, 1 << 26, 1 << 26, 1 << 26, 1 << 30, -1]
