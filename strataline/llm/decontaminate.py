"""Benchmark decontamination by spaced-seed hashing with substitution-tolerant verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.caches import in_worker
from strataline.llm.storage import bounded_batches, free_name, row_key, stored
from strataline.llm.words import window_hashes, word_hashes

#: Word offsets that each fixed mask looks at; the positions between are ignored. One of them meets
#: only equal words in every 10 words with up to 2 changed and every 15 with up to 3, so in every
#: overlap: a longer one falls into parts of 10 to 19 words, and one part is as equal as the whole.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 4, 6, 7, 8), (0, 2, 4, 5, 6, 7), (0, 1, 2, 3, 8, 9), (0, 1, 3, 4, 5, 7))
#: An overlap has at least this many aligned words (or the whole item, if it is shorter) ...
MIN_WORDS = 10
#: ... of which at least this share is equal.
MIN_EQUAL = 0.8
#: Up to so many distinct item seeds (16 MB) go to every task, which sorts out all other training
#: seeds before they become rows; with more, all training seeds are joined.
LISTED_SEEDS = 1 << 21

_SEED = pa.schema([("seed", pa.int64()), ("position", pa.int32())])


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks from end to end of an item of n words that is too short for the fixed ones.

    From 5 words on one inner word may be changed: each inner word is ignored by one mask.
    """
    if n < 5:
        return [tuple(range(n))]
    parts = 3 if n == 5 else 2  # so that at least four words are looked at
    return [tuple(i for i in range(n) if i in (0, n - 1) or i % parts != k) for k in range(parts)]


def masks_for(short_lengths: list[int]) -> list[tuple[int, ...]]:
    """The fixed masks, and those of each length of items that are shorter than an overlap."""
    return [*MASKS, *(m for n in sorted(short_lengths) for m in short_masks(n))]


def item_masks(masks: list[tuple[int, ...]], n: int) -> list[tuple[int, ...]]:
    """The same masks for an item of n words; those of other lengths find no window in it."""
    short = n < MIN_WORDS
    return [m if (k >= len(MASKS) and m[-1] == n - 1 if short else k < len(MASKS)) else (0, n) for k, m in enumerate(masks)]


def seeds(words: np.ndarray, masks: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of all masks over a word sequence."""
    found = [window_hashes(words, m) ^ np.uint64(k) for k, m in enumerate(masks)]
    return np.concatenate(found), np.concatenate([np.arange(len(f)) for f in found])


def shared_diagonals(document: np.ndarray, item: np.ndarray, masks: list[tuple[int, ...]]) -> np.ndarray:
    """The diagonals (document position less item position) on which some mask meets equal words.

    Memory is a byte per word of both, however often the words repeat.
    """
    marks = np.zeros(len(document) + len(item) + 1, bool)
    for mask in item_masks(masks, len(item)):
        theirs = window_hashes(item, mask)
        if not len(theirs):
            continue
        ours = window_hashes(document, mask)
        order = np.argsort(theirs, kind="stable")
        first = np.searchsorted(theirs[order], ours, side="left")
        places = np.searchsorted(theirs[order], ours, side="right") - first
        at, step = np.flatnonzero(places), 0
        while len(at):
            marks[at - order[first[at] + step] + len(item)] = True
            step += 1
            at = at[places[at] > step]
    return np.flatnonzero(marks) - len(item)


def overlap(document: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """(start in the document, aligned words, equal words) of the longest stretch on a diagonal
    (document position less item position) of which MIN_EQUAL is equal; starts and ends equal."""
    low, high = max(0, -diagonal), min(len(item), len(document) - diagonal)
    if low >= high:
        return 0, 0, 0
    equal = item[low:high] == document[low + diagonal : high + diagonal]
    # A stretch [i, j) qualifies if its gain is not negative; gains are kept as whole numbers.
    gain = np.concatenate([[0], np.cumsum(np.where(equal, round(100 * (1 - MIN_EQUAL)), -round(100 * MIN_EQUAL)))])
    lowest = np.minimum.accumulate(gain)
    starts = np.flatnonzero(np.diff(lowest, prepend=lowest[0] + 1) < 0)  # where a new low begins
    # For each end, the first start whose prefix is not above the end's is the leftmost new low.
    # Unequal words that follow a low lower it further, so the start moves on to the next equal word.
    order = np.searchsorted(-gain[starts], -gain[1:], side="left")
    usable = equal & (order < len(starts))
    ends = np.flatnonzero(usable) + 1
    if not len(ends):
        return 0, 0, 0
    same = np.flatnonzero(equal)
    firsts = same[np.searchsorted(same, starts[order[ends - 1]])]
    k = int((ends - firsts).argmax())
    first, end = int(firsts[k]), int(ends[k])
    return low + diagonal + first, end - first, int(equal[first:end].sum())


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, words): word hashes of each item; items without words are left out."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, word_hashes(t).tobytes()) for i, t in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True)]
            rows = [r for r in rows if r[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["item_id", "words"]
            )

    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return items.mapInArrow(in_worker(hashed, "words"), "item_id long, words binary")


def _item_seeds(items: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, data in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                words = np.frombuffer(data, np.uint64)
                found = np.unique(seeds(words, item_masks(masks, len(words)))[0]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array([item_id] * len(found), pa.int64())], names=["seed", "item_id"])

    return items.mapInArrow(in_worker(seeded, "words"), "seed long, item_id long").distinct()


def _listed(item_seeds: DataFrame) -> np.ndarray | None:
    """The distinct seeds in order; None if there are too many to send out."""
    distinct = item_seeds.select("seed").distinct()
    if distinct.count() > LISTED_SEEDS:
        return None
    return np.unique(np.array([r[0] for r in distinct.collect()], np.int64).view(np.uint64))


class SeedSet:
    """Finds the members of a sorted set of seeds among many: one bit by the low part, then a search."""

    def __init__(self, seeds: np.ndarray) -> None:
        self.seeds = seeds
        self.low = np.uint64((1 << max(16, int(16 * len(seeds)).bit_length())) - 1)
        self.marks = np.zeros(int(self.low) + 1, bool)
        self.marks[seeds & self.low] = True

    def positions(self, found: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.marks[found & self.low])
        where = np.minimum(np.searchsorted(self.seeds, found[at]), max(0, len(self.seeds) - 1))
        return at[self.seeds[where] == found[at]] if len(self.seeds) else at[:0]


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row_key, doc_id, item_id, start_word, n_words, n_equal): the longest verified overlap of each
    document row with each benchmark item.

    Takes `doc_id`, `text` of the documents and `item_id`, `text` of the benchmark; other columns
    are not read. Null, empty and wordless texts overlap with nothing. Items of under MIN_WORDS
    words are looked for as a whole. Repeated document rows are reported once (row_key is a hash of id
    and text); items with equal id are reported as one, with their longest overlap. A null
    doc_id is reported as null. An empty table on either side gives an empty result.

    Both sides are hashed under the masks; the items' seeds, of checked number, leave few training
    seeds in each task, and these are joined with the items' seeds by value. Only documents with
    such a seed are shuffled, as word hashes.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    items = stored(benchmark_items(benchmark), "items")
    length = F.length("words") / 8
    short = items.where(length < MIN_WORDS).select(length.cast("int").alias("n")).distinct().collect()
    masks = masks_for([r[0] for r in short])  # under MIN_WORDS lengths
    item_seeds = stored(_item_seeds(items, masks), "item-seeds")
    listed = _listed(item_seeds)
    schema = pa.schema([("row_key", pa.binary()), ("doc_id", pa.int64()), ("words", pa.binary()), ("seeds", pa.list_(pa.int64()))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if listed is None else SeedSet(listed)
        for batch in batches:
            rows = []
            texts = [word_hashes(t) for t in batch[2].to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            ends = np.cumsum(sizes)
            if not len(ends) or not ends[-1]:
                continue
            joined = np.concatenate(texts)
            end_of = np.repeat(ends, sizes)  # for each position, where its document ends
            hits: list[tuple[np.ndarray, np.ndarray]] = []
            for k, mask in enumerate(masks):
                found = window_hashes(joined, mask) ^ np.uint64(k)
                at = np.arange(len(found)) if known is None else known.positions(found)
                at = at[at + mask[-1] < end_of[at]]
                hits.append((at, found[at]))
            at = np.concatenate([h[0] for h in hits])
            found = np.concatenate([h[1] for h in hits]).view(np.int64)
            owner = np.searchsorted(ends, at, side="right")
            order = np.argsort(owner, kind="stable")
            found, owner = found[order], owner[order]
            keys, doc_ids = batch[0].to_pylist(), batch[1].to_pylist()
            for d in np.unique(owner):
                own = slice(*np.searchsorted(owner, [d, d + 1]))
                rows.append((keys[d], doc_ids[d], texts[d].tobytes(), np.unique(found[own])))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = documents.select(row_key().alias("row_key"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kind = "row_key binary, doc_id long, words binary, seeds array<long>"
    hits = stored(rows.mapInArrow(in_worker(search, "words"), kind), "seed-hits")
    # A pair of a document and an item is a candidate once, however many of its seeds it shares; where
    # they lie is worked out again from the words of both, which travel once per pair.
    single = hits.select("row_key", F.explode("seeds").alias("seed"))
    candidates = single.join(item_seeds, "seed").select("row_key", "item_id").distinct()
    texts = hits.select("row_key", "doc_id", "words").groupBy("row_key").agg(F.first("doc_id").alias("doc_id"), F.first("words").alias("words"))
    pairs = candidates.join(items.withColumnRenamed("words", "item_words"), "item_id").join(texts, "row_key")
    verified_schema = pa.schema([("row_key", pa.binary()), *((c, pa.int64()) for c in ("doc_id", "item_id", "start_word", "n_words", "n_equal"))])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):  # a row at a time: words may be long
                key, doc_id, item_id, words, item = (c[k] for c in batch.columns)
                words, item = (np.frombuffer(w.as_py(), np.uint64) for w in (words, item))
                tried = (overlap(words, item, d) for d in shared_diagonals(words, item, masks).tolist())
                start, n, equal = max(tried, key=lambda o: (o[1], o[2], -o[0]), default=(0, 0, 0))
                if n >= min(MIN_WORDS, len(item)):
                    rows.append((key.as_py(), doc_id.as_py(), item_id.as_py(), start, n, equal))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, verified_schema, strict=True)], schema=verified_schema)

    pairs = pairs.select("row_key", "doc_id", "item_id", "words", "item_words")
    found = pairs.mapInArrow(in_worker(verify, "words"), "row_key binary, doc_id long, item_id long, start_word long, n_words long, n_equal long")
    best = F.max(F.struct("n_words", "n_equal", (-F.col("start_word")).alias("start"))).alias("best")
    found = found.groupBy("row_key", "doc_id", "item_id").agg(best)
    return found.select(
        "row_key", "doc_id", "item_id", (-F.col("best.start")).alias("start_word"), "best.n_words", "best.n_equal"
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `documents` that overlap with no benchmark item, with all their columns.

    Null, empty and wordless texts stay, repeated rows stay or go together; with an empty
    benchmark all rows stay, and an empty table stays empty.
    """
    key = row_key()
    name = free_name(documents, "row_key")
    found = contaminated(documents, benchmark).select(F.col("row_key").alias(name)).distinct()
    return documents.withColumn(name, key).join(found, name, "left_anti").drop(name)
