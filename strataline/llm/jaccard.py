"""N-gram Jaccard similarity join with Bayesian candidate pruning over MinHash values.

Documents with the same words are one class and are compared once. Locality-sensitive bands
of MinHash values propose candidates; blocks of candidates are compared a few MinHash values
at a time, and a pair is dropped as soon as the posterior probability that its similarity
reaches the threshold falls below a tolerance; what remains is verified on whole shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.blocks import by_unit, crosses, in_blocks, squares, whole_units
from strataline.llm.caches import in_worker
from strataline.llm.components import components, local_roots
from strataline.llm.storage import bounded_batches, free_name, row_key, stored
from strataline.llm.words import mixed, shingle_set, word_hashes

WORDS = 5
THRESHOLD = 0.8
#: MinHash values per class: 25 bands of 5 propose a pair at 0.8 with probability 0.99995.
HASHES = 128
BANDS, BAND_ROWS = 25, 5
#: Values compared before each pruning decision, and the posterior below which a pair goes.
STEP = 16
TOLERANCE = 1e-6
#: Leading values that candidates are compared by before components are formed.
FIRST_HASHES = 32
#: Members of a block of a bucket, and members and shingles of a block of a component.
#: Larger ones are split into blocks whose pairs are separate work.
BUCKET_BLOCK = 1024
BLOCK_MEMBERS, BLOCK_SHINGLES = 2048, 1 << 20
#: Side of the squares in which a pair of blocks is compared.
SQUARE = 512

_rng = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """One 32-bit minimum per hash function over a set of shingles."""
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(shingles), 512):
        some = shingles[k : k + 512]
        hashed = (some[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]) >> np.uint64(32)
        out = np.minimum(out, hashed.min(axis=1).astype(np.uint32))
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of a signature."""
    rows = signature[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(BAND_ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, step: int = STEP) -> list[int]:
    """For each multiple n of `step`, the matches among n values below which a pair is dropped.

    With a uniform prior the similarity after m matches of n follows Beta(m+1, n-m+1), whose
    probability of reaching the threshold is that of at most m successes in n+1 draws.
    """
    least = []
    for n in range(step, HASHES + 1, step):
        reach, m = 0.0, -1
        while reach < tolerance:
            m += 1
            reach += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return least


def surviving(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Positions of the pairs (a, b) that no step of values drops."""
    kept = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for k, need in enumerate(least):
        at = slice(k * STEP, (k + 1) * STEP)
        if at.stop > left.shape[1]:
            break
        matches = matches + (left[a[kept], at] == right[b[kept], at]).sum(axis=1, dtype=np.int32)
        enough = matches >= need
        kept, matches = kept[enough], matches[enough]
    return kept


def _sketches(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, row_key, class, size, signature, bands): class is a digest of the words, null without any."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row_key", pa.binary()), ("class", pa.binary()), ("size", pa.int64()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = word_hashes(text)
                if not len(hashes):
                    rows.append((doc_id, key, None, 0, None, None))
                    continue
                shingles = shingle_set(hashes, words)
                signature = minhash(shingles)
                digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
                rows.append((doc_id, key, digest, len(shingles), signature.tobytes(), band_keys(signature)))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    kind = "doc_id long, row_key binary, class binary, size long, signature binary, bands array<long>"
    rows = documents.select(F.col("doc_id").cast("long"), row_key().alias("row_key"), F.col("text").cast("string"))
    return rows.mapInArrow(in_worker(sketch, "words"), kind)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, width)


def _pairs(unit: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a unit: across its two blocks, or within its one."""
    if not crosses(unit):
        return np.triu_indices(unit.num_rows, 1)
    second = np.array(unit["second"].to_pylist(), bool)
    a, b = np.meshgrid(np.flatnonzero(~second), np.flatnonzero(second), indexing="ij")
    return a.ravel(), b.ravel()


def _candidate_links(units: DataFrame, least: list[int]) -> DataFrame:
    """(a, b) class links that span what survives the first values in each unit."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[list, list] = ([], [])
        for group in whole_units(batches):
            if group.num_rows > 1:
                node = group["class"].to_pylist()
                head = _matrix(group["head"], FIRST_HASHES)
                a, b = _pairs(group)
                kept = surviving(head, head, a, b, least)
                root = local_roots(len(node), a[kept], b[kept])
                for k in np.flatnonzero(root != np.arange(len(node))):
                    found[0].append(node[k])
                    found[1].append(node[root[k]])
            if len(found[0]) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in found], schema=schema)
                found = ([], [])
        if found[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in found], schema=schema)

    return units.mapInArrow(in_worker(compare), "a binary, b binary")


def _links_in_square(
    sets: list[np.ndarray], signatures: np.ndarray, rows: np.ndarray, columns: np.ndarray, least: list[int], threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs with an exact similarity of at least the threshold."""
    if rows is columns:
        a, b = np.triu_indices(len(rows), 1)
    else:
        a, b = (x.ravel() for x in np.meshgrid(np.arange(len(rows)), np.arange(len(columns)), indexing="ij"))
    kept = surviving(signatures[rows], signatures[columns], a, b, least)
    a, b = a[kept], b[kept]
    if not len(a):
        return rows[a], columns[b]
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(a) < 4 * (len(rows) + len(columns)):
        both = np.fromiter(
            (_shared(sets[rows[x]], sets[columns[y]]) for x, y in zip(a, b, strict=True)), np.int64, len(a)
        )
    else:
        both = _shared_counts([sets[r] for r in rows], [sets[c] for c in columns], rows is columns)[a, b].astype(np.int64)
    links = both >= threshold * (sizes[rows[a]] + sizes[columns[b]] - both) - 1e-9
    return rows[a[links]], columns[b[links]]


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    merged = np.concatenate([x, y])
    merged.sort(kind="stable")
    return int(np.count_nonzero(merged[1:] == merged[:-1]))


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray], same: bool) -> np.ndarray:
    """The number of shingles each left set shares with each right set, by matrix products over
    slices of the shingles that occur on both sides."""
    common, seen = np.unique(np.concatenate(left), return_counts=True)
    if same:
        common = common[seen > 1]
    else:
        common = np.intersect1d(common, np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    for k in range(0, len(common), 4096):
        part = common[k : k + 4096]
        x = _indicator(left, part)
        out += x @ (x if same else _indicator(right, part)).T
    return out


def _indicator(sets: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    """Which shingles of the sorted vocabulary each set holds."""
    out = np.zeros((len(sets), len(vocabulary)), np.float32)
    for k, s in enumerate(sets):
        some = s[np.searchsorted(s, vocabulary[0]) : np.searchsorted(s, vocabulary[-1], "right")]
        at = np.searchsorted(vocabulary, some)
        out[k, at[vocabulary[np.minimum(at, len(vocabulary) - 1)] == some]] = 1
    return out


def _verified(units: DataFrame, least: list[int], words: int, threshold: float) -> DataFrame:
    """(a, b, n): verified links that span each unit, and with b null how many documents a class
    of the unit is linked to in it."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_units(batches):
            if group.num_rows < 2:
                continue
            node = group["class"].to_pylist()
            copies = np.array(group["copies"].to_pylist(), np.int64)
            signatures = _matrix(group["signature"], HASHES)
            sets = [shingle_set(word_hashes(t), words) for t in group["text"].to_pylist()]
            counts = np.zeros(len(node), np.int64)
            ends: tuple[list, list] = ([], [])
            for x, y in squares(group, SQUARE):
                a, b = _links_in_square(sets, signatures, x, y, least, threshold)
                np.add.at(counts, a, copies[b])
                np.add.at(counts, b, copies[a])
                root = local_roots(len(node), a, b)
                ends[0].append(np.flatnonzero(root != np.arange(len(node))))
                ends[1].append(root[ends[0][-1]])
            root = local_roots(len(node), np.concatenate(ends[0]), np.concatenate(ends[1]))
            rows = [(node[k], node[root[k]], 0) for k in np.flatnonzero(root != np.arange(len(node)))]
            rows += [(node[k], None, int(counts[k])) for k in np.flatnonzero(counts)]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return units.mapInArrow(in_worker(verify, "words"), "a binary, b binary, n long")


def _first() -> Column:
    """Orders rows by id, null last, then by row."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")


def jaccard_join(documents: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, class_id, n_links), one row per row of `documents`.

    Takes `doc_id` and `text`; other columns are not read. Two documents are linked when the
    sets of their runs of `words` words (lower case) have a Jaccard similarity of at least
    `threshold`; a text with fewer words is one run. class_id is the smallest doc_id that links
    reach, n_links the number of other rows linked directly, copies included. A null or wordless
    text links with nothing: its class_id is its own doc_id, n_links 0. Rows with equal words
    count as copies whatever their ids; a null doc_id takes part and is never a class_id unless
    its class has no other. An empty table gives an empty result.

    """
    return linked(documents, threshold, words, tolerance).select("doc_id", "class_id", "n_links")


def linked(documents: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, row_key, class_id, n_links, stays): `jaccard_join` with a hash of each row's id and
    text, and whether the row is the first of its class.

    Copies are one class before anything is compared. A bucket or component of any size is split
    into blocks, so a task holds two blocks; pairs never become rows, only spanning links and
    counts do. Texts are shuffled only for classes with a candidate.
    """
    bounded_batches(documents.sparkSession)
    least = least_matches(threshold, tolerance)
    sketches = stored(_sketches(documents, words), "sketches")
    classes = stored(
        sketches.where("class is not null")
        .groupBy("class")
        .agg(
            F.min(_first()).alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.first("size").alias("size"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    classes = classes.withColumn("row_key", F.col("first.row_key"))
    members = classes.select("class", F.explode("bands").alias("key"))
    crowded = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = members.join(crowded, "key")
    splits = F.ceil(F.col("n") / BUCKET_BLOCK)
    units = in_blocks(crowded, "key", "class", splits, "class")
    heads = classes.select("class", F.expr(f"substring(signature, 1, {4 * FIRST_HASHES})").alias("head"))
    links = _candidate_links(by_unit(units.join(heads, "class")), least)
    groups = components(links, "candidates")

    involved = groups.withColumnRenamed("node", "class").join(classes.drop("bands"), "class")
    weight = involved.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight"))
    involved = involved.join(weight, "root")
    splits = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("weight") / BLOCK_SHINGLES))
    units = in_blocks(involved, "root", "class", splits, "class", "copies", "signature", "row_key")
    # One row's text stands for a class. Only texts of classes with a candidate are kept.
    texts = documents.select(row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    texts = texts.join(involved.select("row_key"), "row_key", "left_semi").groupBy("row_key").agg(F.first("text").alias("text"))
    found = stored(_verified(by_unit(units.join(texts, "row_key")), least, words, threshold), "links")
    joined = components(found.where("b is not null").select("a", "b"), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))

    own = classes.select("class", "first", "copies").join(joined.withColumnRenamed("node", "class"), "class", "left")
    own = own.withColumn("root", F.coalesce("root", "class"))
    lowest = own.groupBy("root").agg(F.min("first").alias("lowest"))
    own = own.join(lowest, "root").join(counts, "class", "left")
    own = own.select("class", "lowest", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    return (
        sketches.select("doc_id", "row_key", "class")
        .join(own, "class", "left")
        .select(
            "doc_id",
            "row_key",
            F.coalesce("lowest.doc_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce(F.col("row_key") == F.col("lowest.row_key"), F.lit(True)).alias("stays"),
        )
    )


def one_of_each(documents: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """The rows of `documents`, of each class of near-copies the one with the smallest doc_id.

    All columns stay. Of rows with equal id and text one stays; a null or wordless text is a
    class of its own for each id and text.
    """
    name = free_name(documents, "row_key")
    staying = linked(documents, threshold, words).where("stays").select(F.col("row_key").alias(name))
    keyed = documents.withColumn(name, row_key()).dropDuplicates([name])
    return keyed.join(staying, name, "left_semi").select(*documents.columns)
