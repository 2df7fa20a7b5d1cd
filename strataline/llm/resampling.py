"""Importance resampling towards a target distribution, over hashed word runs.

The bucket of a run is a checksum of its text. A vocabulary of frequent words and pairs goes to
every task: the checksum of a run of frequent words follows from their states by arithmetic, and a
frequent pair has its bucket ready. Every other run takes the checksum of its bytes. Both ways give
the same bucket, so the vocabulary decides about speed alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.caches import in_worker
from strataline.llm.licenses import LOWER, UPPER, WORD, words_of
from strataline.llm.quality import least_kept
from strataline.llm.storage import bounded_batches, sampled, stored
from strataline.operators.ranking import Falling, global_index

#: Buckets, longest run, and who takes part in the draw.
BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS, PERCENT = 20, 5
SEED = 42

#: The vocabulary: so many frequent words and pairs, counted in about so many documents drawn by
#: hash. These bound what goes to every task (about 8 MB) and change no result.
HEAD_WORDS, HEAD_PAIRS, HEAD_ROWS = 1 << 16, 1 << 17, 10_000
#: Slots of the pair table (a pair whose slot is taken is left out), and the longest frequent word.
PAIR_SLOTS, HEAD_BYTES = 1 << 19, 62
#: Words worked on at a time, and bytes split at a time.
BLOCK_WORDS, BLOCK_BYTES = 100_000, 1 << 20

#: A-Z lower-cased; bytes that are in no word become blanks.
_AS_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_PAIR_MIX = np.int64(0x2545F4914F6CDD1D)


def _byte_steps() -> np.ndarray:
    """What the checksum's polynomial makes of each byte."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    return step


def _shift_tables(longest: int) -> np.ndarray:
    """For each length n and each byte of a checksum: what it becomes when n zero bytes follow."""
    step = _byte_steps()
    tables = np.zeros((longest + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, longest + 1):
        tables[n] = (tables[n - 1] >> np.uint32(8)) ^ step[tables[n - 1] & np.uint32(255)]
    return tables.reshape(-1)


def _followed(state: np.ndarray, length: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The part of a checksum that comes from the bytes before, when `length` bytes follow."""
    base = length.astype(np.int64) * 1024
    out = tables[base + (state & np.uint32(255))]
    for k in (1, 2, 3):
        out = out ^ tables[base + (k * 256) + ((state >> np.uint32(8 * k)) & np.uint32(255))]
    return out


def _slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((first * np.int64(HEAD_WORDS) + second) * _PAIR_MIX >> np.int64(20)) & np.int64(PAIR_SLOTS - 1)


@dataclass
class Vocabulary:
    """Checksum states of frequent words, alone and after a blank; buckets of frequent pairs."""

    words: dict[bytes, int]
    alone: np.ndarray
    after_blank: np.ndarray
    lengths: np.ndarray
    pair_keys: np.ndarray
    pair_states: np.ndarray
    pair_buckets: np.ndarray
    tables: np.ndarray

    @classmethod
    def of(cls, words: Sequence[bytes], pairs: Sequence[tuple[bytes, bytes]]) -> Vocabulary:
        words = [w for w in words if 0 < len(w) <= HEAD_BYTES][:HEAD_WORDS]
        ids = {w: i for i, w in enumerate(words)}
        keys = np.full(PAIR_SLOTS, -1, np.int64)
        states = np.zeros(PAIR_SLOTS, np.uint32)
        known = [(ids[a], ids[b], zlib.crc32(b"%b %b" % (a, b))) for a, b in pairs if a in ids and b in ids]
        if known:
            first, second, state = (np.array(c, np.int64) for c in zip(*known, strict=True))
            at, chosen = np.unique(_slots(first, second), return_index=True)
            keys[at] = (first * HEAD_WORDS + second)[chosen]
            states[at] = state[chosen].astype(np.uint32)
        crc = lambda lead: np.array([zlib.crc32(lead + w) for w in words], np.uint32)
        lengths = np.array([len(w) + 1 for w in words], np.int64)
        buckets = (states % BUCKETS).astype(np.uint16)
        return cls(ids, crc(b""), crc(b" "), lengths, keys, states, buckets, _shift_tables(HEAD_BYTES + 1))

    def buckets(self, words: list[bytes], place: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the last word, bucket) of all runs that end in a counted word.

        `place` is each word's number in its piece of text; no run crosses pieces.
        """
        n = len(words)
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, n)
        head = ids >= 0
        out_at, out_bucket = [], []

        def put(at: np.ndarray, bucket: np.ndarray) -> None:
            out_at.append(at)
            out_bucket.append(bucket.astype(np.int64))

        def direct(at: np.ndarray, size: int) -> None:
            """Checksums of the bytes of runs with a word that is not frequent."""
            crcs = (zlib.crc32(b" ".join(words[i - size + 1 : i + 1])) for i in at.tolist())
            put(at, np.fromiter(crcs, np.int64, len(at)) % BUCKETS)

        one = np.flatnonzero(head & counted)
        put(one, self.alone[ids[one]] % BUCKETS)
        direct(np.flatnonzero(~head & counted), 1)
        if n < 2:
            return np.concatenate(out_at), np.concatenate(out_bucket)

        # The state after each pair of frequent words, by its last word; counted or needed by a triple.
        pair = np.zeros(n, bool)
        pair[1:] = head[1:] & head[:-1] & (place[1:] >= 1)
        at = np.flatnonzero(pair)
        first, second = ids[at - 1], ids[at]
        slot = _slots(first, second)
        ready = self.pair_keys[slot] == first * HEAD_WORDS + second
        state = np.zeros(n, np.uint32)
        state[at[ready]] = self.pair_states[slot[ready]]
        rest = at[~ready]
        state[rest] = _followed(self.alone[ids[rest - 1]], self.lengths[ids[rest]], self.tables) ^ self.after_blank[ids[rest]]
        ends = counted[at]
        put(at[ready & ends], self.pair_buckets[slot[ready & ends]])
        rest = rest[counted[rest]]
        put(rest, state[rest] % BUCKETS)
        direct(np.flatnonzero(~pair & counted & (place >= 1)), 2)

        triple = np.zeros(n, bool)
        triple[2:] = pair[1:-1] & head[2:] & (place[2:] >= 2)
        at = np.flatnonzero(triple & counted)
        put(at, (_followed(state[at - 1], self.lengths[ids[at]], self.tables) ^ self.after_blank[ids[at]]) % BUCKETS)
        direct(np.flatnonzero(~triple & counted & (place >= 2)), 3)
        return np.concatenate(out_at), np.concatenate(out_bucket)


def pieces_of(text: bytes | None, table: bytes = _AS_WORDS) -> Iterator[list[bytes]]:
    """The words of a whole text, in lists of bounded size that are cut between words.

    `table` says what each byte becomes; words stand between blanks then.
    """
    if not text:
        return
    text = text.translate(table)
    start = 0
    while start < len(text):
        end = start + BLOCK_BYTES
        if end < len(text):
            cut = text.find(b" ", end)
            end = len(text) if cut < 0 else cut
        yield text[start:end].split()
        start = end


def bucket_blocks(texts: Sequence[bytes | None], vocabulary: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of words of whole texts: the text number of every counted word, and, for every
    run of one to three words, the text number and the bucket."""
    words: list[bytes] = []
    text_no, sizes, carried = [], [], []

    def block() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array(sizes, np.int64)
        owner = np.repeat(np.array(text_no, np.int64), size)
        place = np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size)
        counted = place >= np.repeat(np.array(carried, np.int64), size)
        at, bucket = vocabulary.buckets(words, place, counted)
        return owner[counted], owner[at], bucket

    for number, text in enumerate(texts):
        tail: list[bytes] = []
        for found in pieces_of(text):
            words += tail
            words += found
            text_no.append(number)
            sizes.append(len(tail) + len(found))
            carried.append(len(tail))
            tail = (tail + found)[1 - LONGEST_RUN :]
            if len(words) >= BLOCK_WORDS:
                yield block()
                words, text_no, sizes, carried = [], [], [], []
    if words:
        yield block()


def frequent(documents: DataFrame) -> Vocabulary:
    """The vocabulary of a bounded draw of documents."""
    some = stored(sampled(documents.select("text"), HEAD_ROWS, "text").select(words_of(F.col("text")).alias("w")), "resampling-head")
    top = lambda runs, n: [
        r[0].encode("utf-8", "surrogatepass")
        for r in runs.groupBy("run").count().orderBy(F.desc("count"), "run").limit(n).select("run").collect()
    ]
    short = lambda w: F.octet_length(w) <= HEAD_BYTES
    words = some.select(F.explode("w").alias("run")).where(short(F.col("run")))
    lasts = F.when(F.size("w") > 1, F.sequence(F.lit(1), F.size("w") - 1))
    pairs = some.select(F.explode(F.transform(lasts, lambda i: F.struct(F.get("w", i - 1).alias("a"), F.get("w", i).alias("b")))).alias("p"))
    pairs = pairs.where(short(F.col("p.a")) & short(F.col("p.b"))).select(F.concat_ws(" ", "p.a", "p.b").alias("run"))
    return Vocabulary.of(top(words, HEAD_WORDS), [tuple(p.split(b" ")) for p in top(pairs, HEAD_PAIRS)])


def bucket_totals(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How many runs of all texts fall in each bucket: added up in each task, then by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, bucket in bucket_blocks(batch[0].to_pylist(), vocabulary):
                total += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    counted = texts.select(F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(in_worker(count), "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        out[bucket] = n
    return out


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floored log ratio of the target's smoothed share over the raw one's, times 1,000."""
    all_raw, all_target = float(raw.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array(
        [math.floor(1000 * math.log((float(t) + 1) * all_raw / ((float(s) + 1) * all_target))) for s, t in zip(raw, target, strict=True)],
        np.int64,
    )


def weighed(texts: DataFrame, vocabulary: Vocabulary, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) for every row of (doc_id, text)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, runs, weight = (np.zeros(n, np.int64) for _ in range(3))
            for word_owner, owner, bucket in bucket_blocks(batch[1].to_pylist(), vocabulary):
                words += np.bincount(word_owner, minlength=n)
                runs += np.bincount(owner, minlength=n)
                np.add.at(weight, owner, gains[bucket])
            yield pa.RecordBatch.from_arrays(
                [batch[0], pa.array(words), pa.array(runs), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"]
            )

    binary = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return binary.mapInArrow(in_worker(weigh), "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: str) -> Column:
    """Gumbel noise that follows from the id alone, floored, times 1,000; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    documents: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of `documents`.

    Runs of one to three words of whole texts fall into BUCKETS by the checksum of their text. A
    bucket's gain is the log ratio of the smoothed shares it has in the texts of `target` and in
    those of `documents`; `weight` adds up the gains of a document's runs, repeats counted, and
    `score` adds Gumbel noise that follows from the id. Of the documents with at least
    `min_words` words, `percent` % (rounded down) with the largest scores are drawn; `rank`
    numbers them from 1, ties by the smaller doc_id (a null id first), and is null for others. A
    null, empty or wordless text has no runs and weight 0. Repeated rows take part each and get
    ranks of their own. Other columns are not read; an empty table gives an empty result; with an
    empty target, or an empty table, counts of 0 are smoothed as all others.

    Two scans of the texts, without a shuffle: one adds up the buckets, one the weights. What is
    sorted is the drawn rows alone, by ranges of (score, doc_id, row), so equal scores and ids
    are spread too.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    texts = documents.select("doc_id", "text")
    vocabulary = vocabulary or frequent(documents)
    gains = gains_of(bucket_totals(texts, vocabulary), bucket_totals(target, vocabulary))
    scored = weighed(texts, vocabulary, gains).withColumn("score", F.col("weight") + noise("doc_id"))
    scored = stored(scored.withColumn("row_id", F.monotonically_increasing_id()), "resampling")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    bound = least_kept(able, "score", drawn)
    columns = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if bound is None:
        return scored.select(*columns, unranked)
    near = (F.col("n_words") >= min_words) & (F.col("score") >= F.lit(bound))
    ranked = global_index(scored.where(near), [Falling("score"), "doc_id", "row_id"], "rank")
    ranked = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank").cast("long")).alias("rank"))
    return ranked.unionByName(scored.where(~near).select(*columns, unranked))


def oracle() -> str:
    """The same draw as DuckDB SQL; the checksum is worked out byte by byte for each distinct run."""
    steps = [int(c) for c in _byte_steps()]
    runs = " UNION ALL ".join(
        f"SELECT doc, kind, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS run "
        f"FROM words WHERE len(w) >= {n}"
        for n in range(1, LONGEST_RUN + 1)
    )
    return rf"""
WITH words AS MATERIALIZED (
  SELECT doc, kind, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM (
    SELECT row_number() OVER () AS doc, 'raw' AS kind, doc_id, text FROM documents
    UNION ALL SELECT 0, 'target', NULL, text FROM benchmark
  )
),
runs AS MATERIALIZED (SELECT doc, kind, run, count(*) AS n FROM ({runs}) GROUP BY ALL),
bytes AS (
  SELECT run, hex(encode(run)) AS h, '0123456789ABCDEF' AS digits FROM (SELECT DISTINCT run FROM runs)
),
buckets AS MATERIALIZED (
  SELECT run, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(1, len(h), 2),
      lambda i: (16 * (strpos(digits, h[i]) - 1) + strpos(digits, h[i + 1]) - 1)::BIGINT)),
    lambda c, b: xor({steps}[(xor(c, b) & 255) + 1], c >> 8))) % {BUCKETS} AS bucket
  FROM bytes
),
counts AS (
  SELECT b AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t
  FROM (SELECT unnest(range({BUCKETS})) AS b) LEFT JOIN (
    SELECT bucket, sum(n) FILTER (kind = 'raw') AS s, sum(n) FILTER (kind = 'target') AS t
    FROM runs JOIN buckets USING (run) GROUP BY bucket
  ) ON bucket = b
),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM counts
),
weights AS (
  SELECT doc, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM runs JOIN buckets USING (run) JOIN gains USING (bucket) WHERE kind = 'raw' GROUP BY doc
),
scored AS (
  SELECT doc, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM words LEFT JOIN weights USING (doc) WHERE kind = 'raw'
),
ranked AS (
  SELECT doc, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS r, {PERCENT} * count(*) OVER () // 100 AS k
  FROM scored WHERE n_words >= {MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= k THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc)
"""
