"""Quality selection by importance resampling over hashed n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.caches import in_worker, remembers
from strataline.llm.storage import bounded_batches, sampled, stored
from strataline.llm.words import WordHashes, window_hashes

#: What n-grams are made of: words, and runs of marks, which tell tables and damaged text.
UNIT = re.compile(r"\w+|[^\w\s]+")
#: Uni- and bigrams of them are hashed to so many buckets.
BUCKETS = 10_000
#: The target model counts about so many documents labelled good, drawn by hash.
TARGET_ROWS = 20_000
#: Added to each bucket's count, as a share of the mean count.
SMOOTHING = 0.01
SEED = 11


_KNOWN = WordHashes()


def _forget() -> int:
    known = len(_KNOWN)
    _KNOWN.clear()
    return known


remembers("units", _forget)


def bucket_counts(text: str | None) -> np.ndarray:
    """How often each bucket occurs in a whole text; null and blank texts have no n-grams."""
    units = UNIT.findall(text.lower()) if text else []
    words = np.fromiter(map(_KNOWN.__getitem__, units), np.uint64, len(units))
    grams = np.concatenate([window_hashes(words, (0,)), window_hashes(words, (0, 1))])
    return np.bincount((grams % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)


def _model(texts: DataFrame) -> np.ndarray:
    """Total counts of each bucket over all texts: added up in each task, then by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch[0].to_pylist():
                total += bucket_counts(text)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(in_worker(count, "units"), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.float64)
    for bucket, n in found:
        out[bucket] = n
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket the log of the target's probability over the raw text's, both smoothed."""
    smooth = [c + SMOOTHING * max(c.mean(), 1.0) for c in (target, raw)]
    p, q = (c / c.sum() for c in smooth)
    return np.log(p) - np.log(q)


def least_kept(scored: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest key, exactly: counts by ever finer ranges of it, three narrow passes.

    None if nothing is to be kept; -inf if everything is.
    """
    total = scored.count()
    if k <= 0 or not total:
        return None
    if k >= total:
        return float("-inf")
    low, high = scored.agg(F.min(key), F.max(key)).first()
    while low < high:
        width = (high - low) / 4096
        if not low + width > low or not high - width < high:
            break
        part = F.least(F.floor((F.col(key) - low) / width), F.lit(4095)).alias("part")
        inside = scored.where(F.col(key).between(low, high))
        counts = inside.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        above = scored.where(F.col(key) > high).count()
        for _, n, a, b in sorted(counts.collect(), key=lambda r: -r[0]):  # at most 4,096 rows
            if above + n >= k:
                low, high = a, b
                break
            above += n
        if above + 1 == k:
            low = high
    return low


def select_quality(documents: DataFrame, labels: DataFrame, share: float | None = None, target_rows: int = TARGET_ROWS) -> DataFrame:
    """(doc_id, log_weight, key, kept) for every row of `documents`.

    log_weight is the sum over a whole text's hashed n-grams of the log ratio between a model of
    the documents labelled good and a model of all documents. key adds Gumbel noise that depends
    on the row alone, and the `share` of the rows with the largest keys are kept: a sample
    without replacement in proportion to the weights. Without `share` it is the labelled rows'
    share of good ones. Rows with the k-th key are all kept, so ties stay together. Null and
    blank texts have weight 0 in log. Labels that are null or neither 0 nor 1 are left
    out; without labels every log weight is 0 and all rows are kept. Other columns are not read;
    an empty table gives an empty result.
    """
    bounded_batches(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality"))
    usable = usable.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good, labelled = usable.agg(F.sum("quality"), F.count(F.lit(1))).first()
    share = share if share is not None else (good or 0) / labelled if labelled else 1.0
    some = sampled(usable.where("quality = 1"), target_rows, "doc_id").select("doc_id")
    ratios = np.zeros(BUCKETS)
    if good:
        raw = _model(texts)
        # The target's ids are few by the limit above.
        ratios = log_ratios(_model(texts.join(F.broadcast(some), "doc_id", "left_semi")), raw)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [float(bucket_counts(t) @ ratios) for t in batch[2].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch[0], batch[1], pa.array(weights, pa.float64())], names=["doc_id", "noise", "log_weight"]
            )

    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(SEED)), 11).cast("double")
    gumbel = -F.log(-F.log((drawn + 0.5) / F.lit(float(1 << 53))))
    scored = texts.select("doc_id", gumbel.alias("noise"), "text").mapInArrow(in_worker(weigh, "units"), "doc_id long, noise double, log_weight double")
    scored = scored.select("doc_id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("key"))
    scored = stored(scored, "quality")
    bound = least_kept(scored, "key", round(share * scored.count()))
    kept = F.lit(False) if bound is None else F.col("key") >= F.lit(bound)
    return scored.withColumn("kept", kept)
