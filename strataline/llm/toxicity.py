"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strataline.llm.caches import in_worker
from strataline.llm.storage import bounded_batches, free_name, sampled, stored
from strataline.llm.words import KNOWN_WORDS, split_words

#: Terms are hashed to so many buckets, of which the most telling ones are kept.
BUCKETS = 1 << 20
KEPT = 512
#: The model is fitted on about so many labelled rows, drawn by hash.
TRAINING_ROWS = 12_000
#: A kept bucket occurs in at least so many training rows.
LEAST_ROWS = 3
FACTORS = 8
PREFIXES = (4, 5, 6)
#: Steps of the fit, rows in each, their rate, and the pull of weights and factors towards zero.
STEPS, BATCH, RATE, DECAY = 2000, 256, 0.03, 1e-4
THRESHOLD = 0.3
SEED = 7


@dataclass
class FactorizationMachine:
    """Bias, a weight and a factor vector for each kept bucket; `column` maps buckets to them.

    The score of a set of terms is the logistic of bias + weights + the products of the factors
    of every pair of terms, so a pair may say more than its terms one by one.
    """

    column: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, at: np.ndarray) -> float:
        some = self.factors[at]
        pairs = 0.5 * float((some.sum(axis=0) ** 2 - (some**2).sum(axis=0)).sum())
        return self.bias + float(self.weights[at].sum()) + pairs

    def score(self, at: np.ndarray) -> float:
        """Between 0 and 1, from the columns of a text's kept terms."""
        return float(1 / (1 + np.exp(-np.clip(self.raw(at), -60, 60))))


class WordTerms(dict):
    """The buckets of a word: of the whole word and of its first 4, 5 and 6 letters, since
    compounds share a stem. With `column`, only the kept ones, as columns."""

    def __init__(self, column: np.ndarray | None = None) -> None:
        super().__init__()
        self.column = column

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        forms = [word, *(f"^{word[:k]}" for k in PREFIXES if len(word) >= k)]
        found = [xxhash.xxh64_intdigest(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in forms]
        if self.column is not None:
            found = [c for c in (int(self.column[b]) for b in found) if c >= 0]
        self[word] = out = tuple(found)
        return out

    def of(self, text: str | None) -> np.ndarray:
        """The distinct terms of a whole text. Null and wordless texts have none."""
        terms = set(chain.from_iterable(map(self.__getitem__, set(split_words(text)))))
        return np.array(sorted(terms), np.int32)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> FactorizationMachine:
    """Fit by logistic loss with Adam steps. One class only or no rows: a constant score."""
    column = np.full(BUCKETS, -1, np.int16)
    share = (float(labels.sum()) + 0.5) / (len(labels) + 1.0)
    machine = FactorizationMachine(column, float(np.log(share / (1 - share))), np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32))
    n, ones = len(labels), float(labels.sum())
    if not n or ones in (0.0, float(n)):
        return machine
    joined = np.concatenate(rows)
    seen = np.bincount(joined, minlength=BUCKETS).astype(np.float64)
    toxic = np.bincount(np.concatenate([r for r, y in zip(rows, labels, strict=True) if y] or [joined[:0]]), minlength=BUCKETS)
    expected = seen * ones / n
    telling = np.where(seen >= LEAST_ROWS, (toxic - expected) ** 2 / np.maximum(expected * (1 - seen / (n + 1)), 1e-9), 0)
    chosen = np.argsort(-telling, kind="stable")[:KEPT]
    chosen = chosen[telling[chosen] > 0]
    if not len(chosen):
        return machine
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen)), np.float32)
    for k, terms in enumerate(rows):
        at = column[terms]
        x[k, at[at >= 0]] = 1
    random = np.random.Generator(np.random.PCG64(SEED))
    y = labels.astype(np.float32)
    state = [np.array([machine.bias], np.float32), np.zeros(len(chosen), np.float32)]
    state.append((random.standard_normal((len(chosen), FACTORS)) * 0.01).astype(np.float32))
    first, second, steps = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state], 0
    while steps < STEPS:
        order = random.permutation(n)
        for k in range(0, n, BATCH):
            some = order[k : k + BATCH]
            xs = x[some]
            bias, weights, factors = state
            summed = xs @ factors
            raw = bias + xs @ weights + 0.5 * (summed**2 - xs @ factors**2).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[some]) / len(some)
            gradients = [
                np.array([error.sum()], np.float32),
                xs.T @ error + DECAY * weights,
                xs.T @ (error[:, None] * summed) - factors * (xs.T @ error)[:, None] + DECAY * factors,
            ]
            steps += 1
            for p, g, m, v in zip(state, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    return FactorizationMachine(column, float(state[0][0]), state[1], state[2])


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is 2 modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> FactorizationMachine:
    """Fit on about `rows` labelled documents that are not held out.

    Takes `doc_id` and `text`, and `doc_id` and `toxic` of the labels; labels that are null or
    neither 0 nor 1 are left out, and an id with differing labels counts as 1. Equal rows count
    once; if repeated ids leave more than twice `rows` still, about `rows` of those are drawn.
    """
    bounded_batches(documents.sparkSession)
    some = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    some = sampled(some, rows, "doc_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of = WordTerms()
        for batch in batches:
            terms = pa.array([terms_of.of(t).tobytes() for t in batch[1].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch[0].cast(pa.int32()), terms], names=["toxic", "terms"])

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    drawn = stored(texts.join(F.broadcast(some), "doc_id").select("doc_id", "text", "toxic").distinct(), "toxicity-rows")
    if drawn.count() > 2 * rows:
        drawn = sampled(drawn, rows, "doc_id", "text")
    rows_of = drawn.select("toxic", "text").mapInArrow(in_worker(hashed), "toxic int, terms binary")
    found = sorted((bytes(r[1]), r[0]) for r in rows_of.collect())
    return fit([np.frombuffer(t, np.int32) for t, _ in found], np.array([y for _, y in found], np.int32))


def score_toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `documents`.

    Scores whole texts from their words alone; null, empty and wordless texts get the score of
    no terms. Without usable labels every text gets one half. Repeated rows are scored alike;
    other columns are not read; an empty table gives an empty result. One scan, no shuffle of
    texts; the model (2 MB) goes to every task.
    """
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = with_scores(texts, train(texts, labels, rows), "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRAINING_ROWS) -> DataFrame:
    """The rows of `documents` that score below the threshold, with all their columns.

    Equal texts stay or go together, null and wordless ones by the score of no terms. Without
    usable labels nothing can be told toxic, and all rows stay; an empty table stays empty.
    """
    machine = train(documents, labels, rows)
    if machine.bias == 0 and not len(machine.weights):
        return documents
    name = free_name(documents, "toxicity")
    return with_scores(documents, machine, name).where(F.col(name) < threshold).drop(name)


def with_scores(documents: DataFrame, machine: FactorizationMachine, name: str) -> DataFrame:
    """`documents` with the score as a last column of this name."""
    at = documents.columns.index("text")
    kind = StructType([*documents.schema.fields, StructField(name, DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = WordTerms(machine.column)
        for batch in batches:
            scores = [machine.score(terms.of(t)) for t in batch[at].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return documents.mapInArrow(in_worker(score), kind)
