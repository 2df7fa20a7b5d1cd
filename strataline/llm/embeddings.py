"""Near-duplicate embeddings by int8 tile products with rigorous error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.blocks import by_unit, in_blocks, squares, whole_units
from strataline.llm.caches import in_worker
from strataline.llm.components import components, local_roots
from strataline.llm.storage import bounded_batches, stored

THRESHOLD = 0.98
#: Vectors of a block; a label of more is split into blocks whose pairs are separate work.
BLOCK_MEMBERS = 2048
#: Side of the squares in which a pair of blocks is multiplied.
SQUARE = 1024
#: Products of so many int8 components add up exactly in single precision.
EXACT_COMPONENTS = 1024
#: Allowance for rounding in the bounds themselves.
SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and error norms of unit vectors: vector = scale * code + error."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - scale[:, None] * codes, axis=1)
    return codes, scale, error


def code_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole-number products of all pairs of codes, exactly."""
    out = np.zeros((len(left), len(right)), np.float64)
    for k in range(0, left.shape[1], EXACT_COMPONENTS):
        part = slice(k, k + EXACT_COMPONENTS)
        out += left[:, part].astype(np.float32) @ right[:, part].astype(np.float32).T
    return out


def links_in_square(unit: np.ndarray, coded: tuple, rows: np.ndarray, columns: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a square with a cosine of at least the threshold.

    With u = s q + e the product u.v differs from s t (q.r) by at most |e|(1 + |f|) + |f|, so
    pairs whose bound stays below the threshold are out; the rest is recomputed in double precision.
    """
    codes, scale, error = coded
    close = code_products(codes[rows], codes[columns])
    close *= scale[rows][:, None]
    close *= scale[columns][None, :]
    bound = error[rows][:, None] * (1 + error[columns][None, :]) + error[columns][None, :] + SLACK
    possible = close + bound >= threshold
    if rows is columns:
        possible &= np.triu(np.ones(possible.shape, bool), 1)
    a, b = np.nonzero(possible)
    a, b = rows[a], columns[b]
    exact = np.concatenate(
        [np.einsum("ij,ij->i", unit[a[k : k + 65536]], unit[b[k : k + 65536]]) for k in range(0, len(a), 65536)] or [np.zeros(0)]
    )
    linked = exact >= threshold
    return a[linked], b[linked]


def _search(units: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): links that span each unit, and with b null the vectors a class is linked to in it."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_units(batches):
            if group.num_rows < 2:
                continue
            node = np.array(group["class"].to_pylist(), np.int64)
            copies = np.array(group["copies"].to_pylist(), np.int64)
            vectors = np.array(group["embedding"].to_pylist(), np.float64)
            vectors /= np.abs(vectors).max(axis=1, keepdims=True)
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            coded = quantised(unit)
            counts = np.zeros(len(node), np.int64)
            root = np.arange(len(node))
            for x, y in squares(group, SQUARE):
                a, b = links_in_square(unit, coded, x, y, threshold)
                np.add.at(counts, a, copies[b])
                np.add.at(counts, b, copies[a])
                root = local_roots(len(node), np.concatenate([a, np.arange(len(node))]), np.concatenate([b, root]))
            ends, some = np.flatnonzero(root != np.arange(len(node))), np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[ends], node[some]])),
                    pa.array([*node[root[ends]].tolist(), *([None] * len(some))], pa.int64()),
                    pa.array(np.concatenate([np.zeros(len(ends), np.int64), counts[some]])),
                ],
                schema=schema,
            )

    return units.mapInArrow(in_worker(search), "a long, b long, n long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `embeddings`.

    Takes `vec_id`, `embedding` and `label`; other columns are not read. Two rows are linked when
    their labels are equal and not null, their vectors as long, and the cosine in double
    precision is at least `threshold`. n_links counts the other rows linked directly, component_id
    is the smallest vec_id that links reach, kept marks the row it belongs to. A vector that is
    null, empty, zero, or holds a null or non-finite component links with nothing: it is its own
    component and kept. Rows with equal vectors and labels count as copies, also under one
    vec_id; a row with a null vec_id takes part and is kept only if nothing else is in its
    component. An empty table gives an empty result.

    Copies are one class before anything is compared. A label of any size is split into blocks;
    a task holds two blocks, and sends out spanning links and counts, never pairs.
    """
    bounded_batches(embeddings.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable, F.concat_ws(":", F.col("label").cast("string"), F.size(vector))).alias("group"),
        # Adding zero makes equal what differs in the sign of a zero only.
        F.when(usable, F.transform(vector, lambda x: x + F.lit(0.0))).alias("embedding"),
    )
    classes = rows.where("group is not null").groupBy("group", "embedding")
    classes = classes.agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "vectors")
    sizes = classes.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).alias("splits"))
    units = in_blocks(classes.join(sizes, "group"), "group", "class", F.col("splits"), "class", "copies", "embedding")
    found = stored(_search(by_unit(units), threshold), "links")
    joined = components(found.where("b is not null").select("a", "b"), "components")
    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))

    own = classes.join(joined.withColumnRenamed("node", "class"), "class", "left")
    own = own.withColumn("root", F.coalesce("root", "class"))
    lowest = own.groupBy("root").agg(F.min("first_id").alias("component_id"))
    own = own.join(lowest, "root").join(counts, "class", "left")
    own = own.select("group", "embedding", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    component = F.coalesce("component_id", "vec_id")
    return rows.join(own, ["group", "embedding"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
