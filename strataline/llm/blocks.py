"""Groups of any size as pairs of bounded blocks, and streams of whole units in a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit of work: a group and the numbers of the two blocks that it compares.
UNIT = ["unit", "i", "j"]


def in_blocks(df: DataFrame, group: str, member: str, splits: Column, *carried: str) -> DataFrame:
    """Rows of each group dealt into `splits` blocks, one row per unit that the row takes part in.

    A group of one block makes one unit (group, 0, 0); one of n blocks makes n(n+1)/2 units, each
    row in n of them. `second` marks rows of the higher of two different blocks.
    """
    block = F.pmod(F.xxhash64(member), splits).cast("int")
    df = df.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), splits.cast("int") - 1)))
    return df.select(
        F.col(group).alias("unit"),
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).alias("second"),
        *carried,
    )


def by_unit(units: DataFrame) -> DataFrame:
    """All rows of a unit next to each other in one task."""
    return units.repartition(*UNIT).sortWithinPartitions(*UNIT)


def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole units of a stream that is sorted by unit; holds one unit and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch[c].to_pylist() for c in UNIT), strict=True))
        start = 0
        for k, key in enumerate(keys):
            if key != last:
                if held or k > start:
                    yield pa.Table.from_batches([*held, batch.slice(start, k - start)])
                held, start, last = [], k, key
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def crosses(unit: pa.Table) -> bool:
    """Whether a unit compares two different blocks."""
    return unit["i"][0].as_py() != unit["j"][0].as_py()


def squares(unit: pa.Table, side: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The unit's pairs of rows as squares of bounded size. Both sides are the same array where
    a square compares rows with themselves; then each pair is meant once."""
    second = np.array(unit["second"].to_pylist(), bool)
    left, right = ([at[k : k + side] for k in range(0, len(at), side)] for at in (np.flatnonzero(~second), np.flatnonzero(second)))
    if crosses(unit):
        return [(x, y) for x in left for y in right]
    return [(x, y) for k, x in enumerate(left) for y in left[k:]]
