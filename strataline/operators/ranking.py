"""Global order without a single-task window, and per-group leaders.

Positions in a total order over a whole table come from even ranges: one pass counts the rows of
each range, and a window numbers rows within their range. Nothing is stored, and no task holds
more than a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.operators.history import first_per_key
from strataline.operators.ranges import Falling, Key, even_ranges, sorted_by

__all__ = ["Falling", "dense_keys", "global_index", "global_ntile", "leader_per_group", "top_rows"]

_CUT = "_range_no"


def _positions(df: DataFrame, order: Sequence[Key], index: str, cuts: int | None) -> tuple[DataFrame, int]:
    """The table with each row's position, and how many rows there are."""
    ranges = even_ranges(df, order, cuts)
    ranged = df.withColumn(_CUT, ranges.number)
    before = [0] * ranges.count
    if ranges.count > 1:
        counts = dict(map(tuple, ranged.groupBy(_CUT).agg(F.count(F.lit(1))).collect()))  # a row per range
        for i in range(ranges.count - 1):
            before[i + 1] = before[i] + counts.get(i, 0)
    window = Window.partitionBy(_CUT).orderBy(*map(sorted_by, order))
    offsets = F.array(*[F.lit(n).cast("bigint") for n in before])
    place = F.row_number().over(window) + F.get(offsets, F.col(_CUT))
    return ranged.withColumn(index, place).drop(_CUT), ranges.total


def global_index(df: DataFrame, order: Sequence[Key], index: str, cuts: int | None = None) -> DataFrame:
    """Number all rows 1..n under a total order.

    ``row_number() over (order by ...)`` would move the whole table into one task. Here the
    table is read to count it, to sample the cut points and to count each range, all on the
    order's keys alone, and once more for the result, with one shuffle. It must give the
    same rows each time it is read: a stored table, or a plan over stored tables without random
    values. Rows that are equal in all keys are numbered in any order, in one range: end the
    order with something unique.
    """
    return _positions(df, order, index, cuts)[0]


def global_ntile(df: DataFrame, tiles: int, order: Sequence[Key], tile: str, cuts: int | None = None) -> DataFrame:
    """``ntile(tiles) over (order by ...)`` on top of :func:`global_index`.

    The first ``n % tiles`` tiles hold one row more than the others.
    """
    indexed, total = _positions(df, order, "_index", cuts)
    place = F.col("_index") - 1
    small, larger_tiles = divmod(total, tiles)
    in_larger = larger_tiles * (small + 1)
    number = F.when(place < in_larger, F.floor(place / (small + 1))).otherwise(
        larger_tiles + F.floor((place - in_larger) / max(small, 1))
    )
    return indexed.withColumn(tile, number.cast("int") + 1).drop("_index")


def dense_keys(df: DataFrame, order: Sequence[Key], key: str) -> DataFrame:
    """Consecutive integer surrogate keys over the whole table."""
    return global_index(df, order, key)


def leader_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group, meant for already aggregated input."""
    return first_per_key(df, group, order)


def top_rows(df: DataFrame, limit: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(limit)
