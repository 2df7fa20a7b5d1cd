"""De-duplication and version histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataline.operators.ranges import even_ranges, sorted_by

_RANK = "_row_rank"
_RANGE, _AHEAD = "_range_no", "_ahead"


def first_per_key(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]
) -> DataFrame:
    """Keep one row per key, the first under ``order``.

    ``order`` should be total, otherwise the survivor among equal rows is open.
    Spark pushes the rank limit below the exchange (WindowGroupLimit), so every map
    task ships at most one row per key and a hot key never piles up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def newest_per_key(
    df: DataFrame, keys: Sequence[Column | str], by: Column | str, tie_break: Sequence[str]
) -> DataFrame:
    """Keep the row with the greatest ``by``; NULLs count as oldest."""
    lead_column = F.col(by) if isinstance(by, str) else by
    order = [lead_column.desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    return first_per_key(df, keys, order)


def next_start(
    df: DataFrame, key: str, start: str, tie_break: str, result: str, cuts: int | None = None
) -> DataFrame:
    """Add the start of the following version of the same key (NULL for the last).

    Equivalent to ``lead(start) over (partition by key order by start, tie_break)``
    but safe when one key, or one month of it, holds a large part of all rows: a window
    over the key would bring all of them into one task. Here the table is cut into even
    ranges of (key, start, tie_break); a window looks ahead inside each range, and the last
    row of a range looks at the first row of the next one. Those first rows, one per range,
    are found in one narrow pass and are literals in the plan. One shuffle, no join.

    Rows without a start come first; NULL is a key like any other. ``df`` must give the
    same rows each time it is read, and ``tie_break`` be unique within a key and start.
    """
    order = [key, start, tie_break]
    ranges = even_ranges(df, order, cuts)
    ranged = df.withColumn(_RANGE, ranges.number)
    own = F.struct(F.col(key).alias("k"), F.col(start).alias("s"))
    kind = f"struct<k:{df.schema[key].dataType.simpleString()},s:{df.schema[start].dataType.simpleString()}>"
    heads: list[Column] = [F.lit(None).cast(kind)] * ranges.count
    if ranges.count > 1:
        found = ranged.groupBy(_RANGE).agg(F.min(own).alias("head")).collect()  # a row per range
        first = {row[_RANGE]: row["head"] for row in found}
        following = None
        for number in reversed(range(ranges.count)):
            if following is not None:
                heads[number] = F.struct(F.lit(following.k).alias("k"), F.lit(following.s).alias("s")).cast(kind)
            following = first.get(number, following)
    ahead = F.lead(own).over(Window.partitionBy(_RANGE).orderBy(*map(sorted_by, order)))
    looked = ranged.withColumn(_AHEAD, F.coalesce(ahead, F.get(F.array(*heads), F.col(_RANGE))))
    same_key = F.col(_AHEAD).isNotNull() & F.col(key).eqNullSafe(F.col(f"{_AHEAD}.k"))
    return looked.withColumn(result, F.when(same_key, F.col(f"{_AHEAD}.s"))).drop(_RANGE, _AHEAD)


def close_versions(
    df: DataFrame, key: str, start: str, tie_break: str, end: str
) -> DataFrame:
    """Version end = day before the next version starts; the last one stays open."""
    return next_start(df, key, start, tie_break, end).withColumn(end, F.date_sub(end, 1))


def current_versions(df: DataFrame, end: str) -> DataFrame:
    return df.filter(F.col(end).isNull())
