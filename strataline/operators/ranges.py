"""Even ranges of a total order, fixed in the plan.

A small uniform sample of an order's keys gives tuples that split a table into ranges of about the
same size, however often some keys repeat. The cut points are literals in the plan, so a row's
range follows from the row alone, in every pass and after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Smaller tables are one range.
ROWS_PER_CUT = 1_000_000
#: Ranges per shuffle partition, so that those dealt to one partition even out; and at most, as
#: cut points are part of the plan.
CUTS_PER_PARTITION, MOST_CUTS = 4, 1024
#: Sampled rows per range: the size of a range then varies by about a tenth.
SAMPLED_PER_CUT = 100
SAMPLE_SEED = 17


@dataclass(frozen=True)
class Falling:
    """A descending key of an order. NULL counts as smallest, in rising and falling keys."""

    column: Column | str


Key = Column | str | Falling


def key_column(key: Key) -> Column:
    inner = key.column if isinstance(key, Falling) else key
    return F.col(inner) if isinstance(inner, str) else inner


def sorted_by(key: Key) -> Column:
    return key_column(key).desc_nulls_last() if isinstance(key, Falling) else key_column(key).asc_nulls_first()


def _precedes(row: Sequence[Column], cut: Sequence[Column], falling: Sequence[bool]) -> Column:
    """Whether a row comes before a cut point, key by key."""
    out = F.lit(False)
    for value, edge, is_falling in reversed(list(zip(row, cut, falling, strict=True))):
        smaller = F.coalesce(value < edge, value.isNull() & edge.isNotNull())
        larger = F.coalesce(value > edge, value.isNotNull() & edge.isNull())
        before, after = (larger, smaller) if is_falling else (smaller, larger)
        out = F.when(before, True).when(after, False).otherwise(out)
    return out


def _range_number(row: Sequence[Column], cuts: Sequence[Sequence[Column]], falling: Sequence[bool], first: int = 0) -> Column:
    """How many cut points a row does not come before, found by halving."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    left = _range_number(row, cuts[:middle], falling, first)
    right = _range_number(row, cuts[middle + 1 :], falling, first + middle + 1)
    return F.when(_precedes(row, cuts[middle], falling), left).otherwise(right)


def cut_points(df: DataFrame, order: Sequence[Key], cuts: int, total: int) -> list[list[Column]]:
    """Tuples of key values that split the table evenly, from a sample of bounded size."""
    names = [f"_k{i}" for i in range(len(order))]
    share = min(1.0, SAMPLED_PER_CUT * cuts / total)
    keys = df.select(*[key_column(k).alias(n) for k, n in zip(order, names, strict=True)])
    drawn = keys.where(F.rand(SAMPLE_SEED) < share).limit(4 * SAMPLED_PER_CUT * cuts)
    ordered = drawn.orderBy(*[sorted_by(Falling(n) if isinstance(k, Falling) else n) for k, n in zip(order, names, strict=True)])
    rows = list(dict.fromkeys(tuple(r) for r in ordered.collect()[:: SAMPLED_PER_CUT][1:]))
    kinds = [f.dataType for f in keys.schema.fields]
    return [[F.lit(v).cast(t) for v, t in zip(row, kinds, strict=True)] for row in rows]


@dataclass(frozen=True)
class Ranges:
    """The ranges of one table under one order: ``number`` is a row's range, 0 to ``count`` - 1."""

    total: int
    count: int
    number: Column


def even_ranges(df: DataFrame, order: Sequence[Key], cuts: int | None = None) -> Ranges:
    """Count the table, and cut it by a sample; a small table is one range."""
    total = df.count()
    if cuts is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cuts = max(1, min(total // ROWS_PER_CUT, CUTS_PER_PARTITION * partitions, MOST_CUTS))
    points = cut_points(df, order, cuts, total) if cuts > 1 and total else []
    number = _range_number([key_column(k) for k in order], points, [isinstance(k, Falling) for k in order])
    return Ranges(total, len(points) + 1, number.cast("int"))
