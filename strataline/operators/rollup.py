"""Aggregations that stay small on the wire."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions.numbers import safe_ratio


def count_by(df: DataFrame, *keys: Column | str, name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_through_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    by: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Group a fact by dimension attributes, adding up fact columns.

    The fact is pre-aggregated on the join key (and on its own group columns), so
    the join sees one row per key instead of every fact row: no hot join key is
    left, and the exchange made for the pre-aggregation is reused by the join when
    the dimension is too large to broadcast. ``on`` must be unique in ``dimension``.
    """
    own = [c for c in by if c not in dimension.columns]
    partial = fact.groupBy(on, *own).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    attributes = [c for c in by if c in dimension.columns]
    joined = partial.join(dimension.select(on, *attributes), on)
    return joined.groupBy(*by).agg(*[F.sum(n).alias(n) for n in sums])


def ratio_of_sum_to_distinct(df: DataFrame, amount: str, key: str, name: str) -> DataFrame:
    return df.agg(safe_ratio(F.sum(amount), F.count_distinct(key)).alias(name))


def share_of_total(df: DataFrame, part: str, name: str, share: Column | None = None) -> DataFrame:
    """Add each row's share of the column total.

    The total is a scalar subquery over the same aggregate (Spark reuses its
    exchange), not a window without partitions, which would gather all groups.
    """
    total = df.agg(F.sum(part)).scalar()
    value = safe_ratio(part, total) if share is None else share
    return df.withColumn(name, value)


def column_total(df: DataFrame, column: str) -> Column:
    return df.agg(F.sum(column)).scalar()


def value_counts(df: DataFrame, column: Column | str, name: str = "row_count") -> DataFrame:
    """Occurrences per value, NULL included as a value of its own."""
    return count_by(df, column, name=name)
