"""Exploratory checks on any table. Each returns the rows or groups worth a look."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions import dates
from strataline.functions.text import has_outer_whitespace, trim_all
from strataline.operators.fingerprints import repeated_keys
from strataline.operators.rollup import count_by, value_counts


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def duplicate_keys(df: DataFrame, *keys: Column | str) -> DataFrame:
    return repeated_keys(df, list(keys))


def untrimmed(df: DataFrame, *columns: str, leading_only: bool = False) -> DataFrame:
    """Rows where any column carries outer whitespace."""
    return df.filter(_any([has_outer_whitespace(c, leading_only) for c in columns]))


def missing_or_untrimmed(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(_any([F.col(c).isNull() | has_outer_whitespace(c) for c in columns]))


def missing_or_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull() | (trim_all(column) == ""))


def distribution(df: DataFrame, column: Column | str) -> DataFrame:
    return value_counts(df, column)


def distribution_with_known(df: DataFrame, column: str) -> DataFrame:
    """Per value: rows, and rows with a known value (zero for the NULL group)."""
    return df.groupBy(column).agg(
        F.count(F.lit(1)).alias("row_count"), F.count(column).alias("known_count")
    )


def missing_or_not_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull() | (F.col(column) <= 0))


def inverted_ranges(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(F.col(end) < F.col(start))


def outside_horizon(df: DataFrame, column: str, as_of: dates.AsOf) -> DataFrame:
    """yyyymmdd values that are missing, no date, before 1900 or not before the horizon."""
    kept = dates.within_horizon(dates.compact_day(column), as_of, include_as_of=False)
    return df.filter(kept.isNull())


def implausible_birthdates(df: DataFrame, column: str, as_of: dates.AsOf) -> DataFrame:
    return df.filter(dates.plausible_birthdate(column, as_of).isNull())


def misordered(df: DataFrame, first: str, *later: str) -> DataFrame:
    """Rows where ``first`` comes after any of the later columns."""
    return df.filter(_any([F.col(first) > F.col(c) for c in later]))


def not_castable(df: DataFrame, column: str, type_name: str = "bigint") -> DataFrame:
    """Rows whose text is no value of the type; NULL text counts."""
    return df.filter(F.col(column).try_cast(type_name).isNull())


def overlong_keys(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Distinct keys longer than ``limit``, with their length."""
    long_ones = df.filter(F.length(column) > limit)
    return long_ones.groupBy(column).agg(F.first(F.length(column)).alias("key_length"))


def formula_mismatch(
    df: DataFrame, total: Column, left: Column, right: Column, missing_is_bad: bool = True
) -> DataFrame:
    differs = total != left * right
    return df.filter((differs | total.isNull()) if missing_is_bad else differs)


def outside_bounds(
    df: DataFrame, column: str, low: float, high: float | None = None, type_name: str = "bigint"
) -> DataFrame:
    """Castable values at or below ``low`` or at or above ``high``."""
    value = F.col(column).try_cast(type_name)
    outside = value <= low
    return df.filter(outside if high is None else outside | (value >= high))


def rows_with_key(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def rows_per_key(df: DataFrame, *keys: str) -> DataFrame:
    return count_by(df, *keys)


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, NULLs, blank and untrimmed texts, in one scan."""
    measures = [F.count(F.lit(1)).alias("rows")]
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    for i, name in enumerate(df.columns):
        column = F.col(name)
        measures.append(F.count_if(column.isNull()).alias(f"nulls{i}"))
        blank = trim_all(column) == "" if name in texts else F.lit(False)
        padded = has_outer_whitespace(column) if name in texts else F.lit(False)
        measures.append(F.count_if(blank).alias(f"blank{i}"))
        measures.append(F.count_if(padded).alias(f"padded{i}"))
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.col(f"nulls{i}").alias("null_count"),
            F.col(f"blank{i}").alias("blank_count"),
            F.col(f"padded{i}").alias("untrimmed_count"),
        )
        for i, name in enumerate(df.columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*entries)))
