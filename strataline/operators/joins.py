"""Joins beyond a plain ``DataFrame.join``.

None of them hints a broadcast: Spark broadcasts a side whose measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.operators.history import first_per_key


def _keys(df: DataFrame, key: str, name: str = "_member") -> DataFrame:
    """The distinct keys of a table.

    Semi and anti joins would accept repeated keys, but a key that repeats millions
    of times would fill one task, and that side of such a join is never split. The
    distinct step combines map-side and its exchange also serves the join.
    """
    return df.select(F.col(key).alias(name)).distinct()


def keep_members(df: DataFrame, key: Column | str, members: DataFrame, member_key: str) -> DataFrame:
    """Rows whose key occurs in ``members`` (``key IN (SELECT ...)``)."""
    probe = F.col(key) if isinstance(key, str) else key
    return df.join(_keys(members, member_key), probe == F.col("_member"), "left_semi")


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows with a known key that has no parent; a NULL key is no orphan."""
    known = df.filter(F.col(key).isNotNull())
    return known.join(_keys(parents, parent_key), F.col(key) == F.col("_member"), "left_anti")


def unmatched(df: DataFrame, key: Column | str, parents: DataFrame, parent_key: str) -> DataFrame:
    """``LEFT JOIN ... WHERE parent IS NULL``: rows without a partner, NULL keys included."""
    probe = F.col(key) if isinstance(key, str) else key
    return df.join(_keys(parents, parent_key), probe == F.col("_member"), "left_anti")


def not_in(df: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """SQL ``key NOT IN (SELECT other_key ...)`` with its NULL rules, at any size.

    An empty list keeps every row; a NULL in the list keeps none; otherwise rows
    with a NULL key are dropped. Spark's own null-aware anti join needs the list to
    fit a broadcast; here it shuffles, and the two facts about the list arrive in
    one scalar subquery.
    """
    facts = others.agg(
        F.struct(
            F.count(F.lit(1)).alias("size"), F.count_if(F.col(other_key).isNull()).alias("nulls")
        ).alias("facts")
    ).scalar()
    size, nulls = facts.getField("size"), facts.getField("nulls")
    absent = df.join(_keys(others, other_key), F.col(key) == F.col("_member"), "left_anti")
    return absent.filter((size == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def override(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    column: str,
    new_value: str,
    order: Sequence[Column],
) -> DataFrame:
    """Replace ``column`` by the lookup's value for the key, keeping it where there is none.

    When the lookup repeats a key, the first row under ``order`` wins.
    """
    best = first_per_key(lookup, [key], order).select(
        F.col(key).alias("_key"), F.col(new_value).alias("_value")
    )
    joined = df.join(best, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(column, F.coalesce("_value", column)).select(*df.columns)


def disagreements(
    left: DataFrame, right: DataFrame, on: Column, left_value: Column, right_value: Column
) -> DataFrame:
    """Left-joined pairs whose two values differ once trimmed and lower-cased."""
    return left.join(right, on, "left").filter(
        F.lower(F.trim(left_value)) != F.lower(F.trim(right_value))
    )


def attach(df: DataFrame, values: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add the columns of a keyed lookup, NULL where the key is unknown."""
    return df.join(values, list(on), "left")


def exclude_loaded(df: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the target yet, for idempotent appends."""
    return df.join(loaded.select(key).distinct(), key, "left_anti")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project and rename in one go: ``{source: target}``."""
    return df.select(*[F.col(source).alias(target) for source, target in names.items()])
