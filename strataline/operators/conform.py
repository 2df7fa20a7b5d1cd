"""Bringing several sources under one schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: cast what is there, pad what is not with typed NULLs."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_sources(parts: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """UNION ALL after alignment, so branches may lack columns or differ in width."""
    return reduce(DataFrame.unionByName, [align(part, schema) for part in parts])


def with_constants(df: DataFrame, **constants: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def as_text(df: DataFrame) -> DataFrame:
    """Every column as string; NULL stays NULL."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Remove rows with a NULL in any of the columns."""
    return df.na.drop("any", subset=list(columns) if columns else None)
