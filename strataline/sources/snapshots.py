"""Whole tables that are replaced at one stroke, and appends that count once.

Rows always go to a folder of their own, where no reader looks. What makes them visible is one
small record that is written afterwards, as a single file that appears by a rename. A job that is
lost before that leaves the old state; one that is repeated leaves the new state once.

``<path>/versions/<version>``
    the rows of one refresh
``<path>/pointers/<version>``
    says which place in the sequence of refreshes this version has; the largest is current
``<path>/rows/attempt=<id>``
    the rows one append wrote
``<path>/records/attempt=<id>``
    says which units (such as runs) that append holds, and how many rows of each
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.session import scratch_path

ATTEMPT = "attempt"


def folder_or_empty(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet") -> DataFrame:
    """A folder that may not exist yet; other failures are not swallowed."""
    try:
        found = spark.read.format(form).schema(schema).load(path)
        found.schema  # noqa: B018  a missing path is reported when the plan is analysed
        return found
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# --- versions -----------------------------------------------------------------------------------

_POINTER = T.StructType([T.StructField("sequence", T.LongType()), T.StructField("version", T.StringType())])


def _pointers(spark: SparkSession, path: str) -> DataFrame:
    return folder_or_empty(spark, f"{path}/pointers/*", _POINTER, "json")


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version that readers see; None before the first refresh is complete."""
    newest = _pointers(spark, path).orderBy(F.desc("sequence"), F.desc("version")).first()
    return newest.version if newest else None


def replace_files(df: DataFrame, path: str, order: Sequence[str] = (), partition_by: Sequence[str] = ()) -> str:
    """Replace what ``path`` holds: readers see the old rows until all new ones are stored.

    ``order`` only sorts within files, for scan skipping. The table may be read by ``df``
    itself. Returns the new version.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    write_once(df, f"{path}/versions/{version}", order, partition_by)
    last = _pointers(spark, path).agg(F.max("sequence")).first()[0]
    pointer = spark.createDataFrame([((last or 0) + 1, version)], _POINTER)
    pointer.coalesce(1).write.json(f"{path}/pointers/{version}")
    return version


def read_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current version; empty before the first refresh is complete."""
    version = current_version(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/versions/{version}")


def write_once(df: DataFrame, path: str, order: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Write to a folder that does not exist yet.

    Zstandard also shortens hashed keys: their hex digits, which repeat no longer text, are stored in
    full by the default codec.
    """
    ordered = df.sortWithinPartitions(*order) if order else df
    ordered.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """The table as written to a fresh scratch folder: computed once, however often it is read."""
    path = scratch_path(df.sparkSession, name)
    write_once(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- appends ------------------------------------------------------------------------------------


def append_units(
    rows: DataFrame, path: str, unit: str, partition_by: Sequence[str] = (), order: Sequence[str] = ()
) -> str:
    """Append rows, of which each ``unit`` (a run, a load) counts once however often it comes.

    The rows become visible when the record of their units is written, all at once. Rows without a
    unit fail the append, since nothing could say whether they are there. Returns the attempt.
    """
    spark, attempt = rows.sparkSession, uuid.uuid4().hex
    target = f"{path}/rows/{ATTEMPT}={attempt}"
    named = rows.withColumn(unit, F.coalesce(unit, F.raise_error(F.lit(f"a row without {unit}")).cast("string")))
    named = named.sortWithinPartitions(*order) if order else named
    named.write.partitionBy(*partition_by).parquet(target)
    stored = spark.read.schema(rows.schema).parquet(target)
    counted = stored.groupBy(unit).agg(F.count(F.lit(1)).alias("row_count"))
    counted.coalesce(1).write.json(f"{path}/records/{ATTEMPT}={attempt}")
    return attempt


def recorded_units(spark: SparkSession, path: str, unit: str) -> DataFrame:
    """(unit, attempt, row_count): the append that each unit's rows are taken from.

    If two appends of the same unit were made at once, both are stored, and the one that was
    recorded first counts, by the storage's own time.
    """
    kinds = {unit: T.StringType(), "row_count": T.LongType(), ATTEMPT: T.StringType()}
    record = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
    records = folder_or_empty(spark, f"{path}/records", record, "json")
    if not records.inputFiles():
        return records.select(unit, ATTEMPT, "row_count")
    at = F.struct(F.col("_metadata.file_modification_time").alias("at"), ATTEMPT)
    first = records.groupBy(unit).agg(F.min_by(F.struct(ATTEMPT, "row_count"), at).alias("first"))
    return first.select(unit, "first.*")


def read_units(spark: SparkSession, path: str, schema: T.StructType, unit: str) -> DataFrame:
    """The rows of all recorded units, once each; ``schema`` includes the partition columns.

    Rows of an append that was never recorded are not read.
    """
    stored = folder_or_empty(spark, f"{path}/rows", T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())]))
    recorded = recorded_units(spark, path, unit).select(unit, ATTEMPT)
    return stored.join(recorded, [unit, ATTEMPT], "left_semi").select(*schema.names)


def damaged_units(spark: SparkSession, path: str, schema: T.StructType, unit: str) -> DataFrame:
    """Recorded units whose stored rows are not as many as recorded: (unit, attempt, row_count, found)."""
    found = read_units(spark, path, schema, unit).groupBy(unit).agg(F.count(F.lit(1)).alias("found"))
    both = recorded_units(spark, path, unit).join(found, unit, "left").fillna(0, ["found"])
    return both.filter(F.col("found") != F.col("row_count"))
