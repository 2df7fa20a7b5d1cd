"""Table scans and sinks: full refresh, append, views, schemas."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.sources.snapshots import write_once

LOAD_COLUMN = "dwh_create_date"

# Schema per model prefix.
LAYERS = ("bronze", "silver", "gold", "dq", "audit_stg", "audit_mrt")


def layer_of(model: str) -> str:
    """Schema a model materialises in."""
    return "silver" if model.startswith("stg_") else "gold"


def qualified(model: str, layer: str | None = None) -> str:
    return f"{layer or layer_of(model)}.{model}"


def create_schemas(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def recreate_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Drop and create an empty typed table."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([], schema).write.saveAsTable(name, format="parquet")


def stamp_load(df: DataFrame, load_ts: dt.datetime | str | Column) -> DataFrame:
    """Add the load timestamp: one value per run, handed in by the caller."""
    value = load_ts if isinstance(load_ts, Column) else F.lit(str(load_ts))
    return df.withColumn(LOAD_COLUMN, value.cast("timestamp"))


def _new_location(spark: SparkSession, name: str) -> str:
    """A fresh folder for one version of a table, beside its schema's tables."""
    schema_name, _, table = name.rpartition(".")
    root = spark.catalog.getDatabase(schema_name or spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{table}.versions/{uuid.uuid4().hex}"


def _plain(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition or c.isBucket for c in spark.catalog.listColumns(name))


def full_refresh(df: DataFrame, name: str, order: Sequence[str] = ()) -> None:
    """Replace a table's content and definition.

    All rows are stored in a folder of their own first; then the catalog is told that the table
    lies there, which is one step. A refresh that fails leaves the table as it was, and queries
    that are running keep the version they began with. Only if the definition changes is the
    table made anew, over rows that are stored already. Old versions stay until
    :func:`drop_old_versions`.
    """
    spark, location = df.sparkSession, _new_location(df.sparkSession, name)
    write_once(df, location, order)
    if spark.catalog.tableExists(name):
        known = spark.table(name).schema
        if _plain(known) == _plain(df.schema) and not _is_partitioned(spark, name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=location, source="parquet", schema=df.schema)


def truncate_insert(df: DataFrame, name: str, order: Sequence[str] = ()) -> None:
    """Empty an existing table and fill it; its definition stays.

    As in :func:`full_refresh` the old rows stay readable until all new ones are stored.
    """
    spark = df.sparkSession
    target = spark.table(name)
    if _is_partitioned(spark, name):
        raise ValueError(f"{name} is partitioned; its partitions cannot be replaced at one stroke")
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])
    location = _new_location(spark, name)
    write_once(rows, location, order)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")


def drop_old_versions(spark: SparkSession, name: str) -> int:
    """Delete the versions of a table that its catalog entry no longer names; returns how many.

    For when no query reads them any more. Needs the JVM's file system, so no Spark Connect.
    """
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    current = spark._jvm.org.apache.hadoop.fs.Path(details.data_type)
    if not current.getParent().getName().endswith(".versions"):
        return 0
    file_system = current.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in file_system.listStatus(current.getParent()) if s.getPath().getName() != current.getName()]
    for path in old:
        file_system.delete(path, True)
    return len(old)


def publish_view(df: DataFrame, name: str) -> None:
    """Expose a plan as a view for the session; nothing is materialised."""
    df.createOrReplaceTempView(name)


def materialise(df: DataFrame, model: str, layer: str | None = None) -> DataFrame:
    """Write a model to its layer and return the stored table.

    The model's table keeps its old rows until the new ones are stored. Cuts lineage: later models read files instead of repeating the plan, and a lost
    executor costs one task of the later model, not the whole chain.
    """
    name = qualified(model, layer)
    full_refresh(df, name)
    return df.sparkSession.table(name)


def literal_table(spark: SparkSession, rows: Sequence[Sequence[object]], ddl: str) -> DataFrame:
    """A small declared table as literals in the plan, without shipping rows from Python."""
    fields = T.StructType.fromDDL(ddl).fields
    if not rows:
        return spark.createDataFrame([], T.StructType(fields))
    entries = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A table that may not exist yet; other failures are not swallowed."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)
