"""The append-only quality log, its feed from run artifacts, and its summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.functions.numbers import safe_ratio
from strataline.functions.text import as_column
from strataline.operators.joins import exclude_loaded
from strataline.quality.rules import TEST_CATEGORIES
from strataline.sources.files import json_texts, typed_document
from strataline.sources.schemas import DQ_LOG_DDL, schema
from strataline.sources.snapshots import append_units, damaged_units, read_units, recorded_units
from strataline.sources.tables import literal_table

RUN_DAY = "run_date"

# Shapes of the run artifacts (manifest and run results).
NODE = (
    "struct<resource_type:string,name:string,test_metadata:struct<name:string>,"
    "column_name:string,config:struct<severity:string>,depends_on:struct<nodes:array<string>>>"
)
MANIFEST_DDL = f"metadata struct<invocation_id:string>, nodes map<string,{NODE}>"
RUN_RESULTS_DDL = "results array<struct<unique_id:string,status:string,failures:bigint>>"

# The task that all rows of a run are sent to.
PLACE = "_place"

# The run listing a backfill looks at.
RUNS_KEPT = 20
STATUS_SUCCESS = 10


def layer_of(model: Column | str) -> Column:
    """'staging' for stg_* models, 'marts' for all others, unknown ones included."""
    name = as_column(model)
    return F.when(name.startswith("stg_"), "staging").otherwise("marts")


def _categories() -> dict[str, str]:
    """Category per test name; artifacts name a package's test with or without the package."""
    return {name.rpartition(".")[2]: category for name, category in TEST_CATEGORIES.items()} | TEST_CATEGORIES


def category_table(spark: SparkSession) -> DataFrame:
    """The categories as a table."""
    return literal_table(spark, list(_categories().items()), "test_name string, test_category string")


def log_rows(
    results: DataFrame,
    run_id: str,
    started_at: dt.datetime | str,
    finished_at: dt.datetime | str,
    trigger_type: str = "manual",
    invocation_id: str | None = None,
) -> DataFrame:
    """Rule results in the log's schema; tests without a category are left out."""
    categorised = results.filter(F.col("test_category").isNotNull())
    return _to_log(
        categorised.withColumns(
            {
                "run_id": F.lit(run_id),
                "invocation_id": F.lit(invocation_id),
                "run_started_at": F.lit(str(started_at)),
                "run_finished_at": F.lit(str(finished_at)),
                "trigger_type": F.lit(trigger_type),
                "unique_id": F.concat_ws(".", F.lit("test"), "model_name", "rule_id"),
                "is_backfilled": F.lit(False),
            }
        )
    )


def _to_log(df: DataFrame) -> DataFrame:
    ready = df.withColumn("schema_layer", layer_of("model_name"))
    return ready.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(DQ_LOG_DDL).fields]
    )


def read_artifacts(
    spark: SparkSession, path: str | Sequence[str], ddl: str, one_per_line: bool = False
) -> DataFrame:
    """Artifact documents of many runs.

    One document per file, with the run named by the folder ``run_id=...``; or one
    document per line, carrying its ``run_id``. A document that is no JSON, or that does not
    fit the declared shape, fails the scan: a run is either read whole or not at all.
    """
    kind = schema(f"{ddl}, run_id string")
    texts = json_texts(spark, path, one_per_line)
    broken = F.raise_error(F.concat(F.lit("an artifact that does not fit: "), "file")).cast(kind)
    folder = [F.col("run_id").cast("string").alias("run")] if "run_id" in texts.columns else []
    parsed = texts.select("file", *folder, "value", F.try_parse_json("value").alias("document"))
    whole = typed_document("value", F.col("document"), kind, broken)
    # A generator, as a filter on a column would be pushed below a projection and read each document again.
    parsed = parsed.select(*(["run"] if folder else []), F.inline(F.array(whole)))
    run = F.coalesce("run", "run_id") if folder else F.col("run_id")
    return parsed.select(*[f.name for f in kind.fields if f.name != "run_id"], run.alias("run_id"))


def _node_of(entry: Column, invocation_id: Column) -> Column:
    """What the log asks of an entry of a manifest; ``test`` is NULL if it is no known test."""
    node = entry["value"]
    name = node["test_metadata"]["name"]
    test = F.struct(
        invocation_id.alias("invocation_id"),
        name.alias("test_name"),
        node["column_name"].alias("column_name"),
        node["config"]["severity"].alias("severity"),
        F.get(node["depends_on"]["nodes"], F.lit(0)).alias("model_id"),
    )
    known = (node["resource_type"] == "test") & name.isin(*_categories())
    return F.struct(entry["key"].alias("unique_id"), node["name"].alias("name"), F.when(known, test).alias("test"))


def _by_run(df: DataFrame, *columns: Column | str) -> DataFrame:
    """The rows of each run, brought together in the task numbered PLACE."""
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = F.col("run_id").cast("string").alias("run_id")
    return df.select(F.pmod(F.hash(run), F.lit(count)).alias(PLACE), run, *columns).repartitionById(count, PLACE)


def parse_artifacts(
    manifests: DataFrame,
    run_results: DataFrame,
    runs: DataFrame,
    is_backfilled: bool = False,
) -> DataFrame:
    """One log row per recognised test of each run.

    ``manifests`` has run_id and the manifest columns, ``run_results`` run_id and
    results, ``runs`` run_id, run_started_at, run_finished_at and trigger_type. Nodes
    and results are exploded and joined on (run, node), so any number of runs is
    handled at once. The model of a test is the first node it depends on.

    Documents travel to the task of their run as one row each, reduced to what the log asks for, and
    are exploded there. The joins name that task first, so none of them shuffles exploded rows.

    Spark takes exploded rows to be as large as the documents' files and would broadcast them, so
    these joins are asked to sort and merge.
    """
    placed = [PLACE, "run_id"]
    listed = F.transform(F.map_entries("nodes"), lambda e: _node_of(e, F.col("metadata.invocation_id")))
    nodes = _by_run(manifests, listed.alias("nodes")).select(*placed, F.inline_outer("nodes"))
    tests = nodes.filter(F.col("test").isNotNull()).select(*placed, "unique_id", "test.*")
    names = nodes.select(*placed, F.col("unique_id").alias("model_id"), F.col("name").alias("model_name"))
    outcomes = _by_run(run_results, "results").select(*placed, F.inline_outer("results"))
    recognised = tests.join(category_table(manifests.sparkSession), "test_name")
    # Spark sees that rows are in place after an outer join, but not after an inner one, which comes last.
    parsed = (
        recognised.join(names.hint("merge"), [*placed, "model_id"], "left")
        .join(_by_run(runs, "run_started_at", "run_finished_at", "trigger_type"), placed, "left")
        .join(outcomes.withColumnRenamed("failures", "failure_count").hint("merge"), [*placed, "unique_id"])
        .withColumn("evaluated_rows", F.lit(None).cast("bigint"))
        .withColumn("is_backfilled", F.lit(is_backfilled))
    )
    return _to_log(parsed)


def attach_row_counts(log: DataFrame, counts: DataFrame) -> DataFrame:
    """Fill evaluated_rows from (model_name, row_count), one row per model."""
    counted = log.drop("evaluated_rows").join(counts, "model_name", "left")
    return counted.withColumnRenamed("row_count", "evaluated_rows").select(*log.columns)


def model_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per model: a plain count each, combined map-side."""
    counted = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model_name"), "row_count"
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted


def successful_runs(
    runs: DataFrame, kept: int | None = RUNS_KEPT, success: int = STATUS_SUCCESS
) -> DataFrame:
    """Among the newest ``kept`` runs of any status, or all, those that succeeded."""
    if kept is None:
        return runs.filter(F.col("status") == success)
    newest = runs.orderBy(F.col("finished_at").desc(), F.col("id").desc()).limit(kept)
    return newest.filter(F.col("status") == success)


def _stored_schema() -> T.StructType:
    return schema(DQ_LOG_DDL).add(RUN_DAY, "date")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log so far: every recorded run once. Empty when nothing was ever appended."""
    return read_units(spark, path, _stored_schema(), "run_id")


def loaded_runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs whose rows are all stored, from their records alone."""
    return recorded_units(spark, path, "run_id").select("run_id")


def damaged_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs of which more or fewer rows are stored than were recorded."""
    return damaged_units(spark, path, _stored_schema(), "run_id")


def append_log(log: DataFrame, path: str) -> None:
    """Append rows, partitioned by day and clustered within files; never overwrites.

    A run counts when the record of its append is written, and once: a lost append leaves
    nothing that readers see. The rebalance hint lets adaptive execution give a small day
    one file and split a very large one.
    """
    dated = log.withColumn(RUN_DAY, F.to_date("run_finished_at"))
    append_units(dated.hint("rebalance", RUN_DAY), path, "run_id", [RUN_DAY], [RUN_DAY, "model_name", "test_category"])


def append_new_runs(log: DataFrame, path: str) -> None:
    """Append only runs that are not recorded, so repeating a backfill adds nothing and
    completes what an earlier one lost.

    Two backfills at once may both store a run; readers take it from the one recorded first.
    """
    known = loaded_runs(log.sparkSession, path)
    append_log(exclude_loaded(log, known, "run_id").select(*log.columns), path)


def backfill(
    runs: DataFrame,
    manifests: DataFrame,
    run_results: DataFrame,
    counts: DataFrame,
    loaded: DataFrame,
    kept: int | None = None,
) -> DataFrame:
    """Log rows of successful, not yet loaded runs, with today's row counts.

    All runs of the listing take part unless ``kept`` names how many of the newest do.
    """
    wanted = exclude_loaded(
        successful_runs(runs, kept).select(
            F.col("id").cast("string").alias("run_id"),
            F.col("started_at").alias("run_started_at"),
            F.col("finished_at").alias("run_finished_at"),
            F.lit("backfill").alias("trigger_type"),
        ),
        loaded,
        "run_id",
    )
    needed = wanted.select("run_id")
    parsed = parse_artifacts(
        manifests.join(needed, "run_id", "left_semi"),
        run_results.join(needed, "run_id", "left_semi"),
        wanted,
        is_backfilled=True,
    )
    return attach_row_counts(parsed, counts)


# What the summary groups by.
SUMMARY_KEYS = (
    "run_id",
    "run_finished_at",
    "trigger_type",
    "is_backfilled",
    "schema_layer",
    "model_name",
    "test_category",
    "severity",
)


def summary(log: DataFrame) -> DataFrame:
    """Failure and pass rate per run, model, category and severity.

    Failures of several tests are added up while the rows are counted once, so the
    failure rate of a group can exceed one.
    """
    grouped = log.groupBy(*SUMMARY_KEYS).agg(
        F.sum("failure_count").alias("total_failures"),
        F.max("evaluated_rows").alias("evaluated_rows"),
    )
    rate = safe_ratio("total_failures", "evaluated_rows")
    return grouped.withColumn("failure_rate", rate).withColumn("pass_rate", 1 - rate)
