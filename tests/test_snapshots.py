"""Refreshes that fail half-way, appends that are lost, repeated or made at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.quality import log, rules, runner
from strataline.sources import schemas, snapshots, tables
from strataline.sources.schemas import schema

PAIR = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def pairs(spark, *rows):
    return spark.createDataFrame(rows, PAIR)


def failing(df):
    """Fails in a task, while other tasks have written their rows."""
    spread = df.repartition(4).withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("source lost"))).otherwise(F.col("v")))
    return spread.select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("string").alias("v"))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


OLD = [(1, "a"), (2, "b")]
NEW = [(1, "x"), (3, "y"), (4, "z")]


def test_failed_refresh_leaves_the_old_files(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.read_files(spark, path, PAIR).isEmpty()
    snapshots.replace_files(pairs(spark, *OLD), path)
    with pytest.raises(Exception, match="source lost"):
        snapshots.replace_files(failing(pairs(spark, *NEW)), path)
    assert rows_of(snapshots.read_files(spark, path, PAIR)) == OLD
    snapshots.replace_files(pairs(spark, *NEW), path, order=["v"])
    assert rows_of(snapshots.read_files(spark, path, PAIR)) == NEW


def test_a_refresh_may_read_its_own_target(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace_files(pairs(spark, *OLD), path)
    current = snapshots.read_files(spark, path, PAIR)
    snapshots.replace_files(current.unionByName(current), path)
    assert rows_of(snapshots.read_files(spark, path, PAIR)) == sorted(OLD + OLD)
    snapshots.replace_files(current.limit(0), path)
    assert snapshots.read_files(spark, path, PAIR).isEmpty()


def test_rows_without_a_pointer_are_not_current(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_once(pairs(spark, *NEW), f"{path}/versions/lost")
    assert snapshots.current_version(spark, path) is None
    version = snapshots.replace_files(pairs(spark, *OLD), path)
    assert snapshots.current_version(spark, path) == version


@pytest.mark.parametrize("write", [tables.full_refresh, tables.truncate_insert])
def test_failed_refresh_leaves_the_old_table(spark, write):
    name = f"atomic_{write.__name__}"
    tables.full_refresh(pairs(spark, *OLD), name)
    with pytest.raises(Exception, match="source lost"):
        write(failing(pairs(spark, *NEW)), name)
    assert rows_of(spark.table(name)) == OLD
    write(spark.table(name).unionByName(pairs(spark, (9, "n"))), name)
    assert rows_of(spark.table(name)) == [*OLD, (9, "n")]
    assert tables.drop_old_versions(spark, name) == 2  # the first one and the lost one
    assert rows_of(spark.table(name)) == [*OLD, (9, "n")]


def test_refresh_may_change_the_definition(spark):
    name = "atomic_definition"
    tables.full_refresh(pairs(spark, *OLD), name)
    tables.full_refresh(spark.createDataFrame([("k", 1.5)], "k string, d double"), name)
    assert spark.table(name).dtypes == [("k", "string"), ("d", "double")]
    with pytest.raises(Exception):
        tables.truncate_insert(failing(pairs(spark, *NEW)), name)
    assert rows_of(spark.table(name)) == [("k", 1.5)]


def test_refresh_of_a_managed_table(spark):
    name = "atomic_managed"
    tables.recreate_table(spark, name, PAIR)
    tables.truncate_insert(pairs(spark, *OLD), name)
    assert rows_of(spark.table(name)) == OLD
    spark.sql(f"CREATE TABLE {name}_parts (id BIGINT, v STRING) USING parquet PARTITIONED BY (v)")
    with pytest.raises(ValueError, match="partitioned"):
        tables.truncate_insert(pairs(spark, *OLD), f"{name}_parts")


# --- appends ------------------------------------------------------------------------------------

AS_OF = "2031-01-01"


@pytest.fixture(scope="module")
def run_log(spark):
    people = spark.createDataFrame([(1, "a"), (2, None), (2, " b")], "id int, name string")

    def build(run_id, day="2031-02-03"):
        checks = [rules.not_null("name"), rules.unique("id"), rules.no_whitespace("name")]
        results = runner.check_model("stg_people", people, checks, AS_OF)
        return log.log_rows(results, run_id, f"{day} 08:15:00", f"{day} 08:22:30")

    return build


def runs_in(spark, path):
    return {r.run_id: r.n for r in log.read_log(spark, path).groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_a_lost_append_is_completed_by_the_next(spark, run_log, tmp_path):
    path = str(tmp_path / "log")
    rows = run_log("run-1")
    # A driver lost after the first file: rows are there, their record is not.
    part = rows.limit(1).withColumn(log.RUN_DAY, F.to_date("run_finished_at"))
    part.write.partitionBy(log.RUN_DAY).parquet(f"{path}/rows/attempt=lost")
    assert log.read_log(spark, path).isEmpty() and log.loaded_runs(spark, path).isEmpty()
    log.append_new_runs(rows, path)
    assert runs_in(spark, path) == {"run-1": 3}
    log.append_new_runs(rows, path)
    assert runs_in(spark, path) == {"run-1": 3}
    assert log.damaged_runs(spark, path).isEmpty()


def test_an_append_that_fails_in_a_task_leaves_nothing(spark, run_log, tmp_path):
    path = str(tmp_path / "log")
    log.append_new_runs(run_log("run-0"), path)
    rows = run_log("run-1").unionByName(run_log("run-2"))
    lost = rows.withColumn("status", F.when(F.col("test_name") == "unique", F.raise_error(F.lit("gone"))).otherwise(F.col("status")))
    lost = lost.withColumn("status", F.col("status").cast("string"))
    with pytest.raises(Exception, match="gone"):
        log.append_new_runs(lost, path)
    assert runs_in(spark, path) == {"run-0": 3}
    log.append_new_runs(rows, path)
    assert runs_in(spark, path) == {"run-0": 3, "run-1": 3, "run-2": 3}


def test_two_appends_at_once_count_once(spark, run_log, tmp_path):
    path = str(tmp_path / "log")
    both = run_log("run-1")
    log.append_log(both, path)  # neither has seen the other's record
    log.append_log(both.unionByName(run_log("run-2", "2031-02-04")), path)
    assert runs_in(spark, path) == {"run-1": 3, "run-2": 3}
    days = log.read_log(spark, path).select(log.RUN_DAY).distinct().collect()
    assert sorted(str(r[0]) for r in days) == ["2031-02-03", "2031-02-04"]


def test_a_run_that_lost_files_is_listed(spark, run_log, tmp_path):
    path = tmp_path / "log"
    log.append_log(run_log("run-1"), str(path))
    log.append_log(run_log("run-2", "2031-02-04"), str(path))
    for file in path.glob("rows/*/run_date=2031-02-04/*.parquet"):
        file.rename(tmp_path / file.name)
    assert [(r.run_id, r.row_count, r.found) for r in log.damaged_runs(spark, str(path)).collect()] == [("run-2", 3, 0)]


def test_rows_without_a_run_are_refused(spark, run_log, tmp_path):
    with pytest.raises(Exception, match="a row without run_id"):
        log.append_log(run_log("run-1").withColumn("run_id", F.lit(None).cast("string")), str(tmp_path / "log"))


def test_stored_log_has_the_declared_columns(spark, run_log, tmp_path):
    path = str(tmp_path / "log")
    log.append_log(run_log("run-1"), path)
    assert log.read_log(spark, path).drop(log.RUN_DAY).schema.simpleString() == schema(schemas.DQ_LOG_DDL).simpleString()


def test_stored_hashed_keys_take_less_than_their_text(spark, tmp_path):
    """32 hex digits hold 16 bytes."""
    path = str(tmp_path / "keys")
    keys = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("key"))
    snapshots.write_once(keys, path)
    assert sum(f.stat().st_size for f in (tmp_path / "keys").glob("*.parquet")) < 20_000 * 24
    assert spark.read.parquet(path).exceptAll(keys).count() == 0
