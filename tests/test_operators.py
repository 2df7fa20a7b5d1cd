from __future__ import annotations

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataline.operators import conform, history, joins, profiling, ranges, ranking, rollup
from strataline.sources.schemas import schema

D = dt.date


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_newest_per_key_breaks_ties(spark):
    data = [(1, D(2020, 1, 1), "a"), (1, D(2020, 1, 1), "b"), (1, None, "z"), (2, None, "c")]
    df = spark.createDataFrame(data, "k int, d date, v string")
    assert rows(history.newest_per_key(df, ["k"], "d", ["v"])) == [
        (1, D(2020, 1, 1), "b"),
        (2, None, "c"),
    ]


def test_dedupe_limits_rows_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS v")
    plan = plan_of(history.newest_per_key(df, ["k"], "v", []))
    assert plan.count("WindowGroupLimit") >= 2


def _plain_lead(df):
    window = Window.partitionBy("k").orderBy("s", "t")
    return df.withColumn("n", F.lead("s").over(window))


@pytest.mark.parametrize("seed", range(4))
def test_next_start_equals_window(spark, seed):
    """One key holds most rows, starts repeat, keys may be NULL."""
    rng = random.Random(seed)
    data = []
    for i in range(300):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        start = D(2020, 1, 1) + dt.timedelta(days=rng.randrange(400))
        data.append((key, start if rng.random() > 0.05 else None, i))
    df = spark.createDataFrame(data, "k string, s date, t int").repartition(5)
    expected = _plain_lead(df)
    for cuts in (None, 2, 9):
        actual = history.next_start(df, "k", "s", "t", "n", cuts)
        assert rows(actual.select("k", "s", "t", "n")) == rows(expected.select("k", "s", "t", "n"))


def test_next_start_splits_one_key_in_one_month(spark):
    """A third of all rows on one key and one month: ranges stay even, rows unchanged."""
    df = spark.range(20_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('k', id % 2000)) AS k",
        "date_add(DATE '2020-01-01', CAST(IF(id % 3 = 0, id % 30, id % 900) AS INT)) AS s", "id AS t",
    )
    actual = history.next_start(df, "k", "s", "t", "n", cuts=12)
    assert rows(actual.select("k", "s", "t", "n")) == rows(_plain_lead(df).select("k", "s", "t", "n"))
    number = ranges.even_ranges(df, ["k", "s", "t"], 12).number
    sizes = [r[0] for r in df.groupBy(number.alias("r")).agg(F.count(F.lit(1)).alias("c")).select("c").collect()]
    assert len(sizes) >= 11 and max(sizes) <= 2 * 20_000 / len(sizes)
    assert "Join" not in plan_of(actual)


def test_close_versions(spark):
    data = [("p", D(2020, 1, 1), 1), ("p", D(2021, 1, 1), 2), ("q", D(2020, 5, 5), 3)]
    df = spark.createDataFrame(data, "k string, s date, id int")
    closed = history.close_versions(df, "k", "s", "id", "e")
    assert rows(closed.select("id", "e")) == [(1, D(2020, 12, 31)), (2, None), (3, None)]
    assert history.current_versions(closed, "e").count() == 2


@pytest.mark.parametrize("count", [0, 1, 9, 10, 11, 1503])
def test_global_ntile_equals_window(spark, count):
    df = spark.range(count).selectExpr("id", "(id * 7919) % 101 AS v")
    expected = df.withColumn("tile", F.ntile(10).over(Window.orderBy(F.col("v").desc(), F.col("id"))))
    actual = ranking.global_ntile(df, 10, [ranking.Falling("v"), "id"], "tile", cuts=5)
    assert rows(actual.select("id", "tile")) == rows(expected.select("id", "tile"))


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(5000).selectExpr("id", "(id * 7919) % 13 AS v")
    indexed = ranking.global_index(df, [F.col("v"), F.col("id")], "i", cuts=7)
    ordered = [(r.v, r.id) for r in indexed.orderBy("i").collect()]
    assert ordered == sorted(ordered)
    assert rows(indexed.select("i")) == rows(spark.range(1, 5001).toDF("i"))


def test_global_index_never_gathers_all_rows(spark):
    indexed = ranking.global_index(spark.range(2000).toDF("v"), ["v"], "i", cuts=3)
    plan = plan_of(indexed)
    assert "SinglePartition" not in plan and "Scan parquet" not in plan  # nothing stored on the way


def test_global_index_ranges_are_even_when_first_keys_repeat(spark):
    """A third of all rows share their first two keys, keys may be NULL, some fall, text is not ASCII."""
    df = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 'hot', IF(id % 11 = 0, NULL, concat('é', id % 500))) AS s",
        "IF(id % 3 = 0, 1.5D, IF(id % 7 = 0, NULL, CAST(id % 90 AS DOUBLE))) AS d",
        "date_add(DATE '2020-01-01', CAST(id % 300 AS INT)) AS day", "id",
    )
    order = [ranking.Falling("s"), F.col("d"), ranking.Falling("day"), "id"]
    ranged, _ = ranking._positions(df, order, "i", 16)
    plain = Window.orderBy(F.col("s").desc_nulls_last(), F.col("d").asc_nulls_first(), F.col("day").desc_nulls_last(), "id")
    expected = df.withColumn("i", F.row_number().over(plain))
    assert rows(ranged.select("id", "i")) == rows(expected.select("id", "i"))
    number = ranges.even_ranges(df, order, 16).number
    sizes = [r[0] for r in df.groupBy(number.alias("n")).agg(F.count(F.lit(1)).alias("c")).select("c").collect()]
    assert len(sizes) >= 14 and max(sizes) <= 2 * 30_000 / len(sizes)


@pytest.mark.parametrize(
    ("others", "kept"),
    [([], [1, 2, None]), ([2], [1]), ([2, None], []), ([None], [])],
)
def test_not_in_follows_sql(spark, others, kept):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(o,) for o in others], "o int")
    result = [r.k for r in joins.not_in(left, "k", right, "o").collect()]
    assert sorted(result, key=str) == sorted(kept, key=str)


def test_orphans_and_unmatched_differ_on_null(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,)], "o int")
    assert rows(joins.orphans(left, "k", right, "o")) == [(2,)]
    assert rows(joins.unmatched(left, "k", right, "o")) == [(2,), (None,)]


def test_override_keeps_old_where_unknown(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    lookup = spark.createDataFrame([("a", "9", 2), ("a", "8", 1)], "k string, n string, o int")
    changed = joins.override(df, lookup, "k", "v", "n", [F.col("o")])
    assert rows(changed) == [("a", "8"), ("b", "2")]


def test_union_pads_and_widens(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = spark.createDataFrame([(1.5,)], "a double")
    united = conform.union_sources([left, right], schema("a double, b int"))
    assert rows(united) == [(1.0, 2), (1.5, None)]


def test_sum_through_dimension_pre_aggregates(spark):
    fact = spark.range(1000).selectExpr("id % 5 AS k", "id AS amount", "'s' AS source")
    dimension = spark.createDataFrame([(i, "xy"[i % 2]) for i in range(5)], "k bigint, g string")
    result = rollup.sum_through_dimension(
        fact, dimension, "k", ["g", "source"], {"total": F.col("amount")}
    )
    expected = fact.join(dimension, "k").groupBy("g", "source").agg(F.sum("amount").alias("total"))
    assert rows(result) == rows(expected)
    plan = plan_of(result)
    assert plan.index("HashAggregate") < plan.index("Join")


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "g string, n int")
    assert rows(rollup.share_of_total(df, "n", "s")) == [("a", 1, 0.25), ("b", 3, 0.75)]


def test_column_profile(spark):
    df = spark.createDataFrame([(1, " x"), (2, None), (None, " ")], "n int, t string")
    assert rows(profiling.column_profile(df)) == [("n", 3, 1, 0, 0), ("t", 3, 1, 1, 2)]


def test_outside_horizon(spark):
    data = [("19990101",), ("0",), (None,), ("20000101",), ("20250230",)]
    df = spark.createDataFrame(data, "d string")
    found = profiling.outside_horizon(df, "d", "2000-01-01")
    assert rows(found) == sorted([("0",), (None,), ("20000101",), ("20250230",)], key=str)
