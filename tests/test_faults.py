from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataline.operators import faults, shipping


@pytest.fixture(scope="module")
def products(spark):
    return spark.range(1, 401).selectExpr(
        "id", "concat('Title ', id) AS title", "'a-b' AS category", "concat('ABC-', id) AS pkey"
    )


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rate_zero_changes_nothing(products):
    key = faults.record_key("product")
    clean = products.withColumn("id", F.col("id").cast("string"))
    assert as_rows(faults.inject_faults(products, key, rate=0.0)) == as_rows(clean)
    assert faults.ground_truth(products, "product", "now", rate=0.0).filter("is_corrupted").isEmpty()


def test_partitioning_does_not_matter(products):
    key = faults.record_key("product")
    one = faults.inject_faults(products.coalesce(1), key)
    many = faults.inject_faults(products.repartition(7), key)
    assert as_rows(one) == as_rows(many)


def test_flags_tell_the_truth(products):
    key = faults.record_key("product")
    dirty = products.select("id", key.alias("record_id")).join(
        faults.inject_faults(products.withColumn("record_id", key), key).drop("id"), "record_id"
    )
    flags = faults.ground_truth(products, "product", "now").filter("field_name = 'title'")
    joined = dirty.join(flags, "record_id").join(
        products.select(F.col("id").alias("i"), F.col("title").alias("clean")), F.col("id") == F.col("i")
    )
    wrong = joined.filter(F.col("is_corrupted") == faults.same_text("title", "clean"))
    assert wrong.isEmpty()


def test_four_candidate_fields_per_product(products):
    truth = faults.ground_truth(products, "product", "now")
    assert truth.count() == 4 * products.count()
    assert faults.candidate_fields(products.columns) == ["id", "title", "category", "pkey"]


def test_rate_and_strategies_are_near_their_shares(spark):
    key = F.col("id").cast("string")
    many = spark.range(20000)
    hit = many.filter(faults.draw(key, "x") < 0.4).count() / 20000
    assert abs(hit - 0.4) < 0.02
    lost = many.filter(faults.damage_text(F.lit("abc"), key, "x").isNull()).count() / 20000
    assert abs(lost - 0.04) < 0.01
    halved = many.select(faults.damage_price(F.lit(100.0), key, "x").alias("p"))
    shares = {r.p: r["count"] / 20000 for r in halved.groupBy("p").count().collect()}
    for value, share in {100.0: 0.7, 50.0: 0.13, 150.0: 0.13, 300.0: 0.02, None: 0.02}.items():
        assert abs(shares[value] - share) < 0.02


def test_unchanged_strategy_is_no_corruption(spark):
    key = F.col("id").cast("string")
    ids = spark.range(1000, 3000)
    damaged = ids.select("id", faults.damage_id(F.col("id"), key, "x").alias("d"))
    kinds = {r.d.replace(str(r.id), "#") for r in damaged.collect()}
    assert kinds == {"dummy-#", "#", " # "}


def test_order_key_joins_both_ids(spark):
    df = spark.createDataFrame([(5, 12, 3)], "id int, prd_id int, cust_id int")
    assert df.select(faults.record_key("order")).first()[0] == "5_12"


def test_bad_arguments():
    with pytest.raises(ValueError, match="data type"):
        faults.record_key("payment")
    with pytest.raises(ValueError, match="rate"):
        faults._check_rate(1.5)


@pytest.fixture(scope="module")
def order_days(spark):
    return spark.sql(
        "SELECT concat('SO', id) AS o, date_format(date_add(DATE '2020-01-01', "
        "CAST(id % 366 AS INT)), 'yyyyMMdd') AS d, '19990101' AS s FROM range(8000)"
    )


def test_delays_stay_in_season(order_days):
    shipped = shipping.order_shipments(order_days, "o", "d")
    lag = F.datediff("ship_day", "order_day")
    for number, season in shipping.SEASONS.items():
        usual = shipped.filter(
            (shipping.dates.season_number("order_day") == number)
            & ~F.month("order_day").isin(*shipping.OUTLIER_MONTHS)
        ).agg(F.min(lag), F.max(lag))
        low, high = usual.first()
        assert (low, high) == (season.shortest, season.longest)


def test_outliers_only_in_opening_months(order_days):
    shipped = shipping.order_shipments(order_days, "o", "d")
    same_day = shipped.filter(F.datediff("ship_day", "order_day") == 0)
    months = {r[0] for r in same_day.select(F.month("order_day")).distinct().collect()}
    assert months == set(shipping.OUTLIER_MONTHS)


def test_lines_without_order_date_keep_their_day(spark):
    lines = [("a", "20200610", "x"), ("a", "20200611", "y"), ("b", None, "keep"), ("c", "0", "keep")]
    df = spark.createDataFrame(lines, "o string, d string, s string")
    changed = shipping.override_ship_dates(df, "o", "d", "s")
    by_order: dict[str, set] = {}
    for row in changed.collect():
        by_order.setdefault(row.o, set()).add(row.s)
    assert by_order["b"] == by_order["c"] == {"keep"}
    assert len(by_order["a"]) == 1 and "20200615" <= by_order["a"].pop() <= "20200621"
    assert changed.columns == df.columns


def test_season_table_is_checked():
    with pytest.raises(ValueError, match="seasons"):
        shipping.check_seasons({1: shipping.SEASONS[1]})
    bad = {**shipping.SEASONS, 2: shipping.Season("Spring", 9, 3, 1)}
    with pytest.raises(ValueError, match="Spring"):
        shipping.check_seasons(bad)
