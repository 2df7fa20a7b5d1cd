"""Sales, customer and product KPIs over the gold star.

Every function takes gold DataFrames and returns a DataFrame. Money is summed in
floating point as stored and rounded only at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions import dates
from strataline.functions.codes import MISSING
from strataline.functions.numbers import percentage, safe_ratio
from strataline.operators.ranking import Falling, global_ntile, leader_per_group, top_rows
from strataline.operators.rollup import (
    column_total,
    count_by,
    ratio_of_sum_to_distinct,
    sum_through_dimension,
)
from strataline.sources.snapshots import stored_once


def ship_lag() -> Column:
    return dates.days_between("order_date", "shipping_date")


def is_known(column: str) -> Column:
    """Neither NULL nor the missing marker, however it is written ('n/a', 'N/A')."""
    return F.lower(F.col(column)) != MISSING


# Customers


def revenue_per_active_customer(sales: DataFrame) -> DataFrame:
    return ratio_of_sum_to_distinct(
        sales, "total_sales_amount", "customer_key", "avg_revenue_per_customer"
    )


def customer_count(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count("customer_key").alias("current_cust_count"))


def top_decile_revenue_share(sales: DataFrame) -> DataFrame:
    """Percentage of revenue made by the tenth of customers that spends most.

    Equal spenders are ordered by key, so that the decile is the same on every run.
    """
    spending = sales.groupBy("customer_key").agg(
        F.sum("total_sales_amount").alias("customer_total")
    )
    spending = stored_once(spending, "spending")  # a row per customer, read more than once below
    order = [Falling("customer_total"), "customer_key"]
    ranked = global_ntile(spending, 10, order, "decile")
    best = F.sum(F.when(F.col("decile") == 1, F.col("customer_total")).otherwise(0.0))
    return ranked.agg(
        (safe_ratio(best, F.sum("customer_total")) * 100).alias("top10_concentration_pct")
    )


def customers_by(customers: DataFrame, column: str) -> DataFrame:
    """Distribution over country, gender or marital status."""
    return customers.groupBy(column).agg(F.count("customer_key").alias("customer_count"))


def with_age_band(customers: DataFrame, as_of: dates.AsOf) -> DataFrame:
    return customers.filter(F.col("birthdate").isNotNull()).withColumn(
        "age_group", dates.age_band(dates.age_in_years("birthdate", as_of))
    )


def age_distribution(customers: DataFrame, as_of: dates.AsOf) -> DataFrame:
    bands = with_age_band(customers, as_of).groupBy("age_group")
    counted = bands.agg(F.count("customer_key").alias("customer_count"))
    total = column_total(counted, "customer_count")
    share = (F.col("customer_count").cast("decimal(20,2)") * 100 / total).try_cast("decimal(10,2)")
    return counted.withColumn("percentage", share).orderBy(dates.age_band_order("age_group"))


def _source_shares(counted: DataFrame, group: str) -> DataFrame:
    """Two count columns into percentages of their own totals."""
    api, csv = column_total(counted, "api_count"), column_total(counted, "csv_count")
    return counted.select(
        group,
        percentage("api_count", api).alias("api_pct"),
        percentage("csv_count", csv).alias("csv_pct"),
    )


def _per_source(api: str, csv: str) -> list[Column]:
    return [
        F.count_if(F.col("data_source") == api).alias("api_count"),
        F.count_if(F.col("data_source") == csv).alias("csv_count"),
    ]


def age_distribution_by_source(
    customers: DataFrame, as_of: dates.AsOf, api: str = "api", csv: str = "csv"
) -> DataFrame:
    bands = with_age_band(customers, as_of).groupBy("age_group")
    counted = bands.agg(*_per_source(api, csv))
    return _source_shares(counted, "age_group").orderBy(dates.age_band_order("age_group"))


def marital_distribution_by_source(
    customers: DataFrame, api: str = "api", csv: str = "csv"
) -> DataFrame:
    """Grouped by status and source: a status shows once per source that has it."""
    born = customers.filter(F.col("birthdate").isNotNull())
    counted = born.groupBy("marital_status", "data_source").agg(*_per_source(api, csv))
    return _source_shares(counted, "marital_status")


# Products


def product_name_count(products: DataFrame) -> DataFrame:
    return products.agg(F.count_distinct("product_name").alias("product_count"))


def _profit_ratios(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Per product name: mean price, mean cost and their relative difference.

    Prices are pre-summed per product key before the join. A product's cost counts
    once per order line, as an average over joined lines would have it.
    """
    per_key = sales.groupBy("product_key").agg(
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("price_count"),
        F.count(F.lit(1)).alias("line_count"),
    )
    costly = products.filter(F.col("cost") > 0).select("product_key", "product_name", "cost")
    joined = per_key.join(costly, "product_key")
    means = joined.groupBy("product_name").agg(
        safe_ratio(F.sum("price_sum"), F.sum("price_count")).alias("unit_price"),
        safe_ratio(
            F.sum(F.col("cost").cast("double") * F.col("line_count")), F.sum("line_count")
        ).alias("cost"),
    )
    return means.withColumn(
        "ratio", safe_ratio(F.col("unit_price") - F.col("cost"), F.col("unit_price"))
    )


def mean_profit_rate(sales: DataFrame, products: DataFrame) -> DataFrame:
    ratios = _profit_ratios(sales, products)
    return ratios.agg((F.avg("ratio") * 100).try_cast("decimal(10,2)").alias("avg_profit_rate"))


def mean_profit_margin(sales: DataFrame, products: DataFrame) -> DataFrame:
    ratios = _profit_ratios(sales, products)
    return ratios.agg(F.round(F.avg("ratio"), 2).alias("avg_profit_margin_pct"))


def favourite_category_by_country(
    sales: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Most ordered category of each known country; ties go to the first name.

    (product, customer) pairs are nearly as many as lines, so counting them first would not
    save a shuffle. Both dimensions are joined with two columns each, unless the lines carry
    category and country already, and the lines are counted once per (country, category), of
    which every task sends few.
    """
    placed = sales
    if "category" not in sales.columns:
        placed = placed.join(products.select("product_key", "category"), "product_key")
    if "country" not in sales.columns:
        placed = placed.join(customers.select("customer_key", "country"), "customer_key")
    counted = placed.groupBy("country", "category").agg(F.count("category").alias("line_count"))
    best = leader_per_group(
        counted, ["country"], [F.col("line_count").desc(), F.col("category").asc_nulls_last()]
    )
    return best.filter(is_known("country")).select("country", "category", "line_count")


# Sales


def total_sales(sales: DataFrame) -> DataFrame:
    return sales.agg(F.sum("total_sales_amount").alias("total_sales"))


def order_count(sales: DataFrame) -> DataFrame:
    return sales.agg(F.count_distinct("order_number").alias("total_orders"))


def mean_line_value(sales: DataFrame) -> DataFrame:
    return sales.agg(F.avg("total_sales_amount").cast("decimal(10,2)").alias("avg_order_value"))


def monthly_sales(sales: DataFrame) -> DataFrame:
    dated = sales.filter(F.col("order_date").isNotNull())
    return (
        dated.groupBy(dates.month_label("order_date").alias("month"))
        .agg(F.sum("total_sales_amount").alias("total_sales"))
        .orderBy("month")
    )


def shipped(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("order_date").isNotNull() & F.col("shipping_date").isNotNull())


def _whole_mean(value: Column) -> Column:
    """Integer average, cut towards zero as in engines that average INTs as INTs."""
    return F.try_divide(F.sum(value), F.count(value)).cast("bigint")


def monthly_ship_lag(sales: DataFrame, whole_days: bool = True) -> DataFrame:
    mean = _whole_mean(ship_lag()) if whole_days else F.avg(ship_lag())
    return (
        shipped(sales)
        .groupBy(dates.month_label("shipping_date").alias("month"))
        .agg(mean.alias("ship_lag_days"))
        .orderBy("month")
    )


def min_ship_lag(sales: DataFrame) -> DataFrame:
    return shipped(sales).agg(F.min(ship_lag()).alias("min_ship_lag_days"))


def mean_ship_lag(sales: DataFrame, whole_days: bool = True) -> DataFrame:
    mean = _whole_mean(ship_lag()) if whole_days else F.avg(ship_lag())
    return shipped(sales).agg(mean.alias("avg_ship_lag_days"))


def max_ship_lag(sales: DataFrame) -> DataFrame:
    return shipped(sales).agg(F.max(ship_lag()).alias("max_ship_lag_days"))


def _sales_through(sales: DataFrame, dimension: DataFrame, on: str, attribute: str) -> DataFrame:
    known = dimension.filter(is_known(attribute)).select(on, attribute)
    return sum_through_dimension(
        sales, known, on, [attribute, "data_source"], {"total_sales": F.col("total_sales_amount")}
    )


def top_categories(sales: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Best selling (category, source) pairs."""
    totals = _sales_through(sales, products, "product_key", "category")
    order = [F.col("total_sales").desc(), F.col("category"), F.col("data_source")]
    return top_rows(totals.select("category", "total_sales", "data_source"), limit, order)


def sales_by_country(sales: DataFrame, customers: DataFrame) -> DataFrame:
    totals = _sales_through(sales, customers, "customer_key", "country")
    return totals.orderBy(F.col("total_sales").desc(), "country", "data_source")


def sales_by_source(sales: DataFrame) -> DataFrame:
    return sales.groupBy("data_source").agg(
        F.sum("total_sales_amount").alias("total_sales"), F.count(F.lit(1)).alias("order_count")
    )


# All sales figures at once

#: Columns of lines that carry the known values of their dimensions, as :func:`known_values` gives them.
CATEGORIES, COUNTRIES = "categories", "countries"


def known_values(dimension: DataFrame, key: str, attribute: str, name: str) -> DataFrame:
    """One row per key: (value, n) of each known value of the attribute, n being its rows.

    Lines that carry this column can be added up as if joined with the dimension, without
    repeating a line whose key repeats there.
    """
    counted = dimension.filter(is_known(attribute)).groupBy(key, F.col(attribute).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias(name))


def _grains(sales: DataFrame) -> dict[str, tuple[str, ...]]:
    """Grains by the keys they group by; "order" is only counted."""
    product = CATEGORIES if CATEGORIES in sales.columns else "product_key"
    customer = COUNTRIES if COUNTRIES in sales.columns else "customer_key"
    return {
        "total": (),
        "order_month": ("order_month",),
        "ship_month": ("ship_month",),
        "product": (product, "data_source"),
        "customer": (customer, "data_source"),
        "source": ("data_source",),
        "order": ("order_number",),
    }


def sales_grains(sales: DataFrame) -> DataFrame:
    """One row per group of every grain of the sales figures, from one scan of the fact.

    Each line is expanded into the grains and aggregated once, map-side first. Lines that carry
    categories and countries are grouped by these, of which each task sends few, others by the
    keys of products and customers. Orders, as many as there are, are only counted: a second
    aggregation makes one row of them.
    """
    grains = _grains(sales)
    grain_keys = tuple(dict.fromkeys(k for keys in grains.values() for k in keys))
    lag = F.when(F.col("order_date").isNotNull() & F.col("shipping_date").isNotNull(), ship_lag())
    lines = sales.select(
        *[c for c in grain_keys if c in sales.columns],
        dates.month_label("order_date").alias("order_month"),
        dates.month_label("shipping_date").alias("ship_month"),
        "total_sales_amount",
        lag.alias("lag"),
    )
    # grouping_id has a bit per key, the first key's the highest, set where the grain drops it.
    ids = {
        sum(1 << i for i, key in enumerate(reversed(grain_keys)) if key not in keys): grain
        for grain, keys in grains.items()
    }
    grain = F.lit(None).cast("string")
    for number, name in ids.items():
        grain = F.when(F.col("_id") == number, name).otherwise(grain)
    amount = F.col("total_sales_amount")
    grouped = (
        lines.groupingSets([list(keys) for keys in grains.values()], *grain_keys)
        .agg(
            F.grouping_id().alias("_id"),
            F.sum(amount).alias("total_sales"),
            F.avg(amount).alias("mean_sales"),
            F.count(F.lit(1)).alias("line_count"),
            F.sum("lag").alias("lag_sum"),
            F.count("lag").alias("lag_count"),
            F.min("lag").alias("lag_min"),
            F.max("lag").alias("lag_max"),
        )
        .withColumn("grain", grain)
    )
    is_order = F.col("grain") == "order"
    orders = F.count(F.when(is_order & F.col("order_number").isNotNull(), 1)).alias("order_count")
    kept = [k for k in grain_keys if k != "order_number"]
    figures = ["total_sales", "mean_sales", "line_count", "lag_sum", "lag_count", "lag_min", "lag_max"]
    return grouped.groupBy("grain", *kept).agg(
        orders, *[F.max(F.when(~is_order, F.col(c))).alias(c) for c in figures]
    )


def all_sales_figures(
    sales: DataFrame, products: DataFrame, customers: DataFrame, limit: int = 10
) -> DataFrame:
    """The eleven sales figures as one table: (kpi, item, data_source, amount, whole).

    The grains are stored once, small as they are; every figure is read from them, the ones by
    category and country through the dimension of their key, unless the lines carry these.
    """
    grains = stored_once(sales_grains(sales), "sales_grains")

    def of(grain: str) -> DataFrame:
        return grains.filter(F.col("grain") == grain)

    mean_lag = F.try_divide(F.col("lag_sum"), F.col("lag_count")).cast("bigint")
    amount = F.col("total_sales")

    def shown(df: DataFrame, kpi: str, item=None, source=None, value=None, whole=None) -> DataFrame:
        cell = lambda c, kind: (F.lit(None) if c is None else c).cast(kind)
        return df.select(
            F.lit(kpi).alias("kpi"),
            cell(item, "string").alias("item"),
            cell(source, "string").alias("data_source"),
            cell(value, "double").alias("amount"),
            cell(whole, "bigint").alias("whole"),
        )

    def through(grain: str, dimension: DataFrame, key: str, attribute: str, carried: str) -> DataFrame:
        if carried in grains.columns:
            each = of(grain).select("data_source", "total_sales", F.inline(carried).alias(attribute, "n"))
            joined = each.withColumn("total_sales", F.col("total_sales") * F.col("n"))
        else:
            known = dimension.filter(is_known(attribute)).select(key, attribute)
            joined = of(grain).select(key, "data_source", "total_sales").join(known, key)
        return joined.groupBy(attribute, "data_source").agg(F.sum("total_sales").alias("total_sales"))

    total = of("total")
    order = [F.col("total_sales").desc(), F.col("category"), F.col("data_source")]
    best = top_rows(through("product", products, "product_key", "category", CATEGORIES), limit, order)
    by_country = through("customer", customers, "customer_key", "country", COUNTRIES)
    parts = [
        shown(total, "total_sales", value=amount),
        shown(of("order"), "total_orders", whole=F.col("order_count")),
        shown(total, "avg_order_value", value=F.col("mean_sales").cast("decimal(10,2)")),
        shown(of("order_month").filter("order_month IS NOT NULL"), "monthly_sales", F.col("order_month"), value=amount),
        shown(of("ship_month").filter("lag_count > 0"), "monthly_ship_lag", F.col("ship_month"), whole=mean_lag),
        shown(total, "min_ship_lag", whole=F.col("lag_min")),
        shown(total, "avg_ship_lag", whole=mean_lag),
        shown(total, "max_ship_lag", whole=F.col("lag_max")),
        shown(best, "top_categories", F.col("category"), F.col("data_source"), amount),
        shown(by_country, "sales_by_country", F.col("country"), F.col("data_source"), amount),
        shown(of("source"), "sales_by_source", None, F.col("data_source"), amount, F.col("line_count")),
    ]
    return reduce(DataFrame.unionByName, parts)
