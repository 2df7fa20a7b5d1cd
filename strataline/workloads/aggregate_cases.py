"""Aggregations over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.functions import dates
from strataline.functions.numbers import safe_ratio
from strataline.operators import fingerprints, profiling, rollup
from strataline.quality import log
from strataline.workloads.registry import case, portable


@case("a1_global_sum", "SELECT round(sum(l_extendedprice), 2) AS amount FROM lineitem")
def a1(t):
    return portable(t.lineitem.agg(F.sum("l_extendedprice").alias("amount")), 2)


@case("a2_global_count", "SELECT count(cst_gndr) AS known_genders FROM crm_cust_info", "bronze")
def a2(t):
    return t.bronze["crm_cust_info"].agg(F.count("cst_gndr").alias("known_genders"))


@case(
    "a3_count_distinct",
    """SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts
       FROM lineitem""",
)
def a3(t):
    return t.lineitem.agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )


@case(
    "a4_ratio_of_aggregates",
    """SELECT round(sum(o_totalprice) / nullif(count(DISTINCT o_custkey), 0), 2) AS per_customer
       FROM orders""",
)
def a4(t):
    return portable(
        rollup.ratio_of_sum_to_distinct(t.orders, "o_totalprice", "o_custkey", "per_customer"), 2
    )


@case(
    "a5_average_as_decimal",
    "SELECT CAST(CAST(avg(l_extendedprice) AS DECIMAL(10,2)) AS DOUBLE) AS mean_price FROM lineitem",
)
def a5(t):
    mean = F.avg("l_extendedprice").cast("decimal(10,2)")
    return portable(t.lineitem.agg(mean.alias("mean_price")))


_LAG = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"


@case(
    "a6_date_difference_extremes",
    f"""SELECT min({_LAG}) AS shortest, max({_LAG}) AS longest,
               CAST(trunc(sum({_LAG}) / count(*)) AS BIGINT) AS whole_mean
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def a6(t):
    lag = dates.days_between(F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date"))
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lags = joined.select(lag.alias("lag"))
    mean = F.try_divide(F.sum("lag"), F.count("lag")).cast("bigint")
    return lags.agg(
        F.min("lag").alias("shortest"), F.max("lag").alias("longest"), mean.alias("whole_mean")
    )


@case("a7_count_by_key", "SELECT lang, count(*) AS row_count FROM documents GROUP BY lang")
def a7(t):
    return rollup.count_by(t.documents, "lang")


@case(
    "a8_sum_by_two_keys",
    """SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS amount
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def a8(t):
    grouped = t.lineitem.groupBy("l_returnflag", "l_linestatus")
    return portable(grouped.agg(F.sum("l_extendedprice").alias("amount")), 2)


@case(
    "a9_several_aggregates",
    """SELECT event_type, round(sum(value), 2) AS amount, count(*) AS row_count,
              count(DISTINCT user_id) AS users FROM events GROUP BY event_type""",
)
def a9(t):
    return portable(
        t.events.groupBy("event_type").agg(
            F.sum("value").alias("amount"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("user_id").alias("users"),
        ),
        2,
    )


@case(
    "a10_group_by_month",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS amount
       FROM orders GROUP BY 1""",
)
def a10(t):
    grouped = t.orders.groupBy(dates.month_label("o_orderdate").alias("month"))
    return portable(grouped.agg(F.sum("o_totalprice").alias("amount")), 2)


@case(
    "a11_conditional_aggregates",
    """SELECT lang, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
              sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS poor,
              sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
       FROM documents JOIN labels ON documents.doc_id = labels.doc_id GROUP BY lang""",
)
def a11(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    return joined.groupBy("lang").agg(
        F.count_if(F.col("quality") == 1).alias("good"),
        F.count_if(F.col("quality") == 0).alias("poor"),
        F.count_if(F.col("toxic") == 1).alias("toxic"),
    )


@case(
    "a11_pivot",
    """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
              count(*) FILTER (WHERE o_orderstatus = 'O') AS open,
              count(*) FILTER (WHERE o_orderstatus = 'P') AS pending
       FROM orders GROUP BY o_orderpriority""",
)
def a11_pivot(t):
    """The values are declared, so no extra job looks them up."""
    pivoted = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()
    named = pivoted.toDF("o_orderpriority", "finished", "open", "pending")
    return named.na.fill(0)


@case(
    "a12_two_level_aggregate",
    """SELECT round(avg(mean_price), 4) AS mean_of_means FROM
           (SELECT l_partkey, avg(l_extendedprice) AS mean_price FROM lineitem
            GROUP BY l_partkey) AS per_part""",
)
def a12(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(F.avg("l_extendedprice").alias("mean_price"))
    return portable(per_part.agg(F.avg("mean_price").alias("mean_of_means")), 4)


@case(
    "a13_difference_of_aggregates",
    """SELECT l_returnflag, round(avg(l_extendedprice) - avg(l_quantity), 4) AS spread
       FROM lineitem GROUP BY l_returnflag""",
)
def a13(t):
    spread = F.avg("l_extendedprice") - F.avg("l_quantity")
    return portable(t.lineitem.groupBy("l_returnflag").agg(spread.alias("spread")), 4)


@case(
    "a14_safe_ratio_per_key",
    """SELECT event_type, sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS failures,
              count(*) AS evaluated,
              round(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) / nullif(count(*), 0), 6) AS rate
       FROM events GROUP BY event_type""",
)
def a14(t):
    counted = t.events.groupBy("event_type").agg(
        F.count_if(F.col("value") > 100).alias("failures"), F.count(F.lit(1)).alias("evaluated")
    )
    return portable(counted.withColumn("rate", safe_ratio("failures", "evaluated")), 6)


@case(
    "a15_row_count_per_table",
    """SELECT 'orders' AS model_name, count(*) AS row_count FROM orders
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem
       UNION ALL SELECT 'events', count(*) FROM events
       UNION ALL SELECT 'pages', count(*) FROM pages
       UNION ALL SELECT 'conversations', count(*) FROM conversations""",
)
def a15(t):
    names = ("orders", "lineitem", "events", "pages", "conversations")
    return log.model_row_counts({name: t.table(name) for name in names})


@case(
    "a16_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def a16(t):
    return fingerprints.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@case(
    "a17_known_against_all",
    """SELECT cst_marital_status, count(*) AS row_count,
              count(cst_marital_status) AS known_count
       FROM crm_cust_info GROUP BY cst_marital_status""",
    "bronze",
)
def a17(t):
    return profiling.distribution_with_known(t.bronze["crm_cust_info"], "cst_marital_status")
