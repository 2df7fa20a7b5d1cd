"""Projections, filters, joins, set operations, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.functions import codes, dates, keys, text
from strataline.operators import conform, history, joins, ranking, rollup
from strataline.plans import gold
from strataline.sources.schemas import schema
from strataline.workloads.registry import CTX, case, portable

# Projections and filters


@case(
    "p1_project_rename",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment
       FROM customer""",
)
def p1(t):
    names = {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "segment"}
    return joins.rename(t.customer, names)


@case(
    "p2_staged_steps",
    """WITH casted AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day,
                              o_totalprice FROM orders),
            kept AS (SELECT * FROM casted WHERE day < DATE '1998-01-01')
       SELECT o_custkey, count(*) AS order_count, round(sum(o_totalprice), 2) AS amount
       FROM kept GROUP BY o_custkey""",
)
def p2(t):
    def casted(df):
        return df.withColumn("day", F.col("o_orderdate").cast("date"))

    def kept(df):
        return df.filter(F.col("day") < dates.day("1998-01-01"))

    def totalled(df):
        return df.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("order_count"),
            F.round(F.sum("o_totalprice"), 2).alias("amount"),
        )

    return t.orders.transform(casted).transform(kept).transform(totalled)


@case(
    "p3_derived_table_raw_key",
    """SELECT md5(CAST(raw_id AS VARCHAR) || '-' || source) AS row_key,
              CASE source WHEN 'csv' THEN 'CSV-' ELSE 'API-' END || CAST(raw_id AS VARCHAR)
                  AS raw_id
       FROM (SELECT c_custkey AS raw_id, 'csv' AS source FROM customer
             UNION ALL SELECT s_suppkey, 'api' FROM supplier) AS united""",
)
def p3(t):
    """The key hashes the raw id of the inner table, not the prefixed one."""
    united = t.customer.select(F.col("c_custkey").alias("raw_id"), F.lit("csv").alias("source"))
    united = united.unionByName(
        t.supplier.select(F.col("s_suppkey").alias("raw_id"), F.lit("api").alias("source"))
    )
    return united.select(
        keys.surrogate_key("raw_id", "source").alias("row_key"),
        keys.source_id("raw_id", "source").alias("raw_id"),
    )


@case(
    "p4_null_filters",
    """SELECT count(*) AS known_titles, count(category) AS known_categories
       FROM djapi_product WHERE title IS NOT NULL""",
    stage="bronze",
)
def p4(t):
    named = t.bronze["djapi_product"].filter(F.col("title").isNotNull())
    return named.agg(
        F.count(F.lit(1)).alias("known_titles"), F.count("category").alias("known_categories")
    )


@case(
    "p5_comparison_between",
    """SELECT l_returnflag, count(*) AS line_count FROM lineitem
       WHERE l_quantity BETWEEN 10 AND 20 AND l_extendedprice > 1000 GROUP BY l_returnflag""",
)
def p5(t):
    kept = t.lineitem.filter(F.col("l_quantity").between(10, 20) & (F.col("l_extendedprice") > 1000))
    return rollup.count_by(kept, "l_returnflag", name="line_count")


@case(
    "p6_disjunctive_validity",
    """SELECT sls_ord_num, sls_order_dt FROM crm_sales_details
       WHERE sls_order_dt IS NULL OR TRY_CAST(sls_order_dt AS BIGINT) <= 19000000
          OR try_strptime(sls_order_dt, '%Y%m%d') IS NULL
          OR CAST(try_strptime(sls_order_dt, '%Y%m%d') AS DATE) > DATE '2000-01-01'""",
    stage="bronze",
)
def p6(t):
    kept = dates.within_horizon(dates.compact_day("sls_order_dt"), CTX.as_of)
    sales = t.bronze["crm_sales_details"]
    return sales.filter(kept.isNull()).select("sls_ord_num", "sls_order_dt")


@case(
    "p7_in_list",
    """SELECT event_id, event_type FROM events WHERE event_type IN ('purchase', 'signup')""",
)
def p7(t):
    return t.events.filter(F.col("event_type").isin("purchase", "signup")).select(
        "event_id", "event_type"
    )


@case("p8_like_prefix", "SELECT cid FROM erp_cust_az12 WHERE cid LIKE 'NAS%'", stage="bronze")
def p8(t):
    return t.bronze["erp_cust_az12"].filter(F.col("cid").startswith("NAS")).select("cid")


@case(
    "p9_regex_predicate",
    "SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https://.*/[a-z]{2}/[0-9]+')",
)
def p9(t):
    return t.pages.filter(F.col("url").rlike("^https://.*/[a-z]{2}/[0-9]+")).select("page_id", "url")


@case(
    "p10_substring_containment",
    "SELECT doc_id, strpos(text, 'the') AS found_at FROM documents WHERE strpos(text, 'the') > 0",
)
def p10(t):
    found = F.instr("text", "the")
    return t.documents.filter(found > 0).select("doc_id", found.alias("found_at"))


@case(
    "p11_not_the_marker",
    """SELECT cid, cntry FROM stg_erp__loc_a101 WHERE cntry <> 'n/a'""",
    stage="bronze",
)
def p11(t):
    return t.silver["stg_erp__loc_a101"].filter(F.col("cntry") != codes.MISSING).select("cid", "cntry")


@case(
    "p12_searched_case",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN l_discount = 0 THEN 'full' WHEN l_discount < 0.05 THEN 'low'
                   ELSE 'high' END AS discount_level FROM lineitem""",
)
def p12(t):
    level = (
        F.when(F.col("l_discount") == 0, "full").when(F.col("l_discount") < 0.05, "low")
    ).otherwise("high")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", level.alias("discount_level")
    )


@case(
    "p13_simple_case_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open'
                               ELSE 'n/a' END AS status FROM orders""",
)
def p13(t):
    status = codes.map_codes("o_orderstatus", {"F": "Finished", "O": "Open"})
    return t.orders.select("o_orderkey", status.alias("status"))


@case(
    "p14_constant_filter_in_join",
    """SELECT o_orderkey, c_name FROM orders
       JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""",
)
def p14(t):
    builders = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return t.orders.join(builders, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name"
    )


@case("p15_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def p15(t):
    return t.events.select("user_id", "event_type").distinct()


@case(
    "p16_drop_incomplete",
    """SELECT cid, bdate, gen FROM erp_cust_az12
       WHERE cid IS NOT NULL AND bdate IS NOT NULL AND gen IS NOT NULL""",
    stage="bronze",
)
def p16(t):
    return conform.drop_incomplete(t.bronze["erp_cust_az12"])


@case(
    "p17_having",
    """SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY o_custkey
       HAVING count(*) > 10""",
)
def p17(t):
    return rollup.count_by(t.orders, "o_custkey", name="order_count").filter(
        F.col("order_count") > 10
    )


# Joins


@case(
    "j1_two_lookups",
    """SELECT cst_id, cntry, gen, CAST(bdate AS VARCHAR) AS bdate
       FROM stg_crm__cust_info LEFT JOIN stg_erp__cust_az12 AS a ON cst_key = a.cid
            LEFT JOIN stg_erp__loc_a101 AS b ON cst_key = b.cid""",
    stage="bronze",
)
def j1(t):
    people = t.silver["stg_crm__cust_info"]
    born = t.silver["stg_erp__cust_az12"].select(F.col("cid").alias("cst_key"), "bdate", "gen")
    lives = t.silver["stg_erp__loc_a101"].select(F.col("cid").alias("cst_key"), "cntry")
    joined = joins.attach(joins.attach(people, born, ["cst_key"]), lives, ["cst_key"])
    return portable(joined.select("cst_id", "cntry", "gen", "bdate"))


@case(
    "j2_category_lookup",
    """SELECT prd_id, cat_id, cat, subcat FROM stg_crm__prd_info
       LEFT JOIN stg_erp__px_cat_g1v2 AS c ON cat_id = c.id""",
    stage="bronze",
)
def j2(t):
    categories = t.silver["stg_erp__px_cat_g1v2"].select(F.col("id").alias("cat_id"), "cat", "subcat")
    return joins.attach(t.silver["stg_crm__prd_info"], categories, ["cat_id"]).select(
        "prd_id", "cat_id", "cat", "subcat"
    )


@case(
    "j3_natural_key_join",
    """SELECT sls_ord_num, sls_prd_key, p.product_id FROM stg_crm__sales_details
       JOIN dim_products AS p ON sls_prd_key = p.product_number""",
    stage="bronze",
)
def j3(t):
    products = t.star_from_bronze.products.select("product_number", "product_id")
    sales = t.silver["stg_crm__sales_details"]
    return sales.join(products, F.col("sls_prd_key") == F.col("product_number")).select(
        "sls_ord_num", "sls_prd_key", "product_id"
    )


@case(
    "j4_computed_key_join",
    """SELECT o.id, o.prd_id, c.customer_key, c.country FROM stg_djapi__order AS o
       JOIN dim_customers AS c
         ON c.customer_id = 'API-' || CAST(o.cust_id AS VARCHAR)""",
    stage="bronze",
)
def j4(t):
    """The dimension keeps the raw id, so no text surgery on the prefixed one."""
    api = t.star_from_bronze.keyed_customers.filter(F.col("data_source") == "api")
    orders = t.silver["stg_djapi__order"]
    return orders.join(api, F.col("cust_id").cast("string") == F.col(gold.RAW_ID)).select(
        "id", "prd_id", "customer_key", "country"
    )


@case(
    "j5_star_join",
    """SELECT c.country, p.category, count(*) AS line_count, sum(s.quantity) AS quantity
       FROM fact_sales AS s JOIN dim_products AS p ON s.product_key = p.product_key
            JOIN dim_customers AS c ON s.customer_key = c.customer_key
       GROUP BY c.country, p.category""",
)
def j5(t):
    """Each line is joined with both dimensions while the fact finds its keys there."""
    joined = t.star.sales_with(["category"], ["country"])
    return joined.groupBy("country", "category").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("quantity").alias("quantity")
    )


@case(
    "j6_rollup_through_dimension",
    """SELECT n_name, round(sum(o_totalprice), 2) AS amount, count(*) AS order_count
       FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def j6(t):
    buyers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), "n_name"
    )
    sums = {"amount": F.col("o_totalprice"), "order_count": F.lit(1)}
    return portable(rollup.sum_through_dimension(t.orders, buyers, "o_custkey", ["n_name"], sums), 2)


@case(
    "j7_semi_joins",
    """SELECT event_id, user_id, k FROM
           (SELECT event_id, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
            FROM events) AS e
       WHERE k IN (SELECT p_partkey FROM part) AND user_id IN (SELECT s_suppkey FROM supplier)""",
)
def j7(t):
    item = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    lines = t.events.select("event_id", "user_id", item.alias("k"))
    known = joins.keep_members(lines, "k", t.part, "p_partkey")
    return joins.keep_members(known, "user_id", t.supplier, "s_suppkey")


@case(
    "j8_not_in",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def j8(t):
    absent = joins.not_in(t.orders, "o_orderkey", t.lineitem, "l_orderkey")
    return absent.select("o_orderkey", "o_custkey")


@case(
    "j8_not_in_with_null",
    """SELECT count(*) AS row_count FROM orders WHERE CAST(o_custkey AS VARCHAR) NOT IN
           (SELECT cst_id FROM crm_cust_info)""",
    stage="bronze",
)
def j8_null(t):
    """A NULL in the list keeps nothing."""
    orders = t.orders.withColumn("cst", F.col("o_custkey").cast("string"))
    absent = joins.not_in(orders, "cst", t.bronze["crm_cust_info"], "cst_id")
    return absent.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "j9_unmatched",
    """SELECT ec.cid, ec.gen FROM erp_cust_az12 AS ec
       LEFT JOIN (SELECT cst_key FROM crm_cust_info) AS cc ON replace(ec.cid, 'NAS', '') = cc.cst_key
       WHERE cc.cst_key IS NULL
       UNION ALL
       SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus FROM orders
       LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL""",
    stage="bronze",
)
def j9(t):
    people = joins.unmatched(
        t.bronze["erp_cust_az12"],
        text.remove_text("cid", "NAS"),
        t.bronze["crm_cust_info"],
        "cst_key",
    ).select("cid", "gen")
    empty_orders = joins.unmatched(t.orders, "o_orderkey", t.lineitem, "l_orderkey").select(
        F.col("o_orderkey").cast("string").alias("cid"), F.col("o_orderstatus").alias("gen")
    )
    return people.unionByName(empty_orders)


@case(
    "j10_orphans",
    """SELECT event_id, user_id FROM events
       WHERE user_id IS NOT NULL AND NOT EXISTS
           (SELECT 1 FROM supplier WHERE s_suppkey = user_id)""",
)
def j10(t):
    return joins.orphans(t.events, "user_id", t.supplier, "s_suppkey").select("event_id", "user_id")


@case(
    "j11_keyed_override",
    """SELECT o_orderkey, coalesce(best.flag, o_orderstatus) AS o_orderstatus
       FROM orders LEFT JOIN (SELECT l_orderkey, l_returnflag AS flag FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,
                l_extendedprice, l_partkey, l_suppkey, l_returnflag) = 1) AS best
         ON o_orderkey = best.l_orderkey""",
)
def j11(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    order = [
        F.col(c)
        for c in ("l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_returnflag")
    ]
    changed = joins.override(
        t.orders, lines, "o_orderkey", "o_orderstatus", "l_returnflag", order
    )
    return changed.select("o_orderkey", "o_orderstatus")


@case(
    "j12_exclude_loaded",
    """SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def j12(t):
    return joins.exclude_loaded(t.documents.select("doc_id", "source"), t.labels, "doc_id")


@case(
    "j13_attach_counts",
    """SELECT doc_id, d.lang, n.docs FROM documents AS d
       LEFT JOIN (SELECT lang, count(*) AS docs FROM documents GROUP BY lang) AS n
         ON d.lang = n.lang""",
)
def j13(t):
    counts = rollup.count_by(t.documents, "lang", name="docs")
    return joins.attach(t.documents.select("doc_id", "lang"), counts, ["lang"])


@case(
    "j15_disagreements",
    """SELECT cst_id, cst_gndr, gen FROM stg_crm__cust_info
       LEFT JOIN stg_erp__cust_az12 AS a ON cst_key = a.cid
       WHERE trim(lower(cst_gndr)) <> trim(lower(gen))""",
    stage="bronze",
)
def j15(t):
    left, right = t.silver["stg_crm__cust_info"], t.silver["stg_erp__cust_az12"]
    pairs = joins.disagreements(
        left, right, F.col("cst_key") == F.col("cid"), F.col("cst_gndr"), F.col("gen")
    )
    return pairs.select("cst_id", "cst_gndr", "gen")


# Set operations


@case(
    "u1_union_sources",
    """SELECT c_custkey AS id, c_name AS name, 'csv' AS source FROM customer
       UNION ALL SELECT s_suppkey, s_name, 'api' FROM supplier""",
)
def u1(t):
    left = joins.rename(t.customer, {"c_custkey": "id", "c_name": "name"})
    right = joins.rename(t.supplier, {"s_suppkey": "id", "s_name": "name"})
    return conform.union_sources(
        [conform.with_constants(left, source="csv"), conform.with_constants(right, source="api")],
        schema("id bigint, name string, source string"),
    )


@case(
    "u2_null_padding",
    """SELECT p_partkey AS id, p_brand AS brand, p_size AS size, p_retailprice AS price FROM part
       UNION ALL SELECT CAST(user_id AS BIGINT), NULL, NULL, value FROM events""",
)
def u2(t):
    parts = joins.rename(
        t.part, {"p_partkey": "id", "p_brand": "brand", "p_size": "size", "p_retailprice": "price"}
    )
    lines = joins.rename(t.events, {"user_id": "id", "value": "price"})
    return conform.union_sources(
        [parts, lines], schema("id bigint, brand string, size int, price double")
    )


@case(
    "u3_constant_padding",
    """SELECT s_suppkey AS id, 'n/a' AS customer_number, 'n/a' AS marital_status,
              'api' AS data_source FROM supplier""",
)
def u3(t):
    ids = joins.rename(t.supplier, {"s_suppkey": "id"})
    return conform.with_constants(
        ids, customer_number="n/a", marital_status="n/a", data_source="api"
    )


@case(
    "u4_numeric_widening",
    """SELECT CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders
       UNION ALL SELECT value FROM events""",
)
def u4(t):
    exact = t.orders.select(F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    floating = t.events.select(F.col("value").alias("amount"))
    return conform.union_sources([exact, floating], schema("amount double"))


@case(
    "u5_set_difference",
    "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)",
)
def u5(t):
    users = t.events.select("user_id").distinct()
    return joins.exclude_loaded(users, joins.rename(t.supplier, {"s_suppkey": "user_id"}), "user_id")


# Ordering


@case(
    "k1_order_by",
    """SELECT n_name, count(*) AS customers FROM customer
       JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY customers DESC, n_name""",
)
def k1(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    counted = rollup.count_by(joined, "n_name", name="customers")
    return counted.orderBy(F.col("customers").desc(), "n_name")


@case(
    "k2_custom_order",
    """SELECT o_orderpriority, count(*) AS order_count FROM orders GROUP BY o_orderpriority
       ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END""",
)
def k2(t):
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(
        F.col("o_orderpriority") == "2-HIGH", 2
    )
    counted = rollup.count_by(t.orders, "o_orderpriority", name="order_count")
    return counted.orderBy(rank.otherwise(3))


@case(
    "k3_top_ten",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def k3(t):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return ranking.top_rows(t.orders.select("o_orderkey", "o_totalprice"), 10, order)


@case(
    "k5_first_row_per_key",
    """SELECT user_id, event_id, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def k5(t):
    first = history.first_per_key(t.events, ["user_id"], [F.col("ts"), F.col("event_id")])
    return first.select("user_id", "event_id", "event_type")


# Windows


@case(
    "w1_newest_per_key",
    """SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
       FROM orders QUALIFY row_number() OVER
           (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def w1(t):
    newest = history.newest_per_key(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return newest.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day")
    )


@case(
    "w2_max_per_composite_key",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def w2(t):
    best = history.newest_per_key(
        t.lineitem, ["l_orderkey", "l_linenumber"], "l_extendedprice", ["l_partkey", "l_suppkey"]
    )
    return best.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")


_VERSIONS = """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS start_day,
    lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey
        ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS end_day FROM orders"""


def _versions(t):
    starts = t.orders.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("start_day")
    )
    return history.close_versions(starts, "o_custkey", "start_day", "o_orderkey", "end_day")


@case(
    "w3_version_intervals",
    f"""SELECT o_custkey, o_orderkey, CAST(start_day AS VARCHAR) AS start_day,
               CAST(end_day AS VARCHAR) AS end_day FROM ({_VERSIONS}) AS v""",
)
def w3(t):
    return portable(_versions(t))


@case(
    "w4_current_versions",
    f"""SELECT o_custkey, o_orderkey, CAST(start_day AS VARCHAR) AS start_day
        FROM ({_VERSIONS}) AS v WHERE end_day IS NULL""",
)
def w4(t):
    return portable(history.current_versions(_versions(t), "end_day").drop("end_day"))


@case(
    "w5_global_ntile",
    """SELECT o_orderkey, ntile(10) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS decile
       FROM orders""",
)
def w5(t):
    order = [ranking.Falling("o_totalprice"), "o_orderkey"]
    return ranking.global_ntile(t.orders.select("o_orderkey", "o_totalprice"), 10, order, "decile").select(
        "o_orderkey", "decile"
    )


@case(
    "w6_share_of_total",
    """SELECT event_type, count(*) AS row_count,
              round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY event_type""",
)
def w6(t):
    counted = rollup.count_by(t.events, "event_type")
    return portable(rollup.share_of_total(counted, "row_count", "share"), 6)


@case(
    "w7_leader_per_group",
    """SELECT n_name, c_mktsegment, customers FROM
           (SELECT n_name, c_mktsegment, count(*) AS customers FROM customer
            JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment) AS counted
       QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY customers DESC, c_mktsegment) = 1""",
)
def w7(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    counted = rollup.count_by(joined, "n_name", "c_mktsegment", name="customers")
    return ranking.leader_per_group(
        counted, ["n_name"], [F.col("customers").desc(), F.col("c_mktsegment")]
    )


@case(
    "w8_dense_keys",
    """SELECT row_number() OVER (ORDER BY id, source) AS dense_key, id, source FROM
           (SELECT c_custkey AS id, 'csv' AS source FROM customer
            UNION ALL SELECT s_suppkey, 'api' FROM supplier) AS united""",
)
def w8(t):
    left = conform.with_constants(joins.rename(t.customer, {"c_custkey": "id"}), source="csv")
    right = conform.with_constants(joins.rename(t.supplier, {"s_suppkey": "id"}), source="api")
    united = left.unionByName(right)
    return ranking.dense_keys(united, [F.col("id"), F.col("source")], "dense_key")


@case(
    "o1_global_index",
    """SELECT row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey,
                                 l_suppkey, l_quantity) AS place,
              l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem""",
)
def o1(t):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    order = [ranking.Falling("l_extendedprice"), *columns]
    indexed = ranking.global_index(t.lineitem.select(*columns, "l_extendedprice"), order, "place")
    return indexed.select("place", *columns[:4])

