"""Scans and sinks: what is written to shared storage is read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strataline.operators import conform, joins
from strataline.plans import rulebook, warehouse
from strataline.quality import log, runner
from strataline.session import scratch_path
from strataline.sources import files, snapshots, tables
from strataline.sources.schemas import TYPED_BRONZE_DDL, schema
from strataline.workloads.feeds import AS_OF, LOAD_TS
from strataline.workloads import oracle_stages as sql
from strataline.workloads.quality_cases import _customer_log, _log_sql
from strataline.workloads.registry import CTX, case, portable


@case(
    "io1_csv_text_scan",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, '"' || text || '", end' AS text,
              CASE WHEN lang = 'de' THEN NULL ELSE lang END AS lang
       FROM documents""",
)
def io1(t):
    """Upper-case headers come back lower, NA spellings come back NULL, all is text; quotes,
    commas and line breaks inside fields come back as they were."""
    path = scratch_path(t.spark, "csv")
    lang = F.when(F.col("lang") == "de", "n/a").otherwise(F.col("lang"))
    text = F.concat(F.lit('"'), "text", F.lit('", end'))
    documents = t.spark.read.parquet(f"{t.folder}/documents.parquet")
    shown = documents.select("doc_id", text.alias("text"), lang.alias("lang"))
    writer = shown.toDF("DOC_ID", "TEXT", "LANG").write.option("header", True)
    writer.option("quoteAll", True).option("escape", '"').csv(path)
    return files.scan_csv_text(t.spark, path, ["DOC_ID", "TEXT", "LANG"])


@case(
    "io2_csv_typed_scan",
    """SELECT l_orderkey, l_linenumber, l_quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)
              AS l_shipdate FROM lineitem""",
)
def io2(t):
    path = scratch_path(t.spark, "csv-typed")
    shown = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date")
    )
    shown.write.option("header", True).csv(path)
    typed = schema("l_orderkey bigint, l_linenumber int, l_quantity double, l_shipdate date")
    return portable(files.scan_csv_typed(t.spark, path, typed))


def _carts(t):
    """A cart of two lines per event, as one JSON document each."""
    item = F.from_json("props", "k bigint").getField("k")

    def line(number: int):
        return F.struct(
            (item + number).alias("id"),
            F.col("value").alias("price"),
            F.lit(number + 1).cast("bigint").alias("quantity"),
            (F.col("value") * (number + 1)).alias("total"),
        )

    cart = F.struct(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("userId"),
        F.array(line(0), line(1)).alias("products"),
    )
    return t.events.select(F.array(cart).alias("carts"))


_CART_SQL = """SELECT event_id AS id, user_id AS cust_id, k + n AS prd_id, value AS unit_price,
       CAST(n + 1 AS BIGINT) AS quantity, value * (n + 1) AS total_price
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) AS e,
         (SELECT 0 AS n UNION ALL SELECT 1) AS line"""


@case("io3_json_documents", _CART_SQL)
def io3(t):
    path = scratch_path(t.spark, "json")
    _carts(t).write.json(path)
    return files.scan_feed(t.spark, "order", path, one_per_line=True)


@case("io5_explode_lines", _CART_SQL)
def io5(t):
    return files.flatten("order", files.elements(_carts(t), "carts"))


@case(
    "io4_flatten_objects",
    """SELECT s_suppkey AS id, s_name AS first_name, n_name AS last_name, 'female' AS gender,
              '1990-01-01' AS birthdate, n_name AS city, r_name AS state,
              substring(r_name, 1, 2) AS state_code, n_name AS country
       FROM supplier JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey""",
)
def io4(t):
    placed = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    address = F.struct(
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.substring("r_name", 1, 2).alias("stateCode"),
        F.col("n_name").alias("country"),
    )
    users = placed.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("firstName"),
        F.col("n_name").alias("lastName"),
        F.lit("female").alias("gender"),
        F.lit("1990-01-01").alias("birthDate"),
        address.alias("address"),
    )
    return files.flatten("user", users)


@case(
    "io6_stringify",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size,
              CASE WHEN p_size > 25 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS maybe
       FROM part""",
)
def io6(t):
    maybe = F.when(F.col("p_size") <= 25, F.col("p_partkey"))
    return files.bronze_text(t.part.select("p_partkey", "p_name", "p_size", maybe.alias("maybe")))


@case(
    "io7_full_refresh",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""",
)
def io7(t):
    """The second refresh replaces what the first one wrote."""
    path = scratch_path(t.spark, "refresh")
    shown = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    snapshots.replace_files(shown, path)
    unfinished = shown.filter(F.col("o_orderstatus") != "F")
    snapshots.replace_files(unfinished, path, order=["o_custkey"])
    return snapshots.read_files(t.spark, path, shown.schema)


@case(
    "io8_truncate_insert",
    "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier",
)
def io8(t):
    """Filled twice, the table holds the last filling in its own column types."""
    path = scratch_path(t.spark, "target")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    shown = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    empty = conform.align(shown, schema("s_suppkey bigint, s_name string, s_nationkey bigint"))
    empty.filter(F.lit(False)).write.option("path", path).saveAsTable(name, format="parquet")
    tables.truncate_insert(shown, name)
    tables.truncate_insert(shown, name, order=["s_nationkey"])
    return t.spark.table(name)


@case("io9_append_partitioned_log", _log_sql(), "bronze")
def io9(t):
    """Appending the same run twice leaves it once."""
    path = scratch_path(t.spark, "dq-log")
    rows = _customer_log(t)
    log.append_new_runs(rows, path)
    log.append_new_runs(rows, path)
    return portable(log.read_log(t.spark, path).drop(log.RUN_DAY))


@case(
    "io11_view",
    "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "GROUP BY n_name",
)
def io11(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    tables.publish_view(joined, "customer_nations")
    return t.spark.sql("SELECT n_name, count(*) AS customers FROM customer_nations GROUP BY n_name")


# What each rule of the API products objects to, written out: column, condition, or repeated key.
_PRODUCT_FAILURES = {
    "not_null_id": ("id", "id IS NULL"),
    "not_null_title": ("title", "title IS NULL"),
    "not_null_category": ("category", "category IS NULL"),
    "not_null_pkey": ("pkey", "pkey IS NULL"),
    "unique_id": ("id", None),
    "unique_title": ("title", None),
    "accepted_range_id": ("id", "id <= 0"),
    "no_whitespace_title": ("title", f"length(title) <> length({sql.trim('title')})"),
    "no_whitespace_category": ("category", f"length(category) <> length({sql.trim('category')})"),
    "no_whitespace_pkey": ("pkey", f"length(pkey) <> length({sql.trim('pkey')})"),
    "assert_case_title_initcap": ("title", f"title <> {sql.words('title')}"),
    "assert_case_category_initcap": ("category", f"category <> {sql.words('category')}"),
    "assert_length_pkey": ("pkey", "length(pkey) <> 15"),
    "not_contains_string_pkey": ("pkey", "strpos(pkey, '_') > 0"),
}
_PRODUCT_COLUMNS = ("id", "title", "category", "pkey")


def _product_failures_sql() -> str:
    parts = []
    for rule_id, (column, condition) in _PRODUCT_FAILURES.items():
        shown = ", ".join(c if c == column else f"NULL AS {c}" for c in _PRODUCT_COLUMNS)
        if condition is None:
            tail = f"count(*) AS n_records FROM stg_djapi__product WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"
        else:
            tail = f"NULL AS n_records FROM stg_djapi__product WHERE {condition}"
        parts.append(f"SELECT '{rule_id}' AS rule_id, {shown}, {tail}")
    return "\nUNION ALL ".join(parts)


@case("io13_failing_row_sink", _product_failures_sql(), "bronze")
def io13(t):
    """Each failed rule leaves its rows in a folder of its own; every folder is read back whole."""
    folder = scratch_path(t.spark, "audit")
    model = "stg_djapi__product"
    declared = {model: rulebook.STAGING[model]}
    stored = {model: t.stored(t.silver[model], model)}
    results = runner.check_warehouse(stored, declared, AS_OF)
    written = runner.store_failures(stored, declared, results, AS_OF, folder)
    by_id = {rule.rule_id: rule for rule in declared[model]}
    every = None
    for (_, rule_id), path in written.items():
        rows = runner.read_failures(stored[model], by_id[rule_id], path)
        shown = [F.col(c) if c in rows.columns else F.lit(None).cast(stored[model].schema[c].dataType).alias(c) for c in _PRODUCT_COLUMNS]
        count = F.col("n_records") if "n_records" in rows.columns else F.lit(None).cast("bigint").alias("n_records")
        one = rows.select(F.lit(rule_id).alias("rule_id"), *shown, count)
        every = one if every is None else every.unionByName(one)
    return every


@case(
    "io12_typed_bronze",
    """SELECT TRY_CAST(cst_id AS INT) AS cst_id, cst_key, cst_firstname, cst_lastname,
              cst_marital_status, cst_gndr FROM crm_cust_info""",
    "bronze",
)
def io12(t):
    """First-generation bronze: a typed table is created anew and filled."""
    ddl = TYPED_BRONZE_DDL["crm_cust_info"]
    name = f"bronze.crm_cust_info_{uuid.uuid4().hex}"
    tables.create_schemas(t.spark, ("bronze",))
    tables.recreate_table(t.spark, name, schema(ddl))
    typed = t.bronze["crm_cust_info"].select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema(ddl).fields]
    )
    tables.truncate_insert(typed, name)
    shown = ["cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr"]
    return t.spark.table(name).select(*shown)


@case("io15_column_subset", "SELECT sls_ord_num, sls_order_dt FROM crm_sales_details", "bronze")
def io15(t):
    return t.bronze["crm_sales_details"].select("sls_ord_num", "sls_order_dt")


@case("io16_missing_target", "SELECT o_orderkey AS run_id FROM orders")
def io16(t):
    """A log that does not exist yet excludes nothing."""
    runs = t.orders.select(F.col("o_orderkey").alias("run_id"))
    nothing = snapshots.folder_or_empty(
        t.spark, scratch_path(t.spark, "absent"), schema("run_id bigint")
    )
    return joins.exclude_loaded(runs, nothing, "run_id")


@case(
    "io17_load_stamp",
    f"SELECT r_regionkey, r_name, '{LOAD_TS}' AS dwh_create_date FROM region",
)
def io17(t):
    return portable(tables.stamp_load(t.region, LOAD_TS))


@case(
    "io10_layered_refresh",
    """SELECT data_source, count(*) AS row_count, round(sum(total_sales_amount), 2) AS total_sales
       FROM fact_sales GROUP BY data_source""",
    "bronze",
)
def io10(t):
    """Silver and gold written model by model to the tables of their layers, then read back."""
    run = uuid.uuid4().hex  # schemas of this call's own, as queries may run side by side
    layers = {layer: f"{layer}_{run}" for layer in ("silver", "gold")}
    tables.create_schemas(t.spark, layers.values())

    def materialise(df, model):
        return tables.materialise(df, model, layers[tables.layer_of(model)])

    star = warehouse.refresh(t.bronze, CTX, store=materialise)
    return portable(
        star.sales.groupBy("data_source").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("total_sales_amount").alias("total_sales")
        ),
        2,
    )


@case(
    "k4_sorted_write",
    "SELECT event_id, user_id, event_type FROM events",
)
def k4(t):
    """Sorting on write changes file layout only, never the rows."""
    path = scratch_path(t.spark, "sorted")
    shown = t.events.select("event_id", "user_id", "event_type")
    snapshots.replace_files(shown, path, order=["user_id", "event_id"])
    return conform.align(snapshots.read_files(t.spark, path, shown.schema), shown.schema)
