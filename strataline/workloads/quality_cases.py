"""Quality rules, the fused runner, the log, and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.operators import joins, profiling
from strataline.plans import rulebook
from strataline.quality import log, rules, runner
from strataline.session import scratch_path
from strataline.sources.tables import literal_table
from strataline.workloads import declared_checks
from strataline.workloads import oracle_stages as sql
from strataline.workloads.feeds import AS_OF
from strataline.workloads.registry import case, portable

# Failing rows of each rule kind, on real texts and on dirty feeds


def _rule_case(name: str, oracle: str, pick, rule: rules.Rule, stage: str = "bronze") -> None:
    @case(name, oracle, stage)
    def build(t):
        return portable(rules.failing_rows(pick(t), rule, AS_OF))


_rule_case(
    "dq1_not_null",
    "SELECT title FROM djapi_product WHERE title IS NULL",
    lambda t: t.bronze["djapi_product"],
    rules.not_null("title"),
)
_rule_case(
    "dq2_unique",
    """SELECT cst_key, count(*) AS n_records FROM crm_cust_info WHERE cst_key IS NOT NULL
       GROUP BY cst_key HAVING count(*) > 1""",
    lambda t: t.bronze["crm_cust_info"],
    rules.unique("cst_key"),
)
_rule_case(
    "dq3_accepted_values",
    """SELECT lang, count(*) AS n_records FROM documents WHERE lang NOT IN ('en', 'de')
       GROUP BY lang""",
    lambda t: t.documents,
    rules.accepted_values("lang", "en", "de"),
)
_rule_case(
    "dq4_accepted_range",
    "SELECT value FROM events WHERE value < 1 OR value > 100",
    lambda t: t.events,
    rules.accepted_range("value", low=1, high=100),
)
_rule_case(
    "dq5_matches_pattern",
    "SELECT url FROM pages WHERE url IS NOT NULL AND NOT regexp_matches(url, '^https://[a-z.]+/')",
    lambda t: t.pages,
    rules.matches_pattern("url", "^https://[a-z.]+/"),
)
_rule_case(
    "dq6_assert_case",
    f"SELECT text FROM benchmark WHERE text <> {sql.words('text')}",
    lambda t: t.benchmark,
    rules.assert_case("text", "initcap"),
)
_rule_case(
    "dq7_no_whitespace",
    f"SELECT title FROM djapi_product WHERE length(title) <> length({sql.trim('title')})",
    lambda t: t.bronze["djapi_product"],
    rules.no_whitespace("title"),
)
_rule_case(
    "dq8_assert_length",
    "SELECT pkey FROM djapi_product WHERE length(pkey) <> 15",
    lambda t: t.bronze["djapi_product"],
    rules.assert_length("pkey", 15),
)
_rule_case(
    "dq9_not_contains_string",
    "SELECT url FROM pages WHERE strpos(url, '?') > 0",
    lambda t: t.pages,
    rules.not_contains_string("url", "?"),
)
_rule_case(
    "dq10_contains_string",
    "SELECT url FROM pages WHERE strpos(url, '/en/') = 0",
    lambda t: t.pages,
    rules.contains_string("url", "/en/"),
)


@case(
    "dq11_relationships",
    """SELECT doc_id FROM documents WHERE doc_id IS NOT NULL
       AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)""",
)
def dq11(t):
    rule = rules.relationships("doc_id", "labels", "doc_id")
    return rules.failing_rows(t.documents, rule, AS_OF, {"labels": t.labels})


_rule_case(
    "dq12_unique_combination",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    lambda t: t.lineitem,
    rules.unique_combination("l_orderkey", "l_linenumber"),
)
_rule_case(
    "dq13_assert_formula",
    """SELECT CAST(total AS DOUBLE) AS total FROM
           (SELECT TRY_CAST(sls_sales AS DECIMAL(12,2)) AS total,
                   TRY_CAST(sls_price AS DECIMAL(12,2)) AS price,
                   TRY_CAST(sls_quantity AS DECIMAL(10,0)) AS quantity FROM crm_sales_details) AS s
       WHERE total <> price * quantity""",
    lambda t: t.bronze["crm_sales_details"].select(
        F.col("sls_sales").try_cast("decimal(12,2)").alias("total"),
        F.col("sls_price").try_cast("decimal(12,2)").alias("price"),
        F.col("sls_quantity").try_cast("decimal(10,0)").alias("quantity"),
    ),
    rules.assert_formula("total", "price", "quantity"),
)
_rule_case(
    "dq14_assert_less_than",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ordered
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       WHERE CAST(o_orderdate AS DATE) >= CAST(l_shipdate AS DATE)""",
    lambda t: t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.col("l_shipdate").cast("date").alias("shipped"),
    ),
    rules.assert_less_than("ordered", "shipped"),
)


# All declared rules at once, against one counting query per check

SHOWN = ("model_name", "rule_id", "failure_count", "status", "evaluated_rows")


def _model_rules_case(model: str, declared: list[rules.Rule], stage: str) -> None:
    name = f"dq18_rules_{model}" + ("" if stage == "bronze" else "_clean")

    @case(name, declared_checks.results_sql(model), stage)
    def build(t):
        """Rules run on stored tables, so the model is computed once."""
        source = t.silver if stage == "bronze" else t.clean_silver
        star = t.star_from_bronze if stage == "bronze" else t.star
        marts = {
            "dim_customers": lambda: star.customers,
            "dim_products": lambda: star.products,
            "fact_sales": lambda: star.sales,
        }

        def table(needed: str):
            return marts[needed]() if needed in marts else source[needed]

        # The checked table first: the fact stores its dimensions, which then serve as parents.
        checked = t.stored(table(model), model)
        parents = {r.parent: table(r.parent) for r in declared if isinstance(r, rules.ParentRule)}
        return runner.check_model(model, checked, declared, AS_OF, parents).select(*SHOWN)


for _model, _declared in rulebook.STAGING.items():
    _model_rules_case(_model, _declared, "bronze")
for _model, _declared in rulebook.MARTS.items():
    _model_rules_case(_model, _declared, "clean")


_CUSTOMER_RULES = rulebook.STAGING["stg_djapi__customer"]
_RUN = {
    "run_id": "run-1",
    "started_at": "1999-12-31 08:00:00",
    "finished_at": "1999-12-31 08:05:00",
    "trigger_type": "schedule",
    "invocation_id": "inv-1",
}


# Test name and quality dimension by the start of a check's id.
_LOGGED_AS = (
    ("not_null_", "not_null", "completeness"),
    ("unique_", "unique", "uniqueness"),
    ("accepted_range_", "dbt_utils.accepted_range", "validity"),
    ("no_whitespace_", "no_whitespace", "validity"),
    ("accepted_values_", "accepted_values", "validity"),
    ("assert_case_", "assert_case", "validity"),
)


def _log_sql() -> str:
    """The log of the customer checks: all 16 columns."""
    model = "stg_djapi__customer"
    named = ", ".join(f"('{prefix}', '{test}', '{category}')" for prefix, test, category in _LOGGED_AS)
    severities = ", ".join(f"('{rule_id}', '{severity}')" for rule_id, severity, _ in declared_checks.failing_sql(model))
    return f"""SELECT 'run-1' AS run_id, 'inv-1' AS invocation_id, '{_RUN['started_at']}' AS run_started_at,
           '{_RUN['finished_at']}' AS run_finished_at, 'schedule' AS trigger_type, model_name, 'staging' AS schema_layer,
           regexp_replace(substr(rule_id, length(prefix) + 1), '_(initcap|upper|lower)$', '') AS column_name, test AS test_name,
           category AS test_category, severity, status, failure_count, evaluated_rows,
           'test.' || model_name || '.' || rule_id AS unique_id, false AS is_backfilled
    FROM ({declared_checks.results_sql(model)}) AS r JOIN (VALUES {severities}) AS s(id, severity) ON rule_id = id
         JOIN (VALUES {named}) AS known(prefix, test, category) ON starts_with(rule_id, prefix)"""


def _customer_log(t):
    model = "stg_djapi__customer"
    results = runner.check_model(model, t.silver[model], _CUSTOMER_RULES, AS_OF)
    return log.log_rows(results, **_RUN)


@case("dq19_log_rows", _log_sql(), "bronze")
def dq19(t):
    """Every column of the log."""
    return portable(_customer_log(t))


@case(
    "q25_quality_summary",
    f"""SELECT run_id, run_finished_at, trigger_type, is_backfilled, schema_layer, model_name,
               test_category, severity, CAST(sum(failure_count) AS BIGINT) AS total_failures,
               max(evaluated_rows) AS evaluated_rows,
               round(sum(failure_count) / nullif(max(evaluated_rows), 0), 6) AS failure_rate,
               round(1 - sum(failure_count) / nullif(max(evaluated_rows), 0), 6) AS pass_rate
        FROM ({_log_sql()}) AS logged
        GROUP BY run_id, run_finished_at, trigger_type, is_backfilled, schema_layer, model_name,
                 test_category, severity""",
    "bronze",
)
def q25(t):
    return portable(log.summary(_customer_log(t)), 6)


# Run artifacts: every order stands for one run with a manifest of five nodes

_TESTS = (
    ("test.a", "not_null", "o_custkey", True),
    ("test.b", "unique", "o_orderkey", True),
    ("test.c", "dbt_utils.expression_is_true", "o_orderkey", True),
    ("test.d", "assert_formula", "o_totalprice", False),
)


def _manifests(t):
    """One JSON manifest per order, parsed with the declared artifact schema."""
    model_name = F.when(F.col("o_orderstatus") == "F", "stg_orders").otherwise("dim_orders")

    def node(kind, name, test, column, depends):
        return F.struct(
            F.lit(kind).alias("resource_type"),
            name.alias("name"),
            F.struct(F.lit(test).alias("name")).alias("test_metadata"),
            F.lit(column).alias("column_name"),
            F.struct(F.lit("error").alias("severity")).alias("config"),
            F.struct(depends.alias("nodes")).alias("depends_on"),
        )

    nothing = F.array().cast("array<string>")
    entries = [F.lit("model.m"), node("model", model_name, None, None, nothing)]
    for uid, test, column, has_model in _TESTS:
        depends = F.array(F.lit("model.m")) if has_model else nothing
        entries += [F.lit(uid), node("test", F.lit(uid), test, column, depends)]
    document = F.struct(
        F.struct(F.concat(F.lit("inv-"), F.col("o_orderkey").cast("string")).alias("invocation_id"))
        .alias("metadata"),
        F.create_map(*entries).alias("nodes"),
    )
    parsed = F.from_json(F.to_json(document), log.MANIFEST_DDL)
    return t.orders.select(F.col("o_orderkey").cast("string").alias("run_id"), parsed.alias("m")).select(
        "run_id", "m.*"
    )


def _run_results(t):
    def outcome(uid, status, failures):
        return F.struct(
            F.lit(uid).alias("unique_id"),
            F.lit(status).alias("status"),
            failures.cast("bigint").alias("failures"),
        )

    none = F.lit(None)
    results = F.array(
        outcome("model.m", "success", none),
        outcome("test.a", "pass", F.lit(0)),
        outcome("test.b", "fail", F.col("o_orderkey") % 7),
        outcome("test.c", "pass", F.lit(0)),
        outcome("test.d", "warn", none),
    )
    document = F.to_json(F.struct(results.alias("results")))
    parsed = F.from_json(document, log.RUN_RESULTS_DDL)
    return t.orders.select(F.col("o_orderkey").cast("string").alias("run_id"), parsed.alias("r")).select(
        "run_id", "r.*"
    )


def _runs(t):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderdate").cast("string").alias("run_started_at"),
        F.col("o_orderdate").cast("string").alias("run_finished_at"),
        F.lit("schedule").alias("trigger_type"),
    )


def _artifact_sql(source: str, trigger: str, counts: str, backfilled: str) -> str:
    model = "CASE o_orderstatus WHEN 'F' THEN 'stg_orders' ELSE 'dim_orders' END"
    layer = "CASE o_orderstatus WHEN 'F' THEN 'staging' ELSE 'marts' END"
    common = (
        "SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'inv-' || CAST(o_orderkey AS VARCHAR) "
        f"AS invocation_id, CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS run_finished_at, "
        f"'{trigger}' AS trigger_type, {backfilled} AS is_backfilled, 'error' AS severity, "
    )
    evaluated = counts.format(model=model)
    return f"""
        {common} {model} AS model_name, {layer} AS schema_layer, 'o_custkey' AS column_name,
            'not_null' AS test_name, 'completeness' AS test_category, 'pass' AS status,
            CAST(0 AS BIGINT) AS failure_count, {evaluated} AS evaluated_rows,
            'test.a' AS unique_id FROM {source}
        UNION ALL
        {common} {model}, {layer}, 'o_orderkey', 'unique', 'uniqueness', 'fail',
            CAST(o_orderkey % 7 AS BIGINT), {evaluated}, 'test.b' FROM {source}
        UNION ALL
        {common} NULL, 'marts', 'o_totalprice', 'assert_formula', 'accuracy', 'warn', NULL, NULL,
            'test.d' FROM {source}"""


_DOCUMENTS_PER_FILE = 50_000


@case(
    "io14_artifact_scan", _artifact_sql("orders", "schedule", "CAST(NULL AS BIGINT)", "false")
)
def io14(t):
    """The artifacts go through files, one document per line.

    Every document repeats the names of its fields, so the files are compressed. Such files are not
    split, so they hold so many documents each.
    """
    manifests, results = scratch_path(t.spark, "manifests"), scratch_path(t.spark, "results")
    for documents, path in ((_manifests(t), manifests), (_run_results(t), results)):
        documents.write.option("maxRecordsPerFile", _DOCUMENTS_PER_FILE).json(path, compression="gzip")
    parsed = log.parse_artifacts(
        log.read_artifacts(t.spark, manifests, log.MANIFEST_DDL, one_per_line=True),
        log.read_artifacts(t.spark, results, log.RUN_RESULTS_DDL, one_per_line=True),
        _runs(t),
    )
    return _shown_log(parsed)


@case(
    "dq15_severity_statuses",
    f"""SELECT status, count(*) AS rule_count, CAST(sum(failure_count) AS BIGINT) AS failures
        FROM ({declared_checks.results_sql("stg_crm__prd_info")}) AS r GROUP BY status""",
    "bronze",
)
def dq15(t):
    model = "stg_crm__prd_info"
    checked = t.stored(t.silver[model], model)
    results = runner.check_model(model, checked, rulebook.STAGING[model], AS_OF)
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("rule_count"), F.sum("failure_count").alias("failures")
    )


def _shown_log(df):
    return portable(df.drop("run_started_at"))


@case("dq20_j14_parse_artifacts", _artifact_sql("orders", "schedule", "CAST(NULL AS BIGINT)", "false"))
def dq20(t):
    return _shown_log(log.parse_artifacts(_manifests(t), _run_results(t), _runs(t)))


def _run_listing(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", 20).otherwise(10).alias("status"),
        F.col("o_orderdate").cast("string").alias("started_at"),
        F.col("o_orderdate").cast("string").alias("finished_at"),
    )


@case(
    "k6_latest_runs",
    """SELECT id, status FROM (SELECT o_orderkey AS id,
              CASE o_orderstatus WHEN 'F' THEN 20 ELSE 10 END AS status
              FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20) AS newest
       WHERE status = 10""",
)
def k6(t):
    return log.successful_runs(_run_listing(t)).select("id", "status")


_WANTED = "(SELECT * FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 3 <> 0) AS wanted"
_COUNTS = (
    "CASE {model} WHEN 'stg_orders' THEN (SELECT count(*) FROM orders) "
    "ELSE (SELECT count(*) FROM lineitem) END"
)


@case("dq21_backfill", _artifact_sql(_WANTED, "backfill", _COUNTS, "true"))
def dq21(t):
    """Runs whose id divides by three count as loaded already."""
    counts = log.model_row_counts({"stg_orders": t.orders, "dim_orders": t.lineitem})
    loaded = t.orders.filter(F.col("o_orderkey") % 3 == 0).select(
        F.col("o_orderkey").cast("string").alias("run_id")
    )
    rows = log.backfill(_run_listing(t), _manifests(t), _run_results(t), counts, loaded)
    return _shown_log(rows)


# Test names as artifacts spell them, with the category that each must get.
_SPELLINGS = (
    ("not_null", "completeness"),
    ("unique", "uniqueness"),
    ("accepted_values", "validity"),
    ("dbt_utils.accepted_range", "validity"),
    ("accepted_range", "validity"),
    ("matches_pattern", "validity"),
    ("assert_case", "validity"),
    ("no_whitespace", "validity"),
    ("assert_length", "validity"),
    ("not_contains_string", "validity"),
    ("relationships", "referential_integrity"),
    ("dbt_utils.unique_combination_of_columns", "referential_integrity"),
    ("unique_combination_of_columns", "referential_integrity"),
    ("assert_formula", "accuracy"),
    ("assert_less_than", "accuracy"),
    ("expression_is_true", None),
)


@case(
    "dq16_dq17_category_and_layer",
    f"""SELECT CASE WHEN p_name LIKE 'red%' THEN 'staging' ELSE 'marts' END AS layer, test_name,
              category, count(*) AS row_count
       FROM part JOIN (VALUES {", ".join(
           f"({k}, '{name}', '{category}')" for k, (name, category) in enumerate(_SPELLINGS) if category
       )}) AS n(place, test_name, category) ON p_partkey % {len(_SPELLINGS)} = place GROUP BY ALL""",
)
def dq16(t):
    """Parts stand for tests, one spelling each; names starting with red for staging models."""
    spelled = [(k, name) for k, (name, _) in enumerate(_SPELLINGS)]
    names = literal_table(t.spark, spelled, "place int, test_name string")
    model = F.when(F.col("p_name").startswith("red"), F.concat(F.lit("stg_"), "p_name"))
    place = (F.col("p_partkey") % len(_SPELLINGS)).cast("int")
    tests = t.part.select(place.alias("place"), F.coalesce(model, "p_name").alias("model_name"))
    tagged = tests.join(names, "place").join(log.category_table(t.spark), "test_name")
    return tagged.groupBy(
        log.layer_of("model_name").alias("layer"),
        "test_name",
        F.col("test_category").alias("category"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


# Profiling


@case(
    "pr1_duplicate_keys",
    """SELECT cst_id, count(*) AS row_count FROM crm_cust_info GROUP BY cst_id
       HAVING count(*) > 1""",
    "bronze",
)
def pr1(t):
    return profiling.duplicate_keys(t.bronze["crm_cust_info"], "cst_id")


@case(
    "pr2_untrimmed",
    f"""SELECT cst_id, cst_firstname, cst_lastname FROM crm_cust_info
        WHERE length(cst_firstname) <> length({sql.trim("cst_firstname")})
           OR length(cst_lastname) <> length({sql.trim("cst_lastname")})""",
    "bronze",
)
def pr2(t):
    rows = profiling.untrimmed(t.bronze["crm_cust_info"], "cst_firstname", "cst_lastname")
    return rows.select("cst_id", "cst_firstname", "cst_lastname")


@case(
    "pr2_untrimmed_leading_only",
    """SELECT cst_id, cst_firstname FROM crm_cust_info
       WHERE length(rtrim(cst_firstname, ' ')) <> length(trim(cst_firstname, ' '))""",
    "bronze",
)
def pr2_leading(t):
    rows = profiling.untrimmed(t.bronze["crm_cust_info"], "cst_firstname", leading_only=True)
    return rows.select("cst_id", "cst_firstname")


@case(
    "pr3_value_distribution",
    "SELECT cntry, count(*) AS row_count FROM erp_loc_a101 GROUP BY cntry",
    "bronze",
)
def pr3(t):
    return profiling.distribution(t.bronze["erp_loc_a101"], "cntry")


@case(
    "pr4_missing_or_not_positive",
    """SELECT sls_ord_num, sls_price FROM crm_sales_details
       WHERE sls_price IS NULL OR CAST(sls_price AS DECIMAL(12,2)) <= 0""",
    "bronze",
)
def pr4(t):
    typed = t.bronze["crm_sales_details"].withColumn(
        "price", F.col("sls_price").try_cast("decimal(12,2)")
    )
    return profiling.missing_or_not_positive(typed, "price").select("sls_ord_num", "sls_price")


@case(
    "pr5_inverted_ranges",
    "SELECT prd_id, prd_start_dt, prd_end_dt FROM crm_prd_info WHERE prd_end_dt < prd_start_dt",
    "bronze",
)
def pr5(t):
    rows = profiling.inverted_ranges(t.bronze["crm_prd_info"], "prd_start_dt", "prd_end_dt")
    return rows.select("prd_id", "prd_start_dt", "prd_end_dt")


@case(
    "pr6_outside_horizon",
    f"""SELECT sls_ord_num, sls_ship_dt FROM crm_sales_details
        WHERE sls_ship_dt IS NULL
           OR CAST(strptime(sls_ship_dt, '%Y%m%d') AS DATE) >= DATE '{AS_OF}'""",
    "bronze",
)
def pr6(t):
    rows = profiling.outside_horizon(t.bronze["crm_sales_details"], "sls_ship_dt", AS_OF)
    return rows.select("sls_ord_num", "sls_ship_dt")


@case(
    "pr6_implausible_birthdates",
    f"SELECT cid, bdate FROM erp_cust_az12 WHERE {sql.birthday('bdate')} IS NULL",
    "bronze",
)
def pr6_birth(t):
    typed = t.bronze["erp_cust_az12"].withColumn("born", profiling.dates.iso_day("bdate"))
    return profiling.implausible_birthdates(typed, "born", AS_OF).select("cid", "bdate")


@case(
    "pr7_misordered_dates",
    """SELECT sls_ord_num, sls_order_dt, sls_ship_dt FROM crm_sales_details
       WHERE CAST(sls_order_dt AS BIGINT) > CAST(sls_ship_dt AS BIGINT)
          OR CAST(sls_order_dt AS BIGINT) > CAST(sls_due_dt AS BIGINT)""",
    "bronze",
)
def pr7(t):
    shown = ("sls_ord_num", "sls_order_dt", "sls_ship_dt")
    typed = t.bronze["crm_sales_details"].withColumns(
        {f"_{c}": F.col(c).try_cast("bigint") for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")}
    )
    return profiling.misordered(typed, "_sls_order_dt", "_sls_ship_dt", "_sls_due_dt").select(*shown)


@case(
    "pr8_orphans",
    """SELECT sls_prd_key, count(*) AS row_count FROM crm_sales_details
       WHERE sls_prd_key NOT IN (SELECT pkey FROM stg_djapi__product)
       GROUP BY sls_prd_key""",
    "bronze",
)
def pr8(t):
    lost = joins.not_in(
        t.bronze["crm_sales_details"], "sls_prd_key", t.silver["stg_djapi__product"], "pkey"
    )
    return profiling.rows_per_key(lost, "sls_prd_key")


@case(
    "pr9_not_castable",
    "SELECT cst_id, cst_key FROM crm_cust_info WHERE TRY_CAST(cst_id AS BIGINT) IS NULL",
    "bronze",
)
def pr9(t):
    return profiling.not_castable(t.bronze["crm_cust_info"], "cst_id").select("cst_id", "cst_key")


@case(
    "pr10_overlong_keys",
    """SELECT pkey, length(pkey) AS key_length FROM djapi_product GROUP BY pkey
       HAVING length(pkey) > 15""",
    "bronze",
)
def pr10(t):
    return profiling.overlong_keys(t.bronze["djapi_product"], "pkey", 15)


@case(
    "pr11_formula_mismatch",
    """SELECT id, unit_price, quantity, total_price FROM djapi_order
       WHERE TRY_CAST(unit_price AS DOUBLE) * TRY_CAST(quantity AS DOUBLE)
                 <> TRY_CAST(total_price AS DOUBLE) OR total_price IS NULL""",
    "bronze",
)
def pr11(t):
    total, price, quantity = (
        F.col(c).try_cast("double") for c in ("total_price", "unit_price", "quantity")
    )
    rows = profiling.formula_mismatch(t.bronze["djapi_order"], total, price, quantity)
    return rows.select("id", "unit_price", "quantity", "total_price")


@case(
    "pr12_outside_bounds",
    """SELECT id, quantity FROM djapi_order
       WHERE TRY_CAST(quantity AS INT) <= 0 OR TRY_CAST(quantity AS INT) >= 10""",
    "bronze",
)
def pr12(t):
    return profiling.outside_bounds(t.bronze["djapi_order"], "quantity", 0, 10, "int").select(
        "id", "quantity"
    )


@case(
    "pr14_missing_or_untrimmed",
    f"""SELECT id, title, category FROM djapi_product
        WHERE title IS NULL OR length(title) <> length({sql.trim("title")})
           OR category IS NULL OR length(category) <> length({sql.trim("category")})""",
    "bronze",
)
def pr14(t):
    rows = profiling.missing_or_untrimmed(t.bronze["djapi_product"], "title", "category")
    return rows.select("id", "title", "category")


@case(
    "pr14_missing_or_blank",
    f"SELECT cid, cntry FROM erp_loc_a101 WHERE cntry IS NULL OR {sql.trim('cntry')} = ''",
    "bronze",
)
def pr14_blank(t):
    return profiling.missing_or_blank(t.bronze["erp_loc_a101"], "cntry")


@case(
    "pr15_point_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 5979",
)
def pr15(t):
    rows = profiling.rows_with_key(t.lineitem, "l_orderkey", 5979)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@case(
    "pr16_lines_per_order",
    "SELECT l_orderkey, count(*) AS row_count FROM lineitem GROUP BY l_orderkey",
)
def pr16(t):
    return profiling.rows_per_key(t.lineitem, "l_orderkey")


def _profile_sql(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"count(*) FILTER (WHERE {sql.trim(c)} = '') AS blank_count, "
        f"count(*) FILTER (WHERE length({c}) <> length({sql.trim(c)})) AS untrimmed_count "
        f"FROM {table}"
        for c in columns
    )


@case(
    "pr_column_profile",
    _profile_sql("djapi_product", ("id", "title", "category", "pkey", "createdAt")),
    "bronze",
)
def pr_profile(t):
    return profiling.column_profile(t.bronze["djapi_product"])

