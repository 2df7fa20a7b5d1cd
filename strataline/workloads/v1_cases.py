"""First-generation rules, where they differ from the current ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.functions import codes
from strataline.plans import gold, kpis, silver, warehouse
from strataline.workloads import oracle_stages as sql
from strataline.workloads.feeds import AS_OF
from strataline.workloads.kpi_cases import BAND
from strataline.workloads.registry import V1_CTX, case, portable
from strataline.workloads.scalar_cases import titled


def _v1_star(t, dense: bool = False) -> warehouse.Star:
    return warehouse.Star(t.clean_silver, V1_CTX, dense)


_CUSTOMERS = """(SELECT CAST(cst_id AS BIGINT) AS id, cst_key AS customer_number, cntry AS country,
                        bdate AS birthdate, 'crm-csv' AS data_source
                 FROM stg_crm__cust_info LEFT JOIN stg_erp__cust_az12 AS a ON cst_key = a.cid
                      LEFT JOIN stg_erp__loc_a101 AS b ON cst_key = b.cid
                 UNION ALL SELECT id, 'n/a', country, birthdate, 'dummyjson-api'
                 FROM stg_djapi__customer) AS people"""


@case(
    "t1_t2_dense_customer_keys",
    f"""SELECT row_number() OVER (ORDER BY id, data_source) AS customer_key,
               CASE data_source WHEN 'crm-csv' THEN 'CSV-' ELSE 'API-' END || CAST(id AS VARCHAR)
                   AS customer_id, customer_number, country, data_source FROM {_CUSTOMERS}""",
)
def t1(t):
    return _v1_star(t, dense=True).customers.select(
        "customer_key", "customer_id", "customer_number", "country", "data_source"
    )


_KEYED_CUSTOMERS = f"""(SELECT row_number() OVER (ORDER BY id NULLS FIRST, data_source NULLS FIRST) AS customer_key, id, data_source
    FROM {_CUSTOMERS})"""
_KEYED_PRODUCTS = """(SELECT row_number() OVER (ORDER BY id NULLS FIRST, source NULLS FIRST) AS product_key, id, number, source FROM
    (SELECT CAST(prd_id AS BIGINT) AS id, prd_key AS number, 'erp-csv' AS source FROM stg_crm__prd_info WHERE prd_end_dt IS NULL
     UNION ALL SELECT id, pkey, 'dummyjson-api' FROM stg_djapi__product) AS x)"""
_LINES = f"""(SELECT replace(sls_ord_num, 'SO', '') AS order_number, product_key, customer_key, sls_order_dt AS order_date,
           sls_ship_dt AS shipping_date, sls_due_dt AS due_date, CAST(sls_sales AS DOUBLE) AS total_sales_amount,
           CAST(sls_quantity AS BIGINT) AS quantity, CAST(sls_price AS DOUBLE) AS unit_price, 'crm-csv' AS data_source
    FROM stg_crm__sales_details JOIN {_KEYED_PRODUCTS} AS p ON sls_prd_key = p.number
         JOIN {_KEYED_CUSTOMERS} AS c ON sls_cust_id = c.id AND c.data_source = 'crm-csv'
    UNION ALL
    SELECT CAST(o.id AS VARCHAR), product_key, customer_key, CAST(dwh_create_date AS DATE), NULL, NULL,
           CAST(total_price AS DOUBLE), CAST(quantity AS BIGINT), CAST(unit_price AS DOUBLE), 'dummyjson-api'
    FROM stg_djapi__order AS o JOIN {_KEYED_PRODUCTS} AS p ON o.prd_id = p.id AND p.source = 'dummyjson-api'
         JOIN {_KEYED_CUSTOMERS} AS c ON o.cust_id = c.id AND c.data_source = 'dummyjson-api')"""
_KEY_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "TRY_CAST(order_number AS BIGINT)", "data_source", "order_number", "product_key", "customer_key", "order_date", "shipping_date",
        "due_date", "total_sales_amount", "quantity", "unit_price",
    )
)


@case(
    "t1_dense_fact_keys",
    f"""SELECT row_number() OVER (ORDER BY {_KEY_ORDER}) AS order_key,
               CASE data_source WHEN 'crm-csv' THEN 'CSV-' ELSE 'API-' END || order_number AS order_number,
               product_key, customer_key, total_sales_amount, quantity, unit_price, data_source FROM {_LINES} AS lines""",
)
def t1_fact(t):
    """Every line of both sources with its consecutive key."""
    sales = _v1_star(t, dense=True).sales
    shown = ["order_key", "order_number", "product_key", "customer_key", "total_sales_amount", "quantity", "unit_price", "data_source"]
    return portable(sales.select(*shown))


@case(
    "t2_age_distribution_v1_labels",
    f"""SELECT age_group,
               CAST(round(api * 100.0 / nullif(sum(api) OVER (), 0), 2) AS DOUBLE) AS api_pct,
               CAST(round(csv * 100.0 / nullif(sum(csv) OVER (), 0), 2) AS DOUBLE) AS csv_pct
        FROM (SELECT age_group,
                     sum(CASE WHEN data_source = 'dummyjson-api' THEN 1 ELSE 0 END) AS api,
                     sum(CASE WHEN data_source = 'crm-csv' THEN 1 ELSE 0 END) AS csv
              FROM (SELECT data_source, {BAND} AS age_group FROM {_CUSTOMERS}
                    WHERE birthdate IS NOT NULL) AS banded GROUP BY age_group) AS counted""",
)
def t2(t):
    customers = _v1_star(t).customers
    labels = gold.V1_LABELS
    return portable(
        kpis.age_distribution_by_source(customers, AS_OF, labels.api, labels.crm), 2
    )


@case(
    "t3_sales_repair",
    """SELECT sls_ord_num, sls_prd_key,
              CAST(CASE WHEN total > 0 OR price IS NULL THEN total
                        ELSE abs(price) * coalesce(qty, 1) END AS DOUBLE) AS sls_sales,
              abs(coalesce(qty, 1)) AS sls_quantity,
              round(CASE WHEN (price IS NULL OR price = 0) AND qty <> 0 AND total IS NOT NULL
                         THEN total / qty ELSE abs(price) END, 4) AS sls_price
       FROM (SELECT sls_ord_num, sls_prd_key, TRY_CAST(sls_sales AS DECIMAL(12,2)) AS total,
                    TRY_CAST(sls_price AS DECIMAL(12,2)) AS price,
                    TRY_CAST(sls_quantity AS BIGINT) AS qty FROM crm_sales_details) AS s""",
    "bronze",
)
def t3(t):
    cleaned = silver.crm_sales(t.bronze["crm_sales_details"], V1_CTX)
    return portable(
        cleaned.select("sls_ord_num", "sls_prd_key", "sls_sales", "sls_quantity", "sls_price"), 4
    )


@case(
    "t3_v1_erp_people",
    """SELECT 'person' AS kind, gen AS stated,
              CASE upper(trim(coalesce(gen, ''), ' ')) WHEN '' THEN 'n/a' WHEN 'F' THEN 'Female'
                   WHEN 'M' THEN 'Male' ELSE gen END AS label, count(*) AS row_count
       FROM (SELECT gen FROM erp_cust_az12 UNION ALL SELECT gen || ' ' FROM erp_cust_az12) AS g
       GROUP BY ALL
       UNION ALL
       SELECT 'place', cntry,
              CASE upper(trim(coalesce(cntry, ''), ' ')) WHEN 'US' THEN 'United States'
                   WHEN 'USA' THEN 'United States' WHEN 'DE' THEN 'Germany'
                   WHEN 'AU' THEN 'Australia' WHEN 'AUS' THEN 'Australia' WHEN 'CA' THEN 'Canada'
                   WHEN 'CAN' THEN 'Canada' WHEN 'FR' THEN 'France' WHEN 'UK' THEN 'United Kingdom'
                   WHEN '' THEN 'n/a' ELSE trim(cntry, ' ') END, count(*)
       FROM (SELECT cntry FROM erp_loc_a101
             UNION ALL SELECT cntry || chr(13) FROM erp_loc_a101) AS c
       GROUP BY ALL""",
    "bronze",
)
def t3_people(t):
    """The first generation keeps outer blanks of unknown genders and line ends of countries."""
    people, places = t.bronze["erp_cust_az12"], t.bronze["erp_loc_a101"]
    people = people.unionByName(people.withColumn("gen", F.concat("gen", F.lit(" "))))
    places = places.unionByName(places.withColumn("cntry", F.concat("cntry", F.lit("\r"))))

    def counted(kind, model, bronze, column):
        stated = codes.map_codes_or_keep_v1(column, model, trim=kind == "place")
        rows = bronze.select(F.lit(kind).alias("kind"), F.col(column).alias("stated"), stated.alias("label"))
        return rows.groupBy("kind", "stated", "label").agg(F.count(F.lit(1)).alias("row_count"))

    return counted("person", codes.GENDER_CODES, people, "gen").unionByName(
        counted("place", codes.COUNTRY_CODES, places, "cntry")
    )


@case(
    "t5_names_unchanged",
    """SELECT prd_id AS id, prd_nm AS name, NULL AS subcat FROM crm_prd_info
       UNION ALL SELECT id, cat, subcat FROM erp_px_cat_g1v2""",
    "bronze",
)
def t5(t):
    products = silver.crm_products(t.bronze["crm_prd_info"], V1_CTX).select(
        F.col("prd_id").alias("id"), F.col("prd_nm").alias("name")
    )
    categories = silver.erp_categories(t.bronze["erp_px_cat_g1v2"], V1_CTX).select(
        "id", F.col("cat").alias("name"), "subcat"
    )
    return products.unionByName(categories, allowMissingColumns=True)


@case(
    "t6_t7_missing_category_markers",
    """SELECT 'CSV-' || prd_id AS product_id, coalesce(cat, 'n/a') AS category,
              subcat AS subcategory, coalesce(maintenance, 'n/a') AS maintenance
       FROM stg_crm__prd_info LEFT JOIN stg_erp__px_cat_g1v2 AS c ON cat_id = c.id
       WHERE prd_end_dt IS NULL
       UNION ALL SELECT 'API-' || CAST(id AS VARCHAR), category, NULL, 'n/a'
       FROM stg_djapi__product""",
)
def t6(t):
    return _v1_star(t).products.select("product_id", "category", "subcategory", "maintenance")


@case(
    "t8_t9_api_orders",
    f"""SELECT id, prd_id, cust_id, unit_price,
               {sql.AT_LEAST_ONE} AS quantity,
               CASE WHEN total IS NOT NULL
                    THEN {sql.repaired("total", "unit_price", "qty")} END AS total_price
        FROM (SELECT {sql.api_id("id")} AS id, {sql.api_id("prd_id")} AS prd_id,
                     {sql.api_id("cust_id")} AS cust_id, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
                     TRY_CAST(quantity AS BIGINT) AS qty, TRY_CAST(total_price AS DOUBLE) AS total
              FROM djapi_order) AS typed
        WHERE unit_price > 0 AND prd_id IN (SELECT id FROM stg_djapi__product)
          AND cust_id IN (SELECT id FROM stg_djapi__customer)""",
    "bronze",
)
def t8(t):
    orders = silver.api_orders(
        t.bronze["djapi_order"],
        t.silver["stg_djapi__product"],
        t.silver["stg_djapi__customer"],
        V1_CTX,
    )
    return orders.drop("dwh_create_date")


@case(
    "t10_gold_views",
    """SELECT country, round(sum(total_sales_amount), 2) AS total_sales
       FROM fact_sales AS f JOIN dim_customers AS c ON f.customer_key = c.customer_key
       GROUP BY country""",
)
def t10(t):
    warehouse.publish_views(t.star)
    return t.spark.sql(
        """SELECT country, round(sum(total_sales_amount), 2) AS total_sales
           FROM gold_fact_sales AS f JOIN gold_dim_customers AS c USING (customer_key)
           GROUP BY country"""
    )


def _first_up(column: str) -> str:
    trimmed = f"trim({column}, ' ')"
    return (
        f"CASE WHEN {column} IS NULL THEN 'n/a' ELSE upper(substring({trimmed}, 1, 1)) || "
        f"lower(substring({trimmed}, 2)) END"
    )


@case(
    "t11_api_customers",
    f"""SELECT {sql.api_id("id")} AS id, {_first_up("gender")} AS gender,
               {_first_up("last_name")} AS last_name, {titled("trim(city, ' ')")} AS city
        FROM djapi_customer""",
    "bronze",
)
def t11(t):
    people = silver.api_customers(t.bronze["djapi_customer"], V1_CTX)
    return people.select("id", "gender", "last_name", "city")
