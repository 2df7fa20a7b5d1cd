"""The warehouse models written a second time, as SQL for the oracle engine."""

from __future__ import annotations

from strataline.functions import codes
from strataline.functions.text import WHITESPACE
from strataline.workloads.feeds import AS_OF, LOAD_TS

DELIMITERS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""
DAY = f"DATE '{AS_OF}'"
ADULT = f"DATE '{AS_OF}' - INTERVAL 18 YEAR"
LOADED = f"TIMESTAMP '{LOAD_TS}' AS dwh_create_date"


def trim(text: str) -> str:
    return f"trim({text}, '{WHITESPACE}')"


def upper(text: str) -> str:
    """Full Unicode upper case; the oracle engine maps one letter to one letter."""
    return f"replace(upper({text}), 'ẞ', 'SS')"


def words(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({text}), "
        f"'[^{DELIMITERS}]+|[{DELIMITERS}]+'), lambda w: {upper('w[1:1]')} || substring(w, 2)), '')"
    )


def api_id(text: str) -> str:
    return f"CAST({trim(f"replace({text}, 'dummy-', '')")} AS BIGINT)"


def iso_day(text: str) -> str:
    return (
        f"CASE WHEN regexp_matches({text}, '^[0-9]{{1,4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') "
        f"THEN TRY_CAST({text} AS DATE) END"
    )


def compact_day(text: str) -> str:
    parsed = f"CAST(try_strptime(CAST(TRY_CAST({text} AS BIGINT) AS VARCHAR), '%Y%m%d') AS DATE)"
    return (
        f"CASE WHEN TRY_CAST({text} AS BIGINT) > 19000000 AND {parsed} <= {DAY} THEN {parsed} END"
    )


def birthday(text: str) -> str:
    parsed = iso_day(text)
    return f"CASE WHEN {parsed} BETWEEN DATE '1900-01-01' AND {ADULT} THEN {parsed} END"


def coded(text: str, labels: dict[str, str], default: str = "'n/a'") -> str:
    """Look a code up in a map literal."""
    codes = ", ".join(f"'{code}'" for code in labels)
    names = ", ".join(f"'{label}'" for label in labels.values())
    return f"coalesce(map([{codes}], [{names}])[upper({text})], {default})"


def coded_or_kept(text: str, labels: dict[str, str]) -> str:
    kept = trim(f"replace({text}, chr(13), '')")
    return coded(kept, labels, f"nullif({kept}, ''), 'n/a'")


def sku(text: str) -> str:
    shaped = f"upper(replace({trim(text)}, '_', '-'))"
    return f"left({shaped}, CASE WHEN length({text}) > 15 THEN 15 ELSE length({text}) END)"


def repaired(total: str, price: str, count: str) -> str:
    """A stated total stands when it equals price x count or that product is unknown."""
    return (
        f"CASE WHEN {total} IS NULL THEN abs({price} * {count}) "
        f"WHEN {price} * {count} IS NULL OR {total} = {price} * {count} THEN {total} "
        f"WHEN {count} = 0 THEN abs({price}) ELSE abs({price} * {count}) END"
    )


AT_LEAST_ONE = "CAST(coalesce(nullif(abs(qty), 0), 1) AS BIGINT)"


def amount(text: str) -> str:
    """Benchmark amounts have few digits, so that any product with a 64-bit count fits."""
    return f"TRY_CAST({text} AS DECIMAL(18,6))"


SILVER = {
    "stg_crm__cust_info": f"""
        SELECT cst_id, cst_key, {trim("cst_firstname")} AS cst_firstname,
               {trim("cst_lastname")} AS cst_lastname,
               {coded(trim("cst_marital_status"), codes.MARITAL_CODES)} AS cst_marital_status,
               {coded(trim("cst_gndr"), codes.GENDER_CODES)} AS cst_gndr,
               cst_create_date, {LOADED}
        FROM (SELECT TRY_CAST(cst_id AS BIGINT) AS cst_id, cst_key, cst_firstname, cst_lastname,
                     cst_marital_status, cst_gndr, {iso_day("cst_create_date")} AS cst_create_date
              FROM crm_cust_info) AS typed
        WHERE cst_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY cst_id
            ORDER BY cst_create_date DESC NULLS LAST, cst_key DESC NULLS LAST,
                     cst_firstname DESC NULLS LAST, cst_lastname DESC NULLS LAST,
                     cst_marital_status DESC NULLS LAST, cst_gndr DESC NULLS LAST) = 1""",
    "stg_crm__prd_info": f"""
        SELECT prd_id, replace(substring(prd_key, 1, 5), '-', '_') AS cat_id,
               substring(prd_key, 7) AS prd_key, {words("prd_nm")} AS prd_nm,
               CAST(coalesce(nullif(prd_cost, ''), '0') AS DECIMAL(27,9)) AS prd_cost,
               {coded(trim("prd_line"), codes.LINE_CODES)} AS prd_line,
               CAST(prd_start_dt AS DATE) AS prd_start_dt,
               lead(CAST(prd_start_dt AS DATE)) OVER
                   (PARTITION BY prd_key ORDER BY CAST(prd_start_dt AS DATE), prd_id) - 1
                   AS prd_end_dt, {LOADED}
        FROM crm_prd_info""",
    "stg_crm__sales_details": f"""
        SELECT sls_ord_num, sls_prd_key, cust AS sls_cust_id, order_day AS sls_order_dt,
               ship_day AS sls_ship_dt, due_day AS sls_due_dt,
               {repaired("total", "price", "qty")} AS sls_sales,
               CAST(abs(coalesce(qty, 1)) AS BIGINT) AS sls_quantity,
               CAST(CASE WHEN coalesce(price, 0) = 0 AND qty <> 0 AND total IS NOT NULL
                         THEN total / abs(qty) ELSE abs(price) END AS DOUBLE)
                   AS sls_price, {LOADED}
        FROM (SELECT sls_ord_num, sls_prd_key, TRY_CAST(sls_cust_id AS BIGINT) AS cust,
                     {compact_day("sls_order_dt")} AS order_day,
                     {compact_day("sls_ship_dt")} AS ship_day,
                     {compact_day("sls_due_dt")} AS due_day,
                     {amount("sls_sales")} AS total, {amount("sls_price")} AS price,
                     TRY_CAST(sls_quantity AS BIGINT) AS qty
              FROM crm_sales_details) AS typed""",
    "stg_erp__cust_az12": f"""
        SELECT regexp_replace(cid, '^NAS', '') AS cid, {birthday("bdate")} AS bdate,
               {coded_or_kept("gen", codes.GENDER_CODES)} AS gen, {LOADED}
        FROM erp_cust_az12""",
    "stg_erp__loc_a101": f"""
        SELECT replace(cid, '-', '') AS cid,
               {coded_or_kept("cntry", codes.COUNTRY_CODES)} AS cntry, {LOADED}
        FROM erp_loc_a101""",
    "stg_erp__px_cat_g1v2": f"""
        SELECT id, {words("coalesce(cat, 'N/A')")} AS cat,
               {words("coalesce(subcat, 'N/A')")} AS subcat,
               {coded("maintenance", codes.YES_NO_CODES)} AS maintenance, {LOADED}
        FROM erp_px_cat_g1v2""",
    "stg_djapi__product": f"""
        SELECT {api_id("id")} AS id, {trim(words("replace(title, chr(13), '')"))} AS title,
               {trim(words("replace(coalesce(replace(category, chr(13), ''), 'n/a'), '-', ' ')"))}
                   AS category,
               {sku("pkey")} AS pkey,
               createdAt, {LOADED}
        FROM djapi_product WHERE title IS NOT NULL""",
    "stg_djapi__customer": f"""
        SELECT {api_id("id")} AS id,
               coalesce({trim(words("replace(first_name, chr(13), '')"))}, 'n/a') AS first_name,
               coalesce({trim(words("replace(last_name, chr(13), '')"))}, 'n/a') AS last_name,
               {coded(trim("gender"), codes.GENDER_WORDS)} AS gender,
               {birthday("birthdate")} AS birthdate,
               {words("city")} AS city, {words("state")} AS state,
               upper({trim("state_code")}) AS state_code,
               {words("replace(country, chr(13), '')")} AS country, {LOADED}
        FROM djapi_customer""",
    "stg_djapi__order": f"""
        SELECT id, prd_id, cust_id, unit_price, {AT_LEAST_ONE} AS quantity,
               {repaired("total", "unit_price", "qty")} AS total_price, {LOADED}
        FROM (SELECT {api_id("id")} AS id, {api_id("prd_id")} AS prd_id,
                     {api_id("cust_id")} AS cust_id, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
                     TRY_CAST(quantity AS BIGINT) AS qty, TRY_CAST(total_price AS DOUBLE) AS total
              FROM djapi_order) AS typed
        WHERE unit_price > 0
          AND prd_id IN (SELECT id FROM stg_djapi__product)
          AND cust_id IN (SELECT id FROM stg_djapi__customer)
        QUALIFY row_number() OVER (PARTITION BY id, prd_id
            ORDER BY total DESC NULLS LAST, cust_id DESC NULLS LAST, unit_price DESC NULLS LAST,
                     qty DESC NULLS LAST) = 1""",
}


def hashed_key(*parts: str) -> str:
    texts = [f"coalesce(CAST({p} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for p in parts]
    return f"md5({" || '-' || ".join(texts)})"


def prefixed(column: str) -> str:
    return (
        f"CASE data_source WHEN 'csv' THEN 'CSV-' || {column} WHEN 'api' THEN 'API-' || {column} "
        "ELSE 'Unknown' END"
    )


def bounded(column: str) -> str:
    return f"CASE WHEN {column} > DATE '1900-01-01' AND {column} < {DAY} THEN {column} END AS {column}"


GOLD = {
    "dim_customers": f"""
        SELECT {hashed_key("raw_id", "data_source")} AS customer_key,
               {prefixed("raw_id")} AS customer_id, customer_number, first_name, last_name,
               country, marital_status, gender, birthdate, create_date, data_source
        FROM (SELECT CAST(cst_id AS VARCHAR) AS raw_id, cst_key AS customer_number,
                     cst_firstname AS first_name, cst_lastname AS last_name, cntry AS country,
                     cst_marital_status AS marital_status,
                     coalesce(nullif(cst_gndr, 'n/a'), gen, 'n/a') AS gender,
                     bdate AS birthdate, cst_create_date AS create_date, 'csv' AS data_source
              FROM stg_crm__cust_info
                   LEFT JOIN stg_erp__cust_az12 AS born ON cst_key = born.cid
                   LEFT JOIN stg_erp__loc_a101 AS lives ON cst_key = lives.cid
              UNION ALL
              SELECT CAST(id AS VARCHAR), 'n/a', first_name, last_name, country, 'n/a', gender,
                     birthdate, CAST(dwh_create_date AS DATE), 'api'
              FROM stg_djapi__customer) AS parts""",
    "dim_products": f"""
        SELECT {hashed_key("raw_id", "data_source")} AS product_key,
               {prefixed("raw_id")} AS product_id, product_number, product_name, category_id,
               coalesce(category, 'N/A') AS category, coalesce(subcategory, 'N/A') AS subcategory,
               coalesce(maintenance, 'n/a') AS maintenance, coalesce(cost, 0) AS cost,
               coalesce(product_line, 'Other Sales') AS product_line, start_date, data_source
        FROM (SELECT prd_id AS raw_id, prd_key AS product_number, prd_nm AS product_name,
                     cat_id AS category_id, cat AS category, subcat AS subcategory, maintenance,
                     CAST(prd_cost AS DECIMAL(27,9)) AS cost, prd_line AS product_line,
                     prd_start_dt AS start_date, 'csv' AS data_source
              FROM stg_crm__prd_info LEFT JOIN stg_erp__px_cat_g1v2 AS c ON cat_id = c.id
              WHERE prd_end_dt IS NULL
              UNION ALL
              SELECT CAST(id AS VARCHAR), pkey, title, substring(pkey, 1, 3), category, NULL, NULL,
                     NULL, NULL, CAST(substring(createdAt, 1, 10) AS DATE), 'api'
              FROM stg_djapi__product) AS parts""",
    "fact_sales": f"""
        SELECT {hashed_key("order_no", "product_key", "data_source")} AS order_key,
               {prefixed("order_no")} AS order_number, product_key, customer_key,
               {bounded("order_date")}, {bounded("shipping_date")}, {bounded("due_date")},
               total_sales_amount, quantity, unit_price, data_source
        FROM (SELECT replace(sls_ord_num, 'SO', '') AS order_no, p.product_key, c.customer_key,
                     sls_order_dt AS order_date, sls_ship_dt AS shipping_date,
                     sls_due_dt AS due_date, CAST(sls_sales AS DOUBLE) AS total_sales_amount,
                     sls_quantity AS quantity, CAST(sls_price AS DOUBLE) AS unit_price,
                     c.data_source
              FROM stg_crm__sales_details
                   JOIN dim_products AS p ON sls_prd_key = p.product_number
                   JOIN dim_customers AS c
                     ON c.customer_id = 'CSV-' || CAST(sls_cust_id AS VARCHAR)
              UNION ALL
              SELECT CAST(o.id AS VARCHAR), p.product_key, c.customer_key,
                     CAST(o.dwh_create_date AS DATE), NULL, NULL, o.total_price, o.quantity,
                     o.unit_price, c.data_source
              FROM stg_djapi__order AS o
                   JOIN dim_customers AS c
                     ON c.customer_id = 'API-' || CAST(o.cust_id AS VARCHAR)
                   JOIN dim_products AS p
                     ON p.product_id = 'API-' || CAST(o.prd_id AS VARCHAR)) AS parts""",
}
