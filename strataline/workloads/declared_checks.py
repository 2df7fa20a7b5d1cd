"""The declared checks of the warehouse, written out as SQL: what each one objects to.

The expected side of the rule queries. It is stated apart from the rulebook that runs, so that a
rule that is declared wrongly shows. One line per check: its id, its severity, and the failing
rows, values or keys; TRIM, WORDS and UPPER stand for the text functions both engines share.
"""

from __future__ import annotations

import re

from strataline.workloads import oracle_stages as sql

DECLARED = {
    "stg_crm__cust_info": r"""
        not_null_cst_id ; error ; SELECT 1 FROM MODEL WHERE cst_id IS NULL
        not_null_cst_firstname ; error ; SELECT 1 FROM MODEL WHERE cst_firstname IS NULL
        not_null_cst_lastname ; error ; SELECT 1 FROM MODEL WHERE cst_lastname IS NULL
        not_null_cst_create_date ; error ; SELECT 1 FROM MODEL WHERE cst_create_date IS NULL
        not_null_dwh_create_date ; error ; SELECT 1 FROM MODEL WHERE dwh_create_date IS NULL
        unique_cst_id ; error ; SELECT 1 FROM MODEL WHERE cst_id IS NOT NULL GROUP BY cst_id HAVING count(*) > 1
        no_whitespace_cst_firstname ; error ; SELECT 1 FROM MODEL WHERE length(cst_firstname) <> length(TRIM(cst_firstname))
        no_whitespace_cst_lastname ; error ; SELECT 1 FROM MODEL WHERE length(cst_lastname) <> length(TRIM(cst_lastname))
        accepted_values_cst_marital_status ; error ; SELECT DISTINCT cst_marital_status FROM MODEL WHERE cst_marital_status NOT IN ('Single', 'Married', 'n/a')
        accepted_values_cst_gndr ; error ; SELECT DISTINCT cst_gndr FROM MODEL WHERE cst_gndr NOT IN ('Male', 'Female', 'n/a')
    """,
    "stg_crm__prd_info": r"""
        not_null_prd_id ; error ; SELECT 1 FROM MODEL WHERE prd_id IS NULL
        not_null_cat_id ; error ; SELECT 1 FROM MODEL WHERE cat_id IS NULL
        not_null_prd_key ; error ; SELECT 1 FROM MODEL WHERE prd_key IS NULL
        not_null_prd_nm ; error ; SELECT 1 FROM MODEL WHERE prd_nm IS NULL
        not_null_prd_cost ; error ; SELECT 1 FROM MODEL WHERE prd_cost IS NULL
        not_null_prd_start_dt ; error ; SELECT 1 FROM MODEL WHERE prd_start_dt IS NULL
        not_null_dwh_create_date ; error ; SELECT 1 FROM MODEL WHERE dwh_create_date IS NULL
        not_null_prd_end_dt ; warn ; SELECT 1 FROM MODEL WHERE prd_end_dt IS NULL
        unique_prd_id ; error ; SELECT 1 FROM MODEL WHERE prd_id IS NOT NULL GROUP BY prd_id HAVING count(*) > 1
        matches_pattern_cat_id ; error ; SELECT 1 FROM MODEL WHERE NOT regexp_matches(cat_id, '^.{2}_.{2}$')
        no_whitespace_prd_key ; error ; SELECT 1 FROM MODEL WHERE length(prd_key) <> length(TRIM(prd_key))
        no_whitespace_prd_nm ; error ; SELECT 1 FROM MODEL WHERE length(prd_nm) <> length(TRIM(prd_nm))
        assert_case_prd_nm_initcap ; error ; SELECT 1 FROM MODEL WHERE prd_nm <> WORDS(prd_nm)
        accepted_values_prd_line ; error ; SELECT DISTINCT prd_line FROM MODEL WHERE prd_line NOT IN ('Mountain', 'Road', 'Other Sales', 'Touring', 'n/a')
        assert_less_than_prd_start_dt ; error ; SELECT 1 FROM MODEL WHERE prd_start_dt >= prd_end_dt
    """,
    "stg_crm__sales_details": r"""
        not_null_sls_ord_num ; error ; SELECT 1 FROM MODEL WHERE sls_ord_num IS NULL
        not_null_sls_prd_key ; error ; SELECT 1 FROM MODEL WHERE sls_prd_key IS NULL
        not_null_sls_cust_id ; error ; SELECT 1 FROM MODEL WHERE sls_cust_id IS NULL
        not_null_sls_sales ; error ; SELECT 1 FROM MODEL WHERE sls_sales IS NULL
        not_null_sls_quantity ; error ; SELECT 1 FROM MODEL WHERE sls_quantity IS NULL
        not_null_sls_price ; error ; SELECT 1 FROM MODEL WHERE sls_price IS NULL
        not_null_dwh_create_date ; error ; SELECT 1 FROM MODEL WHERE dwh_create_date IS NULL
        not_null_sls_order_dt ; warn ; SELECT 1 FROM MODEL WHERE sls_order_dt IS NULL
        not_null_sls_ship_dt ; warn ; SELECT 1 FROM MODEL WHERE sls_ship_dt IS NULL
        not_null_sls_due_dt ; warn ; SELECT 1 FROM MODEL WHERE sls_due_dt IS NULL
        no_whitespace_sls_ord_num ; error ; SELECT 1 FROM MODEL WHERE length(sls_ord_num) <> length(TRIM(sls_ord_num))
        no_whitespace_sls_prd_key ; error ; SELECT 1 FROM MODEL WHERE length(sls_prd_key) <> length(TRIM(sls_prd_key))
        relationships_sls_prd_key ; error ; SELECT 1 FROM MODEL AS child WHERE sls_prd_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_crm__prd_info AS parent WHERE parent.prd_key = child.sls_prd_key)
        relationships_sls_cust_id ; error ; SELECT 1 FROM MODEL AS child WHERE sls_cust_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_crm__cust_info AS parent WHERE parent.cst_id = child.sls_cust_id)
        accepted_range_sls_order_dt ; error ; SELECT 1 FROM MODEL WHERE sls_order_dt < DATE '1900-01-01' OR sls_order_dt > CAST(DATE '2000-01-01' - INTERVAL 0 YEAR AS DATE)
        accepted_range_sls_ship_dt ; error ; SELECT 1 FROM MODEL WHERE sls_ship_dt < DATE '1900-01-01'
        accepted_range_sls_due_dt ; error ; SELECT 1 FROM MODEL WHERE sls_due_dt < DATE '1900-01-01'
        accepted_range_sls_cust_id ; error ; SELECT 1 FROM MODEL WHERE sls_cust_id <= 0
        accepted_range_sls_sales ; error ; SELECT 1 FROM MODEL WHERE sls_sales <= 0
        accepted_range_sls_quantity ; error ; SELECT 1 FROM MODEL WHERE sls_quantity <= 0
        accepted_range_sls_price ; error ; SELECT 1 FROM MODEL WHERE sls_price <= 0
    """,
    "stg_erp__loc_a101": r"""
        not_null_cid ; error ; SELECT 1 FROM MODEL WHERE cid IS NULL
        not_null_dwh_create_date ; error ; SELECT 1 FROM MODEL WHERE dwh_create_date IS NULL
        unique_cid ; error ; SELECT 1 FROM MODEL WHERE cid IS NOT NULL GROUP BY cid HAVING count(*) > 1
        no_whitespace_cid ; error ; SELECT 1 FROM MODEL WHERE length(cid) <> length(TRIM(cid))
        not_contains_string_cid ; error ; SELECT 1 FROM MODEL WHERE strpos(cid, '-') > 0
        accepted_values_cntry ; error ; SELECT DISTINCT cntry FROM MODEL WHERE cntry NOT IN ('United States', 'Germany', 'Australia', 'Canada', 'France', 'United Kingdom', 'n/a')
    """,
    "stg_erp__cust_az12": r"""
        not_null_cid ; error ; SELECT 1 FROM MODEL WHERE cid IS NULL
        not_null_dwh_create_date ; error ; SELECT 1 FROM MODEL WHERE dwh_create_date IS NULL
        not_null_bdate ; warn ; SELECT 1 FROM MODEL WHERE bdate IS NULL
        unique_cid ; error ; SELECT 1 FROM MODEL WHERE cid IS NOT NULL GROUP BY cid HAVING count(*) > 1
        no_whitespace_cid ; error ; SELECT 1 FROM MODEL WHERE length(cid) <> length(TRIM(cid))
        not_contains_string_cid ; error ; SELECT 1 FROM MODEL WHERE strpos(cid, 'NAS') > 0
        accepted_range_bdate ; error ; SELECT 1 FROM MODEL WHERE bdate < DATE '1900-01-01' OR bdate > CAST(DATE '2000-01-01' - INTERVAL 18 YEAR AS DATE)
        accepted_values_gen ; error ; SELECT DISTINCT gen FROM MODEL WHERE gen NOT IN ('Male', 'Female', 'n/a')
    """,
    "stg_erp__px_cat_g1v2": r"""
        not_null_id ; error ; SELECT 1 FROM MODEL WHERE id IS NULL
        not_null_cat ; error ; SELECT 1 FROM MODEL WHERE cat IS NULL
        not_null_subcat ; error ; SELECT 1 FROM MODEL WHERE subcat IS NULL
        not_null_dwh_create_date ; error ; SELECT 1 FROM MODEL WHERE dwh_create_date IS NULL
        unique_id ; error ; SELECT 1 FROM MODEL WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
        matches_pattern_id ; error ; SELECT 1 FROM MODEL WHERE NOT regexp_matches(id, '^.{2}_.{2}$')
        no_whitespace_cat ; error ; SELECT 1 FROM MODEL WHERE length(cat) <> length(TRIM(cat))
        no_whitespace_subcat ; error ; SELECT 1 FROM MODEL WHERE length(subcat) <> length(TRIM(subcat))
        assert_case_cat_initcap ; error ; SELECT 1 FROM MODEL WHERE cat <> WORDS(cat)
        assert_case_subcat_initcap ; error ; SELECT 1 FROM MODEL WHERE subcat <> WORDS(subcat)
        accepted_values_maintenance ; error ; SELECT DISTINCT maintenance FROM MODEL WHERE maintenance NOT IN ('Yes', 'No', 'n/a')
    """,
    "stg_djapi__customer": r"""
        not_null_id ; error ; SELECT 1 FROM MODEL WHERE id IS NULL
        not_null_first_name ; error ; SELECT 1 FROM MODEL WHERE first_name IS NULL
        not_null_last_name ; error ; SELECT 1 FROM MODEL WHERE last_name IS NULL
        not_null_gender ; error ; SELECT 1 FROM MODEL WHERE gender IS NULL
        not_null_city ; error ; SELECT 1 FROM MODEL WHERE city IS NULL
        not_null_state ; error ; SELECT 1 FROM MODEL WHERE state IS NULL
        not_null_state_code ; error ; SELECT 1 FROM MODEL WHERE state_code IS NULL
        not_null_country ; error ; SELECT 1 FROM MODEL WHERE country IS NULL
        not_null_dwh_create_date ; error ; SELECT 1 FROM MODEL WHERE dwh_create_date IS NULL
        not_null_birthdate ; warn ; SELECT 1 FROM MODEL WHERE birthdate IS NULL
        unique_id ; error ; SELECT 1 FROM MODEL WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
        accepted_range_id ; error ; SELECT 1 FROM MODEL WHERE id <= 0
        no_whitespace_first_name ; error ; SELECT 1 FROM MODEL WHERE length(first_name) <> length(TRIM(first_name))
        no_whitespace_last_name ; error ; SELECT 1 FROM MODEL WHERE length(last_name) <> length(TRIM(last_name))
        no_whitespace_gender ; error ; SELECT 1 FROM MODEL WHERE length(gender) <> length(TRIM(gender))
        no_whitespace_city ; error ; SELECT 1 FROM MODEL WHERE length(city) <> length(TRIM(city))
        no_whitespace_state ; error ; SELECT 1 FROM MODEL WHERE length(state) <> length(TRIM(state))
        no_whitespace_state_code ; error ; SELECT 1 FROM MODEL WHERE length(state_code) <> length(TRIM(state_code))
        no_whitespace_country ; error ; SELECT 1 FROM MODEL WHERE length(country) <> length(TRIM(country))
        accepted_values_gender ; error ; SELECT DISTINCT gender FROM MODEL WHERE gender NOT IN ('Male', 'Female', 'n/a')
        accepted_range_birthdate ; error ; SELECT 1 FROM MODEL WHERE birthdate < DATE '1900-01-01' OR birthdate > CAST(DATE '2000-01-01' - INTERVAL 18 YEAR AS DATE)
        assert_case_city_initcap ; error ; SELECT 1 FROM MODEL WHERE city <> WORDS(city)
        assert_case_state_initcap ; error ; SELECT 1 FROM MODEL WHERE state <> WORDS(state)
        assert_case_country_initcap ; error ; SELECT 1 FROM MODEL WHERE country <> WORDS(country)
        assert_case_state_code_upper ; error ; SELECT 1 FROM MODEL WHERE state_code <> UPPER(state_code)
    """,
    "stg_djapi__product": r"""
        not_null_id ; error ; SELECT 1 FROM MODEL WHERE id IS NULL
        not_null_title ; error ; SELECT 1 FROM MODEL WHERE title IS NULL
        not_null_category ; error ; SELECT 1 FROM MODEL WHERE category IS NULL
        not_null_pkey ; error ; SELECT 1 FROM MODEL WHERE pkey IS NULL
        unique_id ; error ; SELECT 1 FROM MODEL WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
        unique_title ; warn ; SELECT 1 FROM MODEL WHERE title IS NOT NULL GROUP BY title HAVING count(*) > 1
        accepted_range_id ; error ; SELECT 1 FROM MODEL WHERE id <= 0
        no_whitespace_title ; error ; SELECT 1 FROM MODEL WHERE length(title) <> length(TRIM(title))
        no_whitespace_category ; error ; SELECT 1 FROM MODEL WHERE length(category) <> length(TRIM(category))
        no_whitespace_pkey ; error ; SELECT 1 FROM MODEL WHERE length(pkey) <> length(TRIM(pkey))
        assert_case_title_initcap ; error ; SELECT 1 FROM MODEL WHERE title <> WORDS(title)
        assert_case_category_initcap ; error ; SELECT 1 FROM MODEL WHERE category <> WORDS(category)
        assert_length_pkey ; error ; SELECT 1 FROM MODEL WHERE length(pkey) <> 15
        not_contains_string_pkey ; error ; SELECT 1 FROM MODEL WHERE strpos(pkey, '_') > 0
    """,
    "stg_djapi__order": r"""
        unique_combination_of_columns_id_prd_id ; warn ; SELECT 1 FROM MODEL  GROUP BY id, prd_id HAVING count(*) > 1
        not_null_id ; error ; SELECT 1 FROM MODEL WHERE id IS NULL
        not_null_cust_id ; error ; SELECT 1 FROM MODEL WHERE cust_id IS NULL
        not_null_prd_id ; error ; SELECT 1 FROM MODEL WHERE prd_id IS NULL
        not_null_unit_price ; error ; SELECT 1 FROM MODEL WHERE unit_price IS NULL
        not_null_quantity ; error ; SELECT 1 FROM MODEL WHERE quantity IS NULL
        not_null_total_price ; error ; SELECT 1 FROM MODEL WHERE total_price IS NULL
        not_null_dwh_create_date ; error ; SELECT 1 FROM MODEL WHERE dwh_create_date IS NULL
        accepted_range_id ; error ; SELECT 1 FROM MODEL WHERE id <= 0
        accepted_range_cust_id ; error ; SELECT 1 FROM MODEL WHERE cust_id <= 0
        accepted_range_prd_id ; error ; SELECT 1 FROM MODEL WHERE prd_id <= 0
        accepted_range_unit_price ; error ; SELECT 1 FROM MODEL WHERE unit_price <= 0
        accepted_range_total_price ; error ; SELECT 1 FROM MODEL WHERE total_price <= 0
        accepted_range_quantity ; error ; SELECT 1 FROM MODEL WHERE quantity < 1
        relationships_cust_id ; error ; SELECT 1 FROM MODEL AS child WHERE cust_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_djapi__customer AS parent WHERE parent.id = child.cust_id)
        relationships_prd_id ; error ; SELECT 1 FROM MODEL AS child WHERE prd_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_djapi__product AS parent WHERE parent.id = child.prd_id)
        assert_formula_total_price_multiply ; error ; SELECT 1 FROM MODEL WHERE total_price <> unit_price * quantity
    """,
    "dim_customers": r"""
        not_null_customer_key ; error ; SELECT 1 FROM MODEL WHERE customer_key IS NULL
        not_null_customer_id ; error ; SELECT 1 FROM MODEL WHERE customer_id IS NULL
        not_null_customer_number ; error ; SELECT 1 FROM MODEL WHERE customer_number IS NULL
        not_null_first_name ; error ; SELECT 1 FROM MODEL WHERE first_name IS NULL
        not_null_last_name ; error ; SELECT 1 FROM MODEL WHERE last_name IS NULL
        unique_customer_key ; error ; SELECT 1 FROM MODEL WHERE customer_key IS NOT NULL GROUP BY customer_key HAVING count(*) > 1
        unique_customer_id ; error ; SELECT 1 FROM MODEL WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1
        unique_customer_number ; warn ; SELECT 1 FROM MODEL WHERE customer_number IS NOT NULL GROUP BY customer_number HAVING count(*) > 1
        no_whitespace_customer_id ; error ; SELECT 1 FROM MODEL WHERE length(customer_id) <> length(TRIM(customer_id))
        no_whitespace_customer_number ; error ; SELECT 1 FROM MODEL WHERE length(customer_number) <> length(TRIM(customer_number))
        no_whitespace_first_name ; error ; SELECT 1 FROM MODEL WHERE length(first_name) <> length(TRIM(first_name))
        no_whitespace_last_name ; error ; SELECT 1 FROM MODEL WHERE length(last_name) <> length(TRIM(last_name))
        accepted_values_country ; error ; SELECT DISTINCT country FROM MODEL WHERE country NOT IN ('United States', 'Germany', 'Australia', 'Canada', 'France', 'United Kingdom', 'n/a')
        accepted_values_marital_status ; error ; SELECT DISTINCT marital_status FROM MODEL WHERE marital_status NOT IN ('Single', 'Married', 'n/a')
        accepted_values_gender ; error ; SELECT DISTINCT gender FROM MODEL WHERE gender NOT IN ('Male', 'Female', 'n/a')
        accepted_values_data_source ; error ; SELECT DISTINCT data_source FROM MODEL WHERE data_source NOT IN ('csv', 'api')
        accepted_range_birthdate ; error ; SELECT 1 FROM MODEL WHERE birthdate < DATE '1900-01-01' OR birthdate > CAST(DATE '2000-01-01' - INTERVAL 18 YEAR AS DATE)
        accepted_range_create_date ; error ; SELECT 1 FROM MODEL WHERE create_date < DATE '1900-01-01' OR create_date > CAST(DATE '2000-01-01' - INTERVAL 0 YEAR AS DATE)
    """,
    "dim_products": r"""
        not_null_product_key ; error ; SELECT 1 FROM MODEL WHERE product_key IS NULL
        not_null_product_id ; error ; SELECT 1 FROM MODEL WHERE product_id IS NULL
        not_null_product_number ; error ; SELECT 1 FROM MODEL WHERE product_number IS NULL
        not_null_product_name ; error ; SELECT 1 FROM MODEL WHERE product_name IS NULL
        not_null_category_id ; error ; SELECT 1 FROM MODEL WHERE category_id IS NULL
        not_null_category ; error ; SELECT 1 FROM MODEL WHERE category IS NULL
        not_null_subcategory ; error ; SELECT 1 FROM MODEL WHERE subcategory IS NULL
        not_null_cost ; error ; SELECT 1 FROM MODEL WHERE cost IS NULL
        unique_product_key ; error ; SELECT 1 FROM MODEL WHERE product_key IS NOT NULL GROUP BY product_key HAVING count(*) > 1
        unique_product_id ; error ; SELECT 1 FROM MODEL WHERE product_id IS NOT NULL GROUP BY product_id HAVING count(*) > 1
        unique_product_number ; error ; SELECT 1 FROM MODEL WHERE product_number IS NOT NULL GROUP BY product_number HAVING count(*) > 1
        unique_product_name ; warn ; SELECT 1 FROM MODEL WHERE product_name IS NOT NULL GROUP BY product_name HAVING count(*) > 1
        no_whitespace_product_id ; error ; SELECT 1 FROM MODEL WHERE length(product_id) <> length(TRIM(product_id))
        no_whitespace_product_number ; error ; SELECT 1 FROM MODEL WHERE length(product_number) <> length(TRIM(product_number))
        contains_string_product_number ; error ; SELECT 1 FROM MODEL WHERE strpos(product_number, '-') = 0
        assert_case_category_id_upper ; error ; SELECT 1 FROM MODEL WHERE category_id <> UPPER(category_id)
        assert_case_category_initcap ; error ; SELECT 1 FROM MODEL WHERE category <> WORDS(category)
        assert_case_subcategory_initcap ; error ; SELECT 1 FROM MODEL WHERE subcategory <> WORDS(subcategory)
        accepted_values_maintenance ; error ; SELECT DISTINCT maintenance FROM MODEL WHERE maintenance NOT IN ('Yes', 'No', 'n/a')
        accepted_values_product_line ; error ; SELECT DISTINCT product_line FROM MODEL WHERE product_line NOT IN ('Mountain', 'Road', 'Other Sales', 'Touring', 'n/a')
        accepted_values_data_source ; error ; SELECT DISTINCT data_source FROM MODEL WHERE data_source NOT IN ('csv', 'api')
        accepted_range_cost ; error ; SELECT 1 FROM MODEL WHERE cost < 0
        accepted_range_start_date ; error ; SELECT 1 FROM MODEL WHERE start_date < DATE '1900-01-01' OR start_date > CAST(DATE '2000-01-01' - INTERVAL 0 YEAR AS DATE)
    """,
    "fact_sales": r"""
        not_null_order_key ; error ; SELECT 1 FROM MODEL WHERE order_key IS NULL
        not_null_order_number ; error ; SELECT 1 FROM MODEL WHERE order_number IS NULL
        not_null_product_key ; error ; SELECT 1 FROM MODEL WHERE product_key IS NULL
        not_null_customer_key ; error ; SELECT 1 FROM MODEL WHERE customer_key IS NULL
        not_null_total_sales_amount ; error ; SELECT 1 FROM MODEL WHERE total_sales_amount IS NULL
        not_null_quantity ; error ; SELECT 1 FROM MODEL WHERE quantity IS NULL
        not_null_unit_price ; error ; SELECT 1 FROM MODEL WHERE unit_price IS NULL
        not_null_order_date ; warn ; SELECT 1 FROM MODEL WHERE order_date IS NULL
        not_null_shipping_date ; warn ; SELECT 1 FROM MODEL WHERE shipping_date IS NULL
        not_null_due_date ; warn ; SELECT 1 FROM MODEL WHERE due_date IS NULL
        unique_order_key ; error ; SELECT 1 FROM MODEL WHERE order_key IS NOT NULL GROUP BY order_key HAVING count(*) > 1
        no_whitespace_order_number ; error ; SELECT 1 FROM MODEL WHERE length(order_number) <> length(TRIM(order_number))
        relationships_product_key ; error ; SELECT 1 FROM MODEL AS child WHERE product_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_products AS parent WHERE parent.product_key = child.product_key)
        relationships_customer_key ; error ; SELECT 1 FROM MODEL AS child WHERE customer_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_customers AS parent WHERE parent.customer_key = child.customer_key)
        accepted_range_order_date ; error ; SELECT 1 FROM MODEL WHERE order_date < DATE '1900-01-01' OR order_date > CAST(DATE '2000-01-01' - INTERVAL 0 YEAR AS DATE)
        accepted_range_shipping_date ; error ; SELECT 1 FROM MODEL WHERE shipping_date < DATE '1900-01-01'
        accepted_range_due_date ; error ; SELECT 1 FROM MODEL WHERE due_date < DATE '1900-01-01'
        accepted_range_total_sales_amount ; error ; SELECT 1 FROM MODEL WHERE total_sales_amount <= 0
        accepted_range_quantity ; error ; SELECT 1 FROM MODEL WHERE quantity <= 0
        accepted_range_unit_price ; error ; SELECT 1 FROM MODEL WHERE unit_price <= 0
        assert_formula_total_sales_amount_multiply ; error ; SELECT 1 FROM MODEL WHERE total_sales_amount <> unit_price * quantity
        accepted_values_data_source ; error ; SELECT DISTINCT data_source FROM MODEL WHERE data_source NOT IN ('csv', 'api')
    """,
}

_TEXT = {"TRIM": sql.trim, "WORDS": sql.words, "UPPER": sql.upper}


def failing_sql(model: str) -> list[tuple[str, str, str]]:
    """(rule_id, severity, failing) of each check of a model."""
    checks = []
    for line in DECLARED[model].strip().splitlines():
        rule_id, severity, failing = line.strip().split(" ; ", 2)
        failing = re.sub(r"\b(TRIM|WORDS|UPPER)\((\w+)\)", lambda m: _TEXT[m[1]](m[2]), failing)
        checks.append((rule_id, severity, failing.replace("FROM MODEL", f"FROM {model}")))
    return checks


def counting_sql(model: str, rule_id: str, severity: str, failing: str) -> str:
    """The result row of one check."""
    status = f"CASE WHEN n = 0 THEN 'pass' WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END"
    return (
        f"SELECT '{model}' AS model_name, '{rule_id}' AS rule_id, n AS failure_count, {status} AS status, "
        f"(SELECT count(*) FROM {model}) AS evaluated_rows FROM (SELECT count(*) AS n FROM ({failing}) AS f) AS c"
    )


def results_sql(model: str) -> str:
    """The result rows of all checks of a model."""
    return "\nUNION ALL ".join(counting_sql(model, *check) for check in failing_sql(model))
