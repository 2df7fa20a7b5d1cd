"""Declared checks of the warehouse (fixed values: which rule holds for which column)."""

from __future__ import annotations

import datetime as dt

from strataline.functions.dates import OLDEST_DAY
from strataline.quality.rules import (
    Horizon,
    Rule,
    accepted_range,
    accepted_values,
    assert_case,
    assert_formula,
    assert_length,
    assert_less_than,
    contains_string,
    matches_pattern,
    no_whitespace,
    not_contains_string,
    not_null,
    relationships,
    unique,
    unique_combination,
)

MARITAL = ("Single", "Married", "n/a")
GENDERS = ("Male", "Female", "n/a")
YES_NO = ("Yes", "No", "n/a")
LINES = ("Mountain", "Road", "Other Sales", "Touring", "n/a")
COUNTRIES = (
    "United States", "Germany", "Australia", "Canada", "France", "United Kingdom", "n/a",
)
SOURCES = ("csv", "api")
CATEGORY_ID = "^.{2}_.{2}$"


OLDEST = dt.date.fromisoformat(OLDEST_DAY)
TODAY = Horizon()
ADULT = Horizon(years_back=18)


def _each(rule, *columns: str) -> list[Rule]:
    return [rule(column) for column in columns]


def _positive(column: str) -> Rule:
    return accepted_range(column, low=0, inclusive=False)


def _since_1900(column: str) -> Rule:
    return accepted_range(column, low=OLDEST)


def _past(column: str) -> Rule:
    return accepted_range(column, low=OLDEST, high=TODAY)


def _adult_birthday(column: str) -> Rule:
    return accepted_range(column, low=OLDEST, high=ADULT)


def _title(column: str) -> Rule:
    return assert_case(column, "initcap")


STAGING: dict[str, list[Rule]] = {
    "stg_crm__cust_info": [
        *_each(
            not_null,
            "cst_id", "cst_firstname", "cst_lastname", "cst_create_date", "dwh_create_date",
        ),
        unique("cst_id"),
        *_each(no_whitespace, "cst_firstname", "cst_lastname"),
        accepted_values("cst_marital_status", *MARITAL),
        accepted_values("cst_gndr", *GENDERS),
    ],
    "stg_crm__prd_info": [
        *_each(
            not_null,
            "prd_id", "cat_id", "prd_key", "prd_nm", "prd_cost", "prd_start_dt",
            "dwh_create_date",
        ),
        not_null("prd_end_dt").warn(),
        unique("prd_id"),
        matches_pattern("cat_id", CATEGORY_ID),
        *_each(no_whitespace, "prd_key", "prd_nm"),
        _title("prd_nm"),
        accepted_values("prd_line", *LINES),
        assert_less_than("prd_start_dt", "prd_end_dt"),
    ],
    "stg_crm__sales_details": [
        *_each(
            not_null,
            "sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_sales", "sls_quantity",
            "sls_price", "dwh_create_date",
        ),
        *[not_null(c).warn() for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        *_each(no_whitespace, "sls_ord_num", "sls_prd_key"),
        relationships("sls_prd_key", "stg_crm__prd_info", "prd_key"),
        relationships("sls_cust_id", "stg_crm__cust_info", "cst_id"),
        _past("sls_order_dt"),
        *_each(_since_1900, "sls_ship_dt", "sls_due_dt"),
        *_each(_positive, "sls_cust_id", "sls_sales", "sls_quantity", "sls_price"),
    ],
    "stg_erp__loc_a101": [
        *_each(not_null, "cid", "dwh_create_date"),
        unique("cid"),
        no_whitespace("cid"),
        not_contains_string("cid", "-"),
        accepted_values("cntry", *COUNTRIES),
    ],
    "stg_erp__cust_az12": [
        *_each(not_null, "cid", "dwh_create_date"),
        not_null("bdate").warn(),
        unique("cid"),
        no_whitespace("cid"),
        not_contains_string("cid", "NAS"),
        _adult_birthday("bdate"),
        accepted_values("gen", *GENDERS),
    ],
    "stg_erp__px_cat_g1v2": [
        *_each(not_null, "id", "cat", "subcat", "dwh_create_date"),
        unique("id"),
        matches_pattern("id", CATEGORY_ID),
        *_each(no_whitespace, "cat", "subcat"),
        *_each(_title, "cat", "subcat"),
        accepted_values("maintenance", *YES_NO),
    ],
    "stg_djapi__customer": [
        *_each(
            not_null,
            "id", "first_name", "last_name", "gender", "city", "state", "state_code",
            "country", "dwh_create_date",
        ),
        not_null("birthdate").warn(),
        unique("id"),
        _positive("id"),
        *_each(
            no_whitespace,
            "first_name", "last_name", "gender", "city", "state", "state_code", "country",
        ),
        accepted_values("gender", *GENDERS),
        _adult_birthday("birthdate"),
        *_each(_title, "city", "state", "country"),
        assert_case("state_code", "upper"),
    ],
    "stg_djapi__product": [
        *_each(not_null, "id", "title", "category", "pkey"),
        unique("id"),
        unique("title").warn(),
        _positive("id"),
        *_each(no_whitespace, "title", "category", "pkey"),
        *_each(_title, "title", "category"),
        assert_length("pkey", 15),
        not_contains_string("pkey", "_"),
    ],
    "stg_djapi__order": [
        unique_combination("id", "prd_id").warn(),
        *_each(
            not_null,
            "id", "cust_id", "prd_id", "unit_price", "quantity", "total_price",
            "dwh_create_date",
        ),
        *_each(_positive, "id", "cust_id", "prd_id", "unit_price", "total_price"),
        accepted_range("quantity", low=1),
        relationships("cust_id", "stg_djapi__customer", "id"),
        relationships("prd_id", "stg_djapi__product", "id"),
        assert_formula("total_price", "unit_price", "quantity", "multiply"),
    ],
}

MARTS: dict[str, list[Rule]] = {
    "dim_customers": [
        *_each(
            not_null,
            "customer_key", "customer_id", "customer_number", "first_name", "last_name",
        ),
        *_each(unique, "customer_key", "customer_id"),
        unique("customer_number").warn(),
        *_each(no_whitespace, "customer_id", "customer_number", "first_name", "last_name"),
        accepted_values("country", *COUNTRIES),
        accepted_values("marital_status", *MARITAL),
        accepted_values("gender", *GENDERS),
        accepted_values("data_source", *SOURCES),
        _adult_birthday("birthdate"),
        _past("create_date"),
    ],
    "dim_products": [
        *_each(
            not_null,
            "product_key", "product_id", "product_number", "product_name", "category_id",
            "category", "subcategory", "cost",
        ),
        *_each(unique, "product_key", "product_id", "product_number"),
        unique("product_name").warn(),
        *_each(no_whitespace, "product_id", "product_number"),
        contains_string("product_number", "-"),
        assert_case("category_id", "upper"),
        *_each(_title, "category", "subcategory"),
        accepted_values("maintenance", *YES_NO),
        accepted_values("product_line", *LINES),
        accepted_values("data_source", *SOURCES),
        accepted_range("cost", low=0),
        _past("start_date"),
    ],
    "fact_sales": [
        *_each(
            not_null,
            "order_key", "order_number", "product_key", "customer_key", "total_sales_amount",
            "quantity", "unit_price",
        ),
        *[not_null(c).warn() for c in ("order_date", "shipping_date", "due_date")],
        unique("order_key"),
        no_whitespace("order_number"),
        relationships("product_key", "dim_products", "product_key"),
        relationships("customer_key", "dim_customers", "customer_key"),
        _past("order_date"),
        *_each(_since_1900, "shipping_date", "due_date"),
        *_each(_positive, "total_sales_amount", "quantity", "unit_price"),
        assert_formula("total_sales_amount", "unit_price", "quantity", "multiply"),
        accepted_values("data_source", *SOURCES),
    ],
}

RULEBOOK: dict[str, list[Rule]] = {**STAGING, **MARTS}
