"""Declared schemas of the warehouse (fixed values: table and column names, types)."""

from __future__ import annotations

from pyspark.sql import types as T

from strataline.sources.files import text_schema

BRONZE_COLUMNS = {
    "crm_cust_info": (
        "cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status",
        "cst_gndr", "cst_create_date",
    ),
    "crm_prd_info": (
        "prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt",
    ),
    "crm_sales_details": (
        "sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt",
        "sls_due_dt", "sls_sales", "sls_quantity", "sls_price",
    ),
    "erp_cust_az12": ("cid", "bdate", "gen"),
    "erp_loc_a101": ("cid", "cntry"),
    "erp_px_cat_g1v2": ("id", "cat", "subcat", "maintenance"),
    "djapi_product": ("id", "title", "category", "pkey", "createdAt"),
    "djapi_customer": (
        "id", "first_name", "last_name", "gender", "birthdate", "city", "state",
        "state_code", "country",
    ),
    "djapi_order": ("id", "prd_id", "cust_id", "unit_price", "quantity", "total_price"),
}

BRONZE_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_cust_az12": "source_erp/cust_az12.csv",
    "erp_loc_a101": "source_erp/loc_a101.csv",
    "erp_px_cat_g1v2": "source_erp/px_cat_g1v2.csv",
}

# First-generation bronze: typed at load.
TYPED_BRONZE_DDL = {
    "crm_cust_info": (
        "cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gndr string, cst_create_date date"
    ),
    "crm_prd_info": (
        "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, "
        "prd_start_dt timestamp, prd_end_dt timestamp"
    ),
    "crm_sales_details": (
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt int, "
        "sls_ship_dt int, sls_due_dt int, sls_sales int, sls_quantity int, sls_price int"
    ),
    "erp_cust_az12": "cid string, bdate date, gen string",
    "erp_loc_a101": "cid string, cntry string",
    "erp_px_cat_g1v2": "id string, cat string, subcat string, maintenance string",
}

SILVER_DDL = {
    "stg_crm__cust_info": (
        "cst_id bigint, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gndr string, cst_create_date date, "
        "dwh_create_date timestamp"
    ),
    "stg_crm__prd_info": (
        "prd_id string, cat_id string, prd_key string, prd_nm string, "
        "prd_cost decimal(37,9), prd_line string, prd_start_dt date, prd_end_dt date, "
        "dwh_create_date timestamp"
    ),
    "stg_crm__sales_details": (
        "sls_ord_num string, sls_prd_key string, sls_cust_id bigint, sls_order_dt date, "
        "sls_ship_dt date, sls_due_dt date, sls_sales decimal(37,9), sls_quantity bigint, "
        "sls_price decimal(37,9), dwh_create_date timestamp"
    ),
    "stg_erp__cust_az12": "cid string, bdate date, gen string, dwh_create_date timestamp",
    "stg_erp__loc_a101": "cid string, cntry string, dwh_create_date timestamp",
    "stg_erp__px_cat_g1v2": (
        "id string, cat string, subcat string, maintenance string, dwh_create_date timestamp"
    ),
    "stg_djapi__product": (
        "id bigint, title string, category string, pkey string, createdAt string, "
        "dwh_create_date timestamp"
    ),
    "stg_djapi__customer": (
        "id bigint, first_name string, last_name string, gender string, birthdate date, "
        "city string, state string, state_code string, country string, "
        "dwh_create_date timestamp"
    ),
    "stg_djapi__order": (
        "id bigint, prd_id bigint, cust_id bigint, unit_price double, quantity bigint, "
        "total_price double, dwh_create_date timestamp"
    ),
}

GOLD_DDL = {
    "dim_customers": (
        "customer_key string, customer_id string, customer_number string, first_name string, "
        "last_name string, country string, marital_status string, gender string, "
        "birthdate date, create_date date, data_source string"
    ),
    "dim_products": (
        "product_key string, product_id string, product_number string, product_name string, "
        "category_id string, category string, subcategory string, maintenance string, "
        "cost decimal(37,9), product_line string, start_date date, data_source string"
    ),
    "fact_sales": (
        "order_key string, order_number string, product_key string, customer_key string, "
        "order_date date, shipping_date date, due_date date, total_sales_amount double, "
        "quantity bigint, unit_price double, data_source string"
    ),
}

DQ_LOG_DDL = (
    "run_id string, invocation_id string, run_started_at timestamp, "
    "run_finished_at timestamp, trigger_type string, model_name string, "
    "schema_layer string, column_name string, test_name string, test_category string, "
    "severity string, status string, failure_count bigint, evaluated_rows bigint, "
    "unique_id string, is_backfilled boolean"
)


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
