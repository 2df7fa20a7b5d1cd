"""The warehouse models over the dirty feeds, and the whole chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.plans import kpis
from strataline.workloads.registry import case, portable


def text_of(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def doubles(*columns: str) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in columns)


def doubles_exact(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


# Silver models: name -> (query name, text columns, decimal columns).
SILVER_QUERIES = {
    "stg_crm__cust_info": ("m1_crm_customers", ("cst_create_date", "dwh_create_date"), ()),
    "stg_crm__prd_info": (
        "m2_crm_products",
        ("prd_start_dt", "prd_end_dt", "dwh_create_date"),
        ("prd_cost",),
    ),
    "stg_crm__sales_details": (
        "m3_crm_sales",
        ("sls_order_dt", "sls_ship_dt", "sls_due_dt", "dwh_create_date"),
        ("sls_sales", "sls_price"),
    ),
    "stg_erp__cust_az12": ("m4_erp_customers", ("bdate", "dwh_create_date"), ()),
    "stg_erp__loc_a101": ("m5_erp_locations", ("dwh_create_date",), ()),
    "stg_erp__px_cat_g1v2": ("m6_erp_categories", ("dwh_create_date",), ()),
    "stg_djapi__product": ("m7_api_products", ("dwh_create_date",), ()),
    "stg_djapi__customer": ("m8_api_customers", ("birthdate", "dwh_create_date"), ()),
    "stg_djapi__order": (
        "m9_api_orders",
        ("dwh_create_date",),
        ("unit_price", "total_price"),
    ),
}


def _register_silver(model: str, name: str, texts: tuple, decimals: tuple) -> None:
    swaps = ", ".join(filter(None, [text_of(*texts), doubles(*decimals)]))
    oracle = f"SELECT * REPLACE ({swaps}) FROM {model}"

    @case(name, oracle, stage="bronze")
    def build(t):
        return portable(t.silver[model], 4)


for _model, (_name, _texts, _decimals) in SILVER_QUERIES.items():
    _register_silver(_model, _name, _texts, _decimals)


GOLD_SELECTS = {
    "m10_dim_customers": (
        "customers",
        f"SELECT * REPLACE ({text_of('birthdate', 'create_date')}) FROM dim_customers",
    ),
    "m11_dim_products": (
        "products",
        f"SELECT * REPLACE ({doubles_exact('cost')}, {text_of('start_date')}) FROM dim_products",
    ),
    "m12_fact_sales": (
        "sales",
        f"SELECT * REPLACE ({text_of('order_date', 'shipping_date', 'due_date')}) FROM fact_sales",
    ),
}


def _register_gold(name: str, table: str, oracle: str) -> None:
    @case(name, oracle, stage="clean")
    def build(t):
        return portable(getattr(t.star, table))

    @case(f"{name}_from_bronze", oracle, stage="bronze")
    def build_from_bronze(t):
        return portable(getattr(t.star_from_bronze, table))


for _name, (_table, _oracle) in GOLD_SELECTS.items():
    _register_gold(_name, _table, _oracle)


@case(
    "warehouse_sales_by_country",
    """SELECT country, f.data_source, round(sum(total_sales_amount), 2) AS total_sales
       FROM fact_sales AS f JOIN dim_customers AS c ON f.customer_key = c.customer_key
       WHERE lower(country) <> 'n/a' GROUP BY country, f.data_source""",
    stage="bronze",
)
def warehouse_sales_by_country(t):
    """Flagship: nine dirty feeds to silver, gold and the sales report in one plan."""
    star = t.star_from_bronze
    report = kpis.sales_by_country(star.sales, star.customers)
    return report.withColumn("total_sales", F.round("total_sales", 2))
