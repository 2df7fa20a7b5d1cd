"""The sales figures from one scan against the functions that compute each by itself."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataline.plans import kpis, warehouse
from strataline.workloads.registry import CTX, Inputs


@pytest.fixture(scope="module")
def star(spark, data_folder):
    """The gold tables, stored, with a few lines whose keys and dates are missing."""
    inputs = Inputs(spark, data_folder)
    sales = inputs.stored(inputs.star.sales, "sales")
    gone = sales.limit(7).withColumns({c: F.lit(None).cast(sales.schema[c].dataType) for c in ("order_date", "order_number", "product_key")})
    late = sales.limit(3).withColumns({c: F.lit(None).cast(sales.schema[c].dataType) for c in ("shipping_date", "data_source", "customer_key")})
    sales = inputs.stored(sales.unionByName(gone).unionByName(late), "sales")
    return sales, inputs.stored(inputs.star.products, "products"), inputs.stored(inputs.star.customers, "customers")


def near(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


def test_every_figure_equals_its_own_query(star):
    sales, products, customers = star
    found = kpis.all_sales_figures(sales, products, customers).collect()
    own = {
        "total_sales": (kpis.total_sales(sales), lambda r: (None, None, float(r[0]), None)),
        "total_orders": (kpis.order_count(sales), lambda r: (None, None, None, r[0])),
        "avg_order_value": (kpis.mean_line_value(sales), lambda r: (None, None, float(r[0]), None)),
        "monthly_sales": (kpis.monthly_sales(sales), lambda r: (r[0], None, float(r[1]), None)),
        "monthly_ship_lag": (kpis.monthly_ship_lag(sales), lambda r: (r[0], None, None, r[1])),
        "min_ship_lag": (kpis.min_ship_lag(sales), lambda r: (None, None, None, r[0])),
        "avg_ship_lag": (kpis.mean_ship_lag(sales), lambda r: (None, None, None, r[0])),
        "max_ship_lag": (kpis.max_ship_lag(sales), lambda r: (None, None, None, r[0])),
        "top_categories": (kpis.top_categories(sales, products), lambda r: (r[0], r[2], float(r[1]), None)),
        "sales_by_country": (kpis.sales_by_country(sales, customers), lambda r: (r.country, r.data_source, float(r.total_sales), None)),
        "sales_by_source": (kpis.sales_by_source(sales), lambda r: (None, r[0], float(r[1]), r[2])),
    }
    assert {r.kpi for r in found} == set(own)
    for kpi, (frame, shape) in own.items():
        assert near(tuple(r)[1:] for r in found if r.kpi == kpi) == near(map(shape, frame.collect())), kpi


def test_figures_need_one_scan_of_the_fact(star):
    plan = kpis.sales_grains(star[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_lines_that_carry_known_values_give_the_same_figures(spark, data_folder):
    """Also where products and customers repeat; no key of a product or customer is shuffled."""
    inputs = Inputs(spark, data_folder)
    feeds = inputs.clean_silver
    twice = {n: feeds[n].unionByName(feeds[n].limit(50)) if n in ("stg_crm__cust_info", "stg_djapi__product") else feeds[n] for n in feeds}
    star = warehouse.Star(twice, CTX, store_late=inputs.stored).store_dimensions()
    categories = kpis.known_values(star.products, "product_key", "category", kpis.CATEGORIES)
    countries = kpis.known_values(star.customers, "customer_key", "country", kpis.COUNTRIES)
    lines = star.sales_with(categories, countries)
    assert lines.count() == star.sales.count()
    assert "md5" not in kpis.sales_grains(lines)._jdf.queryExecution().optimizedPlan().toString()
    carried = kpis.all_sales_figures(lines, star.products, star.customers)
    plain = kpis.all_sales_figures(star.sales, star.products, star.customers)
    rounded = lambda df: sorted((tuple(round(v, 2) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)
    assert rounded(carried) == rounded(plain)


def test_figures_of_no_sales(star):
    sales, products, customers = star
    found = kpis.all_sales_figures(sales.limit(0), products, customers).collect()
    assert {r.kpi for r in found} <= {"total_sales", "total_orders", "avg_order_value", "min_ship_lag", "avg_ship_lag", "max_ship_lag"}


def test_lines_carry_dimension_columns_as_if_joined(spark, data_folder):
    """Also where customers and products repeat."""
    inputs = Inputs(spark, data_folder)
    feeds = inputs.clean_silver
    twice = {n: feeds[n].unionByName(feeds[n].limit(50)) if n in ("stg_crm__cust_info", "stg_djapi__product") else feeds[n] for n in feeds}
    star = warehouse.Star(twice, CTX, store_late=inputs.stored)
    carried = star.sales_with(["category"], ["country"])
    plain = star.sales.join(star.products.select("product_key", "category"), "product_key")
    plain = plain.join(star.customers.select("customer_key", "country"), "customer_key").select(*carried.columns)
    assert carried.exceptAll(plain).count() == plain.exceptAll(carried).count() == 0
    assert carried.count() > star.sales.count()
    # Lines that need no hashed key are not given one.
    assert "md5" not in carried.select("category", "country", "quantity")._jdf.queryExecution().optimizedPlan().toString()
