"""KPI queries over the gold star."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.plans import kpis
from strataline.workloads.feeds import AS_OF
from strataline.workloads.registry import case, portable

DAY = f"DATE '{AS_OF}'"
AGE = f"date_sub('year', birthdate, {DAY})"
BAND = (
    f"CASE WHEN {AGE} BETWEEN 18 AND 24 THEN '18-24' WHEN {AGE} BETWEEN 25 AND 34 THEN '25-34' "
    f"WHEN {AGE} BETWEEN 35 AND 44 THEN '35-44' WHEN {AGE} BETWEEN 45 AND 54 THEN '45-54' "
    f"WHEN {AGE} BETWEEN 55 AND 64 THEN '55-64' ELSE '65+' END"
)
LAG = "date_diff('day', order_date, shipping_date)"
SHIPPED = "order_date IS NOT NULL AND shipping_date IS NOT NULL"


@case(
    "q1_revenue_per_active_customer",
    """SELECT round(sum(total_sales_amount) / count(DISTINCT customer_key), 2)
              AS avg_revenue_per_customer FROM fact_sales""",
)
def q1(t):
    return portable(kpis.revenue_per_active_customer(t.star.sales), 2)


@case("q2_customer_count", "SELECT count(customer_key) AS current_cust_count FROM dim_customers")
def q2(t):
    return kpis.customer_count(t.star.customers)


@case(
    "q3_top_decile_revenue_share",
    """SELECT round(sum(CASE WHEN decile = 1 THEN customer_total ELSE 0 END)
                    / sum(customer_total) * 100, 4) AS top10_concentration_pct
       FROM (SELECT customer_total,
                    ntile(10) OVER (ORDER BY customer_total DESC, customer_key) AS decile
             FROM (SELECT customer_key, sum(total_sales_amount) AS customer_total
                   FROM fact_sales GROUP BY customer_key) AS spending) AS ranked""",
)
def q3(t):
    return portable(kpis.top_decile_revenue_share(t.star.sales), 4)


def _distribution(name: str, column: str) -> None:
    oracle = (
        f"SELECT {column}, count(customer_key) AS customer_count "
        f"FROM dim_customers GROUP BY {column}"
    )

    @case(name, oracle)
    def build(t):
        return kpis.customers_by(t.star.customers, column)


_distribution("q4_customers_by_country", "country")
_distribution("q6_customers_by_gender", "gender")
_distribution("q7_customers_by_marital_status", "marital_status")


@case(
    "q5_age_distribution",
    f"""SELECT age_group, count(customer_key) AS customer_count,
               CAST(round(count(customer_key) * 100.0 / sum(count(customer_key)) OVER (), 2)
                    AS DOUBLE) AS percentage
        FROM (SELECT customer_key, {BAND} AS age_group FROM dim_customers
              WHERE birthdate IS NOT NULL) AS banded GROUP BY age_group""",
)
def q5(t):
    return portable(kpis.age_distribution(t.star.customers, AS_OF), 2)


@case(
    "q8_age_distribution_by_source",
    f"""SELECT age_group,
               CAST(round(api * 100.0 / nullif(sum(api) OVER (), 0), 2) AS DOUBLE) AS api_pct,
               CAST(round(csv * 100.0 / nullif(sum(csv) OVER (), 0), 2) AS DOUBLE) AS csv_pct
        FROM (SELECT age_group, sum(CASE WHEN data_source = 'api' THEN 1 ELSE 0 END) AS api,
                     sum(CASE WHEN data_source = 'csv' THEN 1 ELSE 0 END) AS csv
              FROM (SELECT data_source, {BAND} AS age_group FROM dim_customers
                    WHERE birthdate IS NOT NULL) AS banded GROUP BY age_group) AS counted""",
)
def q8(t):
    return portable(kpis.age_distribution_by_source(t.star.customers, AS_OF), 2)


@case(
    "q9_marital_distribution_by_source",
    """SELECT marital_status,
              CAST(round(api * 100.0 / nullif(sum(api) OVER (), 0), 2) AS DOUBLE) AS api_pct,
              CAST(round(csv * 100.0 / nullif(sum(csv) OVER (), 0), 2) AS DOUBLE) AS csv_pct
       FROM (SELECT marital_status, data_source,
                    sum(CASE WHEN data_source = 'api' THEN 1 ELSE 0 END) AS api,
                    sum(CASE WHEN data_source = 'csv' THEN 1 ELSE 0 END) AS csv
             FROM dim_customers WHERE birthdate IS NOT NULL
             GROUP BY marital_status, data_source) AS counted""",
)
def q9(t):
    return portable(kpis.marital_distribution_by_source(t.star.customers), 2)


@case(
    "q10_product_name_count",
    "SELECT count(DISTINCT product_name) AS product_count FROM dim_products",
)
def q10(t):
    return kpis.product_name_count(t.star.products)


_RATIOS = """(SELECT avg(unit_price) AS price, avg(CAST(cost AS DOUBLE)) AS cost
              FROM fact_sales AS s JOIN dim_products AS p
                ON s.product_key = p.product_key AND p.cost > 0
              GROUP BY product_name) AS per_product"""


@case(
    "q11_mean_profit_rate",
    f"""SELECT round(avg((price - cost) / nullif(price, 0)) * 100, 2) AS avg_profit_rate
        FROM {_RATIOS}""",
)
def q11(t):
    return portable(kpis.mean_profit_rate(t.star.sales, t.star.products), 2)


@case(
    "q12_favourite_category_by_country",
    """SELECT country, category, line_count
       FROM (SELECT country, category, count(category) AS line_count,
                    row_number() OVER (PARTITION BY country
                                       ORDER BY count(category) DESC, category) AS place
             FROM fact_sales AS s JOIN dim_products AS p ON s.product_key = p.product_key
                  JOIN dim_customers AS c ON s.customer_key = c.customer_key
             GROUP BY country, category) AS ranked
       WHERE place = 1 AND lower(country) <> 'n/a'""",
)
def q12(t):
    lines = t.star.sales_with(["category"], ["country"])
    return kpis.favourite_category_by_country(lines, t.star.products, t.star.customers)


@case(
    "q13_total_sales", "SELECT round(sum(total_sales_amount), 2) AS total_sales FROM fact_sales"
)
def q13(t):
    return portable(kpis.total_sales(t.star.sales), 2)


@case("q14_order_count", "SELECT count(DISTINCT order_number) AS total_orders FROM fact_sales")
def q14(t):
    return kpis.order_count(t.star.sales)


@case(
    "q15_mean_line_value",
    "SELECT round(avg(total_sales_amount), 2) AS avg_order_value FROM fact_sales",
)
def q15(t):
    return portable(kpis.mean_line_value(t.star.sales), 2)


@case(
    "q16_monthly_sales",
    """SELECT strftime(order_date, '%Y-%m') AS month,
              round(sum(total_sales_amount), 2) AS total_sales
       FROM fact_sales WHERE order_date IS NOT NULL GROUP BY 1""",
)
def q16(t):
    return portable(kpis.monthly_sales(t.star.sales), 2)


@case(
    "q17_monthly_ship_lag",
    f"""SELECT strftime(shipping_date, '%Y-%m') AS month,
               CAST(trunc(sum({LAG}) / count(*)) AS BIGINT) AS ship_lag_days
        FROM fact_sales WHERE {SHIPPED} GROUP BY 1""",
)
def q17(t):
    return kpis.monthly_ship_lag(t.star.sales)


@case("q18_min_ship_lag", f"SELECT min({LAG}) AS min_ship_lag_days FROM fact_sales WHERE {SHIPPED}")
def q18(t):
    return kpis.min_ship_lag(t.star.sales)


@case(
    "q19_mean_ship_lag",
    f"""SELECT CAST(trunc(sum({LAG}) / count(*)) AS BIGINT) AS avg_ship_lag_days
        FROM fact_sales WHERE {SHIPPED}""",
)
def q19(t):
    return kpis.mean_ship_lag(t.star.sales)


@case("q20_max_ship_lag", f"SELECT max({LAG}) AS max_ship_lag_days FROM fact_sales WHERE {SHIPPED}")
def q20(t):
    return kpis.max_ship_lag(t.star.sales)


@case(
    "q21_top_categories",
    """SELECT category, round(sum(total_sales_amount), 2) AS total_sales, f.data_source
       FROM fact_sales AS f JOIN dim_products AS p ON f.product_key = p.product_key
       WHERE lower(category) <> 'n/a' GROUP BY category, f.data_source
       ORDER BY sum(total_sales_amount) DESC LIMIT 10""",
)
def q21(t):
    return portable(kpis.top_categories(t.star.sales, t.star.products), 2)


@case(
    "q22_sales_by_country",
    """SELECT country, f.data_source, round(sum(total_sales_amount), 2) AS total_sales
       FROM fact_sales AS f JOIN dim_customers AS c ON f.customer_key = c.customer_key
       WHERE lower(country) <> 'n/a' GROUP BY country, f.data_source""",
)
def q22(t):
    return portable(kpis.sales_by_country(t.star.sales, t.star.customers), 2)


@case(
    "q23_sales_by_source",
    """SELECT data_source, round(sum(total_sales_amount), 2) AS total_sales,
              count(*) AS order_count FROM fact_sales GROUP BY data_source""",
)
def q23(t):
    return portable(kpis.sales_by_source(t.star.sales), 2)


@case(
    "q24_mean_profit_margin",
    f"""SELECT round(avg((price - cost) / nullif(price, 0)), 2) AS avg_profit_margin_pct
        FROM {_RATIOS}""",
)
def q24(t):
    return kpis.mean_profit_margin(t.star.sales, t.star.products).withColumn(
        "avg_profit_margin_pct", F.round("avg_profit_margin_pct", 2)
    )


@case(
    "kpi_all",
    f"""SELECT 'total_sales' AS kpi, NULL AS item, NULL AS data_source, round(sum(total_sales_amount), 2) AS amount, NULL AS whole
        FROM fact_sales
        UNION ALL SELECT 'total_orders', NULL, NULL, NULL, count(DISTINCT order_number) FROM fact_sales
        UNION ALL SELECT 'avg_order_value', NULL, NULL, round(avg(total_sales_amount), 2), NULL FROM fact_sales
        UNION ALL SELECT 'monthly_sales', strftime(order_date, '%Y-%m'), NULL, round(sum(total_sales_amount), 2), NULL
        FROM fact_sales WHERE order_date IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'monthly_ship_lag', strftime(shipping_date, '%Y-%m'), NULL, NULL, CAST(trunc(sum({LAG}) / count(*)) AS BIGINT)
        FROM fact_sales WHERE {SHIPPED} GROUP BY 2
        UNION ALL SELECT 'min_ship_lag', NULL, NULL, NULL, min({LAG}) FROM fact_sales WHERE {SHIPPED}
        UNION ALL SELECT 'avg_ship_lag', NULL, NULL, NULL, CAST(trunc(sum({LAG}) / count(*)) AS BIGINT) FROM fact_sales WHERE {SHIPPED}
        UNION ALL SELECT 'max_ship_lag', NULL, NULL, NULL, max({LAG}) FROM fact_sales WHERE {SHIPPED}
        UNION ALL (SELECT 'top_categories', category, f.data_source, round(sum(total_sales_amount), 2), NULL
        FROM fact_sales AS f JOIN dim_products AS p ON f.product_key = p.product_key
        WHERE lower(category) <> 'n/a' GROUP BY category, f.data_source ORDER BY sum(total_sales_amount) DESC LIMIT 10)
        UNION ALL SELECT 'sales_by_country', country, f.data_source, round(sum(total_sales_amount), 2), NULL
        FROM fact_sales AS f JOIN dim_customers AS c ON f.customer_key = c.customer_key
        WHERE lower(country) <> 'n/a' GROUP BY country, f.data_source
        UNION ALL SELECT 'sales_by_source', NULL, data_source, round(sum(total_sales_amount), 2), count(*) FROM fact_sales GROUP BY 3""",
)
def kpi_all(t):
    """All eleven sales figures from one scan of the fact, whose lines carry category and country."""
    star = t.star.store_dimensions()
    categories = kpis.known_values(star.products, "product_key", "category", kpis.CATEGORIES)
    countries = kpis.known_values(star.customers, "customer_key", "country", kpis.COUNTRIES)
    return portable(kpis.all_sales_figures(star.sales_with(categories, countries), star.products, star.customers), 2)
