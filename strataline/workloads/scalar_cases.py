"""Scalar functions and cleaning rules over whole columns and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataline.functions import codes, dates, keys, numbers, text
from strataline.operators.conform import lower_names
from strataline.plans import silver
from strataline.workloads import oracle_stages as sql
from strataline.workloads.feeds import AS_OF, LOAD_TS
from strataline.workloads.registry import case, portable

STOP_WORDS = "('and', 'or', 'at', 'the', 'a', 'an', 'in', 'of', 'to')"


def titled(value: str) -> str:
    """Title case for the oracle, by position in the split list."""
    words = f"string_split(lower({value}), ' ')"
    word = f"{words}[i]"
    return (
        f"rtrim(array_to_string([CASE WHEN i > 1 AND {word} IN {STOP_WORDS} THEN {word} "
        f"ELSE {sql.upper(word + '[1:1]')} || substring({word}, 2) END "
        f"FOR i IN range(1, len({words}) + 1)], ' '))"
    )


@case(
    "f1_trim",
    f"""SELECT doc_id, length({sql.trim("padded")}) AS trimmed_length,
               md5({sql.trim("padded")}) AS trimmed_hash
        FROM (SELECT doc_id, chr(9) || ' ' || text || chr(13) || chr(10) AS padded
              FROM documents) AS d""",
)
def f1(t):
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit("\r\n"))
    trimmed = text.trim_all(padded)
    return t.documents.select(
        "doc_id", F.length(trimmed).alias("trimmed_length"), F.md5(trimmed).alias("trimmed_hash")
    )


@case(
    "f2_upper_lower",
    f"""SELECT conv_id, turn, md5({sql.upper("text")}) AS upper_hash,
               md5(lower(text)) AS lower_hash
        FROM conversations""",
)
def f2(t):
    return t.conversations.select(
        "conv_id",
        "turn",
        F.md5(F.upper("text")).alias("upper_hash"),
        F.md5(F.lower("text")).alias("lower_hash"),
    )


@case(
    "f3_capitalise_words",
    f"SELECT page_id, md5({sql.words('html')}) AS html_hash, {sql.words('url')} AS url FROM pages",
)
def f3(t):
    return t.pages.select(
        "page_id",
        F.md5(text.capitalise_words("html")).alias("html_hash"),
        text.capitalise_words("url").alias("url"),
    )


@case(
    "f4_title_case",
    f"""SELECT item_id, {titled("text")} AS title FROM benchmark
        UNION ALL SELECT p_partkey, {titled("'the ' || p_name || ' OF the ' || p_type || ' '")}
        FROM part""",
)
def f4(t):
    name = F.concat(
        F.lit("the "), F.col("p_name"), F.lit(" OF the "), F.col("p_type"), F.lit(" ")
    )
    parts = t.part.select(F.col("p_partkey").alias("item_id"), text.title_case(name).alias("title"))
    return t.benchmark.select("item_id", text.title_case("text").alias("title")).unionByName(parts)


@case(
    "f5_capitalise_first",
    """SELECT id, CASE WHEN gender IS NULL THEN 'n/a'
                       ELSE upper(substring(trim(gender), 1, 1)) || lower(substring(trim(gender), 2))
                       END AS gender FROM djapi_customer""",
    "bronze",
)
def f5(t):
    return t.bronze["djapi_customer"].select("id", text.capitalise_first("gender").alias("gender"))


@case(
    "f6_replace",
    """SELECT id, replace(id, 'dummy-', '') AS plain_id, replace(pkey, '_', '-') AS dashed,
              replace(replace(category, chr(13), ''), '-', ' ') AS spaced FROM djapi_product""",
    "bronze",
)
def f6(t):
    return t.bronze["djapi_product"].select(
        "id",
        text.remove_text("id", "dummy-").alias("plain_id"),
        F.replace("pkey", F.lit("_"), F.lit("-")).alias("dashed"),
        F.replace(text.remove_text("category", "\r"), F.lit("-"), F.lit(" ")).alias("spaced"),
    )


@case(
    "f7_substring_left",
    """SELECT prd_id, substring(prd_key, 1, 5) AS head, substring(prd_key, 7) AS tail,
              left(prd_key, 3) AS opening FROM crm_prd_info""",
    "bronze",
)
def f7(t):
    return t.bronze["crm_prd_info"].select(
        "prd_id",
        F.substring("prd_key", 1, 5).alias("head"),
        F.substr("prd_key", F.lit(7)).alias("tail"),
        F.left("prd_key", F.lit(3)).alias("opening"),
    )


@case(
    "f8_length",
    """SELECT doc_id, length(text) AS n, sum(length(text)) OVER (PARTITION BY doc_id) AS total
       FROM documents""",
)
def f8(t):
    return t.documents.select(
        "doc_id", F.length("text").alias("n"), F.length("text").cast("bigint").alias("total")
    )


@case(
    "f9_concat_with_null",
    """SELECT id, CASE WHEN title IS NULL THEN NULL ELSE 'T-' || title END AS label
       FROM djapi_product""",
    "bronze",
)
def f9(t):
    return t.bronze["djapi_product"].select("id", F.concat(F.lit("T-"), F.col("title")).alias("label"))


@case("f10_strpos", "SELECT page_id, strpos(html, '</p>') AS first_end FROM pages")
def f10(t):
    return t.pages.select("page_id", F.instr("html", "</p>").alias("first_end"))


@case(
    "f11_regexp_contains",
    "SELECT id, regexp_matches(id, '^.{2}_.{2}$') AS matches FROM erp_px_cat_g1v2",
    "bronze",
)
def f11(t):
    return t.bronze["erp_px_cat_g1v2"].select("id", F.col("id").rlike("^.{2}_.{2}$").alias("matches"))


@case(
    "f12_month_label",
    """SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS row_count
       FROM lineitem GROUP BY 1""",
)
def f12(t):
    grouped = t.lineitem.groupBy(dates.month_label("l_shipdate").alias("month"))
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "f13_zero_padding",
    """SELECT event_id, CASE WHEN length(CAST(event_id AS VARCHAR)) >= 4
                             THEN CAST(event_id AS VARCHAR)
                             ELSE lpad(CAST(event_id AS VARCHAR), 4, '0') END AS padded FROM events""",
)
def f13(t):
    return t.events.select("event_id", text.zero_padded("event_id", 4).alias("padded"))


@case(
    "f14_strict_casts",
    """SELECT CAST(sls_cust_id AS BIGINT) AS cust, CAST(sls_cust_id AS VARCHAR) AS cust_text,
              count(*) AS row_count FROM crm_sales_details GROUP BY 1, 2""",
    "bronze",
)
def f14(t):
    number = F.col("sls_cust_id").cast("bigint")
    grouped = t.bronze["crm_sales_details"].groupBy(
        number.alias("cust"), number.cast("string").alias("cust_text")
    )
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "f15_safe_casts",
    """SELECT TRY_CAST(cst_id AS BIGINT) AS cst_id, count(*) AS row_count FROM crm_cust_info
       GROUP BY 1""",
    "bronze",
)
def f15(t):
    safe = F.col("cst_id").try_cast("bigint")
    grouped = t.bronze["crm_cust_info"].groupBy(safe.alias("cst_id"))
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "f16_parse_compact_day",
    """SELECT CAST(CAST(CASE WHEN length(sls_order_dt) = 8
                             THEN try_strptime(sls_order_dt, '%Y%m%d') END AS DATE) AS VARCHAR)
                  AS day, count(*) AS row_count FROM crm_sales_details GROUP BY 1""",
    "bronze",
)
def f16(t):
    grouped = t.bronze["crm_sales_details"].groupBy(
        dates.compact_day("sls_order_dt").cast("string").alias("day")
    )
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "f17_lenient_parse",
    f"""SELECT cid, CAST({sql.iso_day("bdate")} AS VARCHAR) AS day FROM erp_cust_az12""",
    "bronze",
)
def f17(t):
    return t.bronze["erp_cust_az12"].select("cid", dates.iso_day("bdate").cast("string").alias("day"))


@case(
    "f18_instant_day",
    "SELECT id, substring(createdAt, 1, 10) AS day FROM djapi_product",
    "bronze",
)
def f18(t):
    return t.bronze["djapi_product"].select(
        "id", dates.iso_instant_day("createdAt").cast("string").alias("day")
    )


@case(
    "f19_horizon",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) < DATE '{AS_OF}' AS before_horizon
        FROM orders""",
)
def f19(t):
    return t.orders.select(
        "o_orderkey", (F.col("o_orderdate").cast("date") < dates.day(AS_OF)).alias("before_horizon")
    )


@case(
    "f20_date_shifts",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day_before,
              CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 18 YEAR AS DATE) AS VARCHAR)
                  AS years_before FROM orders""",
)
def f20(t):
    ordered = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.date_sub(ordered, 1).cast("string").alias("day_before"),
        F.add_months(ordered, -216).cast("string").alias("years_before"),
    )


@case(
    "f21_days_between",
    """SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey,
              date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lag
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def f21(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lag = dates.days_between(F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date"))
    return joined.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", lag.alias("lag"))


@case(
    "f22_age_and_band",
    f"""SELECT cid, date_sub('year', bdate, DATE '{AS_OF}') AS age,
               CASE WHEN date_sub('year', bdate, DATE '{AS_OF}') BETWEEN 18 AND 24 THEN '18-24'
                    WHEN date_sub('year', bdate, DATE '{AS_OF}') BETWEEN 25 AND 34 THEN '25-34'
                    WHEN date_sub('year', bdate, DATE '{AS_OF}') BETWEEN 35 AND 44 THEN '35-44'
                    WHEN date_sub('year', bdate, DATE '{AS_OF}') BETWEEN 45 AND 54 THEN '45-54'
                    WHEN date_sub('year', bdate, DATE '{AS_OF}') BETWEEN 55 AND 64 THEN '55-64'
                    ELSE '65+' END AS band
        FROM stg_erp__cust_az12""",
)
def f22(t):
    age = dates.age_in_years("bdate", AS_OF)
    return t.clean_silver["stg_erp__cust_az12"].select(
        "cid", age.alias("age"), dates.age_band(age).alias("band")
    )


@case(
    "f23_calendar_parts",
    """SELECT month(o_orderdate) AS month, day(o_orderdate) AS day,
              (month(o_orderdate) % 12 + 3) // 3 AS season, count(*) AS row_count
       FROM orders GROUP BY 1, 2, 3""",
)
def f23(t):
    grouped = t.orders.groupBy(
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
        dates.season_number("o_orderdate").alias("season"),
    )
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "f24_add_days_compact",
    """SELECT o_orderkey,
              strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER), '%Y%m%d')
                  AS shifted FROM orders""",
)
def f24(t):
    days = (F.col("o_orderkey") % 30).cast("int")
    shifted = F.date_add(F.col("o_orderdate").cast("date"), days)
    return t.orders.select("o_orderkey", dates.to_compact(shifted).alias("shifted"))


@case(
    "f25_compact_text",
    """SELECT strftime(l_shipdate, '%Y%m%d') AS ship_day, count(*) AS row_count
       FROM lineitem GROUP BY 1""",
)
def f25(t):
    grouped = t.lineitem.groupBy(dates.to_compact("l_shipdate").alias("ship_day"))
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "f27_f28_round_and_safe_ratio",
    """SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(12,3)) / 8, 2) AS DOUBLE)
                  AS rounded,
              p_retailprice / nullif(p_size - 25, 0) AS ratio FROM part""",
)
def f27(t):
    exact = F.col("p_retailprice").cast("decimal(12,3)") / 8
    ratio = numbers.safe_ratio("p_retailprice", (F.col("p_size") - 25).cast("double"))
    return t.part.select(
        "p_partkey", F.round(exact, 2).cast("double").alias("rounded"), ratio.alias("ratio")
    )


@case(
    "f31_ordinal_bands",
    f"""SELECT band, count(*) AS row_count FROM
            (SELECT CASE WHEN a BETWEEN 18 AND 24 THEN '18-24' WHEN a BETWEEN 25 AND 34 THEN '25-34'
                         WHEN a BETWEEN 35 AND 44 THEN '35-44' WHEN a BETWEEN 45 AND 54 THEN '45-54'
                         WHEN a BETWEEN 55 AND 64 THEN '55-64' ELSE '65+' END AS band
             FROM (SELECT p_size * 2 AS a FROM part) AS sized) AS banded GROUP BY band""",
)
def f31(t):
    grouped = t.part.groupBy(dates.age_band(F.col("p_size") * 2).alias("band"))
    counted = grouped.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(dates.age_band_order("band"))


@case(
    "f36_cast_to_text",
    """SELECT CAST(user_id AS VARCHAR) AS user_text, count(*) AS row_count FROM events GROUP BY 1""",
)
def f36(t):
    grouped = t.events.groupBy(F.col("user_id").cast("string").alias("user_text"))
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "f26_arithmetic",
    """SELECT s_suppkey, abs(s_acctbal - 5000) AS gap,
              CASE WHEN s_nationkey = 0 THEN NULL ELSE s_acctbal / s_nationkey END AS ratio,
              CAST(round(CAST(s_acctbal AS DECIMAL(12,2)) / 8, 2) AS DOUBLE) AS eighth
       FROM supplier""",
)
def f26(t):
    exact = F.col("s_acctbal").cast("decimal(12,2)")
    return t.supplier.select(
        "s_suppkey",
        F.abs(F.col("s_acctbal") - 5000).alias("gap"),
        numbers.safe_ratio("s_acctbal", F.col("s_nationkey").cast("double")).alias("ratio"),
        F.round(exact / 8, 2).cast("double").alias("eighth"),
    )


@case(
    "f29_null_functions",
    """SELECT prd_id, coalesce(nullif(prd_cost, ''), '0') AS cost, ifnull(prd_line, 'none') AS line
       FROM crm_prd_info""",
    "bronze",
)
def f29(t):
    return t.bronze["crm_prd_info"].select(
        "prd_id",
        F.coalesce(F.nullif("prd_cost", F.lit("")), F.lit("0")).alias("cost"),
        F.ifnull("prd_line", F.lit("none")).alias("line"),
    )


@case(
    "f30_decimal_percentage",
    """SELECT event_type, CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE)
                  AS percentage FROM events GROUP BY event_type""",
)
def f30(t):
    counted = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return portable(
        counted.select("event_type", numbers.percentage("n", total).alias("percentage")), 2
    )


@case(
    "f32_json_navigation",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def f32(t):
    return t.events.select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@case(
    "f33_lookup_mapping",
    """SELECT o_orderkey, CASE (month(o_orderdate) % 12 + 3) // 3 WHEN 1 THEN 'Winter'
              WHEN 2 THEN 'Spring' WHEN 3 THEN 'Summer' ELSE 'Autumn' END AS season FROM orders""",
)
def f33(t):
    names = {"1": "Winter", "2": "Spring", "3": "Summer", "4": "Autumn"}
    number = dates.season_number("o_orderdate").cast("string")
    return t.orders.select("o_orderkey", codes.map_codes(number, names).alias("season"))


@case(
    "f34_prefix_classification",
    """SELECT p_partkey, CASE WHEN p_name LIKE 'red%' THEN 'red' ELSE 'other' END AS kind
       FROM part""",
)
def f34(t):
    kind = F.when(F.col("p_name").startswith("red"), "red").otherwise("other")
    return t.part.select("p_partkey", kind.alias("kind"))


@case(
    "f35_lower_names",
    "SELECT r_regionkey, r_name FROM region",
)
def f35(t):
    return lower_names(t.region.toDF("R_REGIONKEY", "R_NAME"))


@case(
    "h1_surrogate_key",
    f"""SELECT {sql.hashed_key("id", "gender")} AS row_key, id FROM djapi_customer""",
    "bronze",
)
def h1(t):
    return t.bronze["djapi_customer"].select(keys.surrogate_key("id", "gender").alias("row_key"), "id")


# Cleaning rules


@case(
    "c1_numeric_id",
    f"SELECT {sql.api_id('id')} AS id, count(*) AS row_count FROM djapi_order GROUP BY 1",
    "bronze",
)
def c1(t):
    grouped = t.bronze["djapi_order"].groupBy(codes.numeric_id("id").alias("id"))
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case(
    "c2_drop_prefix",
    "SELECT regexp_replace(cid, '^NAS', '') AS cid FROM erp_cust_az12",
    "bronze",
)
def c2(t):
    return t.bronze["erp_cust_az12"].select(codes.drop_prefix("cid", "NAS").alias("cid"))


@case(
    "c3_map_codes",
    f"""SELECT cst_key,
               {sql.coded(sql.trim("cst_marital_status"), codes.MARITAL_CODES)} AS marital_status,
               {sql.coded(sql.trim("cst_gndr"), codes.GENDER_CODES)} AS gender,
               count(*) AS row_count
        FROM crm_cust_info GROUP BY 1, 2, 3""",
    "bronze",
)
def c3(t):
    grouped = t.bronze["crm_cust_info"].groupBy(
        "cst_key",
        codes.map_codes("cst_marital_status", codes.MARITAL_CODES).alias("marital_status"),
        codes.map_codes("cst_gndr", codes.GENDER_CODES).alias("gender"),
    )
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


@case("c4_map_codes_or_keep", "SELECT cid, cntry FROM stg_erp__loc_a101", "bronze")
def c4(t):
    return t.bronze["erp_loc_a101"].select(
        text.remove_text("cid", "-").alias("cid"),
        codes.map_codes_or_keep("cntry", codes.COUNTRY_CODES).alias("cntry"),
    )


@case("c5_normalise_gender", "SELECT id, gender FROM stg_djapi__customer", "bronze")
def c5(t):
    return t.bronze["djapi_customer"].select(
        codes.numeric_id("id").alias("id"),
        codes.map_codes("gender", codes.GENDER_WORDS).alias("gender"),
    )


def _horizon(name: str, operator: str, include: bool) -> None:
    parsed = "CAST(try_strptime(sls_order_dt, '%Y%m%d') AS DATE)"
    oracle = f"""SELECT CAST(CASE WHEN TRY_CAST(sls_order_dt AS BIGINT) > 19000000
                                   AND {parsed} {operator} DATE '1998-06-01' THEN {parsed} END
                             AS VARCHAR) AS day, count(*) AS row_count
                 FROM crm_sales_details GROUP BY 1"""

    @case(name, oracle, "bronze")
    def build(t):
        kept = dates.within_horizon(dates.compact_day("sls_order_dt"), "1998-06-01", include)
        grouped = t.bronze["crm_sales_details"].groupBy(kept.cast("string").alias("day"))
        return grouped.agg(F.count(F.lit(1)).alias("row_count"))


_horizon("c6_plausible_day", "<=", True)
_horizon("t4_plausible_day_before_today", "<", False)


@case(
    "c7_plausible_birthdate",
    f"SELECT cid, CAST({sql.birthday('bdate')} AS VARCHAR) AS bdate FROM erp_cust_az12",
    "bronze",
)
def c7(t):
    born = dates.plausible_birthdate(dates.iso_day("bdate"), AS_OF)
    return t.bronze["erp_cust_az12"].select("cid", born.cast("string").alias("bdate"))


@case(
    "c8_strict_bounds",
    """SELECT o_orderkey, CAST(CASE WHEN CAST(o_orderdate AS DATE) > DATE '1900-01-01'
                                     AND CAST(o_orderdate AS DATE) < DATE '1999-03-04'
                               THEN CAST(o_orderdate AS DATE) END AS VARCHAR) AS day FROM orders""",
)
def c8(t):
    kept = dates.strictly_between_horizons(F.col("o_orderdate").cast("date"), "1999-03-04")
    return t.orders.select("o_orderkey", kept.cast("string").alias("day"))


@case(
    "c8_strict_bounds_v1",
    """SELECT o_orderkey, CAST(CASE WHEN CAST(o_orderdate AS DATE) > DATE '1900-01-01'
                                     AND CAST(o_orderdate AS DATE) < TIMESTAMP '1996-03-04 12:00:00'
                               THEN CAST(o_orderdate AS DATE) END AS VARCHAR) AS day FROM orders""",
)
def c8_v1(t):
    """The first generation compares with the moment of the load: that day's own orders stay."""
    day = F.col("o_orderdate").cast("date")
    kept = dates.strictly_between_horizons(day, "1996-03-04", "1996-03-04 12:00:00")
    return t.orders.select("o_orderkey", kept.cast("string").alias("day"))


@case(
    "c9_c11_sales_repair",
    """SELECT sls_ord_num, sls_prd_key, round(CAST(sls_sales AS DOUBLE), 4) AS sls_sales,
              sls_quantity, round(CAST(sls_price AS DOUBLE), 4) AS sls_price
       FROM stg_crm__sales_details""",
    "bronze",
)
def c9(t):
    stated = t.bronze["crm_sales_details"].select(
        "sls_ord_num",
        "sls_prd_key",
        F.col("sls_sales").try_cast(numbers.AMOUNT).alias("sales"),
        F.col("sls_quantity").try_cast("bigint").alias("quantity"),
        F.col("sls_price").try_cast(numbers.AMOUNT).alias("price"),
    )
    sales, quantity, price = F.col("sales"), F.col("quantity"), F.col("price")
    repaired = stated.select(
        "sls_ord_num",
        "sls_prd_key",
        numbers.repair_sales(sales, quantity, price).alias("sls_sales"),
        numbers.repair_quantity(quantity).alias("sls_quantity"),
        numbers.repair_price(price, sales, quantity).alias("sls_price"),
    )
    return portable(repaired, 4)


@case(
    "c9_c11_strict_repair",
    """SELECT sls_ord_num, sls_prd_key, sls_cust_id, round(price * quantity, 4) AS sls_sales, quantity AS sls_quantity, round(price, 4) AS sls_price
       FROM (SELECT *, coalesce(nullif(abs(p), 0), abs(s) / quantity, abs(p)) AS price
             FROM (SELECT sls_ord_num, sls_prd_key, TRY_CAST(sls_cust_id AS BIGINT) AS sls_cust_id,
                          TRY_CAST(sls_sales AS DOUBLE) AS s, TRY_CAST(sls_price AS DOUBLE) AS p,
                          coalesce(nullif(abs(TRY_CAST(sls_quantity AS BIGINT)), 0), 1) AS quantity
                   FROM crm_sales_details) AS typed) AS priced""",
    "bronze",
)
def c9_strict(t):
    """With the strict repair a line's total is its price times its quantity."""
    strict = silver.RunContext(as_of=AS_OF, load_ts=LOAD_TS, strict=True)
    lines = silver.crm_sales(t.bronze["crm_sales_details"], strict)
    return portable(lines.select("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_sales", "sls_quantity", "sls_price"), 4)


_WIDE_LINE = """CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 10000000000 AS DECIMAL(37,9)) AS price,
    CAST(l_quantity * 10000000000 AS BIGINT) AS quantity"""


@case(
    "c9_c11_wide_amounts",
    f"""SELECT l_orderkey, l_linenumber, CAST(price AS VARCHAR) AS price, quantity,
               split_part(CAST(CAST(price AS DECIMAL(28,2)) * CAST(quantity / 10000000000 AS DECIMAL(9,0)) AS VARCHAR), '.', 1)
                   || '0000000000' AS total
        FROM (SELECT l_orderkey, l_linenumber, {_WIDE_LINE} FROM lineitem) AS wide""",
)
def c9_wide(t):
    """Amounts of up to 26 digits, quantities of 12: the repaired total has every digit of them.

    The oracle multiplies a quantity without its ten zeros and adds them as text.
    """
    wide = t.spark.sql("SELECT l_orderkey, l_linenumber, " + _WIDE_LINE + " FROM {lineitem}", lineitem=t.lineitem)
    total = numbers.repair_sales(F.lit(None).cast(numbers.AMOUNT), F.col("quantity"), F.col("price"))
    units = total.cast("decimal(28,0)").cast("string")  # prices are whole here
    return wide.select("l_orderkey", "l_linenumber", F.col("price").cast("string").alias("price"), "quantity", units.alias("total"))


@case(
    "c10_c12_total_repair",
    f"""SELECT unit_price, {sql.AT_LEAST_ONE} AS quantity,
              {sql.repaired("total", "unit_price", "qty")} AS total_price
       FROM (SELECT TRY_CAST(unit_price AS DOUBLE) AS unit_price, TRY_CAST(quantity AS BIGINT) AS qty,
                    TRY_CAST(total_price AS DOUBLE) AS total FROM djapi_order) AS typed
       WHERE unit_price > 0""",
    "bronze",
)
def c12(t):
    typed = t.bronze["djapi_order"].select(
        F.col("unit_price").try_cast("double").alias("unit_price"),
        F.col("quantity").try_cast("bigint").alias("qty"),
        F.col("total_price").try_cast("double").alias("total"),
    )
    priced = typed.filter(F.col("unit_price") > 0)
    return priced.select(
        "unit_price",
        numbers.at_least_one(F.col("qty")).alias("quantity"),
        numbers.repair_total(F.col("total"), F.col("unit_price"), F.col("qty")).alias("total_price"),
    )


@case(
    "c13_null_to_default",
    """SELECT id, coalesce(title, 'n/a') AS title, coalesce(category, 'N/A') AS category
       FROM djapi_product""",
    "bronze",
)
def c13(t):
    return t.bronze["djapi_product"].select(
        "id",
        F.coalesce("title", F.lit(codes.MISSING)).alias("title"),
        F.coalesce("category", F.lit("N/A")).alias("category"),
    )


@case(
    "c14_split_composite_key",
    """SELECT prd_id, replace(substring(prd_key, 1, 5), '-', '_') AS cat_id,
              substring(prd_key, 7) AS number FROM crm_prd_info""",
    "bronze",
)
def c14(t):
    return t.bronze["crm_prd_info"].select(
        "prd_id",
        codes.category_of_key("prd_key").alias("cat_id"),
        codes.number_of_key("prd_key").alias("number"),
    )


@case(
    "c15_normalise_sku",
    f"""SELECT id, {sql.sku("pkey")} AS pkey
        FROM djapi_product""",
    "bronze",
)
def c15(t):
    return t.bronze["djapi_product"].select("id", codes.normalise_sku("pkey").alias("pkey"))


@case(
    "c16_prefer_then_fallback",
    """SELECT cst_id, coalesce(nullif(cst_gndr, 'n/a'), gen, 'n/a') AS gender
       FROM stg_crm__cust_info LEFT JOIN stg_erp__cust_az12 AS a ON cst_key = a.cid""",
    "bronze",
)
def c16(t):
    joined = t.silver["stg_crm__cust_info"].join(
        t.silver["stg_erp__cust_az12"], F.col("cst_key") == F.col("cid"), "left"
    )
    return joined.select("cst_id", codes.prefer("cst_gndr", "gen").alias("gender"))


@case(
    "c17_source_prefix",
    f"""SELECT {sql.prefixed("CAST(id AS VARCHAR)")} AS id FROM
            (SELECT c_custkey AS id, 'csv' AS data_source FROM customer
             UNION ALL SELECT s_suppkey, 'api' FROM supplier
             UNION ALL SELECT r_regionkey, 'web' FROM region) AS united""",
)
def c17(t):
    parts = [
        t.customer.select(F.col("c_custkey").alias("id"), F.lit("csv").alias("data_source")),
        t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("api").alias("data_source")),
        t.region.select(
            F.col("r_regionkey").cast("bigint").alias("id"), F.lit("web").alias("data_source")
        ),
    ]
    united = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return united.select(keys.source_id("id", "data_source").alias("id"))


@case(
    "c18_strip_control_chars",
    """SELECT id, replace(country, chr(13), '') AS country,
              replace(first_name, chr(13), '') AS first_name FROM djapi_customer""",
    "bronze",
)
def c18(t):
    return t.bronze["djapi_customer"].select(
        "id",
        text.remove_text("country", "\r").alias("country"),
        text.remove_text("first_name", "\r").alias("first_name"),
    )
