"""Silver models: one cleaned table per bronze table.

Each model is a function of bronze DataFrames and a :class:`RunContext`; it only
builds a plan. ``generation="v1"`` selects the first-generation rules where the two
generations of the warehouse differ.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.functions import codes, dates, numbers, text
from strataline.operators.history import close_versions, newest_per_key
from strataline.operators.joins import keep_members
from strataline.sources.tables import stamp_load

CURRENT, V1 = "current", "v1"


@dataclass(frozen=True)
class RunContext:
    """What a run must know besides its data: the horizon, the load time, the rules.

    ``strict`` repairs sales lines so that total, quantity and price agree with each other; by
    default each is repaired by itself, as the rules were first written.
    """

    as_of: dt.date | str
    load_ts: dt.datetime | str
    generation: str = CURRENT
    strict: bool = False

    def __post_init__(self) -> None:
        if self.generation not in (CURRENT, V1):
            raise ValueError(f"unknown generation: {self.generation!r}")

    @property
    def is_v1(self) -> bool:
        return self.generation == V1


def crm_customers(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    """Newest record per customer id, trimmed names, labelled codes."""
    typed = bronze.withColumns(
        {
            "cst_id": F.col("cst_id").try_cast("bigint"),
            "cst_create_date": dates.iso_day("cst_create_date"),
        }
    ).filter(F.col("cst_id").isNotNull())
    tie_break = [c for c in typed.columns if c not in ("cst_id", "cst_create_date")]
    newest = newest_per_key(typed, ["cst_id"], "cst_create_date", tie_break)
    cleaned = newest.select(
        "cst_id",
        "cst_key",
        text.trim_all("cst_firstname").alias("cst_firstname"),
        text.trim_all("cst_lastname").alias("cst_lastname"),
        codes.map_codes("cst_marital_status", codes.MARITAL_CODES).alias("cst_marital_status"),
        codes.map_codes("cst_gndr", codes.GENDER_CODES).alias("cst_gndr"),
        "cst_create_date",
    )
    return stamp_load(cleaned, ctx.load_ts)


def crm_products(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    """Category and number out of the key, versions closed by the next start."""
    name = F.col("prd_nm") if ctx.is_v1 else text.capitalise_words("prd_nm")
    cost = F.coalesce(F.nullif(F.col("prd_cost"), F.lit("")), F.lit("0"))
    versions = close_versions(
        bronze.withColumn("prd_start_dt", F.col("prd_start_dt").cast("date")),
        key="prd_key",
        start="prd_start_dt",
        tie_break="prd_id",
        end="prd_end_dt",
    )
    cleaned = versions.select(
        "prd_id",
        codes.category_of_key("prd_key").alias("cat_id"),
        codes.number_of_key("prd_key").alias("prd_key"),
        name.alias("prd_nm"),
        cost.cast(numbers.AMOUNT).alias("prd_cost"),
        codes.map_codes("prd_line", codes.LINE_CODES).alias("prd_line"),
        "prd_start_dt",
        "prd_end_dt",
    )
    return stamp_load(cleaned, ctx.load_ts)


def crm_sales(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    """Plausible dates, repaired amounts. Every repair reads the stated values.

    Parsing and repairing are two projections: Spark keeps them apart because the
    parsed values are used several times, so each text is parsed once.
    """
    day_columns = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
    typed = bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        F.col("sls_cust_id").try_cast("bigint").alias("sls_cust_id"),
        *[dates.compact_day(c).alias(c) for c in day_columns],
        F.col("sls_sales").try_cast(numbers.AMOUNT).alias("sls_sales"),
        F.col("sls_quantity").try_cast("bigint").alias("sls_quantity"),
        F.col("sls_price").try_cast(numbers.AMOUNT).alias("sls_price"),
    )
    sales, quantity, price = (F.col(c) for c in ("sls_sales", "sls_quantity", "sls_price"))
    if ctx.strict:
        # One projection for the line, so that price and quantity are repaired once.
        line = numbers.consistent_line(sales, quantity, price)
        typed = typed.withColumn("_line", line).withColumns({f"sls_{c}": F.col(f"_line.{c}") for c in ("sales", "quantity", "price")})
        kept = [dates.within_horizon(c, ctx.as_of, include_as_of=not ctx.is_v1).alias(c) for c in day_columns]
        cleaned = typed.select("sls_ord_num", "sls_prd_key", "sls_cust_id", *kept, "sls_sales", "sls_quantity", "sls_price")
        return stamp_load(cleaned, ctx.load_ts)
    if ctx.is_v1:
        total = numbers.repair_sales_when_not_positive(sales, quantity, price)
    else:
        typed = typed.withColumn("_expected", numbers.expected_sales(price, quantity))
        total = numbers.repair_sales(sales, quantity, price, F.col("_expected"))
    cleaned = typed.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        *[
            dates.within_horizon(c, ctx.as_of, include_as_of=not ctx.is_v1).alias(c)
            for c in day_columns
        ],
        total.alias("sls_sales"),
        numbers.repair_quantity(quantity).alias("sls_quantity"),
        numbers.repair_price(price, sales, quantity, keep_sign=ctx.is_v1).alias("sls_price"),
    )
    return stamp_load(cleaned, ctx.load_ts)


def unfit_sales(bronze: DataFrame) -> DataFrame:
    """Rejects of :func:`crm_sales`: the stated lines whose price x quantity is too large for an
    amount. Their total is NULL in the model."""
    price = F.col("sls_price").try_cast(numbers.AMOUNT)
    return bronze.filter(numbers.does_not_fit(price, F.col("sls_quantity").try_cast("bigint")))


def erp_customers(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    gender = codes.map_codes_or_keep("gen", codes.GENDER_CODES)
    if ctx.is_v1:
        gender = codes.map_codes_or_keep_v1("gen", codes.GENDER_CODES, trim=False)
    cleaned = bronze.select(
        codes.drop_prefix("cid", "NAS").alias("cid"),
        dates.plausible_birthdate(dates.iso_day("bdate"), ctx.as_of).alias("bdate"),
        gender.alias("gen"),
    )
    return stamp_load(cleaned, ctx.load_ts)


def erp_locations(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    country = codes.map_codes_or_keep("cntry", codes.COUNTRY_CODES)
    if ctx.is_v1:
        country = codes.map_codes_or_keep_v1("cntry", codes.COUNTRY_CODES, trim=True)
    cleaned = bronze.select(
        text.remove_text("cid", "-").alias("cid"),
        country.alias("cntry"),
    )
    return stamp_load(cleaned, ctx.load_ts)


def erp_categories(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    if ctx.is_v1:
        return stamp_load(bronze.select("id", "cat", "subcat", "maintenance"), ctx.load_ts)

    def label(column: str):
        return text.capitalise_words(F.coalesce(F.col(column), F.lit("N/A"))).alias(column)

    cleaned = bronze.select(
        "id",
        label("cat"),
        label("subcat"),
        codes.map_codes("maintenance", codes.YES_NO_CODES, trim=False).alias("maintenance"),
    )
    return stamp_load(cleaned, ctx.load_ts)


def api_products(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    """Named products only; keys and titles in one shape."""
    named = bronze.filter(F.col("title").isNotNull())
    if ctx.is_v1:
        title = text.title_case(F.trim("title"))
        kind = F.replace(F.coalesce("category", F.lit(codes.MISSING)), F.lit("-"), F.lit(" "))
        category = text.title_case(F.trim(kind))
    else:
        title = text.trim_all(text.capitalise_words(text.remove_text("title", "\r")))
        kind = F.coalesce(text.remove_text("category", "\r"), F.lit(codes.MISSING))
        category = text.trim_all(
            text.capitalise_words(F.replace(kind, F.lit("-"), F.lit(" ")))
        )
    cleaned = named.select(
        codes.numeric_id("id").alias("id"),
        title.alias("title"),
        category.alias("category"),
        codes.normalise_sku("pkey").alias("pkey"),
        "createdAt",
    )
    return stamp_load(cleaned, ctx.load_ts)


def api_customers(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    if ctx.is_v1:
        names = {c: text.capitalise_first(c) for c in ("first_name", "last_name", "gender")}
        places = {c: text.title_case(F.trim(c)) for c in ("city", "state", "country")}
    else:
        names = {
            c: F.coalesce(
                text.trim_all(text.capitalise_words(text.remove_text(c, "\r"))),
                F.lit(codes.MISSING),
            )
            for c in ("first_name", "last_name")
        }
        names["gender"] = codes.map_codes("gender", codes.GENDER_WORDS)
        places = {c: text.capitalise_words(c) for c in ("city", "state")}
        places["country"] = text.capitalise_words(text.remove_text("country", "\r"))
    cleaned = bronze.select(
        codes.numeric_id("id").alias("id"),
        names["first_name"].alias("first_name"),
        names["last_name"].alias("last_name"),
        names["gender"].alias("gender"),
        dates.plausible_birthdate(dates.iso_day("birthdate"), ctx.as_of).alias("birthdate"),
        places["city"].alias("city"),
        places["state"].alias("state"),
        F.upper(text.trim_all("state_code")).alias("state_code"),
        places["country"].alias("country"),
    )
    return stamp_load(cleaned, ctx.load_ts)


def api_orders(
    bronze: DataFrame, products: DataFrame, customers: DataFrame, ctx: RunContext
) -> DataFrame:
    """Order lines of known products and customers with a positive price.

    ``products`` and ``customers`` are the silver tables. The current rules keep
    one line per (order, product), the one with the highest stated total.
    """
    typed = bronze.select(
        codes.numeric_id("id").alias("id"),
        codes.numeric_id("prd_id").alias("prd_id"),
        codes.numeric_id("cust_id").alias("cust_id"),
        F.col("unit_price").try_cast("double").alias("unit_price"),
        F.col("quantity").try_cast("bigint").alias("quantity"),
        F.col("total_price").try_cast("double").alias("total_price"),
    ).filter(F.col("unit_price") > 0)
    known = keep_members(keep_members(typed, "prd_id", products, "id"), "cust_id", customers, "id")
    if not ctx.is_v1:
        known = newest_per_key(
            known, ["id", "prd_id"], "total_price", ["cust_id", "unit_price", "quantity"]
        )
    quantity = numbers.at_least_one(F.col("quantity"))
    total = numbers.repair_total(
        F.col("total_price"), F.col("unit_price"), F.col("quantity"), rebuild_missing=not ctx.is_v1
    )
    if ctx.strict:
        total = F.col("unit_price") * quantity
    cleaned = known.select(
        "id", "prd_id", "cust_id", "unit_price", quantity.alias("quantity"), total.alias("total_price")
    )
    return stamp_load(cleaned, ctx.load_ts)
