"""Gold star: two dimensions and one fact, united from the CSV and API sources."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.functions import codes, dates, keys
from strataline.operators.conform import union_sources
from strataline.operators.history import current_versions
from strataline.operators.ranking import dense_keys
from strataline.plans.silver import RunContext
from strataline.sources.schemas import schema
from strataline.sources.snapshots import stored_once

RAW_ID = "_raw_id"

_CUSTOMER_PARTS = (
    f"{RAW_ID} string, customer_number string, first_name string, last_name string, "
    "country string, marital_status string, gender string, birthdate date, "
    "create_date date, data_source string"
)
_PRODUCT_PARTS = (
    f"{RAW_ID} string, product_number string, product_name string, category_id string, "
    "category string, subcategory string, maintenance string, cost decimal(37,9), "
    "product_line string, start_date date, data_source string"
)


def _sales_parts(key_type: str):
    return schema(
        f"order_number string, product_key {key_type}, customer_key {key_type}, "
        "order_date date, shipping_date date, due_date date, total_sales_amount double, "
        "quantity bigint, unit_price double, data_source string"
    )


@dataclass(frozen=True)
class Labels:
    """Source labels and the markers for missing product attributes.

    The defaults are the current warehouse; :data:`V1_LABELS` is the first one.
    """

    crm: str = "csv"
    erp: str = "csv"
    api: str = "api"
    missing_category: str = "N/A"
    missing_subcategory: str | None = "N/A"

    @property
    def prefixes(self) -> dict[str, str]:
        return {self.crm: "CSV-", self.erp: "CSV-", self.api: "API-"}


CURRENT_LABELS = Labels()
V1_LABELS = Labels(
    crm="crm-csv",
    erp="erp-csv",
    api="dummyjson-api",
    missing_category="n/a",
    missing_subcategory=None,
)


def labels_for(ctx: RunContext) -> Labels:
    return V1_LABELS if ctx.is_v1 else CURRENT_LABELS


def customer_parts(
    crm: DataFrame, demographics: DataFrame, locations: DataFrame, api: DataFrame, labels: Labels
) -> DataFrame:
    born = demographics.select(F.col("cid").alias("_born_key"), "bdate", "gen")
    lives = locations.select(F.col("cid").alias("_lives_key"), "cntry")
    csv_part = (
        crm.join(born, F.col("cst_key") == F.col("_born_key"), "left")
        .join(lives, F.col("cst_key") == F.col("_lives_key"), "left")
        .select(
            F.col("cst_id").alias(RAW_ID),
            F.col("cst_key").alias("customer_number"),
            F.col("cst_firstname").alias("first_name"),
            F.col("cst_lastname").alias("last_name"),
            F.col("cntry").alias("country"),
            F.col("cst_marital_status").alias("marital_status"),
            codes.prefer("cst_gndr", "gen").alias("gender"),
            F.col("bdate").alias("birthdate"),
            F.col("cst_create_date").alias("create_date"),
            F.lit(labels.crm).alias("data_source"),
        )
    )
    api_part = api.select(
        F.col("id").alias(RAW_ID),
        F.lit(codes.MISSING).alias("customer_number"),
        "first_name",
        "last_name",
        "country",
        F.lit(codes.MISSING).alias("marital_status"),
        "gender",
        "birthdate",
        F.to_date("dwh_create_date").alias("create_date"),
        F.lit(labels.api).alias("data_source"),
    )
    return union_sources([csv_part, api_part], schema(_CUSTOMER_PARTS))


def product_parts(
    crm: DataFrame, categories: DataFrame, api: DataFrame, labels: Labels
) -> DataFrame:
    category = categories.select(
        F.col("id").alias("_cat_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        "maintenance",
    )
    csv_part = (
        current_versions(crm, "prd_end_dt")
        .join(category, F.col("cat_id") == F.col("_cat_id"), "left")
        .select(
            F.col("prd_id").alias(RAW_ID),
            F.col("prd_key").alias("product_number"),
            F.col("prd_nm").alias("product_name"),
            F.col("cat_id").alias("category_id"),
            "category",
            "subcategory",
            "maintenance",
            F.col("prd_cost").alias("cost"),
            F.col("prd_line").alias("product_line"),
            F.col("prd_start_dt").alias("start_date"),
            F.lit(labels.erp).alias("data_source"),
        )
    )
    api_part = api.select(
        F.col("id").alias(RAW_ID),
        F.col("pkey").alias("product_number"),
        F.col("title").alias("product_name"),
        F.left("pkey", F.lit(3)).alias("category_id"),
        "category",
        dates.iso_instant_day("createdAt").alias("start_date"),
        F.lit(labels.api).alias("data_source"),
    )
    parts = union_sources([csv_part, api_part], schema(_PRODUCT_PARTS))
    filled = {
        "category": F.coalesce("category", F.lit(labels.missing_category)),
        "maintenance": F.coalesce("maintenance", F.lit(codes.MISSING)),
        "cost": F.coalesce("cost", F.lit(0).cast("decimal(37,9)")),
        "product_line": F.coalesce("product_line", F.lit("Other Sales")),
    }
    if labels.missing_subcategory is not None:
        filled["subcategory"] = F.coalesce("subcategory", F.lit(labels.missing_subcategory))
    return parts.withColumns(filled)


def _keyed(parts: DataFrame, key: str, natural_id: str, labels: Labels, dense: bool) -> DataFrame:
    """Add the surrogate key and the prefixed id, keeping the raw id for fact joins."""
    if dense:
        order = [F.col(RAW_ID).cast("bigint"), F.col("data_source")]
        keyed = dense_keys(stored_once(parts, key), order, key)
    else:
        keyed = parts.withColumn(key, keys.surrogate_key(RAW_ID, "data_source"))
    prefixed = keys.source_id(RAW_ID, "data_source", labels.prefixes)
    rest = [c for c in parts.columns if c != RAW_ID]
    return keyed.select(key, prefixed.alias(natural_id), *rest, RAW_ID)


def customer_dimension(
    crm: DataFrame,
    demographics: DataFrame,
    locations: DataFrame,
    api: DataFrame,
    labels: Labels = CURRENT_LABELS,
    dense: bool = False,
) -> DataFrame:
    parts = customer_parts(crm, demographics, locations, api, labels)
    return _keyed(parts, "customer_key", "customer_id", labels, dense)


def product_dimension(
    crm: DataFrame,
    categories: DataFrame,
    api: DataFrame,
    labels: Labels = CURRENT_LABELS,
    dense: bool = False,
) -> DataFrame:
    parts = product_parts(crm, categories, api, labels)
    return _keyed(parts, "product_key", "product_id", labels, dense)


def published(dimension: DataFrame) -> DataFrame:
    """The dimension as its readers see it, without the raw id."""
    return dimension.drop(RAW_ID)


def sales_fact(
    crm_sales: DataFrame,
    api_orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    ctx: RunContext,
    labels: Labels = CURRENT_LABELS,
    dense: bool = False,
    product_columns: Sequence[str] | DataFrame = (),
    customer_columns: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """Order lines with the keys of both dimensions.

    Customers and API products are found by the raw id the dimensions carry, so the
    join keys are plain columns instead of text surgery on the prefixed ids. A CRM
    line finds its product by number in whatever source offers it.

    Lines travel with the short raw ids; the hashed keys, which do not compress, are made of
    them at the end. With ``product_columns`` and ``customer_columns`` the lines also carry
    those columns, as if the fact were joined with the dimensions by their keys: the dimensions
    are joined with themselves, and the lines are shuffled no further. A table with one row per
    key may be given instead of names: its columns are added, and no line repeats or is lost.
    """

    def found(dimension: DataFrame, key: str, shown: str, name: str, columns: Sequence[str] | DataFrame) -> DataFrame:
        made_of = [] if dense else [F.col(RAW_ID).alias(f"_{key}_id"), F.col("data_source").alias(f"_{key}_source")]
        joined = dimension.select(F.col(shown).alias(name), key, *made_of)
        if isinstance(columns, DataFrame):
            joined = joined.join(columns, key, "left")
        elif columns:
            joined = joined.join(dimension.select(key, *columns), key)
        return joined if dense else joined.drop(key)

    def added(dimension: DataFrame, key: str, columns: Sequence[str] | DataFrame) -> list[T.StructField]:
        if isinstance(columns, DataFrame):
            return [f for f in columns.schema.fields if f.name != key]
        return [dimension.schema[c] for c in columns]

    def key_of(key: str) -> Column:
        return F.col(key) if dense else keys.surrogate_key(f"_{key}_id", f"_{key}_source").alias(key)

    def buyers(source: str) -> DataFrame:
        return found(customers.filter(F.col("data_source") == source), "customer_key", RAW_ID, "_buyer", customer_columns)

    by_number = found(products, "product_key", "product_number", "_number", product_columns)
    api_goods = found(products.filter(F.col("data_source") == labels.api), "product_key", RAW_ID, "_goods", product_columns)
    extra = [*added(products, "product_key", product_columns), *added(customers, "customer_key", customer_columns)]
    attached = [f.name for f in extra]
    csv_part = (
        crm_sales.join(by_number, F.col("sls_prd_key") == F.col("_number"))
        .join(buyers(labels.crm), F.col("sls_cust_id").cast("string") == F.col("_buyer"))
        .select(
            F.replace("sls_ord_num", F.lit("SO"), F.lit("")).alias("order_number"),
            key_of("product_key"),
            key_of("customer_key"),
            F.col("sls_order_dt").alias("order_date"),
            F.col("sls_ship_dt").alias("shipping_date"),
            F.col("sls_due_dt").alias("due_date"),
            F.col("sls_sales").alias("total_sales_amount"),
            F.col("sls_quantity").alias("quantity"),
            F.col("sls_price").alias("unit_price"),
            F.lit(labels.crm).alias("data_source"),
            *attached,
        )
    )
    api_part = (
        api_orders.join(api_goods, F.col("prd_id").cast("string") == F.col("_goods"))
        .join(buyers(labels.api), F.col("cust_id").cast("string") == F.col("_buyer"))
        .select(
            F.col("id").alias("order_number"),
            key_of("product_key"),
            key_of("customer_key"),
            F.to_date("dwh_create_date").alias("order_date"),
            F.col("total_price").alias("total_sales_amount"),
            "quantity",
            "unit_price",
            F.lit(labels.api).alias("data_source"),
            *attached,
        )
    )
    shape = _sales_parts("bigint" if dense else "string")
    parts = union_sources([csv_part, api_part], T.StructType([*shape.fields, *extra]))
    if dense:
        ties = [c for c in parts.columns if c != "data_source"]
        order = [F.col("order_number").try_cast("bigint"), F.col("data_source")]
        keyed = dense_keys(stored_once(parts, "sales_parts"), [*order, *ties], "order_key")
    else:
        keyed = parts.withColumn(
            "order_key", keys.surrogate_key("order_number", "product_key", "data_source")
        )
    return keyed.select(
        "order_key",
        keys.source_id("order_number", "data_source", labels.prefixes).alias("order_number"),
        "product_key",
        "customer_key",
        *[
            dates.strictly_between_horizons(c, ctx.as_of, ctx.load_ts if ctx.is_v1 else None).alias(c)
            for c in ("order_date", "shipping_date", "due_date")
        ],
        "total_sales_amount",
        "quantity",
        "unit_price",
        "data_source",
        *attached,
    )
