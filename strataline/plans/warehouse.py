"""Bronze to gold in one go, lazily or materialised layer by layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strataline.plans import gold, silver
from strataline.plans.silver import RunContext
from strataline.sources import files, schemas, tables

# Silver model per bronze table, for the models that need no other silver table.
SILVER_MODELS = {
    "stg_crm__cust_info": ("crm_cust_info", silver.crm_customers),
    "stg_crm__prd_info": ("crm_prd_info", silver.crm_products),
    "stg_crm__sales_details": ("crm_sales_details", silver.crm_sales),
    "stg_erp__cust_az12": ("erp_cust_az12", silver.erp_customers),
    "stg_erp__loc_a101": ("erp_loc_a101", silver.erp_locations),
    "stg_erp__px_cat_g1v2": ("erp_px_cat_g1v2", silver.erp_categories),
    "stg_djapi__product": ("djapi_product", silver.api_products),
    "stg_djapi__customer": ("djapi_customer", silver.api_customers),
}
API_ORDERS = "stg_djapi__order"

# Writes a table under a name and returns it as stored.
Store = Callable[[DataFrame, str], DataFrame]


def _planned(df: DataFrame, name: str) -> DataFrame:
    """Store nothing: the plan itself is handed on."""
    return df


def load_bronze_files(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The CSV sources under ``root`` as all-string bronze tables."""
    return {
        name: files.scan_csv_text(spark, f"{root}/{path}", schemas.BRONZE_COLUMNS[name])
        for name, path in schemas.BRONZE_FILES.items()
    }


class Stage(Mapping[str, DataFrame]):
    """Silver tables by name, each planned (and stored, if so wished) when first asked for."""

    def __init__(
        self,
        bronze: Mapping[str, DataFrame],
        ctx: RunContext,
        store: Store | None = None,
    ) -> None:
        self._bronze, self._ctx = bronze, ctx
        self._store = store or _planned
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._store(self._build(name), name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name == API_ORDERS:
            return silver.api_orders(
                self._bronze["djapi_order"],
                self["stg_djapi__product"],
                self["stg_djapi__customer"],
                self._ctx,
            )
        source, model = SILVER_MODELS[name]
        return model(self._bronze[source], self._ctx)

    def __iter__(self):
        return iter([*SILVER_MODELS, API_ORDERS])

    def __len__(self) -> int:
        return len(SILVER_MODELS) + 1


class Star:
    """Gold tables over silver, each planned when first asked for.

    ``customers``, ``products`` and ``sales`` are what readers see; the keyed
    dimensions also carry the raw id the fact joins on.

    ``store`` writes a keyed dimension and hands back the stored table. A stored
    table has a known size: the planner then broadcasts it to the fact when it is
    under the session's threshold, and only shuffles the fact when it is not. Planned
    from joins, a dimension's size is a product of estimates, and the fact would be
    shuffled in either case. With ``store_late`` dimensions are stored only once the
    fact asks for them; readers that come later share the stored ones.
    """

    def __init__(
        self,
        stage: Mapping[str, DataFrame],
        ctx: RunContext,
        dense: bool = False,
        store: Store | None = None,
        store_late: Store | None = None,
    ) -> None:
        self._stage, self._ctx, self._dense = stage, ctx, dense
        self._labels = gold.labels_for(ctx)
        self._store = store or _planned
        self._store_late = store_late or _planned
        self._stored_late = False

    @cached_property
    def keyed_customers(self) -> DataFrame:
        dimension = gold.customer_dimension(
            self._stage["stg_crm__cust_info"],
            self._stage["stg_erp__cust_az12"],
            self._stage["stg_erp__loc_a101"],
            self._stage["stg_djapi__customer"],
            self._labels,
            self._dense,
        )
        return self._store(dimension, "dim_customers_keyed")

    @cached_property
    def keyed_products(self) -> DataFrame:
        dimension = gold.product_dimension(
            self._stage["stg_crm__prd_info"],
            self._stage["stg_erp__px_cat_g1v2"],
            self._stage["stg_djapi__product"],
            self._labels,
            self._dense,
        )
        return self._store(dimension, "dim_products_keyed")

    @cached_property
    def customers(self) -> DataFrame:
        return gold.published(self.keyed_customers)

    @cached_property
    def products(self) -> DataFrame:
        return gold.published(self.keyed_products)

    @cached_property
    def sales(self) -> DataFrame:
        return self.sales_with()

    def store_dimensions(self) -> Star:
        """Store the dimensions that the fact would store, for readers that come before it."""
        if not self._stored_late:
            self.keyed_customers = self._store_late(self.keyed_customers, "dim_customers_keyed")
            self.keyed_products = self._store_late(self.keyed_products, "dim_products_keyed")
            self._stored_late = True
        return self

    def sales_with(
        self, product_columns: Sequence[str] | DataFrame = (), customer_columns: Sequence[str] | DataFrame = ()
    ) -> DataFrame:
        """The fact joined with columns of its dimensions, or with tables of one row per key, at no
        shuffle of the fact more."""
        self.store_dimensions()
        return gold.sales_fact(
            self._stage["stg_crm__sales_details"],
            self._stage[API_ORDERS],
            self.keyed_customers,
            self.keyed_products,
            self._ctx,
            self._labels,
            self._dense,
            product_columns,
            customer_columns,
        )


def refresh(
    bronze: Mapping[str, DataFrame],
    ctx: RunContext,
    dense: bool = False,
    store: Store = tables.materialise,
) -> Star:
    """Rebuild silver and gold, storing every model before the next one reads it.

    ``store`` writes a model and returns the stored table; by default a table in the
    model's layer.
    """
    if store is tables.materialise:
        spark = next(iter(bronze.values())).sparkSession
        tables.create_schemas(spark, ("silver", "gold"))
    stage = Stage(bronze, ctx, store)
    for name in stage:
        stage[name]
    star = Star(stage, ctx, dense, store)
    store(star.customers, "dim_customers")
    store(star.products, "dim_products")
    star.sales = store(star.sales, "fact_sales")
    return star


def stored_star(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers, products and sales as the last refresh left them."""
    names = ("dim_customers", "dim_products", "fact_sales")
    return tuple(spark.table(tables.qualified(name)) for name in names)


def publish_views(star: Star, prefix: str = "gold_") -> None:
    """First-generation gold: views over the plan instead of stored tables."""
    tables.publish_view(star.customers, f"{prefix}dim_customers")
    tables.publish_view(star.products, f"{prefix}dim_products")
    tables.publish_view(star.sales, f"{prefix}fact_sales")
