"""Repair ladders for amounts, quantities and prices.

The ladders are ordered: the first branch whose condition is *true* wins, and a
condition over NULL is not true. Amounts keep nine decimals and up to 28 digits
before them; quantities are any 64-bit number. A product that does not fit is NULL
and named by :func:`does_not_fit`; it never stops the job, and a total is not kept
in its place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataline.functions.text import as_column

AMOUNT = "decimal(37,9)"
COUNT = "decimal(19,0)"


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives NULL for a zero divisor."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def percentage(part: Column | str, whole: Column | str) -> Column:
    """Share in percent as DECIMAL(5,2)."""
    exact = as_column(part).cast("decimal(20,0)") * F.lit(100)
    return F.try_divide(exact, F.nullif(as_column(whole), F.lit(0)).cast("decimal(20,0)")).cast(
        "decimal(5,2)"
    )


def product(price: Column, quantity: Column) -> Column:
    """Price x quantity with all nine decimals; NULL where it has more than 28 digits before them.

    Whole units and decimals of the price are multiplied apart: one decimal product of this
    width would be rounded to six decimals.
    """
    price, quantity = price.try_cast(AMOUNT), quantity.try_cast(COUNT)
    decimals = price % F.lit(1).cast("decimal(1,0)")
    units = F.try_multiply((price - decimals).cast("decimal(28,0)"), quantity).try_cast(AMOUNT)
    return F.try_add(units, decimals * quantity).try_cast(AMOUNT)


def expected_sales(price: Column, quantity: Column) -> Column:
    """The total that price and quantity imply; a projection of its own keeps it one product."""
    return product(price, quantity)


def does_not_fit(price: Column, quantity: Column, expected: Column | None = None) -> Column:
    """Whether price x quantity is known but too large for an amount."""
    expected = expected_sales(price, quantity) if expected is None else expected
    return price.isNotNull() & quantity.isNotNull() & expected.isNull()


def repair_sales(
    sales: Column, quantity: Column, price: Column, expected: Column | None = None
) -> Column:
    """CRM line total, recomputed when missing or inconsistent; NULL where the product does not fit.

    ``expected`` may name a column that already holds :func:`expected_sales`.
    """
    total = expected_sales(price, quantity) if expected is None else expected
    differs = sales != total
    return (
        F.when(does_not_fit(price, quantity, total), F.lit(None))
        .when(sales.isNull() & total.isNotNull(), F.abs(total))
        .when(differs & (quantity == 0), F.abs(price))
        .when(differs, F.abs(total))
        .otherwise(sales)
        .try_cast(AMOUNT)
    )


def repair_sales_when_not_positive(sales: Column, quantity: Column, price: Column) -> Column:
    """First-generation rule: only missing, zero or negative totals are rebuilt."""
    rebuilt = product(F.abs(price), F.coalesce(quantity, F.lit(1)))
    return F.when((sales > 0) | price.isNull(), sales).otherwise(rebuilt).try_cast(AMOUNT)


def repair_quantity(quantity: Column) -> Column:
    """CRM quantity: missing becomes 1, negative becomes positive, zero stays."""
    return F.abs(F.coalesce(quantity, F.lit(1)))


def repair_price(price: Column, sales: Column, quantity: Column, keep_sign: bool = False) -> Column:
    """CRM unit price, derived from the stated total when missing or zero.

    ``keep_sign`` is the first-generation rule: the derived quotient keeps its sign.
    """
    count = quantity.try_cast(COUNT)
    divisor = count if keep_sign else F.abs(count)
    derivable = (price.isNull() | (price == 0)) & (F.abs(count) > 0) & sales.isNotNull()
    return (
        F.when(derivable, F.try_divide(sales, divisor).try_cast(AMOUNT))
        .otherwise(F.abs(price))
        .try_cast(AMOUNT)
    )


def consistent_line(sales: Column, quantity: Column, price: Column) -> Column:
    """The strict repair: a struct of sales, quantity and price in which sales = price x quantity.

    The ladders above repair each column by itself, from the stated values, so a line may end
    with a total that its price and quantity do not give, or with a negative one. Here quantity
    comes first (missing or zero is 1, negative turns positive), then price (without its sign; a
    missing or zero one is the total spread over the quantity, to nine decimals), and the total
    is their product. Without a price and a total both are NULL; a product that does not fit is
    NULL too.
    """
    count = at_least_one(quantity)
    stated = F.nullif(F.abs(price), F.lit(0).cast(AMOUNT))
    derived = F.try_divide(F.abs(sales), count.cast(COUNT)).try_cast(AMOUNT)
    unit = F.coalesce(stated, derived, F.abs(price)).try_cast(AMOUNT)
    return F.struct(product(unit, count).alias("sales"), count.alias("quantity"), unit.alias("price"))


def at_least_one(quantity: Column) -> Column:
    """API quantity: missing or zero becomes 1, negative becomes positive."""
    return F.coalesce(F.nullif(F.abs(quantity), F.lit(0)), F.lit(1)).cast("bigint")


def repair_total(
    total: Column, unit_price: Column, quantity: Column, rebuild_missing: bool = True
) -> Column:
    """API line total in floating point.

    ``rebuild_missing=False`` is the first-generation rule, which leaves a missing
    total alone.
    """
    product = unit_price * quantity
    stands = product.isNull() | (total == product)
    rebuilt = F.when(quantity == 0, F.abs(unit_price)).otherwise(F.abs(product))
    missing = F.abs(product) if rebuild_missing else F.lit(None)
    return F.when(total.isNull(), missing).when(stands, total).otherwise(rebuilt)
