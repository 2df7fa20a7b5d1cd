"""Seasonal shipping dates drawn per order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions import dates
from strataline.operators.faults import draw, draw_between


@dataclass(frozen=True)
class Season:
    name: str
    shortest: int
    longest: int
    extra_divisor: int

    @property
    def longest_extra(self) -> int:
        return self.longest // self.extra_divisor


# Transport time in days per season, and the outlier behaviour.
SEASONS = {
    1: Season("Winter", 14, 30, 4),
    2: Season("Spring", 7, 14, 2),
    3: Season("Summer", 5, 11, 2),
    4: Season("Autumn", 10, 21, 3),
}
OUTLIER_MONTHS = (1, 4, 7, 10)
OUTLIER_SHARE = 0.05
SAME_DAY_SHARE = 0.70


def check_seasons(seasons: dict[int, Season]) -> None:
    if sorted(seasons) != [1, 2, 3, 4]:
        raise ValueError(f"need seasons 1 to 4, got {sorted(seasons)}")
    for season in seasons.values():
        if not 0 < season.shortest <= season.longest or season.longest_extra < 1:
            raise ValueError(f"bad day range for {season.name}")


def shipping_delay(
    order_day: Column, key: Column, seed: int = 0, seasons: dict[int, Season] = SEASONS
) -> Column:
    """Days from order to shipment.

    A seasonal range; in quarter-opening months one order in twenty is an outlier,
    shipped the same day (70 %) or later than the season's range (30 %).
    """
    check_seasons(seasons)
    number = dates.season_number(order_day)
    usual = extra = None
    for value, season in seasons.items():
        hit = number == value
        days = draw_between(key, season.shortest, season.longest, seed, "days")
        more = draw_between(key, 1, season.longest_extra, seed, "extra")
        usual = F.when(hit, days) if usual is None else usual.when(hit, days)
        extra = F.when(hit, more) if extra is None else extra.when(hit, more)
    outlier = F.month(order_day).isin(*OUTLIER_MONTHS) & (
        draw(key, seed, "outlier") < OUTLIER_SHARE
    )
    same_day = draw(key, seed, "same-day") < SAME_DAY_SHARE
    return (
        F.when(outlier & same_day, F.lit(0)).when(outlier, usual + extra).otherwise(usual)
    )


def order_shipments(
    df: DataFrame, order: str, order_day: str, seed: int = 0, seasons: dict[int, Season] = SEASONS
) -> DataFrame:
    """One simulated shipping day per order number with a valid order date.

    An order whose lines disagree on the date ships from its earliest one.
    """
    lines = df.select(F.col(order), dates.compact_day(order_day).alias("_day")).na.drop()
    orders = lines.groupBy(order).agg(F.min("_day").alias("order_day"))
    delay = shipping_delay(F.col("order_day"), F.col(order).cast("string"), seed, seasons)
    return orders.withColumn("ship_day", F.date_add("order_day", delay))


def override_ship_dates(
    df: DataFrame,
    order: str,
    order_day: str,
    ship_day: str,
    seed: int = 0,
    seasons: dict[int, Season] = SEASONS,
) -> DataFrame:
    """Write simulated shipping days (yyyymmdd text) over the stated ones.

    Draws depend on the order number alone, so they can be made per line once the
    order's day is known; only (order, earliest day) pairs are joined back. Orders
    without a valid date keep what they had.
    """
    shipments = order_shipments(df, order, order_day, seed, seasons).select(
        F.col(order).alias("_order"), dates.to_compact("ship_day").alias("_ship")
    )
    joined = df.join(shipments, F.col(order) == F.col("_order"), "left")
    return joined.withColumn(ship_day, F.coalesce("_ship", ship_day)).select(*df.columns)
