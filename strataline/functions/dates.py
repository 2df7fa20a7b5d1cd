"""Date parsing, validity horizons and calendar buckets.

No function reads the clock: the horizon always arrives as ``as_of``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataline.functions.text import as_column

AsOf = dt.date | str | Column

# Fixed value: the oldest accepted calendar day.
OLDEST_DAY = "1900-01-01"

# Reporting age bands, as (label, youngest, oldest); all other ages
# share the catch-all label.
AGE_BANDS = (
    ("18-24", 18, 24),
    ("25-34", 25, 34),
    ("35-44", 35, 44),
    ("45-54", 45, 54),
    ("55-64", 55, 64),
)
OLDEST_AGE_BAND = "65+"

ISO_DAY = r"^\d{1,4}-\d{1,2}-\d{1,2}$"


def day(value: AsOf) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def iso_day(value: Column | str) -> Column:
    """'yyyy-mm-dd' text to a date; anything else, even a bare year, is NULL."""
    text = as_column(value).cast("string")
    return F.when(text.rlike(ISO_DAY), text.try_cast("date"))


def iso_instant_day(value: Column | str) -> Column:
    """ISO-8601 instant text to its UTC calendar day."""
    instant = F.try_to_timestamp(as_column(value))
    return F.to_date(F.to_utc_timestamp(instant, F.current_timezone()))


def compact_day(value: Column | str) -> Column:
    """yyyymmdd text or number to a date, NULL when it is no calendar day.

    The eight digits are re-punctuated and cast with Spark's ISO date cast. A sign or
    leading zeros do not change the number, so they are cut off first.
    """
    written = as_column(value).cast("string")
    number = written.try_cast("int")
    digits = F.ltrim(F.trim(written), F.lit("+0"))
    iso = F.concat(
        F.substring(digits, 1, 4),
        F.lit("-"),
        F.substring(digits, 5, 2),
        F.lit("-"),
        F.substring(digits, 7, 2),
    )
    return F.when(number.between(10_000_000, 99_999_999), iso.try_cast("date"))


def to_compact(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyyMMdd")


def within_horizon(value: Column | str, as_of: AsOf, include_as_of: bool = True) -> Column:
    """Keep days from 1900 on and not past the horizon."""
    moment = as_column(value)
    in_time = moment <= day(as_of) if include_as_of else moment < day(as_of)
    return F.when((moment >= day(OLDEST_DAY)) & in_time, moment)


def plausible_birthdate(value: Column | str, as_of: AsOf, adult_years: int = 18) -> Column:
    """Keep birthdays from 1900 on of people at least ``adult_years`` old."""
    born = as_column(value)
    return F.when(born.between(day(OLDEST_DAY), F.add_months(day(as_of), -12 * adult_years)), born)


def strictly_between_horizons(
    value: Column | str, as_of: AsOf, now: dt.datetime | str | None = None
) -> Column:
    """Keep days strictly after 1900-01-01 and strictly before the horizon.

    With ``now`` the day's midnight must lie before that moment, so the day itself is kept.
    """
    moment = as_column(value)
    end = day(as_of) if now is None else F.lit(str(now)).cast("timestamp")
    return F.when((moment > day(OLDEST_DAY)) & (moment < end), moment.cast("date"))


def _day_number(value: Column) -> Column:
    return F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)


def age_in_years(born: Column | str, as_of: AsOf) -> Column:
    """Completed years of life on ``as_of`` (Feb-29 birthdays wait for Mar-1).

    Written as yyyymmdd, two days are whole years apart by the difference's leading
    digits.
    """
    difference = _day_number(day(as_of)) - _day_number(as_column(born))
    return F.floor(difference / 10000).cast("int")


def age_band(age: Column | str) -> Column:
    years = as_column(age)
    label = F.lit(OLDEST_AGE_BAND)
    for name, youngest, oldest in reversed(AGE_BANDS):
        label = F.when(years.between(youngest, oldest), name).otherwise(label)
    return label


def age_band_order(band: Column | str) -> Column:
    """Position of a band on the report, youngest first."""
    labels = F.array(*[F.lit(name) for name, _, _ in AGE_BANDS])
    position = F.array_position(labels, as_column(band))
    return F.when(position > 0, position).otherwise(F.lit(len(AGE_BANDS) + 1).cast("bigint"))


def season_number(value: Column | str) -> Column:
    """1 Winter (Dec-Feb), 2 Spring, 3 Summer, 4 Autumn."""
    return F.floor((F.month(as_column(value)) % 12 + 3) / 3).cast("int")


def month_label(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM")


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start))
