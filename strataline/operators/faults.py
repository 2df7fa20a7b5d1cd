"""Seeded fault injection with ground truth.

Every draw is a hash of (record key, field, seed, purpose): the result does not
depend on row order, partitioning or retries, and a lost executor's work is
recomputed to the same values.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions.codes import ID_PREFIX
from strataline.functions.text import as_column, zero_padded

# Which fields may be damaged, and how.
FIELD_FAULTS = {
    "id": "id",
    "cust_id": "id",
    "prd_id": "id",
    "title": "string",
    "category": "string",
    "first_name": "string",
    "last_name": "string",
    "gender": "string",
    "pkey": "key",
    "total_price": "price",
}
DEFAULT_RATE = 0.4

# The feeds and the clean columns that identify a record.
RECORD_KEYS = {"product": ("id",), "user": ("id",), "order": ("id", "prd_id")}

# Cumulative weights of the text and price strategies.
TEXT_STEPS = (0.24, 0.48, 0.72, 0.96)
PRICE_STEPS = ((0.70, 1.0), (0.83, 0.5), (0.96, 1.5), (0.98, 3.0))

_DRAW_RANGE = float(1 << 32)


def draw(key: Column, *salt: object) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of an md5."""
    text = F.concat_ws("|", key, *[F.lit(str(part)) for part in salt])
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return bits / F.lit(_DRAW_RANGE)


def draw_between(key: Column, low: int, high: int, *salt: object) -> Column:
    """Uniform integer between both bounds, inclusive."""
    return (F.floor(draw(key, *salt) * (high - low + 1)) + low).cast("int")


def record_key(data_type: str) -> Column:
    """Identifier of a record, from its clean columns."""
    if data_type not in RECORD_KEYS:
        raise ValueError(f"unknown data type: {data_type!r}")
    return F.concat_ws("_", *[F.col(c).cast("string") for c in RECORD_KEYS[data_type]])


def damage_id(value: Column, key: Column, *salt: object) -> Column:
    """Prefix, zero padding, surrounding blanks, or unchanged: one in four each."""
    choice = draw_between(key, 0, 3, *salt, "strategy")
    text = value.cast("string")
    return (
        F.when(choice == 0, F.concat(F.lit(ID_PREFIX), text))
        .when(choice == 1, zero_padded(text, 4))
        .when(choice == 2, F.concat(F.lit(" "), text, F.lit(" ")))
        .otherwise(text)
    )


def damage_text(value: Column, key: Column, *salt: object) -> Column:
    """Case flips, one to four blanks on a side, and rarely NULL."""
    pick = draw(key, *salt, "strategy")
    blanks = F.repeat(F.lit(" "), draw_between(key, 1, 4, *salt, "blanks"))
    upper, lower, before, after = TEXT_STEPS
    return (
        F.when(pick < upper, F.upper(value))
        .when(pick < lower, F.lower(value))
        .when(pick < before, F.concat(blanks, value))
        .when(pick < after, F.concat(value, blanks))
    )


def damage_key(value: Column, key: Column, *salt: object) -> Column:
    """Underscores for dashes, lower case, or a two-digit suffix."""
    choice = draw_between(key, 0, 2, *salt, "strategy")
    suffix = draw_between(key, 10, 99, *salt, "suffix").cast("string")
    return (
        F.when(choice == 0, F.replace(value, F.lit("-"), F.lit("_")))
        .when(choice == 1, F.lower(value))
        .otherwise(F.concat(value, F.lit("-"), suffix))
    )


def damage_price(value: Column, key: Column, *salt: object) -> Column:
    """Mostly unchanged; sometimes halved, raised by half, tripled or lost."""
    pick = draw(key, *salt, "strategy")
    number = value.cast("double")
    result = None
    for step, factor in PRICE_STEPS:
        hit = pick < step
        scaled = number * F.lit(factor)
        result = F.when(hit, scaled) if result is None else result.when(hit, scaled)
    return result


_DAMAGE = {"id": damage_id, "string": damage_text, "key": damage_key, "price": damage_price}


def faulty(field: str, kind: str, key: Column, rate: float, seed: int) -> Column:
    """The field's value after a possible fault, in text form except for prices."""
    if kind not in _DAMAGE:
        raise ValueError(f"unknown fault kind: {kind!r}")
    clean = F.col(field).cast("double" if kind == "price" else "string")
    hit = draw(key, field, seed, "hit") < F.lit(float(rate))
    return F.when(hit, _DAMAGE[kind](clean, key, field, seed)).otherwise(clean)


def inject_faults(
    df: DataFrame,
    key: Column,
    rate: float = DEFAULT_RATE,
    seed: int = 0,
    faults: Mapping[str, str] = FIELD_FAULTS,
) -> DataFrame:
    """Damage every candidate field with probability ``rate``; one narrow projection."""
    _check_rate(rate)
    return df.select(
        *[
            faulty(c, faults[c], key, rate, seed).alias(c) if c in faults else F.col(c)
            for c in df.columns
        ]
    )


def ground_truth(
    df: DataFrame,
    data_type: str,
    run_at: dt.datetime | str,
    rate: float = DEFAULT_RATE,
    seed: int = 0,
    faults: Mapping[str, str] = FIELD_FAULTS,
) -> DataFrame:
    """One row per record and candidate field: was the value really changed?

    Works on the clean rows and repeats the same draws as :func:`inject_faults`, so
    no join between clean and damaged rows is needed.
    """
    _check_rate(rate)
    key = record_key(data_type)
    entries = []
    for field, kind in faults.items():
        if field not in df.columns:
            continue
        before = F.col(field).cast("double" if kind == "price" else "string")
        after = faulty(field, kind, key, rate, seed)
        entries.append(
            F.struct(
                F.lit(field).alias("field_name"),
                F.lit(kind).alias("corruption_type"),
                (~before.eqNullSafe(after)).alias("is_corrupted"),
            )
        )
    return (
        df.select(key.alias("record_id"), F.explode(F.array(*entries)).alias("entry"))
        .select(
            F.lit(data_type).alias("data_type"),
            "record_id",
            "entry.field_name",
            "entry.corruption_type",
            "entry.is_corrupted",
            F.lit(str(run_at)).alias("ingestion_run_at"),
        )
    )


def candidate_fields(columns: Sequence[str]) -> list[str]:
    return [field for field in FIELD_FAULTS if field in columns]


def _check_rate(rate: float) -> None:
    if not 0.0 <= rate <= 1.0:
        raise ValueError(f"rate must lie in [0, 1], got {rate}")


def same_text(left: Column | str, right: Column | str) -> Column:
    """Equality of the text forms, NULL equal to NULL."""
    return as_column(left).cast("string").eqNullSafe(as_column(right).cast("string"))
