"""Surrogate keys and source-prefixed natural ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataline.functions.text import as_column

# Fixed value: what a NULL part contributes to a hashed key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Id prefix per source label.
SOURCE_PREFIXES = {"csv": "CSV-", "api": "API-"}


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the dash-joined parts; equal parts give equal keys on any cluster."""
    texts = [F.coalesce(as_column(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def source_id(
    natural_id: Column | str,
    source: Column | str,
    prefixes: Mapping[str, str] = SOURCE_PREFIXES,
) -> Column:
    """'CSV-12' / 'API-12', so ids of united sources cannot collide."""
    label = as_column(source)
    result = F.lit("Unknown")
    for name, prefix in prefixes.items():
        prefixed = F.concat(F.lit(prefix), as_column(natural_id).cast("string"))
        result = F.when(label == name, prefixed).otherwise(result)
    return result
