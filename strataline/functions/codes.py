"""Code-to-label mapping, prefixes, defaults and composite keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataline.functions.text import as_column, remove_text, trim_all

# Code lists of the retail feeds.
MISSING = "n/a"
MARITAL_CODES = {"S": "Single", "M": "Married"}
GENDER_CODES = {"F": "Female", "M": "Male"}
GENDER_WORDS = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"}
LINE_CODES = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
YES_NO_CODES = {"YES": "Yes", "Y": "Yes", "NO": "No", "N": "No"}
COUNTRY_CODES = {
    "US": "United States",
    "USA": "United States",
    "DE": "Germany",
    "AU": "Australia",
    "AUS": "Australia",
    "CA": "Canada",
    "CAN": "Canada",
    "FR": "France",
    "UK": "United Kingdom",
}
ID_PREFIX = "dummy-"
SKU_LENGTH = 15


def map_codes(
    value: Column | str,
    mapping: Mapping[str, str],
    default: Column | str = MISSING,
    trim: bool = True,
) -> Column:
    """Translate codes without regard to case; ``default`` covers unknown and NULL.

    A string ``default`` is a label; a Column keeps, say, the original text.
    """
    code = F.upper(trim_all(value) if trim else as_column(value))
    labels: dict[str, list[str]] = {}
    for key, label in mapping.items():
        labels.setdefault(label, []).append(key)
    fallback = F.lit(default) if isinstance(default, str) else default
    result = None
    for label, keys in labels.items():
        hit = code.isin(*keys)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return fallback if result is None else result.otherwise(fallback)


def map_codes_or_keep(value: Column | str, mapping: Mapping[str, str]) -> Column:
    """Translate known codes, mark blank as missing, keep any other text trimmed."""
    cleaned = trim_all(remove_text(value, "\r"))
    kept = F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(MISSING))
    return map_codes(cleaned, mapping, default=kept)


def map_codes_or_keep_v1(value: Column | str, mapping: Mapping[str, str], trim: bool) -> Column:
    """First-generation form: blanks are cut off to compare, line ends are not; other text is
    kept as it is, or without outer blanks."""
    shown = F.trim(as_column(value))
    kept = shown if trim else as_column(value)
    kept = F.when(F.coalesce(shown, F.lit("")) == "", MISSING).otherwise(kept)
    return map_codes(shown, mapping, default=kept, trim=False)


def numeric_id(value: Column | str, prefix: str = ID_PREFIX) -> Column:
    """'dummy-7', '0007', ' 7 ' and '7' all become 7; other text is an error."""
    return trim_all(remove_text(value, prefix)).cast("bigint")


def drop_prefix(value: Column | str, prefix: str) -> Column:
    """Remove ``prefix`` at the start only."""
    text = as_column(value)
    return F.when(text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)


def category_of_key(key: Column | str) -> Column:
    """'CO-RF-FR-R92B-58' -> 'CO_RF'."""
    return F.replace(F.substring(as_column(key), 1, 5), F.lit("-"), F.lit("_"))


def number_of_key(key: Column | str) -> Column:
    """'CO-RF-FR-R92B-58' -> 'FR-R92B-58'."""
    return F.substr(as_column(key), F.lit(7))


def normalise_sku(sku: Column | str) -> Column:
    """Upper case, dashes for underscores, over-long *raw* keys cut to 15 characters."""
    raw = as_column(sku)
    shaped = F.upper(F.replace(trim_all(raw), F.lit("_"), F.lit("-")))
    return F.when(F.length(raw) > SKU_LENGTH, F.left(shaped, F.lit(SKU_LENGTH))).otherwise(shaped)


def prefer(first: Column | str, second: Column | str, missing: str = MISSING) -> Column:
    """``first`` unless it is missing, else ``second``, else the missing marker."""
    chosen = F.when(as_column(first) != missing, as_column(first))
    return F.coalesce(chosen, as_column(second), F.lit(missing))
