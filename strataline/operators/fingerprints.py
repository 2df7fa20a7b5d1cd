"""Searching for repeated keys by 8-byte fingerprints first.

Of a table whose keys are nearly all unique, grouping by the keys themselves ships every key in
full. Here only fingerprints are shipped; those seen twice are marked in a bit filter of fixed
size, and rows that the filter lets pass are grouped by their true keys. The filter never stops a
repeated key, so the result is exact; the fewer repeated keys there are, the less is shipped in
the second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Size of a filter in bits, a power of two: 128 KB in every plan, whatever the size of the table.
FILTER_BITS = 1 << 20
_WORD = 64

#: Types whose values take at most so many bytes; all others vary.
_FIXED_BYTES: dict[type[T.DataType], int] = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def is_narrow(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key is at most twice as wide as its fingerprint: a second scan costs more than
    the few bytes a row that one would save."""
    width = sum(_FIXED_BYTES.get(type(df.schema[k].dataType), 99) for k in keys)
    return width <= 16


def _slots(fingerprint: Column, bits: int) -> list[Column]:
    """Two places in the filter, from separate bits of a fingerprint."""
    mask = F.lit(bits - 1)
    return [fingerprint.bitwiseAND(mask), F.shiftrightunsigned(fingerprint, 32).bitwiseAND(mask)]


def filter_of(df: DataFrame, fingerprint: str, bits: int | None = None) -> Column:
    """The bit filter of a column of fingerprints, as a scalar subquery: an array of 64-bit words.

    Words are combined in each task and then by word, so what is gathered is one array of fixed
    length.
    """
    bits = bits or FILTER_BITS
    slots = df.select(F.explode(F.array(*_slots(F.col(fingerprint), bits))).alias("slot"))
    word = F.shiftright("slot", 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = slots.groupBy(word).agg(F.bit_or(bit).alias("bits"))
    every = df.sparkSession.range(0, bits // _WORD, 1, 1)
    dense = every.join(words, every.id == words.word, "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("id", "bits")))
    return dense.agg(F.transform(ordered, lambda w: w["bits"])).scalar()


def may_hold(words: Column, fingerprint: Column, bits: int | None = None) -> Column:
    """False only if the filter, made of as many bits, was made without this fingerprint."""
    tests = [
        F.getbit(F.get(words, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1
        for slot in _slots(fingerprint, bits or FILTER_BITS)
    ]
    return tests[0] & tests[1]


def seen_twice(df: DataFrame, fingerprints: Sequence[Column]) -> Column:
    """A filter of the fingerprints that occur more than once; null ones do not count."""
    one = F.explode(F.array_compact(F.array(*fingerprints))).alias("fingerprint")
    repeated = df.select(one).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return filter_of(repeated, "fingerprint")


def repeated_keys(df: DataFrame, keys: Sequence[Column | str], name: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their count; NULL counts as a key."""
    keyed = df.select(*keys)
    columns = keyed.columns
    counted = lambda rows: rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)
    if is_narrow(keyed, columns):
        return counted(keyed)
    fingerprint = F.xxhash64(*columns)
    return counted(keyed.filter(may_hold(seen_twice(keyed, [fingerprint]), fingerprint)))
