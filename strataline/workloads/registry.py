"""Registration of queries with their oracle, and access to their inputs."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.plans import warehouse
from strataline.plans.silver import RunContext
from strataline.session import apply_adaptive_settings
from strataline.sources.snapshots import stored_once
from strataline.workloads import feeds
from strataline.workloads.oracle_stages import GOLD, SILVER

Build = Callable[["Inputs"], DataFrame]

CTX = RunContext(as_of=feeds.AS_OF, load_ts=feeds.LOAD_TS)
V1_CTX = RunContext(as_of=feeds.AS_OF, load_ts=feeds.LOAD_TS, generation="v1")


class Feeds(Mapping[str, DataFrame]):
    """Feeds by name, each analysed when first asked for."""

    def __init__(self, inputs: "Inputs", selects: Mapping[str, str]) -> None:
        self._inputs, self._selects = inputs, selects
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._inputs.feed(self._selects[name])
        return self._built[name]

    def __iter__(self):
        return iter(self._selects)

    def __len__(self) -> int:
        return len(self._selects)


class Inputs:
    """Benchmark tables and the feeds derived from them, all lazy and all whole."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(feeds.TABLES[name])
            self._tables[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in feeds.TABLES:
            raise AttributeError(name)
        return self.table(name)

    def feed(self, select: str) -> DataFrame:
        """Run a SELECT over benchmark tables written as ``{name}``."""
        sources = {name: self.table(name) for name in feeds.table_names(select)}
        return self.spark.sql(select, **sources)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Write a model to shared storage and read it back, as a refresh would."""
        return stored_once(df, name)

    @cached_property
    def bronze(self) -> Mapping[str, DataFrame]:
        """Dirty all-string feeds."""
        return Feeds(self, feeds.BRONZE)

    @cached_property
    def silver(self) -> Mapping[str, DataFrame]:
        """Silver built from the dirty feeds."""
        return warehouse.Stage(self.bronze, CTX)

    @cached_property
    def clean_silver(self) -> Mapping[str, DataFrame]:
        return Feeds(self, feeds.CLEAN_SILVER)

    @cached_property
    def star(self) -> warehouse.Star:
        """Gold over the clean silver feeds, for KPIs."""
        return warehouse.Star(self.clean_silver, CTX, store_late=self.stored)

    @cached_property
    def star_from_bronze(self) -> warehouse.Star:
        """Gold over silver over the dirty feeds."""
        return warehouse.Star(self.silver, CTX, store_late=self.stored)


@dataclass(frozen=True)
class Case:
    build: Build
    oracle: str | None


CASES: dict[str, Case] = {}


def _stages(kind: str) -> Mapping[str, str]:
    """All named stages an oracle may refer to."""
    bronze = {name: feeds.oracle_text(s) for name, s in feeds.BRONZE.items()}
    clean = {name: feeds.oracle_text(s) for name, s in feeds.CLEAN_SILVER.items()}
    return {**bronze, **(clean if kind == "clean" else SILVER), **GOLD}


def with_stages(body: str, kind: str) -> str:
    """Put the stages the body needs, directly or not, in front of it as CTEs."""
    available = _stages(kind)
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", text)):
            if word in available and word not in needed:
                visit(available[word])
                if word not in needed:
                    needed.append(word)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({available[name]})" for name in needed)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"


def case(name: str, oracle: str | None = None, stage: str = "clean") -> Callable[[Build], Build]:
    """Register a query; ``oracle`` is SQL over tables and stages."""

    def register(build: Build) -> Build:
        if name in CASES:
            raise ValueError(f"duplicate query name: {name}")
        CASES[name] = Case(build, with_stages(oracle, stage) if oracle else None)
        return build

    return register


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return CASES[name].build(Inputs(apply_adaptive_settings(spark), folder))

    run.__name__ = name
    return run


def portable(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Column types both engines print alike: days as text, decimals as doubles.

    ``digits`` rounds floating-point columns, whose sums depend on the order.
    """

    def convert(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType)):
            value = value.cast("string")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        rounds = isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType))
        if digits is not None and rounds:
            value = F.round(value, digits)
        return value.alias(field.name)

    return df.select(*[convert(field) for field in df.schema.fields])
