"""Every registered query against its oracle, on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracles import differences, oracle_engine

import __spark_entry__ as entry_points
from strataline.workloads import catalog, feeds

ORACLES = catalog.oracle_sql()
QUERIES = catalog.queries()
#: Rightly without a row on the smallest tables.
EMPTY = {"pr15_point_lookup"}


@pytest.fixture(scope="module")
def engine(data_folder):
    return oracle_engine(data_folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_oracle(spark, engine, data_folder, name):
    text = differences(spark, engine, data_folder, name, QUERIES[name], ORACLES.get(name))
    assert text == ("no rows" if name in EMPTY else "")


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_declared_table_schemas(spark, data_folder):
    for name, ddl in feeds.TABLES.items():
        path = f"{data_folder}/{name}.parquet"
        declared = spark.read.schema(ddl).parquet(path).schema.simpleString()
        assert declared == spark.read.parquet(path).schema.simpleString()
