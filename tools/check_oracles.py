"""Run registered queries next to their oracle and report differences.

usage: python tools/check_oracles.py FOLDER [name-part ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from strataline.workloads.catalog import oracle_sql, queries  # noqa: E402


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "is_integer") or type(value).__name__ == "Decimal":
        number = float(value)
        return None if math.isnan(number) else round(number, 9)
    return float(value) if isinstance(value, int) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def oracle_engine(folder: str):
    engine = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        engine.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return engine


def differences(spark, engine, folder, name, build, sql):
    """Empty text when both sides agree."""
    frame = build(spark, folder)
    actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return f"rows only: {len(actual)}" if actual else "no rows"
    result = engine.execute(sql)
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if actual != expected:
        pairs = [(a, e) for a, e in zip(actual, expected) if a != e][:2]
        return f"{len(actual)} rows, oracle {len(expected)}; first differences {pairs}"
    return "" if actual else "no rows"


def main() -> None:
    folder, parts = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    engine = oracle_engine(folder)
    oracles = oracle_sql()
    good = bad = 0
    for name, build in queries().items():
        if parts and not any(part in name for part in parts):
            continue
        started = time.time()
        try:
            text = differences(spark, engine, folder, name, build, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            text = f"{type(error).__name__}: {str(error)[:700]}"
        took = time.time() - started
        if text and not text.startswith("rows only"):
            bad += 1
            print(f"BAD  {name} {took:.1f}s {text}", flush=True)
        else:
            good += 1
            print(f"ok   {name} {took:.1f}s {text}", flush=True)
    print(f"{good} ok, {bad} bad")


if __name__ == "__main__":
    main()
