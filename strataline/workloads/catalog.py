"""All registered queries."""

from __future__ import annotations

from strataline.workloads import (  # noqa: F401  (importing registers the queries)
    aggregate_cases,
    fault_cases,
    io_cases,
    kpi_cases,
    model_cases,
    quality_cases,
    relational_cases,
    scalar_cases,
    v1_cases,
)
from strataline.workloads.registry import CASES, runnable


def queries():
    return {name: runnable(name) for name in CASES}


def oracle_sql() -> dict[str, str]:
    return {name: c.oracle for name, c in CASES.items() if c.oracle}
