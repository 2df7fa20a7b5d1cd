"""Declarative rules. A rule fails when it finds rows, values or keys.

Three shapes: a condition on single rows, a condition on the values of a key, and a
reference to a parent table. Conditions are built when a rule is applied, so rules
can be declared before a session exists.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions import text
from strataline.functions.dates import AsOf, day
from strataline.operators.fingerprints import repeated_keys
from strataline.operators.joins import orphans

ERROR, WARN = "error", "warn"

# Test names and the quality dimension they report under. Tests that
# are not listed are run but not logged.
TEST_CATEGORIES = {
    "not_null": "completeness",
    "unique": "uniqueness",
    "accepted_values": "validity",
    "dbt_utils.accepted_range": "validity",
    "matches_pattern": "validity",
    "assert_case": "validity",
    "no_whitespace": "validity",
    "assert_length": "validity",
    "not_contains_string": "validity",
    "relationships": "referential_integrity",
    "dbt_utils.unique_combination_of_columns": "referential_integrity",
    "assert_formula": "accuracy",
    "assert_less_than": "accuracy",
}


@dataclass(frozen=True)
class Horizon:
    """A bound that moves with the run: the horizon, or so many years before it."""

    years_back: int = 0

    def column(self, as_of: AsOf) -> Column:
        return F.add_months(day(as_of), -12 * self.years_back)


Bound = int | float | dt.date | Horizon | None


def _bound(value: Bound, as_of: AsOf) -> Column:
    return value.column(as_of) if isinstance(value, Horizon) else F.lit(value)


@dataclass(frozen=True)
class Rule:
    """Base of all rules; ``columns`` are what the rule looks at."""

    test: str
    columns: tuple[str, ...]
    severity: str = ERROR
    args: str = ""

    @property
    def column(self) -> str | None:
        return self.columns[0] if len(self.columns) == 1 else None

    @property
    def rule_id(self) -> str:
        name = self.test.rpartition(".")[2]
        return "_".join(filter(None, [name, *self.columns, self.args]))

    @property
    def category(self) -> str | None:
        return TEST_CATEGORIES.get(self.test)

    def warn(self) -> Rule:
        return replace(self, severity=WARN)


@dataclass(frozen=True)
class RowRule(Rule):
    """Fails on rows for which the condition is true; ``params`` restates its settings."""

    condition: Callable[[AsOf], Column] = field(default=None, compare=False)
    params: tuple = ()


@dataclass(frozen=True)
class ValueRule(RowRule):
    """Like a row rule, but every offending value counts once."""


@dataclass(frozen=True)
class KeyRule(Rule):
    """Fails on keys that occur more than once."""

    count_nulls: bool = False


@dataclass(frozen=True)
class ParentRule(Rule):
    """Fails on rows whose known key has no parent."""

    parent: str = ""
    parent_column: str = ""


def not_null(column: str) -> RowRule:
    return RowRule("not_null", (column,), condition=lambda _: F.col(column).isNull())


def unique(column: str) -> KeyRule:
    return KeyRule("unique", (column,))


def unique_combination(*columns: str) -> KeyRule:
    return KeyRule("dbt_utils.unique_combination_of_columns", columns, count_nulls=True)


def accepted_values(column: str, *values: str) -> ValueRule:
    return ValueRule(
        "accepted_values",
        (column,),
        condition=lambda _: ~F.col(column).isin(*values),
        params=values,
    )


def accepted_range(
    column: str, low: Bound = None, high: Bound = None, inclusive: bool = True
) -> RowRule:
    """Outside the bounds; NULL is no violation. Bounds may depend on the horizon."""

    def condition(as_of: AsOf) -> Column:
        value, outside = F.col(column), F.lit(False)
        if low is not None:
            edge = _bound(low, as_of)
            outside = outside | ((value < edge) if inclusive else (value <= edge))
        if high is not None:
            edge = _bound(high, as_of)
            outside = outside | ((value > edge) if inclusive else (value >= edge))
        return outside

    return RowRule(
        "dbt_utils.accepted_range", (column,), condition=condition, params=(low, high, inclusive)
    )


def matches_pattern(column: str, pattern: str) -> RowRule:
    return RowRule(
        "matches_pattern",
        (column,),
        condition=lambda _: ~F.col(column).rlike(pattern),
        params=(pattern,),
    )


# The letter cases a column can be held to.
CASES = {"upper": F.upper, "lower": F.lower, "initcap": text.capitalise_words}


def assert_case(column: str, case: str = "upper") -> RowRule:
    if case not in CASES:
        raise ValueError(f"case must be one of {sorted(CASES)}, got {case!r}")
    return RowRule(
        "assert_case",
        (column,),
        args=case,
        condition=lambda _: F.col(column) != CASES[case](F.col(column)),
        params=(case,),
    )


def no_whitespace(column: str) -> RowRule:
    return RowRule(
        "no_whitespace", (column,), condition=lambda _: text.has_outer_whitespace(column)
    )


def assert_length(column: str, length: int) -> RowRule:
    return RowRule(
        "assert_length",
        (column,),
        condition=lambda _: F.length(F.col(column)) != length,
        params=(length,),
    )


def contains_string(column: str, part: str) -> RowRule:
    return RowRule(
        "contains_string",
        (column,),
        condition=lambda _: F.instr(F.col(column), part) == 0,
        params=(part,),
    )


def not_contains_string(column: str, part: str) -> RowRule:
    return RowRule(
        "not_contains_string",
        (column,),
        condition=lambda _: F.instr(F.col(column), part) > 0,
        params=(part,),
    )


def relationships(column: str, parent: str, parent_column: str) -> ParentRule:
    return ParentRule("relationships", (column,), parent=parent, parent_column=parent_column)


# The operations a formula may state.
OPERATIONS: Mapping[str, Callable[[Column, Column], Column]] = {
    "multiply": lambda a, b: a * b,
    "divide": lambda a, b: F.try_divide(a, b),
    "add": lambda a, b: a + b,
    "subtract": lambda a, b: a - b,
}


def assert_formula(
    column: str, left: str, right: str, op: str = "multiply", tolerance: float = 0.0
) -> RowRule:
    """Column differs from ``left op right``, all three known. Exact by default."""
    if op not in OPERATIONS:
        raise ValueError(f"op must be one of {sorted(OPERATIONS)}, got {op!r}")

    def condition(_: AsOf) -> Column:
        expected = OPERATIONS[op](F.col(left), F.col(right))
        if tolerance:
            return F.abs(F.col(column) - expected) > tolerance
        return F.col(column) != expected

    return RowRule(
        "assert_formula", (column,), args=op, condition=condition, params=(left, right, op)
    )


def assert_less_than(column: str, other: str) -> RowRule:
    return RowRule(
        "assert_less_than",
        (column,),
        condition=lambda _: F.col(column) >= F.col(other),
        params=(other,),
    )


def failing_rows(
    df: DataFrame, rule: Rule, as_of: AsOf, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """What the rule objects to: rows, distinct values, or repeated keys."""
    if isinstance(rule, ValueRule):
        bad = df.filter(rule.condition(as_of))
        return bad.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n_records"))
    if isinstance(rule, RowRule):
        return df.filter(rule.condition(as_of)).select(*rule.columns)
    if isinstance(rule, KeyRule):
        known = df if rule.count_nulls else df.na.drop("any", subset=list(rule.columns))
        return repeated_keys(known, list(rule.columns), "n_records")
    if isinstance(rule, ParentRule):
        parent = (parents or {})[rule.parent]
        return orphans(df, rule.columns[0], parent, rule.parent_column).select(*rule.columns)
    raise TypeError(f"unknown rule: {rule!r}")
