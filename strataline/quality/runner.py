"""Running many rules in few passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.functions.dates import AsOf
from strataline.operators.fingerprints import may_hold, seen_twice
from strataline.quality.rules import (
    KeyRule,
    ParentRule,
    RowRule,
    Rule,
    ValueRule,
    failing_rows,
)
from strataline.sources.snapshots import replace_files
from strataline.sources.tables import literal_table

RESULT = "rule_id string, failure_count bigint, row_count bigint"


def _entry(rule: Rule, count: Column, rows: Column | None = None) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        count.cast("bigint").alias("failure_count"),
        (F.lit(None) if rows is None else rows).cast("bigint").alias("row_count"),
    )


def _row_counts(df: DataFrame, rules: Sequence[RowRule], as_of: AsOf) -> DataFrame:
    """All row rules of a model, and its row count, in one aggregate over one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(rule.condition(as_of)).alias(f"r{i}") for i, rule in enumerate(rules)],
    )
    entries = [_entry(rule, F.col(f"r{i}"), F.col("n")) for i, rule in enumerate(rules)]
    total = F.struct(
        F.lit(None).cast("string").alias("rule_id"),
        F.lit(0).cast("bigint").alias("failure_count"),
        F.col("n").alias("row_count"),
    )
    return counted.select(F.inline(F.array(*entries, total)))


def _known(rule: KeyRule) -> Column:
    """Whether a row takes part in a key rule."""
    if rule.count_nulls:
        return F.lit(True)
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in rule.columns])


def _key_text(rule: Rule) -> Column:
    if len(rule.columns) == 1:
        return F.col(rule.columns[0]).cast("string")
    return F.to_json(F.struct(*rule.columns), {"ignoreNullFields": "false"})


def _repeated(df: DataFrame, rules: Sequence[KeyRule]) -> DataFrame:
    """(rule_id, value, n): repeated keys of all key rules, found in two scans.

    The first ships an 8-byte fingerprint for each row and rule. Those seen twice go into
    a filter of fixed size, and the second scan ships the keys that it lets pass: without
    repeated keys, none.
    """
    prints = [F.when(_known(r), F.xxhash64(F.lit(i), *r.columns)) for i, r in enumerate(rules)]
    twice = seen_twice(df, prints)
    entries = [
        F.when(_known(rule) & may_hold(twice, one), F.struct(F.lit(rule.rule_id).alias("rule_id"), _key_text(rule).alias("value")))
        for rule, one in zip(rules, prints, strict=True)
    ]
    flat = df.select(F.explode(F.array_compact(F.array(*entries))).alias("entry"))
    per_key = flat.groupBy("entry.rule_id", "entry.value").agg(F.count(F.lit(1)).alias("n"))
    return per_key.filter("n > 1")


def _offending_values(
    df: DataFrame, rules: Sequence[ValueRule | ParentRule], as_of: AsOf, parents: Mapping[str, DataFrame] | None
) -> DataFrame:
    """(rule_no, v0, v1, ..., n): values that are not accepted, and known keys without a parent.

    One scan for all rules: a row contributes a value per value rule it violates and a key per
    parent rule, in a column of the key's own type. Combined map-side, each distinct key is
    shipped once per task, and a single anti join with the parents' distinct keys takes out
    those that have one.
    """
    types = list(dict.fromkeys(df.schema[r.columns[0]].dataType.simpleString() for r in rules))

    def entry(number: int, value: Column, kind: str) -> Column:
        typed = [(value if t == kind else F.lit(None)).cast(t).alias(f"v{i}") for i, t in enumerate(types)]
        return F.struct(F.lit(number).alias("rule_no"), *typed)

    entries, known = [], []
    for number, rule in enumerate(rules):
        value, kind = F.col(rule.columns[0]), df.schema[rule.columns[0]].dataType.simpleString()
        if isinstance(rule, ParentRule):
            entries.append(F.when(value.isNotNull(), entry(number, value, kind)))
            key = F.col(rule.parent_column).try_cast(kind)  # a key the child's type cannot hold is nobody's parent
            known.append((parents or {})[rule.parent].select(F.inline(F.array(entry(number, key, kind)))))
        else:
            entries.append(F.when(rule.condition(as_of), entry(number, value, kind)))
    flat = df.select(F.explode(F.array_compact(F.array(*entries))).alias("entry")).select("entry.*")
    values = flat.groupBy(*flat.columns).agg(F.count(F.lit(1)).alias("n"))
    if not known:
        return values
    found = reduce(DataFrame.union, known).distinct()
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"p.{c}")) for c in flat.columns]
    return values.alias("c").join(found.alias("p"), reduce(Column.__and__, same), "left_anti")


def count_failures(
    df: DataFrame,
    rules: Sequence[Rule],
    as_of: AsOf,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Failures per rule: one scan for rows, one for values and parents, two for keys.

    The row count comes with the first scan. It is spread over the results by a
    window without partitions, whose input is one row per declared rule.
    """
    spark = df.sparkSession
    row_rules = [r for r in rules if isinstance(r, RowRule) and not isinstance(r, ValueRule)]
    value_rules = [r for r in rules if isinstance(r, (ValueRule, ParentRule))]
    key_rules = [r for r in rules if isinstance(r, KeyRule)]
    counted = [r for r in rules if r not in row_rules]
    parts = [_row_counts(df, row_rules, as_of)]
    if counted:
        parts.append(literal_table(spark, [(r.rule_id, 0, None) for r in counted], RESULT))
    nothing = F.lit(None).cast("bigint").alias("row_count")
    if value_rules:
        # A value that is not accepted counts once, a key without a parent once per row.
        names = literal_table(
            spark,
            [(i, r.rule_id, isinstance(r, ParentRule)) for i, r in enumerate(value_rules)],
            "rule_no int, rule_id string, by_row boolean",
        )
        offending = _offending_values(df, value_rules, as_of, parents).groupBy("rule_no").agg(
            F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("rows")
        )
        failures = F.when(F.col("by_row"), F.col("rows")).otherwise(F.col("distinct"))
        parts.append(offending.join(names, "rule_no").select("rule_id", failures.alias("failure_count"), nothing))
    if key_rules:
        repeated = _repeated(df, key_rules).groupBy("rule_id").agg(F.count(F.lit(1)).alias("failure_count"))
        parts.append(repeated.select("rule_id", "failure_count", nothing))
    per_rule = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("rule_id")
        .agg(F.sum("failure_count").alias("failure_count"), F.max("row_count").alias("row_count"))
    )
    rows = F.max("row_count").over(Window.partitionBy())
    return per_rule.select("rule_id", "failure_count", rows.alias("evaluated_rows")).filter(
        F.col("rule_id").isNotNull()
    )


def status_of(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, "pass").when(severity == "warn", "warn").otherwise("fail")


def check_model(
    model: str,
    df: DataFrame,
    rules: Sequence[Rule],
    as_of: AsOf,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per rule of the model: status, failures and rows looked at.

    The rule list is a driver-side declaration, so the table made of it is bounded.
    """
    spark = df.sparkSession
    declared = literal_table(
        spark,
        [
            (r.rule_id, model, r.column, r.test, r.category, r.severity)
            for r in rules
        ],
        "rule_id string, model_name string, column_name string, test_name string, "
        "test_category string, severity string",
    )
    counted = count_failures(df, rules, as_of, parents)
    return (
        counted.join(declared, "rule_id")
        .withColumn("status", status_of(F.col("failure_count"), F.col("severity")))
    )


def check_warehouse(
    tables: Mapping[str, DataFrame], rulebook: Mapping[str, Sequence[Rule]], as_of: AsOf
) -> DataFrame:
    """All models of a rulebook; parents are looked up among the same tables."""
    parts = [
        check_model(model, tables[model], rules, as_of, tables)
        for model, rules in rulebook.items()
        if model in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def model_failures(
    df: DataFrame, rules: Sequence[Rule], as_of: AsOf, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """What each of the rules objects to, as one table: the columns rules look at, n_records, rule_id.

    A column is filled for rules that look at it and NULL for others; n_records is given for
    distinct values and repeated keys. Row rules share one scan, in which a row is repeated for
    each rule it breaks.
    """
    looked_at = list(dict.fromkeys(c for rule in rules for c in rule.columns))
    row_rules = [r for r in rules if isinstance(r, RowRule) and not isinstance(r, ValueRule)]
    parts = []
    if row_rules:
        broken = F.array_compact(F.array(*[F.when(r.condition(as_of), F.lit(r.rule_id)) for r in row_rules]))
        each = df.select(*looked_at, F.explode(broken).alias("rule_id"))
        users = {c: [r.rule_id for r in row_rules if c in r.columns] for c in looked_at}
        shown = [F.when(F.col("rule_id").isin(users[c]), F.col(c)).alias(c) if users[c] else _absent(df, c) for c in looked_at]
        parts.append(each.select(*shown, F.lit(None).cast("bigint").alias("n_records"), "rule_id"))
    for rule in rules:
        if rule in row_rules:
            continue
        rows = failing_rows(df, rule, as_of, parents)
        count = F.col("n_records") if "n_records" in rows.columns else F.lit(None).cast("bigint").alias("n_records")
        shown = [F.col(c) if c in rule.columns else _absent(df, c) for c in looked_at]
        parts.append(rows.select(*shown, count, F.lit(rule.rule_id).alias("rule_id")))
    return reduce(DataFrame.unionByName, parts)


def _absent(df: DataFrame, column: str) -> Column:
    return F.lit(None).cast(df.schema[column].dataType).alias(column)


def store_failures(
    tables: Mapping[str, DataFrame],
    rulebook: Mapping[str, Sequence[Rule]],
    results: DataFrame,
    as_of: AsOf,
    folder: str,
) -> dict[tuple[str, str], str]:
    """Write what each failed rule objects to; returns the folder of each (model, rule).

    One write per model, partitioned by rule, under ``audit_<layer>/<model>``; it replaces the
    model's last one when complete. The list of failed rules is bounded by the rulebook, and is
    all that reaches the driver. The rebalance hint splits the rows of a rule that nearly every
    row breaks, and joins those of the others.
    """
    failed = results.filter(F.col("failure_count") > 0).select("model_name", "rule_id").collect()
    by_model: dict[str, list[Rule]] = {}
    for model, rules in rulebook.items():
        names = {r.rule_id for r in failed if r.model_name == model}
        by_model[model] = [r for r in rules if r.rule_id in names]
    written = {}
    for model, rules in by_model.items():
        if not rules:
            continue
        layer = "audit_stg" if model.startswith("stg_") else "audit_mrt"
        path = f"{folder}/{layer}/{model}"
        rows = model_failures(tables[model], rules, as_of, tables).hint("rebalance", "rule_id")
        version = replace_files(rows, path, partition_by=["rule_id"])
        for rule in rules:
            written[(model, rule.rule_id)] = f"{path}/versions/{version}/rule_id={rule.rule_id}"
    return written


def read_failures(df: DataFrame, rule: Rule, path: str) -> DataFrame:
    """The stored rows of one rule of the model ``df``, in the columns it looks at."""
    counts = isinstance(rule, (ValueRule, KeyRule))
    fields = [*[df.schema[c] for c in rule.columns], *([T.StructField("n_records", T.LongType())] if counts else [])]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)
