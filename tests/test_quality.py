from __future__ import annotations

import gzip
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataline.operators import fingerprints
from strataline.plans import rulebook
from strataline.quality import log, rules, runner
from strataline.sources.schemas import DQ_LOG_DDL, schema
from strataline.workloads import quality_cases
from strataline.workloads.registry import Inputs

AS_OF = "2000-01-01"


@pytest.fixture(scope="module")
def people(spark):
    data = [(1, "Ann", "x"), (2, " Bob", "y"), (2, None, "z"), (None, "Cid", "z")]
    return spark.createDataFrame(data, "id int, name string, code string")


RULES = [
    rules.not_null("name"),
    rules.unique("id"),
    rules.no_whitespace("name").warn(),
    rules.accepted_values("code", "x", "y"),
    rules.accepted_range("id", low=1, inclusive=False),
    rules.unique_combination("id", "code"),
    rules.relationships("id", "parents", "key"),
    rules.contains_string("name", "n"),
]


def test_one_result_per_rule(spark, people):
    parents = {"parents": spark.createDataFrame([(1,)], "key int")}
    results = runner.check_model("stg_people", people, RULES, AS_OF, parents)
    found = {r.rule_id: (r.failure_count, r.status) for r in results.collect()}
    assert found == {
        "not_null_name": (1, "fail"),
        "unique_id": (1, "fail"),
        "no_whitespace_name": (1, "warn"),
        "accepted_values_code": (1, "fail"),
        "accepted_range_id": (1, "fail"),
        "unique_combination_of_columns_id_code": (0, "pass"),
        "relationships_id": (2, "fail"),
        "contains_string_name": (2, "fail"),
    }
    assert {r.evaluated_rows for r in results.collect()} == {4}


def test_counts_agree_with_failing_rows(spark, people):
    parents = {"parents": spark.createDataFrame([(1,)], "key int")}
    counted = {
        r.rule_id: r.failure_count
        for r in runner.count_failures(people, RULES, AS_OF, parents).collect()
    }
    for rule in RULES:
        assert rules.failing_rows(people, rule, AS_OF, parents).count() == counted[rule.rule_id]


def test_clean_table_passes(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    checks = [rules.unique("id"), rules.accepted_values("name", "a"), rules.not_null("id")]
    assert {r.status for r in runner.check_model("m", df, checks, AS_OF).collect()} == {"pass"}


def test_bad_rule_arguments():
    with pytest.raises(ValueError, match="case"):
        rules.assert_case("c", "camel")
    with pytest.raises(ValueError, match="op"):
        rules.assert_formula("c", "a", "b", "power")


def test_formula_operations(spark):
    df = spark.createDataFrame([(6.0, 2.0, 3.0), (7.0, 2.0, 3.0)], "c double, a double, b double")
    for op, bad in {"multiply": 1, "divide": 2, "add": 2, "subtract": 2}.items():
        assert rules.failing_rows(df, rules.assert_formula("c", "a", "b", op), AS_OF).count() == bad
    close = rules.assert_formula("c", "a", "b", tolerance=1.5)
    assert rules.failing_rows(df, close, AS_OF).isEmpty()


def test_rulebook_size():
    assert sum(map(len, rulebook.STAGING.values())) == 127
    assert sum(map(len, rulebook.MARTS.values())) == 63


def _log(spark, people, run_id):
    results = runner.check_model("stg_people", people, RULES[:4], AS_OF)
    return log.log_rows(results, run_id, "2031-02-03 08:15:00", "2031-02-03 08:22:30")


def test_log_schema_and_append(spark, people, tmp_path):
    path = str(tmp_path / "log")
    first = _log(spark, people, "run-1")
    assert first.schema.simpleString() == schema(DQ_LOG_DDL).simpleString()
    log.append_new_runs(first, path)
    log.append_new_runs(first, path)
    log.append_new_runs(_log(spark, people, "run-2"), path)
    stored = log.read_log(spark, path)
    assert stored.count() == 2 * first.count()
    assert list((tmp_path / "log" / "rows").glob("attempt=*/run_date=2031-02-03"))


def test_appending_nothing_is_harmless(spark, people, tmp_path):
    path = str(tmp_path / "log")
    log.append_log(_log(spark, people, "r").filter(F.lit(False)), path)
    assert log.read_log(spark, path).isEmpty()


def test_layers(spark):
    df = spark.createDataFrame([("stg_a",), ("dim_b",), (None,)], "m string")
    assert [r[0] for r in df.select(log.layer_of("m")).collect()] == ["staging", "marts", "marts"]


def _model(name):
    return {"resource_type": "model", "name": name}


def _test(name, column, severity, *parents):
    return {
        "resource_type": "test",
        "name": f"{name}_of_{column}",
        "test_metadata": {"name": name},
        "column_name": column,
        "config": {"severity": severity},
        "depends_on": {"nodes": list(parents)},
    }


SHOP, TILL = "model.shop.stg_orders", "model.shop.fact_till"
MANIFEST = {
    "metadata": {"invocation_id": "b7c2"},
    "nodes": {
        SHOP: _model("stg_orders"),
        TILL: _model("fact_till"),
        "seed.shop.rates": {"resource_type": "seed", "name": "rates"},
        "k1": _test("relationships", "order_ref", "error", TILL, SHOP),
        "k2": _test("accepted_range", "amount", "warn", TILL),
        "k3": _test("dbt_utils.accepted_range", "tax", "error", TILL),
        "k4": _test("dbt_utils.unique_combination_of_columns", None, None, SHOP),
        "k5": _test("unique_combination_of_columns", None, "error", SHOP),
        "k6": _test("looks_nice", "amount", "error", TILL),
        "k7": _test("assert_formula", "amount", "error"),
        "k8": _test("not_null", "amount", "error", SHOP),
    },
}
RUN_RESULTS = {
    "results": [
        {"unique_id": TILL, "status": "success", "failures": None},
        {"unique_id": "k1", "status": "fail", "failures": 41},
        {"unique_id": "k2", "status": "warn", "failures": 2},
        {"unique_id": "k3", "status": "pass", "failures": 0},
        {"unique_id": "k4", "status": "pass", "failures": 0},
        {"unique_id": "k5", "status": "error", "failures": None},
        {"unique_id": "k6", "status": "fail", "failures": 9},
        {"unique_id": "k7", "status": "skipped", "failures": None},
    ]
}


@pytest.fixture(scope="module")
def artifacts(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("artifacts")
    for run in ("1", "2"):
        for kind, document in (("manifest", MANIFEST), ("results", RUN_RESULTS)):
            folder = root / kind / f"run_id={run}"
            folder.mkdir(parents=True)
            (folder / "document.json").write_text(json.dumps(document, indent=1))
    manifests = log.read_artifacts(spark, str(root / "manifest"), log.MANIFEST_DDL)
    results = log.read_artifacts(spark, str(root / "results"), log.RUN_RESULTS_DDL)
    return manifests, results


def test_artifacts_give_one_row_per_known_test(spark, artifacts):
    manifests, results = artifacts
    runs = spark.createDataFrame(
        [("1", "2031-02-03 08:15:00", "2031-02-03 08:22:30", "schedule")],
        "run_id string, run_started_at string, run_finished_at string, trigger_type string",
    )
    parsed = log.parse_artifacts(manifests, results, runs).filter("run_id = '1'")
    shown = parsed.select(
        "test_name", "test_category", "model_name", "schema_layer", "status", "failure_count",
        "invocation_id",
    )
    assert sorted(map(tuple, shown.collect())) == [
        ("accepted_range", "validity", "fact_till", "marts", "warn", 2, "b7c2"),
        ("assert_formula", "accuracy", None, "marts", "skipped", None, "b7c2"),
        ("dbt_utils.accepted_range", "validity", "fact_till", "marts", "pass", 0, "b7c2"),
        ("dbt_utils.unique_combination_of_columns", "referential_integrity", "stg_orders", "staging", "pass", 0, "b7c2"),
        ("relationships", "referential_integrity", "fact_till", "marts", "fail", 41, "b7c2"),
        ("unique_combination_of_columns", "referential_integrity", "stg_orders", "staging", "error", None, "b7c2"),
    ]


def test_exploded_artifacts_are_not_broadcast(spark, artifacts):
    """However small Spark takes them to be: only the names of the categories are."""
    manifests, results = artifacts
    runs = spark.createDataFrame([("1", "", "", "")], "run_id string, run_started_at string, run_finished_at string, trigger_type string")
    plan = log.parse_artifacts(manifests, results, runs)._jdf.queryExecution().sparkPlan().toString()
    merged = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert sum("unique_id" in line for line in merged) == sum("model_id" in line for line in merged) == 1


RUNS = "run_id string, run_started_at string, run_finished_at string, trigger_type string"


def test_artifacts_are_shuffled_as_documents_only(spark, artifacts):
    """Nodes and results are exploded where their run is; nothing is shuffled for a join."""
    manifests, results = artifacts
    parsed = log.parse_artifacts(manifests, results, spark.createDataFrame([("1", "", "", "")], RUNS))
    plan = parsed._jdf.queryExecution().executedPlan().toString().splitlines()
    shuffles = [line for line in plan if "Exchange" in line and "BroadcastExchange" not in line]
    assert shuffles and not [line for line in shuffles if "hashpartitioning" in line]
    reads = "".join(plan[plan.index(shuffles[0]) :])
    assert reads.count("Scan text") == len(shuffles) - 1  # all but the listing of runs


@pytest.fixture
def shuffle_partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("shuffle_partitions", ["1", "3", "40"], indirect=True)
def test_artifacts_meet_all_others_of_their_run(spark, shuffle_partitions):
    """Repeated documents and listings give every combination; a run without an id has no rows."""

    def manifest(run, invocation, model):
        nodes = {
            "m": ("model", model, None, None, None, None),
            "t": ("test", "t", ("unique",), "c", ("warn",), (["m"],)),
        }
        return run, (invocation,), nodes

    manifests = spark.createDataFrame(
        [
            manifest("1", "i1", "stg_a"), manifest("1", "i2", "dim_b"), manifest("2", "i3", "dim_c"),
            manifest(None, "i4", "dim_d"), ("5", ("i5",), None), ("6", ("i6",), {}),
        ],
        f"run_id string, {log.MANIFEST_DDL}",
    )
    outcomes = [("t", "fail", 3), ("m", "success", None), (None, "fail", 9)]
    results = spark.createDataFrame(
        [("1", outcomes), ("2", outcomes), ("2", outcomes[:1]), (None, outcomes), ("5", outcomes), ("6", []), ("7", None)],
        f"run_id string, {log.RUN_RESULTS_DDL}",
    )
    listing = [(1, "a", "b", "x"), (1, "a", "b", "y"), (None, "a", "b", "z")]
    runs = spark.createDataFrame(listing, RUNS.replace("run_id string", "run_id bigint"))
    found = log.parse_artifacts(manifests, results, runs).select(
        "run_id", "invocation_id", "model_name", "trigger_type", "failure_count"
    )
    several = [("1", i, model, trigger, 3) for i in ("i1", "i2") for model in ("stg_a", "dim_b") for trigger in "xy"]
    assert Counter(map(tuple, found.collect())) == Counter([*several, *2 * [("2", "i3", "dim_c", None, 3)]])


def test_scanned_artifacts_are_stored_compressed_in_files_of_a_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality_cases, "_DOCUMENTS_PER_FILE", 100, raising=False)
    monkeypatch.setattr(quality_cases, "scratch_path", lambda _, name: str(tmp_path / name))
    orders = spark.range(0, 1000, 1, 1).selectExpr("id AS o_orderkey", "'F' AS o_orderstatus", "timestamp'2031-02-03' AS o_orderdate")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    rows = quality_cases.io14(Inputs(spark, str(tmp_path)))
    assert rows.groupBy("run_id").count().filter("count = 3").count() == 1000
    for name in ("manifests", "results"):
        files = list((tmp_path / name).glob("part-*"))
        texts = [gzip.decompress(f.read_bytes()) for f in files]
        assert [t.count(b"\n") for t in texts] == [100] * 10
        assert 5 * sum(f.stat().st_size for f in files) < sum(map(len, texts))


def test_every_category_is_known_with_and_without_package(spark):
    known = {r.test_name: r.test_category for r in log.category_table(spark).collect()}
    for name, category in rules.TEST_CATEGORIES.items():
        assert known[name] == known[name.rpartition(".")[2]] == category
    assert len(known) == 15


def test_backfill_skips_loaded_and_failed_runs(spark, artifacts):
    manifests, results = artifacts
    listing = spark.createDataFrame(
        [(1, 10, "2026-01-01 00:00:00"), (2, 10, "2026-01-02 00:00:00"), (3, 20, "2026-01-03 00:00:00")],
        "id int, status int, finished_at string",
    ).withColumn("started_at", F.col("finished_at"))
    counts = spark.createDataFrame([("fact_till", 100), ("stg_orders", 7)], "model_name string, row_count bigint")
    loaded = spark.createDataFrame([("1",)], "run_id string")
    rows = log.backfill(listing, manifests, results, counts, loaded)
    found = {(r.run_id, r.trigger_type, r.evaluated_rows, r.is_backfilled) for r in rows.collect()}
    assert found == {("2", "backfill", n, True) for n in (100, 7, None)}


def test_backfill_looks_at_all_runs_unless_told(spark, artifacts):
    listing = spark.range(1, 31).selectExpr(
        "id", "10 AS status", "CAST(timestamp_seconds(2000000000 - id) AS STRING) AS finished_at"
    ).withColumn("started_at", F.col("finished_at"))
    nodes, results = (a.filter("run_id = '1'").drop("run_id") for a in artifacts)
    ids = listing.select(F.col("id").cast("string").alias("run_id"))
    manifests, run_results = nodes.crossJoin(ids), results.crossJoin(ids)
    counts = spark.createDataFrame([("stg_orders", 7)], "model_name string, row_count bigint")
    none = ids.limit(0)
    runs = lambda **kept: log.backfill(listing, manifests, run_results, counts, none, **kept)
    assert runs().select("run_id").distinct().count() == 30
    assert runs(kept=20).select("run_id").distinct().count() == 20


def test_latest_runs_limit_before_status(spark):
    listing = spark.range(30).selectExpr(
        "id", "CAST(IF(id >= 15, 20, 10) AS INT) AS status", "CAST(id AS STRING) AS finished_at"
    ).withColumn("finished_at", F.lpad("finished_at", 3, "0"))
    assert log.successful_runs(listing).count() == 5


def test_summary_rates(spark, people):
    summary = log.summary(_log(spark, people, "r")).collect()
    by_category = {(r.test_category, r.severity): (r.total_failures, r.failure_rate, r.pass_rate) for r in summary}
    assert by_category[("completeness", "error")] == (1, 0.25, 0.75)
    assert by_category[("validity", "warn")] == (1, 0.25, 0.75)


def test_failed_rules_leave_their_rows(spark, people, tmp_path):
    declared = {"stg_people": RULES}
    tables = {"stg_people": people, "parents": spark.createDataFrame([(1,)], "key int")}
    results = runner.check_model("stg_people", people, RULES, AS_OF, tables)
    written = runner.store_failures(tables, declared, results, AS_OF, str(tmp_path))
    assert sorted(rule_id for _, rule_id in written) == [
        "accepted_range_id", "accepted_values_code", "contains_string_name", "no_whitespace_name", "not_null_name",
        "relationships_id", "unique_id",
    ]
    by_id = {rule.rule_id: rule for rule in RULES}
    for (_, rule_id), path in written.items():
        stored = runner.read_failures(people, by_id[rule_id], path)
        expected = rules.failing_rows(people, by_id[rule_id], AS_OF, tables)
        assert stored.columns == expected.columns
        assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect())), rule_id


def _scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [") + plan.count("Relation spark_catalog")


def test_row_rules_share_one_scan(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "people"))
    stored = spark.read.parquet(str(tmp_path / "people"))
    row_rules = [r for r in RULES if isinstance(r, rules.RowRule) and not isinstance(r, rules.ValueRule)]
    assert len(row_rules) == 4
    assert _scans(runner.model_failures(stored, row_rules, AS_OF)) == 1


def test_parent_rules_share_one_scan(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "people"))
    stored = spark.read.parquet(str(tmp_path / "people"))
    parents = {f"p{i}": spark.createDataFrame([(i,)], "key bigint") for i in range(6)}
    checks = [rules.relationships("id", f"p{i}", "key") for i in range(5)] + [rules.relationships("code", "p5", "key")]
    found = runner._offending_values(stored, checks, AS_OF, parents)
    assert _scans(found) == 1
    counted = {r.rule_no: r.n for r in found.groupBy("rule_no").agg(F.sum("n").alias("n")).collect()}
    for number, rule in enumerate(checks[:5]):
        assert counted.get(number, 0) == rules.failing_rows(people, rule, AS_OF, parents).count()


def test_clean_keys_ship_no_rows_in_the_second_pass(spark):
    clean = spark.range(5000).selectExpr("id", "concat('key-', id) AS name")
    twice = fingerprints.seen_twice(clean, [F.xxhash64("name")])
    assert clean.filter(fingerprints.may_hold(twice, F.xxhash64("name"))).isEmpty()
    dirty = clean.unionByName(clean.filter("id % 1000 = 7"))
    found = fingerprints.repeated_keys(dirty, ["name", "id"], "n")
    assert {tuple(r) for r in found.collect()} == {(f"key-{i}", i, 2) for i in range(7, 5000, 1000)}
    twice = fingerprints.seen_twice(dirty, [F.xxhash64("name")])
    passed = dirty.filter(fingerprints.may_hold(twice, F.xxhash64("name"))).count()
    assert 10 <= passed <= 20


def test_repeated_keys_are_exact_when_the_filter_is_full(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "FILTER_BITS", 64)
    rows = [(str(i % 40) if i % 7 else None, float(i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "a string, b double")
    found = fingerprints.repeated_keys(df, ["a", "b"], "n").collect()
    expected = {k: n for k, n in Counter(rows).items() if n > 1}
    assert {(r.a, r.b): r.n for r in found} == expected
    assert fingerprints.repeated_keys(df.limit(0), ["a", "b"]).isEmpty()
