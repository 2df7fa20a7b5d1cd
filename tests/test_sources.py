from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strataline import session
from strataline.plans import warehouse
from strataline.plans.silver import RunContext
from strataline.quality import log
from strataline.sources import files, schemas, tables
from strataline.sources.schemas import schema
from strataline.workloads.registry import CTX, Inputs


def test_csv_is_text_with_lower_names(spark, tmp_path):
    path = tmp_path / "loc.csv"
    path.write_text("CID,CNTRY\nAW00011000,US\n007,n/a\nx,\ny,NULL\n")
    df = files.scan_csv_text(spark, str(path), ["CID", "CNTRY"])
    assert df.dtypes == [("cid", "string"), ("cntry", "string")]
    assert sorted(map(tuple, df.collect())) == [
        ("007", None), ("AW00011000", "US"), ("x", None), ("y", None),
    ]


def test_csv_header_must_agree(spark, tmp_path):
    path = tmp_path / "loc.csv"
    path.write_text("cntry,cid\nUS,1\n")
    with pytest.raises(Exception, match="header|Header"):
        files.scan_csv_text(spark, str(path), ["cid", "cntry"]).collect()


def test_typed_csv_fails_on_bad_record(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("cid,bdate,gen\n1,not-a-date,M\n")
    ddl = schemas.schema(schemas.TYPED_BRONZE_DDL["erp_cust_az12"])
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        files.scan_csv_typed(spark, str(path), ddl).collect()


PRODUCTS = {
    "products": [
        {"id": 1, "title": "Test", "category": "c", "sku": "ABC-123",
         "meta": {"createdAt": "2024-01-01", "other": 1}, "price": 3}
    ],
    "total": 1,
}
CARTS = {
    "carts": [
        {"id": 5, "userId": 3, "products": [
            {"id": 12, "price": 2.5, "quantity": 2, "total": 5.0},
            {"id": 13, "price": 1.0, "quantity": 1, "total": 1.0},
        ]}
    ]
}


def test_json_documents(spark, tmp_path):
    (tmp_path / "products.json").write_text(json.dumps(PRODUCTS, indent=2))
    (tmp_path / "carts.json").write_text(json.dumps(CARTS))
    products = files.scan_feed(spark, "product", str(tmp_path / "products.json"))
    carts = files.scan_feed(spark, "order", str(tmp_path / "carts.json"))
    assert [tuple(r) for r in products.collect()] == [(1, "Test", "c", "ABC-123", "2024-01-01")]
    assert sorted(map(tuple, carts.collect())) == [(5, 3, 12, 2.5, 2, 5.0), (5, 3, 13, 1.0, 1, 1.0)]
    text = files.bronze_text(carts)
    assert {t for _, t in text.dtypes} == {"string"}


def test_unknown_feed(spark):
    with pytest.raises(ValueError, match="data type"):
        files.scan_feed(spark, "payment", "/nowhere")


def test_tables_refresh_truncate_append(spark):
    tables.create_schemas(spark, ("silver",))
    target = schemas.schema("id bigint, v string")
    tables.recreate_table(spark, "silver.stg_t", target)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    tables.truncate_insert(rows, "silver.stg_t")
    tables.truncate_insert(rows.limit(1), "silver.stg_t", order=["id"])
    assert spark.table("silver.stg_t").dtypes == [("id", "bigint"), ("v", "string")]
    assert spark.table("silver.stg_t").count() == 1
    assert tables.materialise(rows, "stg_t").count() == 2
    assert tables.qualified("dim_x") == "gold.dim_x"


def test_missing_table_is_empty(spark):
    ddl = schemas.schema("id int")
    assert tables.table_or_empty(spark, "nothing_here", ddl).isEmpty()


def test_load_stamp_is_one_value(spark):
    stamped = tables.stamp_load(spark.range(3), dt.datetime(2026, 1, 2, 3, 4, 5))
    assert {r[1] for r in stamped.collect()} == {dt.datetime(2026, 1, 2, 3, 4, 5)}


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get(session.CHECKPOINT_KEY)
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


def test_unknown_generation():
    with pytest.raises(ValueError, match="generation"):
        RunContext("2000-01-01", "2000-01-01 00:00:00", "v3")


def test_declared_silver_and_gold_schemas(spark, data_folder):
    inputs = Inputs(spark, data_folder)
    for name, ddl in schemas.SILVER_DDL.items():
        assert inputs.silver[name].schema.simpleString() == schemas.schema(ddl).simpleString(), name
    star = inputs.star_from_bronze
    actual = {"dim_customers": star.customers, "dim_products": star.products, "fact_sales": star.sales}
    for name, ddl in schemas.GOLD_DDL.items():
        assert actual[name].schema.simpleString() == schemas.schema(ddl).simpleString(), name


def test_refresh_stores_every_layer(spark, data_folder):
    inputs = Inputs(spark, data_folder)
    star = warehouse.refresh(inputs.bronze, CTX)
    customers, products, sales = warehouse.stored_star(spark)
    assert sales.count() == star.sales.count() > 0
    assert "_raw_id" not in customers.columns and "_raw_id" not in products.columns
    assert spark.catalog.tableExists("silver.stg_djapi__order")


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,NAME,CITY\n1,"say ""hi"", Bob",X\n2,"two\nlines",Y\n3,,"n/a"\n')
    rows = files.scan_csv_text(spark, str(tmp_path), ["ID", "NAME", "CITY"]).collect()
    assert sorted(map(tuple, rows)) == [("1", 'say "hi", Bob', "X"), ("2", "two\nlines", "Y"), ("3", None, None)]
    assert files.csv_rejects(spark, str(tmp_path), ["ID", "NAME", "CITY"]).isEmpty()


def test_ragged_csv_rows_fail_or_are_listed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,NAME\n1,a\n2,b,EXTRA\n3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.scan_csv_text(spark, str(tmp_path), ["ID", "NAME"]).collect()
    rejects = files.csv_rejects(spark, str(tmp_path), ["ID", "NAME"]).collect()
    assert sorted(r.row for r in rejects) == ["2,b,EXTRA", "3"]


# --- files that are split or read whole, documents that do not fit --------------------------------


def test_plain_csv_is_split_and_quoted_breaks_are_read_whole(spark, tmp_path):
    plain = tmp_path / "in" / "a b+[1].csv"
    plain.parent.mkdir()
    plain.write_text("ID,NAME\n" + "".join(f'{i},"say ""{i}"""\n' for i in range(20_000)))
    (tmp_path / "in" / "b.csv").write_text('ID,NAME\n1,"two\nlines"\n2,"a ""quote\n"" more"\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert sorted(files.open_quoted_files(spark, str(tmp_path / "in")).values()) == [False, True]
        only = files.scan_csv_text(spark, str(plain).replace("[", "\\[").replace("]", "\\]"), ["ID", "NAME"])
        assert only.rdd.getNumPartitions() > 3
        both = files.scan_csv_text(spark, str(tmp_path / "in"), ["ID", "NAME"])
        assert both.rdd.getNumPartitions() > 4
        found = {tuple(r) for r in both.collect()}
        assert len(found) == 20_002 and ("1", "two\nlines") in found and ("2", 'a "quote\n" more') in found
        assert ("7", 'say "7"') in found
        assert files.csv_rejects(spark, str(tmp_path / "in"), ["ID", "NAME"]).isEmpty()
        with pytest.raises(Exception, match="(?i)malformed"):  # split by mistake
            files.scan_csv_text(spark, str(tmp_path / "in" / "b.csv"), ["ID", "NAME"], multi_line=False).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_of_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,NAME\n")
    assert files.scan_csv_text(spark, str(tmp_path), ["ID", "NAME"]).isEmpty()


GOOD = {"id": 1, "title": "T", "category": None, "sku": "S", "meta": {"createdAt": "2024-01-01"}, "unknown": [1]}


def _landed(tmp_path, lines):
    path = tmp_path / "feed.json"
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines) + "\n")
    return str(path)


def test_broken_documents_and_unfit_elements_are_listed(spark, tmp_path):
    bad = [{**GOOD, "id": "abc"}, {**GOOD, "id": "12"}, {**GOOD, "id": 1.5}, {**GOOD, "meta": "text"}, {**GOOD, "id": True}, 7, "x"]
    good = [GOOD, {"id": None}, {}, {**GOOD, "id": 3.0, "meta": None}]
    lines = [{"products": good + bad}, '{"products": [{"id": 1}', {"products": {"id": 1}}, {"total": 0}, "", "   ", {"products": []}]
    path = _landed(tmp_path, lines)
    kept = files.scan_feed(spark, "product", path, one_per_line=True, fail_fast=False)
    assert sorted(map(str, kept.collect())) == sorted(
        map(str, spark.createDataFrame([(1, "T", None, "S", "2024-01-01"), (None,) * 5, (None,) * 5, (3, "T", None, "S", None)], kept.schema).collect())
    )
    rejects = files.feed_rejects(spark, "product", path, one_per_line=True).collect()
    assert sorted(r.reason for r in rejects) == ["document"] * 3 + ["element"] * len(bad)
    assert {json.dumps(json.loads(r.text), sort_keys=True) for r in rejects if r.reason == "element"} == {json.dumps(b, sort_keys=True) for b in bad}
    assert all(r.file.endswith("feed.json") for r in rejects)


@pytest.mark.parametrize(
    "line, message", [('{"products": [{"id": 1}', "a document without an array"), ({"products": [{"id": "abc"}]}, "does not fit")]
)
def test_a_bad_document_fails_the_load(spark, tmp_path, line, message):
    path = _landed(tmp_path, [{"products": [GOOD]}, line])
    with pytest.raises(Exception, match=message):
        files.scan_feed(spark, "product", path, one_per_line=True).select("title").collect()


def test_nested_lines_are_checked_too(spark, tmp_path):
    line = {"id": 1, "price": 2, "quantity": 3, "total": 6.0}
    carts = [{"id": 5, "userId": 3, "products": [line, {**line, "quantity": "many"}]}, {"id": 6, "userId": 3, "products": [line]}]
    path = _landed(tmp_path, [{"carts": carts}])
    kept = files.scan_feed(spark, "order", path, one_per_line=True, fail_fast=False)
    assert [tuple(r) for r in kept.collect()] == [(6, 3, 1, 2.0, 3, 6.0)]
    assert files.feed_rejects(spark, "order", path, one_per_line=True).count() == 1


def test_artifact_documents_are_taken_apart_once_a_level(spark):
    kind = schema(f"{log.RUN_RESULTS_DDL}, run_id string")
    fits = {
        '{"results":[{"unique_id":"u","failures":2},null,{}],"run_id":7}': [2, None, None],
        '{"results":[{"failures":2.0}]}': [2],
        '{"results":[{"failures":"3"}]}': "broken",
        '{"results":[{"failures":1.5}]}': "broken",
        '{"results":{}}': "broken",
        '{"run_id":"a","run_id":"b"}': "broken",
        '[]': "broken",
        "no document": "broken",
    }
    rows = spark.createDataFrame([(text,) for text in fits], "value string").withColumn("document", F.try_parse_json("value"))
    broken = F.struct(F.lit(None).cast(kind["results"].dataType).alias("results"), F.lit("broken").alias("run_id"))
    read = rows.select("value", files.typed_document("value", F.col("document"), kind, broken).alias("d"))
    found = {
        r.value: "broken" if r.d.run_id == "broken" else [None if e is None else e.failures for e in r.d.results]
        for r in read.collect()
    }
    assert found == fits
    # The nested shape of a manifest once repeated its parts a thousand times over.
    assert str(files.typed_variant(F.col("document"), schema(log.MANIFEST_DDL))[1]).count("try_variant_get") < 60
