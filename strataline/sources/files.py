"""CSV and nested-JSON scans."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.operators.conform import as_text, lower_names

# Field texts the text-file readers of the feeds take for NULL.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Document shapes of the API feeds.
PRODUCT_DOCUMENT = (
    "products array<struct<id:bigint,title:string,category:string,sku:string,"
    "meta:struct<createdAt:string>>>"
)
USER_DOCUMENT = (
    "users array<struct<id:bigint,firstName:string,lastName:string,gender:string,"
    "birthDate:string,address:struct<city:string,state:string,stateCode:string,country:string>>>"
)
CART_DOCUMENT = (
    "carts array<struct<id:bigint,userId:bigint,"
    "products:array<struct<id:bigint,price:double,quantity:bigint,total:double>>>>"
)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def null_tokens(column: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~column.isin(*tokens), column)


def scan_csv_text(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool | None = None,
) -> DataFrame:
    """Header CSV with every column as string and lower-case names.

    Fields may be quoted, with doubled quotes, commas and line breaks inside. The schema
    is declared, so there is no inference pass, and the header must agree with it. A row
    with too many or too few fields fails the load; :func:`csv_rejects` lists such rows.

    A file with line breaks inside quotes is read by one task, any other is split. By default
    a pass over the lines finds out which files have some; ``multi_line`` says it for all.
    """
    reader = lambda whole: _csv_reader(spark, columns, whole).option("mode", "FAILFAST")
    raw = lower_names(_csv_files(spark, path, reader, multi_line))
    return raw.select(*[null_tokens(F.col(c), na_tokens).alias(c) for c in raw.columns])


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def open_quoted_files(spark: SparkSession, path: str | Sequence[str]) -> dict[str, bool]:
    """For each file whether some line of it has an odd number of quotes.

    A quote that is open at the end of a line makes its count odd, since quotes inside quotes
    are doubled. One row per file comes back, as many as Spark lists for the scan itself.
    """
    lines = spark.read.text(_paths(path))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    per_file = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max(quotes % 2 == 1).alias("is_open"))
    # The name comes encoded, and would be read as a pattern.
    return {re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(r.file)): r.is_open for r in per_file.collect()}


def _csv_files(
    spark: SparkSession, path: str | Sequence[str], reader: Callable[[bool], DataFrameReader], multi_line: bool | None
) -> DataFrame:
    """The files of a path, each read whole or split."""
    if multi_line is not None:
        return reader(multi_line).csv(_paths(path))
    files = open_quoted_files(spark, path)
    if len(set(files.values())) < 2:
        return reader(any(files.values())).csv(_paths(path))
    split, whole = ([f for f, is_open in files.items() if is_open is wanted] for wanted in (False, True))
    return reader(False).csv(split).unionByName(reader(True).csv(whole))


def _csv_reader(spark: SparkSession, columns: Sequence[str], multi_line: bool) -> DataFrameReader:
    return (
        spark.read.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def csv_rejects(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], multi_line: bool | None = None
) -> DataFrame:
    """The rows of a header CSV that do not have one field per column, as one text each."""
    with_text = text_schema([*columns, "_corrupt_record"])
    reader = lambda whole: (
        _csv_reader(spark, columns, whole)
        .schema(with_text)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
    )
    read = _csv_files(spark, path, reader, multi_line)
    # Every column is asked for: Spark checks only the fields it parses.
    kept = read.filter(F.length(F.concat_ws("", *[F.col(c) for c in columns])) >= 0)
    return kept.filter(F.col("_corrupt_record").isNotNull()).select(
        F.col("_corrupt_record").alias("row")
    )


def scan_csv_typed(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """Header CSV straight into a typed table; no quoting, bad records fail the load."""
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", "")
        .option("mode", mode)
        .csv(paths)
    )


def scan_json_documents(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str,
    main_tag: str,
    one_per_line: bool = False,
    fail_fast: bool = True,
) -> DataFrame:
    """Landed API documents; one row per element of the ``main_tag`` array.

    By default a file is one document and so one task's work: feeds that page their
    responses into many files spread over the cluster. With ``one_per_line`` each
    line is a document and large files are split.

    A document that is no JSON or has no such array, and an element with a value that its field
    cannot hold, fail the load; without ``fail_fast`` they are left out. :func:`json_rejects`
    lists them. Fields that are absent or null are NULL, unknown ones are not read.
    """
    documents, listed, element, value, fits = _json_elements(spark, path, schema, main_tag, one_per_line)
    if fail_fast:
        broken = F.raise_error(F.concat(F.lit(f"a document without an array {main_tag}: "), "file")).cast(_ELEMENTS)
        unfit = F.raise_error(F.concat(F.lit("an element that does not fit: "), F.to_json("e"))).cast(element)
        listed, value = F.coalesce(listed, broken), F.when(fits, value).otherwise(unfit)
    rows = documents.select("file", F.explode(listed).alias("e")).select(value.alias("element"), fits.alias("fits"))
    return (rows if fail_fast else rows.filter("fits")).select("element.*")


def json_rejects(
    spark: SparkSession, path: str | Sequence[str], schema: str, main_tag: str, one_per_line: bool = False
) -> DataFrame:
    """(file, reason, text): documents without the array, and elements that do not fit its type."""
    documents, listed, _, _, fits = _json_elements(spark, path, schema, main_tag, one_per_line)
    broken = documents.filter(listed.isNull()).select("file", F.lit("document").alias("reason"), F.col("value").alias("text"))
    elements_of = documents.select("file", F.explode(listed).alias("e")).filter(~fits)
    return broken.unionByName(elements_of.select("file", F.lit("element").alias("reason"), F.to_json("e").alias("text")))


_ELEMENTS = "array<variant>"


def json_texts(spark: SparkSession, path: str | Sequence[str], one_per_line: bool) -> DataFrame:
    """(file, value): whole files, or the lines that are not blank, with partition columns of the path."""
    texts = spark.read.text(_paths(path), wholetext=not one_per_line)
    named = texts.withColumn("file", F.col("_metadata.file_path"))
    return named.filter(F.trim("value") != "") if one_per_line else named


def _json_elements(
    spark: SparkSession, path: str | Sequence[str], schema: str, main_tag: str, one_per_line: bool
) -> tuple[DataFrame, Column, T.DataType, Column, Column]:
    """The documents; their array, NULL for broken ones; and the type, value and fit of an element ``e``."""
    documents = json_texts(spark, path, one_per_line).select("file", "value", F.try_parse_json("value").alias("document"))
    listed = F.try_variant_get("document", f"$.{main_tag}", _ELEMENTS)
    element = T.StructType.fromDDL(schema)[main_tag].dataType.elementType
    return documents, listed, element, *typed_variant(F.col("e"), element)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression over a value that it uses more than once, and that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def read_variant(value: Column, kind: T.DataType) -> Column:
    """A variant as a declared type, with whether it fits, as struct<value, fits>: null where the
    declaration has a value is fit, text in place of a number, or a fraction in place of a whole
    number, is not. Each level is taken apart once; ``value`` itself should be a plain column."""
    absent = value.isNull() | F.is_variant_null(value)

    def part(typed: T.DataType) -> str:
        return "string" if isinstance(typed, T.StringType) else "variant"  # any value has a text

    def pair(shown: Column, fits: Column) -> Column:
        return F.struct(shown.alias("value"), (absent | fits).alias("fits"))

    if isinstance(kind, T.StructType):
        taken = F.try_variant_get(value, "$", f"struct<{','.join(f'`{f.name}`:{part(f.dataType)}' for f in kind.fields)}>")
        nested = [f for f in kind.fields if part(f.dataType) == "variant"]

        def whole(row: Column, parts: Column | None) -> Column:
            shown = [(parts[f.name]["value"] if f in nested else row[f.name]).alias(f.name) for f in kind.fields]
            fits = reduce(Column.__and__, [parts[f.name]["fits"] for f in nested], row.isNotNull())
            return pair(F.when(row.isNotNull(), F.struct(*shown)), fits)

        def read(row: Column) -> Column:
            if not nested:
                return whole(row, None)
            parts = F.struct(*[read_variant(row[f.name], f.dataType).alias(f.name) for f in nested])
            return bound(parts, lambda p: whole(row, p))

        return bound(taken, read)
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", f"array<{part(kind.elementType)}>")
        if part(kind.elementType) == "string":
            return bound(items, lambda i: pair(i, i.isNotNull()))
        pairs = F.transform(items, lambda e: read_variant(e, kind.elementType))
        return bound(pairs, lambda p: pair(F.transform(p, lambda e: e["value"]), p.isNotNull() & F.forall(p, lambda e: e["fits"])))
    if isinstance(kind, T.MapType):
        entries = F.try_variant_get(value, "$", f"map<string,{part(kind.valueType)}>")
        if part(kind.valueType) == "string":
            return bound(entries, lambda e: pair(e, e.isNotNull()))
        pairs = F.transform_values(entries, lambda _, e: read_variant(e, kind.valueType))
        every = lambda p: F.forall(F.map_values(p), lambda e: e["fits"])
        return bound(pairs, lambda p: pair(F.transform_values(p, lambda _, e: e["value"]), p.isNotNull() & every(p)))
    typed = F.try_variant_get(value, "$", kind.simpleString())
    fits = typed.isNotNull()
    if isinstance(kind, T.IntegralType):
        fits = fits & (typed == F.try_variant_get(value, "$", "decimal(38,9)")) & ~F.schema_of_variant(value).isin("STRING", "BOOLEAN")
    return pair(F.when(fits, typed), fits)


def plainly_fits(text: Column | str, kind: T.StructType) -> Column:
    """Whether Spark's JSON parser finds every object, array and whole number of the declared type in
    its place. True is certain, except that it does not look for repeated names; false is not:
    :func:`read_variant` also takes 2.0 for a whole number."""
    corrupt = "_corrupt_record"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    read = F.from_json(text, T.StructType([*kind.fields, T.StructField(corrupt, T.StringType())]), options)
    return read.isNotNull() & read[corrupt].isNull()


def typed_document(text: Column | str, document: Column, kind: T.StructType, broken: Column) -> Column:
    """A parsed document as a declared type, or ``broken`` if it is none or does not fit.

    Documents that plainly fit are cast as a whole; only others are taken apart level by level.
    """
    checked = lambda r: F.when(r["fits"], r["value"]).otherwise(broken)
    return (
        F.when(document.isNull(), broken)
        .when(plainly_fits(text, kind), F.try_variant_get(document, "$", kind.simpleString()))
        .otherwise(bound(read_variant(document, kind), checked))
    )


def typed_variant(value: Column, kind: T.DataType) -> tuple[Column, Column]:
    """The two parts of :func:`read_variant`, for where only one of them is used."""
    both = read_variant(value, kind)
    return both["value"], both["fits"]


def elements(documents: DataFrame, main_tag: str) -> DataFrame:
    return documents.select(F.inline(main_tag))


def flatten_products(products: DataFrame) -> DataFrame:
    return products.select(
        "id",
        "title",
        "category",
        F.col("sku").alias("pkey"),
        F.col("meta.createdAt").alias("createdAt"),
    )


def flatten_users(users: DataFrame) -> DataFrame:
    return users.select(
        "id",
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        F.col("birthDate").alias("birthdate"),
        F.col("address.city").alias("city"),
        F.col("address.state").alias("state"),
        F.col("address.stateCode").alias("state_code"),
        F.col("address.country").alias("country"),
    )


def flatten_carts(carts: DataFrame) -> DataFrame:
    """One row per cart line, carrying the cart and its customer."""
    lines = carts.select("id", F.col("userId").alias("cust_id"), F.explode("products").alias("line"))
    return lines.select(
        "id",
        "cust_id",
        F.col("line.id").alias("prd_id"),
        F.col("line.price").alias("unit_price"),
        F.col("line.quantity").alias("quantity"),
        F.col("line.total").alias("total_price"),
    )


# The feeds, their document shapes and array names.
FEEDS = {
    "product": (PRODUCT_DOCUMENT, "products", flatten_products),
    "user": (USER_DOCUMENT, "users", flatten_users),
    "order": (CART_DOCUMENT, "carts", flatten_carts),
}


def flatten(data_type: str, records: DataFrame) -> DataFrame:
    if data_type not in FEEDS:
        raise ValueError(f"unknown data type: {data_type!r}")
    return FEEDS[data_type][2](records)


def scan_feed(
    spark: SparkSession,
    data_type: str,
    path: str | Sequence[str],
    one_per_line: bool = False,
    fail_fast: bool = True,
) -> DataFrame:
    """Landed API documents of one feed as a flat table."""
    if data_type not in FEEDS:
        raise ValueError(f"unknown data type: {data_type!r}")
    schema, main_tag, _ = FEEDS[data_type]
    records = scan_json_documents(spark, path, schema, main_tag, one_per_line, fail_fast)
    return flatten(data_type, records)


def feed_rejects(
    spark: SparkSession, data_type: str, path: str | Sequence[str], one_per_line: bool = False
) -> DataFrame:
    """What :func:`scan_feed` fails on or leaves out."""
    if data_type not in FEEDS:
        raise ValueError(f"unknown data type: {data_type!r}")
    schema, main_tag, _ = FEEDS[data_type]
    return json_rejects(spark, path, schema, main_tag, one_per_line)


def bronze_text(df: DataFrame) -> DataFrame:
    """Bronze keeps everything as string, NULL as NULL."""
    return as_text(df)
