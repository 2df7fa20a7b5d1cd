from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataline.functions import codes, dates, keys, numbers, text

D = dt.date


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("\t a b \r\n", "a b"),
        (" x　", "x"),
        ("plain", "plain"),
        ("", ""),
        (None, None),
    ],
)
def test_trim_all(evaluate, raw, expected):
    assert evaluate(text.trim_all("t"), [(raw,)], "t string") == [expected]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("n/a", "N/A"),
        ("bib-shorts", "Bib-Shorts"),
        ("bottles and cages", "Bottles And Cages"),
        ("  two  blanks ", "  Two  Blanks "),
        ("it's", "It's"),
        ("RED_hat.v2", "Red_Hat.V2"),
        ("", ""),
        (None, None),
    ],
)
def test_capitalise_words(evaluate, raw, expected):
    assert evaluate(text.capitalise_words("t"), [(raw,)], "t string") == [expected]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("the lord OF the rings", "The Lord of the Rings"),
        ("N/A", "n/a"),
        ("a tale of two cities ", "A Tale of Two Cities"),
        (" the end", " the End"),
        ("double  blank", "Double  Blank"),
        (None, None),
    ],
)
def test_title_case(evaluate, raw, expected):
    assert evaluate(text.title_case("t"), [(raw,)], "t string") == [expected]


def test_title_case_without_marker(evaluate):
    assert evaluate(text.title_case("t", False), [("n/a",)], "t string") == ["N/a"]


def test_capitalise_first(evaluate):
    rows = [("  jANE ",), (None,), ("x",)]
    assert evaluate(text.capitalise_first("t"), rows, "t string") == ["Jane", "n/a", "X"]


def test_outer_whitespace_modes(evaluate):
    rows = [(" a",), ("a ",), ("a",), ("\ta",), (None,)]
    both = evaluate(text.has_outer_whitespace("t"), rows, "t string")
    leading = evaluate(text.has_outer_whitespace("t", leading_only=True), rows, "t string")
    assert both == [True, True, False, True, None]
    assert leading == [True, False, False, False, None]


def test_zero_padding_never_cuts(evaluate):
    assert evaluate(text.zero_padded("n", 4), [(7,), (12345,)], "n bigint") == ["0007", "12345"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("19990131", D(1999, 1, 31)),
        ("0", None),
        ("5489", None),
        ("20250230", None),
        ("199901311", None),
        ("text", None),
        (None, None),
    ],
)
def test_compact_day(evaluate, raw, expected):
    assert evaluate(dates.compact_day("t"), [(raw,)], "t string") == [expected]


def test_horizon_edges(evaluate):
    rows = [(D(1899, 12, 31),), (D(1900, 1, 1),), (D(2000, 1, 1),), (D(2000, 1, 2),)]
    closed = evaluate(dates.within_horizon("d", "2000-01-01"), rows, "d date")
    open_end = evaluate(dates.within_horizon("d", "2000-01-01", False), rows, "d date")
    strict = evaluate(dates.strictly_between_horizons("d", "2000-01-01"), rows, "d date")
    assert closed == [None, D(1900, 1, 1), D(2000, 1, 1), None]
    assert open_end == [None, D(1900, 1, 1), None, None]
    assert strict == [None, None, None, None]


@pytest.mark.parametrize(
    ("born", "kept"),
    [
        (D(1899, 12, 31), False),
        (D(1900, 1, 1), True),
        (D(1981, 12, 31), True),
        (D(1982, 1, 1), True),
        (D(1982, 1, 2), False),
        (None, False),
    ],
)
def test_birthdates(evaluate, born, kept):
    result = evaluate(dates.plausible_birthdate("d", "2000-01-01"), [(born,)], "d date")
    assert result == [born if kept else None]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("2024-01-05", D(2024, 1, 5)), ("2024", None), ("2024-02-30", None), ("x", None)],
)
def test_iso_day_wants_a_full_day(evaluate, raw, expected):
    assert evaluate(dates.iso_day("t"), [(raw,)], "t string") == [expected]


def test_iso_instant_day_is_utc(spark, evaluate):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        result = evaluate(dates.iso_instant_day("t"), [("2024-05-23T23:30:00.000Z",)], "t string")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert result == [D(2024, 5, 23)]


@pytest.mark.parametrize(
    ("born", "as_of", "age"),
    [
        (D(2000, 2, 29), "2021-02-28", 20),
        (D(2000, 2, 29), "2021-03-01", 21),
        (D(1980, 5, 10), "2020-05-09", 39),
        (D(1980, 5, 10), "2020-05-10", 40),
    ],
)
def test_age(evaluate, born, as_of, age):
    assert evaluate(dates.age_in_years("d", as_of), [(born,)], "d date") == [age]


def test_age_bands(evaluate):
    ages = [(n,) for n in (17, 18, 24, 25, 44, 64, 65, 99)]
    bands = evaluate(dates.age_band("a"), ages, "a int")
    assert bands == ["65+", "18-24", "18-24", "25-34", "35-44", "55-64", "65+", "65+"]
    order = evaluate(dates.age_band_order("b"), [("18-24",), ("65+",), ("45-54",)], "b string")
    assert order == [1, 6, 4]


def test_seasons(evaluate):
    days = [(D(2020, month, 15),) for month in range(1, 13)]
    assert evaluate(dates.season_number("d"), days, "d date") == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]


# (sales, quantity, price) -> repaired (sales, quantity, price)
SALES = [
    ((None, 2, 5), (10, 2, 5)),
    ((9, 2, 5), (10, 2, 5)),
    ((9, 0, 5), (5, 0, 5)),
    ((9, None, 5), (9, 1, 5)),
    ((9, -2, 5), (10, 2, 5)),
    ((10, 2, 0), (0, 2, 5)),
    ((10, 2, None), (10, 2, 5)),
    ((-10, 2, -5), (-10, 2, 5)),
    ((10, -2, -5), (10, 2, 5)),
    ((None, None, 5), (None, 1, 5)),
    ((None, None, None), (None, 1, None)),
    ((10, 0, 0), (0, 0, 0)),
]


@pytest.mark.parametrize(("stated", "repaired"), SALES)
def test_sales_repair(spark, stated, repaired):
    def money(value):
        return None if value is None else Decimal(value)

    row = (money(stated[0]), stated[1], money(stated[2]))
    frame = spark.createDataFrame([row], "s decimal(27,9), q bigint, p decimal(27,9)")
    s, q, p = F.col("s"), F.col("q"), F.col("p")
    result = frame.select(
        numbers.repair_sales(s, q, p), numbers.repair_quantity(q), numbers.repair_price(p, s, q)
    ).first()
    assert tuple(result) == (money(repaired[0]), repaired[1], money(repaired[2]))


@pytest.mark.parametrize(
    ("total", "quantity", "price", "expected"),
    [
        (None, 2, 5.0, 10.0),
        (9.0, 2, 5.0, 10.0),
        (9.0, 0, 5.0, 5.0),
        (0.0, 0, 5.0, 0.0),
        (9.0, -2, 5.0, 10.0),
        (-10.0, -2, 5.0, -10.0),
        (9.0, None, 5.0, 9.0),
        (None, None, 5.0, None),
    ],
)
def test_total_repair(evaluate, total, quantity, price, expected):
    expression = numbers.repair_total(F.col("t"), F.col("p"), F.col("q"))
    row = [(total, quantity, price)]
    assert evaluate(expression, row, "t double, q bigint, p double") == [expected]


def test_first_generation_total_keeps_missing(evaluate):
    expression = numbers.repair_total(F.col("t"), F.col("p"), F.col("q"), rebuild_missing=False)
    assert evaluate(expression, [(None, 2, 5.0)], "t double, q bigint, p double") == [None]


def test_at_least_one(evaluate):
    rows = [(0,), (None,), (-3,), (4,)]
    assert evaluate(numbers.at_least_one(F.col("q")), rows, "q bigint") == [1, 1, 3, 4]


def test_safe_ratio(evaluate):
    rows = [(5.0, 2.0), (5.0, 0.0), (None, 2.0)]
    result = evaluate(numbers.safe_ratio("a", "b"), rows, "a double, b double")
    assert result == [2.5, None, None]


def test_rounding_is_half_away_from_zero(evaluate):
    rows = [(Decimal("2.345"),), (Decimal("-2.345"),)]
    assert evaluate(F.round("d", 2), rows, "d decimal(10,3)") == [Decimal("2.35"), Decimal("-2.35")]


def test_code_maps(evaluate):
    rows = [(" s ",), ("m",), (None,), ("X",)]
    labels = evaluate(codes.map_codes("t", codes.MARITAL_CODES), rows, "t string")
    assert labels == ["Single", "Married", "n/a", "n/a"]


def test_maintenance_codes_are_not_trimmed(evaluate):
    rows = [("y",), (" y",), ("NO",)]
    labels = evaluate(codes.map_codes("t", codes.YES_NO_CODES, trim=False), rows, "t string")
    assert labels == ["Yes", "n/a", "No"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("US", "United States"),
        ("usa", "United States"),
        (" aus", "Australia"),
        ("", "n/a"),
        (" ", "n/a"),
        (None, "n/a"),
        ("France\r", "France"),
        (" Spain ", "Spain"),
    ],
)
def test_country_map_keeps_other_text(evaluate, raw, expected):
    expression = codes.map_codes_or_keep("t", codes.COUNTRY_CODES)
    assert evaluate(expression, [(raw,)], "t string") == [expected]


@pytest.mark.parametrize("raw", ["dummy-7", "0007", " 7 ", "7", "dummy- 7"])
def test_numeric_id(evaluate, raw):
    assert evaluate(codes.numeric_id("t"), [(raw,)], "t string") == [7]


def test_numeric_id_rejects_other_text(evaluate):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(codes.numeric_id("t"), [("seven",)], "t string")


def test_drop_prefix_only_at_start(evaluate):
    rows = [("NASAW1",), ("AWNAS1",), (None,)]
    assert evaluate(codes.drop_prefix("t", "NAS"), rows, "t string") == ["AW1", "AWNAS1", None]


def test_composite_key(evaluate):
    rows = [("CO-RF-FR-R92B-58",)]
    assert evaluate(codes.category_of_key("t"), rows, "t string") == ["CO_RF"]
    assert evaluate(codes.number_of_key("t"), rows, "t string") == ["FR-R92B-58"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("BEA-ESS-ESS-001", "BEA-ESS-ESS-001"),
        ("bea_ess_ess_001", "BEA-ESS-ESS-001"),
        ("BEA-ESS-ESS-001-42", "BEA-ESS-ESS-001"),
        (" ABC-1 ", "ABC-1"),
    ],
)
def test_sku(evaluate, raw, expected):
    assert evaluate(codes.normalise_sku("t"), [(raw,)], "t string") == [expected]


def test_prefer(evaluate):
    rows = [("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male")]
    result = evaluate(codes.prefer("a", "b"), rows, "a string, b string")
    assert result == ["Male", "Female", "n/a", "Male"]


def test_surrogate_key_matches_published_hash(evaluate):
    import hashlib

    rows = [("1", "csv"), (None, "csv")]
    result = evaluate(keys.surrogate_key("a", "b"), rows, "a string, b string")
    texts = ["1-csv", "_dbt_utils_surrogate_key_null_-csv"]
    assert result == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_source_prefix(evaluate):
    rows = [("1", "csv"), ("1", "api"), ("1", "web")]
    result = evaluate(keys.source_id("a", "b"), rows, "a string, b string")
    assert result == ["CSV-1", "API-1", "Unknown"]


def test_products_keep_nine_decimals_and_never_abort(evaluate):
    from strataline.functions import numbers

    rows = [
        ("2.000000001", 20_000_000_000),
        ("123456789012345678901.5", 3),
        ("9999999999999999999999999999", 1_000_000_000),  # does not fit
        ("-0.000000003", 7),
        (None, 4),
        ("1", None),
    ]
    ddl = "price string, quantity bigint"
    price, quantity = F.col("price").try_cast(numbers.AMOUNT), F.col("quantity")
    products = evaluate(numbers.expected_sales(price, quantity), rows, ddl)
    assert [None if p is None else format(p.normalize(), "f") for p in products] == [
        "40000000020", "370370367037037036704.5", None, "-0.000000021", None, None,
    ]
    assert evaluate(numbers.does_not_fit(price, quantity), rows, ddl) == [False, False, True] + [False] * 3
    total = F.lit("5").cast(numbers.AMOUNT)
    repaired = evaluate(numbers.repair_sales(total, quantity, price), rows, ddl)
    assert [None if p is None else float(p) for p in repaired] == [40000000020, 370370367037037036704.5, None, 2.1e-08, 5, 5]
    first = evaluate(numbers.repair_sales_when_not_positive(F.lit(None).cast(numbers.AMOUNT), quantity, price), rows, ddl)
    assert [None if p is None else float(p) for p in first][:3] == [40000000020, 370370367037037036704.5, None]


def test_first_generation_price_keeps_its_sign(evaluate):
    from strataline.functions import numbers

    rows = [("-10", -4, None), ("-10", 4, "0"), ("-10", 4, "-3"), ("9", 0, None)]
    columns = [F.col("s").try_cast(numbers.AMOUNT), F.col("q")]
    price = F.col("p").try_cast(numbers.AMOUNT)
    shown = lambda sign: [None if v is None else float(v) for v in evaluate(numbers.repair_price(price, *columns, keep_sign=sign), rows, "s string, q bigint, p string")]
    assert shown(True) == [2.5, -2.5, 3.0, None]
    assert shown(False) == [-2.5, -2.5, 3.0, None]


@pytest.mark.parametrize(
    "sales, quantity, price, expected",
    [
        ("10", 2, "0", ("10", 2, "5")),  # a zero price is the total spread over the quantity
        ("-6", 2, "-3", ("6", 2, "3")),  # both negative
        (None, None, "4", ("4", 1, "4")),
        ("9", 0, "4", ("4", 1, "4")),
        ("0", 0, None, ("0", 1, "0")),
        (None, 3, None, (None, 3, None)),
        (None, 3, "0", ("0", 3, "0")),
        ("10", 3, None, ("9.999999999", 3, "3.333333333")),
        ("1", -2, "7", ("14", 2, "7")),
        (None, 10**18, "9" * 20, (None, 10**18, "9" * 20)),  # does not fit
    ],
)
def test_strict_lines_agree_with_themselves(spark, sales, quantity, price, expected):
    row = [(sales and Decimal(sales), quantity, price and Decimal(price))]
    line = spark.createDataFrame(row, f"s {numbers.AMOUNT}, q bigint, p {numbers.AMOUNT}").select(
        numbers.consistent_line(F.col("s"), F.col("q"), F.col("p")).alias("line")
    ).first().line
    assert tuple(line) == tuple(Decimal(v) if isinstance(v, str) else v for v in expected)
    if line.sales is not None:
        assert line.sales == line.price * line.quantity
