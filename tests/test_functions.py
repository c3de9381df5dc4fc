from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fiscora import functions as fn

MAX, MIN = 2**63 - 1, -(2**63)
getcontext().prec = 80


def evaluate(spark, column, schema, *values):
    frame = spark.createDataFrame([values], schema)
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("100", 100),
        ("-7", -7),
        ("None", None),
        ("-", None),
        ("N/A", None),
        ("", None),
        (None, None),
        ("bad-number", None),
        ("1.5", None),
        ("1e3", None),
        ("9223372036854775807", MAX),
        ("-9223372036854775808", MIN),
        ("9223372036854775808", None),
    ],
)
def test_safe_integer(spark, text, expected):
    assert evaluate(spark, fn.safe_integer(F.col("t")), "t string", text) == expected
    # the sentinel step changes nothing, because no sentinel reads as a number
    cleaned = fn.safe_integer(fn.null_if_sentinel(F.col("t")))
    assert evaluate(spark, cleaned, "t string", text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("20.125", "20.125000000"),
        ("0", "0E-9"),
        ("0.0000000005", "1E-9"),
        ("-0.0000000005", "-1E-9"),
        ("1e2", "100.000000000"),
        ("1e100", None),
        ("None", None),
        ("", None),
        ("bad", None),
    ],
)
def test_safe_numeric(spark, text, expected):
    value = evaluate(spark, fn.safe_numeric(F.col("t")), "t string", text)
    assert value == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-12-31", date(2025, 12, 31)),
        ("2025-1-5", date(2025, 1, 5)),
        ("2025", None),
        ("2025-12", None),
        ("2025-02-30", None),
        ("2025-12-31T00:00:00", None),
        ("broken-date", None),
        ("None", None),
        (None, None),
    ],
)
def test_safe_date(spark, text, expected):
    assert evaluate(spark, fn.safe_date(F.col("t")), "t string", text) == expected


def test_sentinels_only_exact_text(spark):
    values = ["None", "-", "N/A", "", "none", " - ", "0"]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    kept = [r[0] for r in frame.select(fn.null_if_sentinel(F.col("t"))).collect()]
    assert kept == [None, None, None, None, "none", " - ", "0"]


@pytest.mark.parametrize(
    ("a", "b", "added", "subtracted"),
    [(1, 2, 3, -1), (MAX, 1, None, MAX - 1), (MIN, 1, MIN + 1, None), (None, 1, None, None), (0, 0, 0, 0)],
)
def test_safe_add_and_subtract(spark, a, b, added, subtracted):
    schema = "a bigint, b bigint"
    assert evaluate(spark, fn.safe_add(F.col("a"), F.col("b")), schema, a, b) == added
    assert evaluate(spark, fn.safe_subtract(F.col("a"), F.col("b")), schema, a, b) == subtracted


@pytest.mark.parametrize(
    ("reported", "a", "b", "expected"),
    [(150, 80, 20, 150), (None, 80, 20, 100), (None, 80, None, None), (None, MAX, 1, None), (0, 5, 5, 0)],
)
def test_first_or_sum(spark, reported, a, b, expected):
    column = fn.first_or_sum(F.col("r"), F.col("a"), F.col("b"))
    assert evaluate(spark, column, "r bigint, a bigint, b bigint", reported, a, b) == expected


def quotient(a, b):
    if a is None or not b:
        return None
    return (Decimal(a) / Decimal(b)).quantize(Decimal("0.000000001"), rounding=ROUND_HALF_UP)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(MIN, MAX), st.integers(MIN, MAX)), min_size=20, max_size=40))
def test_exact_ratio_and_growth_match_decimal_arithmetic(spark, pairs):
    pairs = [*pairs, (1, 0), (0, 5), (1, 3), (2, 3), (-1, 3), (MAX, -MAX), (MIN, 1)]
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    found = frame.select(a, b, fn.exact_ratio(a, b), fn.growth(a, b)).collect()
    for x, y, ratio, change in found:
        assert ratio == quotient(x, y)
        assert change == quotient(x - y, y)


def test_growth_survives_integer_extremes(spark):
    column = fn.growth(F.col("a"), F.col("b"))
    assert evaluate(spark, column, "a bigint, b bigint", MAX, -MAX) == -2


def test_cents_to_dollars(spark):
    assert evaluate(spark, fn.cents_to_dollars(F.col("c")), "c bigint", 1234) == Decimal("12.34")
    assert evaluate(spark, fn.cents_to_dollars(F.col("c")), "c bigint", None) is None


def test_json_scalar_is_null_for_subtrees(spark):
    raw = '{"a":"x","b":{"c":1},"d":[1],"52WeekHigh":1.5,"e":null,"f":true,"g":"{\\"c\\":1}"}'
    names = ["a", "b", "d", "52WeekHigh", "e", "f", "g", "absent"]
    frame = spark.createDataFrame([(raw,), ("not json",)], "raw string")
    found = [tuple(r) for r in frame.select(*(fn.json_scalar(F.col("raw"), n) for n in names)).collect()]
    assert found[0] == ("x", None, None, "1.5", None, "true", '{"c":1}', None)
    assert found[1] == (None,) * len(names)


def test_business_date_crosses_midnight(spark):
    column = fn.business_date(F.col("ts"))
    assert evaluate(spark, column, "ts timestamp_ntz", datetime(2026, 9, 7, 2)) == date(2026, 9, 6)
    assert evaluate(spark, column, "ts timestamp_ntz", datetime(2026, 9, 7, 4)) == date(2026, 9, 7)


def test_weekday_starts_on_monday(spark):
    assert evaluate(spark, fn.weekday(F.col("d")), "d date", date(2026, 9, 7)) == 0
    assert evaluate(spark, fn.weekday(F.col("d")), "d date", date(2026, 9, 13)) == 6


@pytest.mark.parametrize(
    ("message", "expected"),
    [
        ("https://feed.test/q?apikey=k-99&n=5", "https://feed.test/q?apikey=***REDACTED_API_KEY***&n=5"),
        ("we know the API key as QQ_77, twice", "we know the API key as ***REDACTED_API_KEY***, twice"),
        ("body s3cret$1 end", "body ***REDACTED_API_KEY*** end"),
        (None, ""),
    ],
)
def test_redact_api_keys(spark, message, expected):
    assert evaluate(spark, fn.redact_api_keys(F.col("m"), ["s3cret$1", ""]), "m string", message) == expected


def test_redact_secrets_and_reason(spark):
    text = "Api-Key=a&token=b password=c Rate-Limit"
    masked = "Api-Key=***REDACTED***&token=***REDACTED*** password=***REDACTED*** Rate-Limit"
    assert evaluate(spark, fn.redact_secrets(F.col("m")), "m string", text) == masked
    assert evaluate(spark, fn.failure_reason(F.col("m")), "m string", text) == "rate_limit"
    assert evaluate(spark, fn.failure_reason(F.col("m")), "m string", "boom") == "task_failure"
