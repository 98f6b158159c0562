import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from offerlens.functions import parse


def evaluate(spark, function, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    rows = frame.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()
    return [row["v"] for row in rows]


def python_float(text):
    """(value, accepted) as the engine defines them: NaN is a missing value."""
    try:
        value = float(text)
    except ValueError:
        return None, False
    return (None if math.isnan(value) else value), True


TABLE = [
    "1.8 ", " 1.8", "\xa08 ", "1_000", "1__0", "_1", "1_", "1d", "1f", "0x10", "0x1p3", "inf", "-Infinity", "+inf",
    "nan", "-nan", "1,800", "", " ", ".", ".5", "5.", "5._1", "1e3", "1E+3", "1e", "e3", "+3", "--3", "1 2", "\x1c7\x1f",
    "1e999", "unknown",
]


def test_py_float_table(spark):
    assert evaluate(spark, parse.py_float, TABLE) == [python_float(t)[0] for t in TABLE]
    assert evaluate(spark, parse.is_py_float, TABLE) == [python_float(t)[1] for t in TABLE]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789._eE+- \t\xa0dfxn", max_size=8), min_size=30, max_size=30))
def test_py_float_agrees_with_python(spark, texts):
    assert evaluate(spark, parse.py_float, texts) == [python_float(t)[0] for t in texts]
    assert evaluate(spark, parse.is_py_float, texts) == [python_float(t)[1] for t in texts]


def test_price_removes_both_separators(spark):
    texts = ["1,299.", "1,299.99", "12.", "unknown", " 7 ", None]
    assert evaluate(spark, parse.price_usd, texts) == [1299.0, 129999.0, 12.0, None, 7.0, None]


def test_clock_units(spark):
    texts = ["1.8 GHz", "1800 MHz", "1800", "1.5ghz", "Unknown", "1,800 MHz", "2 GHz MHz", "\xa01.1\xa0GHz"]
    assert evaluate(spark, parse.clock_mhz, texts) == [1800.0, 1800.0, 1800.0, 1500.0, None, None, None, 1100.0]


def test_ram_units_are_decimal_and_mb_goes_first(spark):
    texts = ["512 MB", "8 GB", "8", "UNKNOWN", "1 gbmb", "8 GB GDDR6"]
    assert evaluate(spark, parse.ram_gb, texts) == [512 * 0.001, 8.0, 8.0, None, None, None]


@pytest.mark.parametrize(
    "function, good, bad",
    [
        (parse.bad_price, ["1,299.", "unknown", "unk.nown", "nan", None], ["Unknown", "$5", "", "1d"]),
        (parse.bad_clock, ["1.8 GHz", "UNKNOWN", "7", "nan", None], ["1,800 MHz", "unknownghz", "fast", ""]),
        (parse.bad_ram, ["512 MB", "Unknown", "7", None], ["8 GB GDDR6", "unknownmb", "", "0x8"]),
    ],
)
def test_bad_cells(spark, function, good, bad):
    assert evaluate(spark, function, good + bad) == [False] * len(good) + [True] * len(bad)


def test_trim_strips_what_python_strips(spark):
    texts = [" a\t", "\xa0a b　", "‎a‎", "\x1fa", ""]
    assert evaluate(spark, parse.trim, texts) == [t.strip() for t in texts]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=10**9), min_size=20, max_size=20))
def test_plain_numbers_pass_every_parser_unchanged(spark, numbers):
    texts = [str(n) for n in numbers]
    for function in (parse.price_usd, parse.clock_mhz, parse.ram_gb):
        assert evaluate(spark, function, texts) == [float(n) for n in numbers]
