import math

import pytest
from pyspark.sql import functions as F

from tempestry.functions import (
    bare_suffix,
    label_or,
    magnitude_band,
    measure_parses,
    parse_amount,
    safe_float,
    safe_int,
    severe_by_impact,
    severe_by_scale,
    valid_magnitude,
)
from tempestry.schema import HARM_COLUMNS

NAN = math.nan

# text, strict int, int via double, double, amount
CASES = [
    ("12.7", None, 12, 12.7, 12.7),
    (" 5 ", 5, 5, 5.0, 5.0),
    ("nan", None, None, NAN, NAN),
    ("inf", None, None, math.inf, math.inf),
    ("-Infinity", None, None, -math.inf, -math.inf),
    ("", None, None, None, None),
    ("abc", None, None, None, None),
    ("-3.9", None, -3, -3.9, -3.9),
    ("1e3", None, 1000, 1000.0, 1000.0),
    ("50.00K", None, None, None, 50000.0),
    ("2.5M", None, None, None, 2500000.0),
    ("1B", None, None, None, 1.0e9),
    ("K", None, None, None, None),
    ("5k", None, None, None, None),
    ("0", 0, 0, 0.0, 0.0),
    ("5.", None, 5, 5.0, 5.0),
    (".5", None, 0, 0.5, 0.5),
    ("5d", None, None, None, None),
    ("5f", None, None, None, None),
    ("0x1p3", None, None, None, None),
    ("5dK", None, None, None, None),
    ("99999999999", None, None, 99999999999.0, 99999999999.0),
    (None, None, None, None, None),
]


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_text_to_numbers(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "t string")
    rows = df.select(
        "t",
        safe_int("t").alias("strict"),
        safe_int("t", via_float=True).alias("via"),
        safe_float("t").alias("double"),
        parse_amount("t").alias("amount"),
    ).collect()
    for row, case in zip(rows, CASES):
        assert all(same(a, b) for a, b in zip(row, case)), (row, case)


def test_defaults_follow_the_variant(spark):
    df = spark.createDataFrame([("3.0",), ("x",), (None,)], "t string")
    rows = df.select(
        safe_int("t", 0), safe_int("t", 0, via_float=True), safe_float("t", 0.0)
    ).collect()
    assert [tuple(r) for r in rows] == [(0, 3, 3.0), (0, 0, 0.0), (0, 0, 0.0)]


@pytest.mark.parametrize(
    "text", ["", "  ", "3", "3.7", "-1", "1e2", "x", "nan", "inf", "50K", "99999999999", "1e30"]
)
def test_measure_parses_as_python_would(spark, text):
    def reference(value):
        try:
            number = int(float(value)) if value and value.strip() else 0
        except (ValueError, OverflowError):
            return False
        return abs(number) < 2**63

    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(measure_parses("t")).head()[0] == reference(text)


def test_labels_and_suffixes(spark):
    df = spark.createDataFrame([("",), (None,), ("K",), (" ",)], "t string")
    rows = df.select(label_or("t", "NONE"), F.coalesce(bare_suffix("t"), F.lit(False))).collect()
    assert [tuple(r) for r in rows] == [
        ("NONE", False),
        ("NONE", False),
        ("K", True),
        (" ", False),
    ]


def test_bands_are_half_open(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (50.0,), (100.0,), (None,)], "m double")
    rows = [r[0] for r in df.select(magnitude_band("m")).collect()]
    assert rows == ["0–10", "10–20", "50–100", ">100", None]


def test_valid_magnitude_drops_zero_and_nan(spark):
    text = spark.createDataFrame([("0",), ("nan",), ("x",), ("7.5",), ("inf",)], "MAGNITUDE string")
    assert [r[0] for r in text.select(valid_magnitude(text)).collect()] == [
        None, None, None, 7.5, math.inf,
    ]


def test_severity_thresholds_are_strict(spark):
    columns = ["DAMAGE_PROPERTY", "DAMAGE_CROPS", *HARM_COLUMNS, "TOR_F_SCALE"]
    rows = [
        ("50.00K", "50000", "3", "2", "0", "0", "EF2"),
        ("50.01K", "", "0", "0", "0", "0", None),
        ("", "1M", "0", "0", "0", "0", "EF3"),
        ("", "", "6", "0", "0", "0", "EF5"),
        ("", "", "0", "0", "0", "1", ""),
        ("60000", "", "x", "3.0", "0", "0", "EF4"),
    ]
    df = spark.createDataFrame(rows, [f"{c}" for c in columns])
    flags = df.select(
        severe_by_impact(df), severe_by_impact(df, parse_suffix=False), severe_by_scale()
    ).collect()
    assert [tuple(f) for f in flags] == [
        (False, False, False),
        (True, False, False),
        (True, False, True),
        (True, True, True),
        (True, True, False),
        (True, True, True),
    ]
