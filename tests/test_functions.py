"""Column functions, one text in, one value out."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.coverage import coverage_band, gap_to_target, is_below, target_marker
from tidemark.functions.numbers import to_number, to_year
from tidemark.functions.regions import region_key, region_type, region_type_label
from tidemark.functions.text import (
    WHITESPACE,
    is_blank,
    normalise_code,
    null_if_in,
    strip_text,
    to_flag,
)


def each(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


TEXTS = ["a", " a b ", " a　", "\t\x1ca\x85\n", "  ", "", WHITESPACE, "é ", None]


def test_strip_is_what_python_strips(spark):
    assert each(spark, TEXTS, strip_text) == [t if t is None else t.strip() for t in TEXTS]


def test_blank_is_what_python_calls_blank(spark):
    assert each(spark, TEXTS, is_blank) == [t is None or not t.strip() for t in TEXTS]


def test_code_words_for_nothing_are_null(spark):
    given = [" ZAF ", "nan", " None ", "", "  ", "NAN", None]
    assert each(spark, given, normalise_code) == ["ZAF", None, None, None, None, "NAN", None]


def test_null_if_in(spark):
    got = each(spark, ["NA", "na", "", None], lambda c: null_if_in(c, ("NA", "")))
    assert got == [None, "na", None, None]


@pytest.mark.parametrize(
    "text, number",
    [
        ("75", 75.0), (" 12.5 ", 12.5), ("-0.5", -0.5), ("1e2", 100.0), (".5", 0.5),
        ("inf", float("inf")), ("-Infinity", float("-inf")), ("NaN", None), ("nan", None),
        ("abc", None), ("75d", None), ("75f", None), ("1.F", None), ("0x1p3", None),
        ("1_000", None), ("", None), (None, None),
    ],
)
def test_to_number(spark, text, number):
    assert each(spark, [text], to_number) == [number]


def test_to_year(spark):
    given = ["2020", "2020.0", " 2020 ", "2020.5", "n/a", "NaN", "inf", "9e99", "", None]
    assert each(spark, given, to_year) == [2020, 2020, 2020] + [None] * 7


def test_to_flag(spark):
    given = ["True", "False", "true", "weird", "", None]
    assert each(spark, given, to_flag) == [True, False, True, None, None, None]


def test_region_type(spark):
    given = ["ZAF", "KEN", "USA", "OWID_AFR", "OWID_WRL", None, "", "EU", "OWID_"]
    assert each(spark, given, region_type) == [
        "country", "country", "country", "aggregate", "aggregate", "unknown", "unknown", "other",
        "aggregate",
    ]


def test_region_type_rules_are_parameters(spark):
    got = each(spark, ["AGG1", "ABCD"], lambda c: region_type(c, "AGG", 4))
    assert got == ["aggregate", "country"]


def test_region_key_and_label(spark):
    df = spark.createDataFrame(
        [("ZAF", "South Africa"), (None, "South  Africa"), (None, None)], "c string, n string"
    )
    keys = [r[0] for r in df.select(region_key(F.col("c"), F.col("n"))).collect()]
    assert keys == ["ZAF", "south__africa", None]
    kinds = ["country", "aggregate", "other", "unknown"]
    assert each(spark, kinds, region_type_label) == [
        "Country", "Regional aggregate", "Other", "Other",
    ]


def test_coverage_functions_hold_at_the_limits(spark):
    values = ["80.00", "79.99", "50.00", "49.99", "0.00"]
    as_decimal = lambda fn: each(spark, values, lambda c: fn(c.cast("decimal(8,2)")))
    at, mid, low = "At or above WHO target", "Moderate coverage", "Low coverage"
    assert as_decimal(coverage_band) == [at, mid, mid, low, low]
    assert as_decimal(is_below) == [False, True, True, True, True]
    assert as_decimal(target_marker) == ["at_or_above"] + ["below"] * 4
    assert [str(g) for g in as_decimal(gap_to_target)] == ["0.00", "0.01", "30.00", "30.01", "80.00"]
    assert as_decimal(lambda c: is_below(c, 79.99)) == [False, False, True, True, True]
