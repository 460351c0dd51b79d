"""Unpivot, metadata, region standards, validation and flags on rows made for the purpose."""

import math

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.config import Indicator, Settings
from tidemark.operators.regions import (
    fill_from_alias,
    first_seen_dimension,
    standardise_regions,
)
from tidemark.operators.reshape import (
    apply_indicator_metadata,
    coerce_numeric,
    unpivot_indicators,
)
from tidemark.operators.validate import (
    reject_summary,
    row_rules,
    split_valid,
    with_estimated_flag,
    with_missing_flag,
    with_reject_reason,
)
from tidemark.plans.tidy import seen_regions, tidy_long, typed_wide

SETTINGS = Settings()
RULES = lambda: row_rules(SETTINGS, 2026)
LONG = "source_row bigint, region_name string, iso_code string, year int, indicator_code string, value double"


def long_rows(spark, **change):
    row = {"source_row": 1, "region_name": "Testland", "iso_code": "TST", "year": 2020,
           "indicator_code": "dtp3", "value": 75.0, **change}
    return spark.createDataFrame([tuple(row.values())], LONG)


def regions(spark, name, code):
    return spark.createDataFrame([(name, code)], "region_name string, iso_code string")


# Unpivot and metadata


def test_unpivot_keeps_nulls_and_leaves_out_unknown_columns(spark):
    df = spark.createDataFrame([("A", "1", None, "x")], "id string, `a.b` string, c string, d string")
    wanted = [Indicator(n, n, n, n, n) for n in ("a.b", "c", "not there")]
    got = rows(unpivot_indicators(df, wanted, ["id"]))
    assert got == [("A", "a.b", "1"), ("A", "c", None)]


def test_unpivot_without_any_known_column_is_empty(spark):
    df = spark.createDataFrame([("A", "1")], "id string, x string")
    out = unpivot_indicators(df, SETTINGS.indicators, ["id"])
    assert out.columns == ["id", "indicator_source_col", "value"] and out.count() == 0


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("7", "x"), ("inf", None)], "a string, b string")
    got = [tuple(r) for r in coerce_numeric(df, ["a", "b"]).collect()]
    assert got == [(7.0, None), (math.inf, None)]


@pytest.mark.parametrize("indicator", SETTINGS.indicators)
def test_known_indicators_are_described(spark, indicator):
    df = spark.createDataFrame([(indicator.source_col, 72.0)], "indicator_source_col string, value double")
    got = apply_indicator_metadata(df, SETTINGS.indicators).first()
    assert got.indicator_code == indicator.code and got.indicator_name == indicator.name
    assert (got.indicator_category, got.indicator_unit) == ("vaccination", "%")


def test_unknown_indicators_are_dropped(spark):
    df = spark.createDataFrame([("No Such Indicator",)], "indicator_source_col string")
    assert apply_indicator_metadata(df, SETTINGS.indicators).count() == 0


# Regions


@pytest.mark.parametrize(
    "name, code, expected",
    [
        ("  South Africa  ", "ZAF", ("South Africa", "ZAF", "country", "ZAF")),
        ("South Africa", None, ("South Africa", None, "unknown", "south_africa")),
        ("South Africa", "nan", ("South Africa", None, "unknown", "south_africa")),
        (" South Africa", " None ", ("South Africa", None, "unknown", "south_africa")),
        ("Africa", "OWID_AFR", ("Africa", "OWID_AFR", "aggregate", "OWID_AFR")),
        ("Europe", " EU ", ("Europe", "EU", "other", "EU")),
        (None, None, (None, None, "unknown", None)),
    ],
)
def test_standardise(spark, name, code, expected):
    got = standardise_regions(regions(spark, name, code))
    assert rows(got, "region_name", "iso_code", "region_type", "region_key") == [expected]


def test_alias_fills_only_missing_codes_and_the_last_row_counts(spark):
    aliases = spark.createDataFrame(
        [("DR Congo", "XXX", 1), ("DR Congo", "COD", 2), ("Kenya", "YYY", 3), ("Nowhere", None, 4)],
        "alias string, iso_code string, alias_row bigint",
    )
    df = spark.createDataFrame(
        [(" DR Congo", None), ("DR Congo", "nan"), ("Kenya", "KEN"), ("dr congo", None), ("Nowhere", "")],
        "region_name string, iso_code string",
    )
    got = rows(standardise_regions(df, aliases), "region_name", "iso_code")
    assert got == sorted(
        [("DR Congo", "COD"), ("DR Congo", "COD"), ("Kenya", "KEN"), ("dr congo", None), ("Nowhere", None)],
        key=repr,
    )
    assert fill_from_alias(df, aliases.limit(0)).count() == 5


def test_first_seen_takes_the_attributes_of_the_first_row(spark):
    df = spark.createDataFrame(
        [("K", "late", 9), ("K", "early", 2), ("K", "late", 1), ("L", None, 5), ("L", "named", 6),
         ("M", "unseen", None)],
        "key string, name string, at int",
    )
    got = rows(first_seen_dimension(df, "key", ["name"], F.col("at")))
    assert got == [("K", "late"), ("L", None)]


def test_regions_are_seen_in_the_order_of_a_melt(spark):
    """All rows of the first column come before any row of the second."""
    settings = Settings(indicators=tuple(Indicator(c, c, c, "x", "%") for c in ("b", "a")))
    wide = spark.createDataFrame(
        [(0, "Old", "AAA", "2020", "999", "5"), (1, "New", "AAA", "2020", "7", "7")],
        "source_row bigint, region_name string, iso_code string, year string, a string, b string",
    )
    dim = seen_regions(typed_wide(wide, settings), settings, 2026).select("region_key", "region_name")
    # Column a comes first in the file; its value in row 0 is rejected, so row 1 is seen first.
    assert rows(dim) == [("AAA", "New")]


def test_a_region_is_seen_only_in_valid_rows(spark):
    settings = Settings(indicators=(Indicator("a", "a", "a", "x", "%"), Indicator("b", "b", "b", "x", "%")))
    wide = spark.createDataFrame(
        [(0, "X", "XXX", "1900", "1", "1"), (1, "Y", "YYY", "2020", "101", "-1"),
         (2, "Z", "ZZZ", "2020", None, "-1"), (3, " ", "WWW", "2020", "1", "1")],
        "source_row bigint, region_name string, iso_code string, year string, a string, b string",
    )
    assert rows(seen_regions(typed_wide(wide, settings), settings, 2026), "region_key") == [("ZZZ",)]
    valid, _ = split_valid(tidy_long(wide, settings, carry=["source_row"]), row_rules(settings, 2026))
    assert {r[0] for r in rows(valid, "region_key")} == {"ZZZ"}


# Validation


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, ""),
        ({"year": 1979}, "invalid_year"),
        ({"year": 1900}, "invalid_year"),
        ({"year": None}, "invalid_year"),
        ({"year": 1980}, ""),
        ({"year": 2027}, ""),
        ({"year": 2028}, "invalid_year"),
        ({"region_name": None}, "missing_region"),
        ({"region_name": "   "}, "missing_region"),
        ({"region_name": " "}, "missing_region"),
        ({"value": 101.0}, "value_out_of_range"),
        ({"value": -0.5}, "value_out_of_range"),
        ({"value": math.inf}, "value_out_of_range"),
        ({"value": None}, ""),
        ({"value": 0.0}, ""),
        ({"value": 100.0}, ""),
        ({"year": 1900, "region_name": None}, "invalid_year|missing_region"),
        (
            {"year": None, "region_name": "", "value": 200.0},
            "invalid_year|missing_region|value_out_of_range",
        ),
    ],
)
def test_rules(spark, change, reason):
    df = long_rows(spark, **change)
    assert with_reject_reason(df, RULES()).first().reject_reason == reason
    valid, rejected = split_valid(df, RULES())
    assert (valid.count(), rejected.count()) == ((0, 1) if reason else (1, 0))
    if reason:
        assert rejected.first().reject_reason == reason


def test_flags_and_summary(spark):
    df = spark.createDataFrame(
        [(None, False), (None, True), (1.0, False), (1.0, True)], "value double, is_revised boolean"
    )
    flagged = with_estimated_flag(with_missing_flag(df))
    got = [(r.is_missing, r.is_estimated) for r in flagged.collect()]
    assert got == [(True, True), (True, True), (False, False), (False, True)]
    rejects = spark.createDataFrame([("a",), ("a|b",), ("b|c|a",)], "reject_reason string")
    assert rows(reject_summary(rejects)) == [("a", 3), ("b", 2), ("c", 1)]


def test_nan_is_missing_and_not_out_of_range(spark):
    wide = spark.createDataFrame(
        [("A", "AAA", "2020", "NaN"), ("A", "AAA", "2021.5", "3")],
        "region_name string, iso_code string, year string, `Polio (Pol3)` string",
    )
    valid, rejected = split_valid(tidy_long(wide, SETTINGS).withColumn("source_row", F.lit(0)), RULES())
    assert rows(valid, "year", "value") == [(2020, None)]
    assert rows(rejected, "year", "value", "reject_reason") == [(None, 3.0, "invalid_year")]
