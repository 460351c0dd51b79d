"""Reports, counts and checks on star schemas made for the purpose."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.operators.metrics import count_below, load_audit, one_row, view_status
from tidemark.operators.quality import (
    AcceptedRange,
    MaxLength,
    NotNull,
    Relationship,
    RowCount,
    Unique,
    duplicate_keys,
    orphans,
    run_checks,
)
from tidemark.operators.warehouse import (
    Warehouse,
    build_dim_date,
    build_dim_indicator,
    build_dim_region,
    build_fact,
    build_periods,
    star,
)
from tidemark.plans import reports

REGIONS = [
    ("AAA", "Aland", "AAA", "country"),
    ("BBB", "Bland", "BBB", "country"),
    ("CCC", "Cland", "CCC", "country"),
    ("OWID_X", "Area", "OWID_X", "aggregate"),
]
STAGED = (
    "region_key string, year int, indicator_code string, value decimal(8,2), is_revised boolean"
)


def warehouse(spark, data):
    """data: (region_key, year, indicator, value) rows."""
    regions = spark.createDataFrame(
        REGIONS, "region_key string, region_name string, iso_code string, region_type string"
    )
    typed = [(k, y, i, None if v is None else Decimal(str(v)), False) for k, y, i, v in data]
    staged = spark.createDataFrame(typed, STAGED).select(
        "*",
        F.upper("indicator_code").alias("indicator_name"),
        F.lit("x").alias("indicator_category"),
        F.lit("%").alias("indicator_unit"),
        F.col("value").isNull().alias("is_missing"),
        F.col("is_revised").alias("is_estimated"),
        F.lit(datetime(2026, 1, 1)).alias("loaded_at"),
    )
    dims = (build_dim_region(regions), build_dim_date(staged), build_dim_indicator(staged))
    return staged, Warehouse(build_fact(staged, *dims), *dims)


DATA = [
    ("AAA", 2023, "d", 10), ("AAA", 2024, "d", 70), ("BBB", 2024, "d", 80), ("CCC", 2024, "d", 90),
    ("OWID_X", 2024, "d", 40), ("AAA", 2024, "m", 20), ("AAA", 2025, "m", None),
    ("GONE", 2024, "d", 1),
]


def test_fact_holds_rows_with_a_value_and_a_region(spark):
    staged, w = warehouse(spark, DATA)
    assert rows(w.date, "year") == [(2023,), (2024,), (2025,)]
    assert w.fact.count() == 6 and star(w).count() == 6
    assert "GONE" not in {r[0] for r in rows(w.fact, "region_id")}


def test_latest_year_comparison_and_below(spark):
    _, w = warehouse(spark, DATA)
    comparison = reports.regional_comparison(w, "d", coverage="v")
    assert [r.region_key for r in reports.ordered("comparison", comparison, "v").collect()] == [
        "CCC", "BBB", "AAA",
    ]
    below = reports.below_threshold(w, "d", coverage="v")
    assert rows(below, "region_key", "v", "gap_to_target_pct") == [("AAA", Decimal("70.00"), Decimal("10.00"))]
    assert reports.below_threshold(w, "d", threshold=90.5).count() == 3
    assert rows(reports.top_regions(comparison, 2, coverage="v"), "region_key", "target_marker") == [
        ("BBB", "at_or_above"), ("CCC", "at_or_above"),
    ]
    assert rows(reports.bottom_regions(reports.below_threshold(w, "d", 101, "v"), 1, "v"), "region_key") == [("AAA",)]
    assert rows(reports.comparison_by_band(comparison, "Moderate coverage"), "region_key") == [("AAA",)]
    assert reports.comparison_by_band(comparison).count() == 3


def test_latest_year_may_come_from_an_aggregate(spark):
    _, w = warehouse(spark, [("OWID_X", 2025, "d", 50), ("AAA", 2024, "d", 50)])
    assert rows(reports.latest_year(w, "d")) == [(2025,)]
    assert rows(reports.latest_year(w._replace(periods=build_periods(w.fact)), "d")) == [(2025,)]
    assert reports.regional_comparison(w, "d").count() == 0
    assert reports.below_threshold(w, "d").count() == 0


def test_no_data_at_all(spark):
    _, w = warehouse(spark, [("AAA", 2024, "m", 5)])
    assert rows(reports.latest_year(w, "d")) == [(None,)]
    assert reports.below_threshold(w, "d").count() == 0
    assert rows(reports.headline(w, "d")) == [(0, 0, None)]


def test_trends_and_their_selections(spark):
    _, w = warehouse(spark, DATA)
    trends = reports.vaccination_trends(w, "d", "v")
    assert trends.count() == 5
    assert rows(reports.trends_for(trends, ["Aland", "Nowhere"]), "year") == [(2023,), (2024,)]
    assert [r[0] for r in reports.region_list(trends).collect()] == ["Aland", "Area", "Bland", "Cland"]
    assert [tuple(r)[:2] for r in reports.series_by_region(trends, "v").collect()][:2] == [
        ("Aland", 2023), ("Aland", 2024),
    ]
    recent = reports.recent_for_region(w, "Aland", "d", 1)
    assert rows(recent) == [("Aland", 2024, "D", Decimal("70.00"))]


LONG = "indicator_code string, year int, value double, region_type string"


@pytest.mark.parametrize(
    "data, expected",
    [
        (
            [("d", 2024, 70.0, "country"), ("d", 2024, 80.0, "country"), ("d", 2024, 90.0, "country"),
             ("d", 2024, 40.0, "aggregate"), ("d", 2023, 10.0, "country"), ("d", 2024, None, "country"),
             ("m", 2024, 20.0, "country")],
            (2024, 1),
        ),
        ([("d", 2024, 80.0, "country")], (2024, 0)),
        ([("d", 2025, 50.0, "aggregate"), ("d", 2024, 50.0, "country")], (2025, 0)),
        ([("d", 2025, None, "country"), ("d", 2024, 50.0, "country")], (2024, 1)),
        ([], (None, 0)),
    ],
)
def test_count_below(spark, data, expected):
    assert rows(count_below(spark.createDataFrame(data, LONG), "d")) == [expected]


# Checks


def test_each_check_counts_its_failures(spark):
    tables = {
        "t": spark.createDataFrame(
            [(1, "a", 5.0), (1, "a", None), (2, None, 101.0), (None, "b", -1.0), (None, "b", 100.0)],
            "k int, p string, v double",
        ),
        "p": spark.createDataFrame([("a",), (None,)], "code string"),
    }
    checks = [
        NotNull("t", "k"), NotNull("t", "p"), NotNull("p", "code"), Unique("t", ["k"]),
        Unique("t", ["k", "p"]), Relationship("t", "p", "p", "code"), AcceptedRange("t", "v", 0, 100),
        MaxLength("t", "p", 1), MaxLength("t", "p", 0), RowCount("t", 5), RowCount("p", 3),
    ]
    assert rows(run_checks(tables, checks)) == sorted(
        [
            ("not_null", "t", "k", 2), ("not_null", "t", "p", 1), ("not_null", "p", "code", 1),
            ("unique", "t", "k", 1), ("unique_combination", "t", "k,p", 2),
            ("relationships", "t", "p", 2), ("accepted_range", "t", "v", 2),
            ("max_length", "t", "p", 0), ("max_length", "t", "p", 4), ("row_count", "t", "*", 0),
            ("row_count", "p", "*", 1),
        ],
        key=repr,
    )
    assert rows(duplicate_keys(tables["t"], ["k"])) == [(1, 2), (None, 2)]
    assert rows(orphans(tables["t"], "p", tables["p"], "code")) == [("b", 2)]


def test_small_frames(spark):
    one, two = spark.range(1).selectExpr("1 a", "null b"), spark.range(1).selectExpr("'x' c")
    assert rows(one_row(one, two)) == [(1, None, "x")]
    assert rows(view_status({"full": spark.range(3), "none": spark.range(0)})) == [
        ("full", 3, "OK"), ("none", 0, "EMPTY"),
    ]
    counts = spark.createDataFrame([("t", 2), ("u", 0)], "table_name string, row_count bigint")
    assert [r[3] for r in sorted(load_audit(counts).collect())] == [
        '{"tables_loaded":2,"total_rows":2}', '{"rows_loaded":2}', '{"rows_loaded":0}',
    ]
    stamped = load_audit(counts, F.lit(datetime(2026, 1, 1)))
    assert stamped.columns[-1] == "checked_at" and "loaded_at" in sorted(stamped.collect())[1].details
    assert load_audit(counts.limit(0)).count() == 0
