"""The questions asked of the warehouse.

Each report returns unsorted rows; ``ordered`` gives the order it is shown in. The latest year is
taken over every kind of region and only then are countries selected, so a year for which only
aggregates are published yet gives an empty comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.coverage import coverage_band, gap_to_target, is_below, target_marker
from tidemark.operators.metrics import one_row
from tidemark.operators.warehouse import Warehouse, star

COVERAGE = "dtp3_coverage_pct"
# The order of names in the root locale, which suits names of many languages.
COLLATION = "UNICODE"


def latest_year(w: Warehouse, indicator: str) -> DataFrame:
    """One row: the last year with a value of ``indicator`` in any region, null if none."""
    facts = w.fact if w.periods is None else w.periods
    present = facts.where(F.col("indicator_id") == indicator).select("date_id").distinct()
    return w.date.join(present, "date_id", "left_semi").agg(F.max("year").alias("latest_year"))


def _latest(w: Warehouse, indicator: str) -> Warehouse:
    """The warehouse cut down to the latest year: a one-row date dimension, from which the scan
    of the fact table is pruned to one partition."""
    year = latest_year(w, indicator).scalar()
    return w._replace(date=w.date.where(F.col("year") == year))


def _of_region(w: Warehouse, region_name: str) -> Warehouse:
    """The warehouse cut down to the regions of a name. The fact table is sorted by key, so the
    range of their keys, mostly a single key, lets the scan skip what is outside. The range is
    looked up here, one row, because as a subquery it would not reach the files."""
    named = w.region.where(F.col("region_name") == region_name)
    low, high = map(F.lit, named.agg(F.min("region_key"), F.max("region_key")).first())
    fact = w.fact.where(F.col("region_id").between(low, high))
    return w._replace(region=named, fact=fact)


def vaccination_trends(w: Warehouse, indicator: str, coverage: str = COVERAGE) -> DataFrame:
    """Coverage by region and year, all types of region."""
    return (
        star(w)
        .where(F.col("indicator_id") == indicator)
        .select(
            "region_name",
            "iso_code",
            "region_type_label",
            "year",
            F.col("value").alias(coverage),
            "is_estimated",
        )
    )


def trends_for(trends: DataFrame, regions: Sequence[str]) -> DataFrame:
    return trends.where(F.col("region_name").isin(*regions))


def series_by_region(trends: DataFrame, coverage: str = COVERAGE) -> DataFrame:
    """The line of each region, one row per point, regions and years in order. Kept as rows: an
    array per region would gather a whole group in one place."""
    rows = trends.select("region_name", "year", coverage)
    return rows.orderBy(*by_name("region_name"), "year", coverage)


def region_list(trends: DataFrame) -> DataFrame:
    return trends.select("region_name").distinct().orderBy(*by_name("region_name"))


def by_name(column: str, collation: str = COLLATION) -> list[Column]:
    """The order of names that readers expect: accents and case decide between equal letters only.
    Names that the collation holds for equal are in the order of their characters."""
    return [F.asc_nulls_last(F.collate(F.col(column), collation)), F.asc_nulls_last(column)]


def first_and_last(df: DataFrame, by: str, column: str, collation: str = COLLATION) -> DataFrame:
    """Per value of ``by``: the first and last of ``column`` in the order of names."""
    name = F.collate(F.col(column), collation)
    plain = lambda c: F.collate(c, "UTF8_BINARY")
    return df.groupBy(by).agg(plain(F.min(name)).alias("first_name"), plain(F.max(name)).alias("last_name"))


def regional_comparison(
    w: Warehouse,
    indicator: str,
    threshold: float = 80.0,
    moderate_floor: float = 50.0,
    coverage: str = COVERAGE,
) -> DataFrame:
    """Countries in the latest year, each with its coverage band. Carries region_key to order
    equal figures."""
    return (
        star(_latest(w, indicator))
        .where((F.col("indicator_id") == indicator) & (F.col("region_type") == "country"))
        .select(
            F.col("region_id").alias("region_key"),
            "region_name",
            "iso_code",
            "year",
            F.col("value").alias(coverage),
            coverage_band(F.col("value"), threshold, moderate_floor).alias("coverage_band"),
        )
    )


def comparison_by_band(comparison: DataFrame, band: str | None = None) -> DataFrame:
    """Rows of one band; all rows without one."""
    return comparison if band is None else comparison.where(F.col("coverage_band") == band)


def below_threshold(
    w: Warehouse, indicator: str, threshold: float = 80.0, coverage: str = COVERAGE
) -> DataFrame:
    """Countries below the target in the latest year and how far they are from it."""
    value = F.col("value")
    return (
        star(_latest(w, indicator))
        .where((F.col("indicator_id") == indicator) & (F.col("region_type") == "country"))
        .where(is_below(value, threshold))
        .select(
            F.col("region_id").alias("region_key"),
            "region_name",
            "iso_code",
            "year",
            value.alias(coverage),
            gap_to_target(value, threshold).alias("gap_to_target_pct"),
        )
    )


def top_regions(
    comparison: DataFrame, n: int = 30, threshold: float = 80.0, coverage: str = COVERAGE
) -> DataFrame:
    """The ``n`` highest figures, marked by which side of the target they are on."""
    return (
        comparison.orderBy(F.desc(coverage), "region_key")
        .limit(n)
        .select(
            "region_key",
            "region_name",
            coverage,
            target_marker(F.col(coverage), threshold).alias("target_marker"),
        )
    )


def bottom_regions(below: DataFrame, n: int = 30, coverage: str = COVERAGE) -> DataFrame:
    """The ``n`` lowest figures."""
    return below.orderBy(coverage, "region_key").limit(n)


def recent_for_region(
    w: Warehouse, region_name: str, indicator: str, n: int = 10
) -> DataFrame:
    """The last ``n`` years of one region."""
    return (
        star(_of_region(w, region_name))
        .where(F.col("indicator_id") == indicator)
        .select("region_name", "year", "indicator_name", "value")
        .orderBy(F.desc("year"))
        .limit(n)
    )


def headline(w: Warehouse, indicator: str, threshold: float = 80.0) -> DataFrame:
    """One row: countries tracked, countries below target, latest year with data. The latest
    year's facts are read once, and the year itself comes from the table of periods."""
    countries = regional_comparison(w, indicator, threshold).agg(
        F.count(F.lit(1)).alias("countries_tracked"),
        F.count_if(is_below(F.col(COVERAGE), threshold)).alias("countries_below"),
    )
    return one_row(countries, latest_year(w, indicator))


def ordered(name: str, report: DataFrame, coverage: str = COVERAGE) -> DataFrame:
    """A report in the order it is shown. Ties are broken by further columns, which also lets the
    sort divide a region that has a large part of all rows."""
    order = {
        "trends": [*by_name("region_name"), F.asc_nulls_last("year"), F.asc(coverage)],
        "comparison": [F.desc_nulls_first(coverage), F.asc("region_key")],
        "below_threshold": [F.asc_nulls_last(coverage), F.asc("region_key")],
    }
    return report.orderBy(*order[name])
