"""The star schema: three dimensions, one fact table, and the join of them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.regions import region_type_label


class Warehouse(NamedTuple):
    """The star schema. ``periods`` says for which dates each indicator has facts; it is a few
    hundred rows, and without it the fact table is asked."""

    fact: DataFrame
    region: DataFrame
    date: DataFrame
    indicator: DataFrame
    periods: DataFrame | None = None


def build_dim_region(regions: DataFrame) -> DataFrame:
    return regions.select(
        "region_key",
        "region_name",
        "iso_code",
        "region_type",
        region_type_label(F.col("region_type")).alias("region_type_label"),
    )


def build_dim_date(indicators: DataFrame) -> DataFrame:
    """One row per year that occurs, also where all its values are missing."""
    years = indicators.where(F.col("year").isNotNull()).select("year").distinct()
    one = F.lit(1)
    return years.select(
        (F.col("year") * 10000 + 101).cast("int").alias("date_id"),
        F.make_date("year", one, one).alias("date_day"),
        one.alias("day"),
        one.alias("month"),
        "year",
        one.alias("quarter"),
        F.lit("Yearly").alias("reporting_frequency"),
    )


def build_dim_indicator(indicators: DataFrame) -> DataFrame:
    return (
        indicators.where(F.col("indicator_code").isNotNull())
        .select("indicator_code", "indicator_name", "indicator_category", "indicator_unit")
        .distinct()
    )


def build_fact(
    indicators: DataFrame, dim_region: DataFrame, dim_date: DataFrame, dim_indicator: DataFrame
) -> DataFrame:
    """Rows with a value whose region, year and indicator are in the dimensions.

    The date and indicator dimensions hold a row per valid year and per configured indicator, so
    Spark broadcasts them by size; the region dimension may be large and is then shuffled."""
    region = dim_region.select(F.col("region_key").alias("region_id"))
    dates = dim_date.select("date_id", "year")
    codes = dim_indicator.select(F.col("indicator_code").alias("indicator_id"))
    rows = indicators.where(F.col("value").isNotNull())
    return (
        rows.join(dates, "year")
        .join(codes, F.col("indicator_code") == F.col("indicator_id"))
        .join(region, F.col("region_key") == F.col("region_id"))
        .select(
            "region_key",
            "region_id",
            "date_id",
            "indicator_id",
            "value",
            "is_missing",
            "is_revised",
            "is_estimated",
            "loaded_at",
        )
    )


def build_periods(fact: DataFrame) -> DataFrame:
    """Facts per indicator and date. Both partition the fact table, so this counts its files'
    rows without reading a column."""
    return fact.groupBy("indicator_id", "date_id").agg(F.count(F.lit(1)).alias("fact_rows"))


def merge_periods(periods: DataFrame) -> DataFrame:
    """One row per indicator and date from those of several lots of facts."""
    return periods.groupBy("indicator_id", "date_id").agg(F.sum("fact_rows").alias("fact_rows"))


def star(w: Warehouse) -> DataFrame:
    """Every fact row with its region, date and indicator attributes. Filters put on the result
    travel to the dimensions, and from there to the partitions of the fact table."""
    return (
        w.fact.drop("region_key")
        .join(w.date, "date_id")
        .join(w.indicator.withColumnRenamed("indicator_code", "indicator_id"), "indicator_id")
        .join(w.region.withColumnRenamed("region_key", "region_id"), "region_id")
    )
