"""Figures about a run and the log of its loads."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.coverage import is_below
from tidemark.operators.revisions import pair_total


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row frames side by side, by way of a union: no join is needed."""
    names = [c for part in parts for c in part.columns]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def count_below(
    df: DataFrame, indicator: str, threshold: float = 80.0
) -> DataFrame:
    """One row (latest_year, countries_below) over long rows; (null, 0) when there are none.

    Counting every year at once leaves a row per year, so the rows are read a single time."""
    by_year = (
        df.where((F.col("indicator_code") == indicator) & F.col("value").isNotNull())
        .groupBy("year")
        .agg(
            F.count_if(
                (F.col("region_type") == "country") & is_below(F.col("value"), threshold)
            ).alias("n")
        )
    )
    return by_year.agg(
        F.max("year").alias("latest_year"),
        F.coalesce(F.max_by("n", "year"), F.lit(0).cast("bigint")).alias("countries_below"),
    )


def view_status(views: Mapping[str, DataFrame]) -> DataFrame:
    """(view_name, row_count, status) where status is OK or EMPTY."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("view_name"), "row_count"
        )
        for name, df in views.items()
    ]
    status = F.when(F.col("row_count") > 0, "OK").otherwise("EMPTY")
    return reduce(DataFrame.unionByName, counts).withColumn("status", status)


def quality_stats(
    indicators: DataFrame,
    regions: DataFrame,
    rejected: DataFrame,
    revisions: DataFrame,
    revision_values: DataFrame,
    indicator: str,
    threshold: float = 80.0,
) -> DataFrame:
    """The eight figures of a run, as one row."""
    rows = F.count(F.lit(1))
    below = count_below(indicators, indicator, threshold)
    return one_row(
        indicators.agg(
            rows.alias("indicator_rows"), F.count_if("is_missing").alias("null_values")
        ),
        regions.agg(
            rows.alias("region_count"),
            F.count_if(F.col("region_type") == "country").alias("country_count"),
        ),
        rejected.agg(rows.alias("rejected_rows")),
        pair_total(revisions, revision_values),
        below.withColumnsRenamed(
            {"latest_year": "latest_main_year", "countries_below": "countries_below_target"}
        ),
    )


def load_audit(counts: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Log rows for a load from (table_name, row_count): one per table and one for the run.

    ``details`` is JSON text; with ``run_ts`` it also says when."""

    def details(stamp: str, **fields: Column) -> Column:
        cols = [c.alias(n) for n, c in fields.items()]
        if run_ts is not None:
            cols.append(run_ts.alias(stamp))
        return F.to_json(F.struct(*cols))

    per_table = counts.select(
        "table_name",
        F.lit("row_count").alias("check_name"),
        F.lit("passed").alias("check_result"),
        details("loaded_at", rows_loaded=F.col("row_count")).alias("details"),
    )
    run = (
        counts.agg(F.count(F.lit(1)).alias("n"), F.sum("row_count").alias("total"))
        .where(F.col("n") > 0)
        .select(
            F.lit("pipeline").alias("table_name"),
            F.lit("pipeline_run").alias("check_name"),
            F.lit("passed").alias("check_result"),
            details("run_at", tables_loaded=F.col("n"), total_rows=F.col("total")).alias(
                "details"
            ),
        )
    )
    log = per_table.unionByName(run)
    return log if run_ts is None else log.withColumn("checked_at", run_ts)
