"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class NotNull(NamedTuple):
    table: str
    column: str


class AcceptedRange(NamedTuple):
    """Inclusive on both ends; null passes."""

    table: str
    column: str
    low: float
    high: float


class MaxLength(NamedTuple):
    """At most so many characters; null passes."""

    table: str
    column: str
    limit: int


class RowCount(NamedTuple):
    """Exactly so many rows; the difference counts as failures."""

    table: str
    expected: int


class Unique(NamedTuple):
    """No combination of the columns occurs twice. A single null column is not compared."""

    table: str
    columns: Sequence[str]


class Relationship(NamedTuple):
    """Each non-null value of the column occurs in the other table."""

    table: str
    column: str
    to_table: str
    to_column: str


RowCheck = NotNull | AcceptedRange | MaxLength | RowCount
Check = RowCheck | Unique | Relationship

# The tests of the warehouse, the staging tables and their keys.
STANDARD_CHECKS: tuple[Check, ...] = (
    NotNull("stg_health_indicators", "region_key"),
    NotNull("stg_health_indicators", "year"),
    NotNull("stg_health_indicators", "indicator_code"),
    Unique("stg_health_indicators", ["region_key", "year", "indicator_code"]),
    NotNull("stg_regions", "region_key"),
    Unique("stg_regions", ["region_key"]),
    NotNull("dim_region", "region_key"),
    Unique("dim_region", ["region_key"]),
    NotNull("dim_date", "date_id"),
    Unique("dim_date", ["date_id"]),
    NotNull("dim_date", "year"),
    NotNull("dim_indicator", "indicator_code"),
    Unique("dim_indicator", ["indicator_code"]),
    NotNull("fact_health_indicator", "region_id"),
    NotNull("fact_health_indicator", "date_id"),
    NotNull("fact_health_indicator", "indicator_id"),
    Relationship("fact_health_indicator", "region_id", "dim_region", "region_key"),
    Relationship("fact_health_indicator", "date_id", "dim_date", "date_id"),
    Relationship("fact_health_indicator", "indicator_id", "dim_indicator", "indicator_code"),
    Unique("fact_health_indicator", ["region_id", "date_id", "indicator_id"]),
    AcceptedRange("fact_health_indicator", "value", 0, 100),
)


# The longest text each staging column may hold.
LENGTH_CHECKS: tuple[Check, ...] = (
    MaxLength("stg_health_indicators", "region_key", 50),
    MaxLength("stg_health_indicators", "region_name", 200),
    MaxLength("stg_health_indicators", "iso_code", 20),
    MaxLength("stg_health_indicators", "region_type", 20),
    MaxLength("stg_health_indicators", "indicator_code", 50),
    MaxLength("stg_health_indicators", "indicator_name", 200),
    MaxLength("stg_health_indicators", "indicator_category", 50),
    MaxLength("stg_health_indicators", "indicator_unit", 20),
    MaxLength("stg_regions", "region_key", 50),
    MaxLength("stg_regions", "region_name", 200),
    MaxLength("stg_regions", "iso_code", 20),
    MaxLength("stg_regions", "region_type", 20),
    MaxLength("stg_rejected_rows", "region_name", 200),
    MaxLength("stg_rejected_rows", "iso_code", 20),
    MaxLength("stg_rejected_rows", "reject_reason", 200),
    MaxLength("stg_rejected_rows", "indicator_code", 50),
    MaxLength("stg_data_revisions", "region_key", 50),
    MaxLength("stg_data_revisions", "indicator_code", 50),
    MaxLength("stg_data_revisions", "prior_snapshot", 20),
)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key with its number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key that occurs more than once, with its number of rows."""
    return key_counts(df, keys).where(F.col("n_records") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, to_column: str) -> DataFrame:
    """Values of the child column without a parent, with their number of rows.

    Both sides shrink to their distinct values before the join, so a hot value is one row."""
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(to_column).alias("_known")).distinct()
    return values.join(known, F.col("value") == F.col("_known"), "left_anti")


def _result(check: str, table: str, column: str, failures: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        failures.cast("bigint").alias("failures"),
    )


def _row_failures(check: RowCheck) -> Column:
    match check:
        case RowCount(_, expected):
            return F.abs(F.count(F.lit(1)) - F.lit(expected))
        case NotNull(_, column):
            return F.count_if(F.col(column).isNull())
        case AcceptedRange(_, column, low, high):
            return F.count_if((F.col(column) < low) | (F.col(column) > high))
        case MaxLength(_, column, limit):
            return F.count_if(F.length(column) > limit)


_ROW_CHECK_NAMES = {
    NotNull: "not_null",
    AcceptedRange: "accepted_range",
    MaxLength: "max_length",
    RowCount: "row_count",
}


def _row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All checks of single rows of a table, in one pass over it."""
    counts = df.agg(*[_row_failures(c).alias(f"c{i}") for i, c in enumerate(checks)])
    results = [
        _result(_ROW_CHECK_NAMES[type(c)], c.table, getattr(c, "column", "*"), F.col(f"c{i}"))
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*results)))


def _unique_check(df: DataFrame, check: Unique) -> DataFrame:
    single = len(check.columns) == 1
    rows = df.dropna(subset=list(check.columns)) if single else df
    failures = duplicate_keys(rows, check.columns).agg(F.count(F.lit(1)).alias("n"))
    name = "unique" if single else "unique_combination"
    result = _result(name, check.table, ",".join(check.columns), F.col("n"))
    return failures.select(F.inline(F.array(result)))


def _relationship_check(
    tables: Mapping[str, DataFrame], check: Relationship, keys: Sequence[str]
) -> DataFrame:
    """From the counts of ``keys``, which include the column. Nothing is filtered on the way, as a
    filter would travel below the counts and they could not serve several checks."""
    parent = tables[check.to_table].select(F.col(check.to_column).alias("_known")).distinct()
    values = (
        key_counts(tables[check.table], keys)
        .groupBy(F.col(check.column).alias("value"))
        .agg(F.sum("n_records").alias("n_records"))
    )
    orphan = F.col("value").isNotNull() & F.col("_known").isNull()
    failures = values.join(parent, F.col("value") == F.col("_known"), "left").agg(
        F.coalesce(F.sum(F.when(orphan, F.col("n_records"))), F.lit(0)).alias("n")
    )
    return failures.select(
        F.inline(F.array(_result("relationships", check.table, check.column, F.col("n"))))
    )


def run_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check] = STANDARD_CHECKS
) -> DataFrame:
    """(check_name, table_name, column_name, failures), a row per check; 0 failures is a pass.

    A table's combined key is counted once: foreign keys that are part of it are checked on the same
    counts, which Spark shuffles once for all of them."""
    combined = {c.table: c.columns for c in checks if isinstance(c, Unique) and len(c.columns) > 1}
    by_table: dict[str, list] = {}
    results: list[DataFrame] = []
    for check in checks:
        if isinstance(check, RowCheck):
            by_table.setdefault(check.table, []).append(check)
        elif isinstance(check, Unique):
            results.append(_unique_check(tables[check.table], check))
        else:
            keys = combined.get(check.table, ())
            keys = keys if check.column in keys else [check.column]
            results.append(_relationship_check(tables, check, keys))
    results += [_row_checks(tables[name], group) for name, group in by_table.items()]
    return reduce(DataFrame.unionByName, results)
