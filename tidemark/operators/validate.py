"""Row rules, quarantine and flags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions.text import is_blank

REASON = "reject_reason"
REJECT_COLUMNS = (
    "source_row", "region_name", "iso_code", "year", "indicator_code", "value", REASON,
)


class Rule(NamedTuple):
    """A reason to reject a row and the condition under which it applies."""

    reason: str
    violated: Column


def region_year_rules(settings: Settings, as_of_year: int) -> list[Rule]:
    """The rules that look at region and year only; wide rows have these too."""
    year, name = F.col("year"), F.col("region_name")
    in_years = year.between(settings.min_year, settings.max_year(as_of_year))
    return [
        Rule("invalid_year", year.isNull() | ~in_years),
        Rule("missing_region", is_blank(name)),
    ]


def value_rule(settings: Settings, value: Column) -> Rule:
    """A missing value breaks no rule."""
    in_range = value.between(settings.value_min, settings.value_max)
    return Rule("value_out_of_range", value.isNotNull() & ~in_range)


def row_rules(settings: Settings, as_of_year: int) -> list[Rule]:
    """The rules of long rows, in the order their reasons are listed."""
    return [*region_year_rules(settings, as_of_year), value_rule(settings, F.col("value"))]


def with_reject_reason(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the reasons that apply, joined by ``|`` in the order of ``rules``; '' for none."""
    return df.withColumn(
        REASON, F.concat_ws("|", *[F.when(r.violated, F.lit(r.reason)) for r in rules])
    )


def violates_any(rules: Sequence[Rule]) -> Column:
    """Never null: each rule says for itself what a null means."""
    return reduce(Column.__or__, [r.violated for r in rules])


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows no rule objects to. A plain filter, of which the conditions on region and year
    move below the unpivot."""
    return df.where(~violates_any(rules))


def rejected_rows(
    df: DataFrame, rules: Sequence[Rule], columns: Sequence[str] = REJECT_COLUMNS
) -> DataFrame:
    """The rows to quarantine, reduced to what identifies and explains them. Reasons are only
    spelled out for these."""
    return with_reject_reason(df.where(violates_any(rules)), rules).select(*columns)


def split_valid(
    df: DataFrame, rules: Sequence[Rule], reject_columns: Sequence[str] = REJECT_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows): each row of ``df`` is in exactly one of them."""
    return valid_rows(df, rules), rejected_rows(df, rules, reject_columns)


def reject_summary(rejected: DataFrame) -> DataFrame:
    """Quarantined rows per single reason."""
    return (
        rejected.groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode(F.split(REASON, r"\|")).alias("reason"), "n")
        .groupBy("reason")
        .agg(F.sum("n").alias("rejected_rows"))
    )


def with_missing_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_missing", F.col("value").isNull())


def with_estimated_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_estimated", F.col("is_missing") | F.col("is_revised"))
