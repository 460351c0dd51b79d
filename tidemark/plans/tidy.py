"""Wide snapshot to validated long rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions.numbers import to_year
from tidemark.functions.text import quoted
from tidemark.operators.regions import first_seen_dimension, standardise_regions
from tidemark.operators.reshape import (
    apply_indicator_metadata,
    coerce_numeric,
    present_indicators,
    unpivot_indicators,
)
from tidemark.operators.revisions import (
    detect_revisions,
    revised_measures,
    revision_values,
    rows_with_keys,
    several_values,
)
from tidemark.operators.validate import (
    region_year_rules,
    rejected_rows,
    row_rules,
    valid_rows,
    value_rule,
    violates_any,
    with_estimated_flag,
    with_missing_flag,
)

WIDE_KEYS = ("region_key", "year")
KEYS = (*WIDE_KEYS, "indicator_code")
REGION_ATTRS = ("region_name", "iso_code", "region_type")

_NO_REVISIONS = (
    "region_key string, year int, indicator_source_col string, old_value double,"
    " new_value double, old_rows bigint, new_rows bigint, prior_snapshot string,"
    " indicator_code string"
)


def typed_wide(
    wide: DataFrame, settings: Settings, aliases: DataFrame | None = None
) -> DataFrame:
    """Wide rows with standardised regions, whole years and figures as numbers.

    All of this is done before the unpivot. There is one wide row for several long ones, a join
    there moves that much less data, and Catalyst does not carry an expression through an
    unpivot, so none is worked out again in the filters above it."""
    regions = standardise_regions(
        wide,
        aliases,
        aggregate_prefix=settings.aggregate_prefix,
        country_len=settings.country_len,
    )
    numbers = coerce_numeric(regions, present_indicators(wide, settings.indicators))
    return numbers.withColumn("year", to_year(F.col("year").cast("string")))


def long_rows(typed: DataFrame, settings: Settings, carry: Sequence[str] = ()) -> DataFrame:
    """Described long rows of typed wide rows; ``carry`` names further columns to keep."""
    ids = [*carry, "region_key", *REGION_ATTRS, "year"]
    long = unpivot_indicators(typed, settings.indicators, ids)
    return apply_indicator_metadata(long, settings.indicators)


def tidy_long(
    wide: DataFrame,
    settings: Settings,
    aliases: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Standardised long rows before validation."""
    return long_rows(typed_wide(wide, settings, aliases), settings, carry)


def snapshot_revisions(
    current: DataFrame, prior: DataFrame, settings: Settings, prior_date: date | str
) -> DataFrame:
    """Revisions between two typed wide snapshots by region, year and indicator. An indicator
    that only one of them has was not revised."""
    known = present_indicators(prior, settings.indicators)
    shared = [c for c in present_indicators(current, settings.indicators) if c in known]
    if not shared:
        return current.sparkSession.createDataFrame([], _NO_REVISIONS)
    found = detect_revisions(
        current, prior, WIDE_KEYS, shared, "indicator_source_col", prior_date
    )
    return apply_indicator_metadata(found, settings.indicators)


def snapshot_revision_values(
    current: DataFrame, prior: DataFrame, revisions: DataFrame, settings: Settings
) -> DataFrame:
    """The values of revisions that have several, from typed wide snapshots. The few regions and
    years concerned are picked out before the unpivot."""
    several = several_values(revisions)
    sides = [
        long_rows(rows_with_keys(side, several, WIDE_KEYS), settings) for side in (current, prior)
    ]
    return revision_values(*sides, revisions, KEYS)


def seen_regions(
    typed: DataFrame, settings: Settings, as_of_year: int, row_col: str = "source_row"
) -> DataFrame:
    """One row per region among the valid long rows, with the attributes of its first one.

    Long rows are in the order a melt lists them: indicator by indicator in the order of the file,
    within each by row. So each indicator is a list of wide rows, and there is no need to unpivot.
    The rules sit inside the aggregates: as a filter they would be moved below the parsing of the
    figures and have it done twice."""
    ok = typed.withColumn("_ok", ~violates_any(region_year_rules(settings, as_of_year)))
    lists = [
        F.when(F.col("_ok") & ~value_rule(settings, quoted(c)).violated, F.col(row_col))
        for c in present_indicators(typed, settings.indicators)
    ]
    return first_seen_dimension(ok, "region_key", REGION_ATTRS, *lists)


def flagged_rows(
    typed: DataFrame,
    revisions: DataFrame | None,
    settings: Settings,
    as_of_year: int,
    run_ts: Column,
    deal: Sequence[str] = (),
) -> DataFrame:
    """The valid long rows of typed wide rows with their flags. ``revisions`` is None without a
    prior snapshot. ``deal`` names columns by whose ranges the rows are dealt, while they are wide:
    that moves a row where dealing long ones moves one per indicator."""
    ok = typed.where(~violates_any(region_year_rules(settings, as_of_year)))
    marked = revised_measures(ok, revisions, WIDE_KEYS, "indicator_code")
    if deal:
        marked = marked.repartitionByRange(*deal)
    long = long_rows(marked, settings, ["revised_measures"]).withColumn(
        "is_revised", F.array_contains("revised_measures", F.col("indicator_code"))
    )
    valid = with_missing_flag(valid_rows(long, row_rules(settings, as_of_year)))
    return with_estimated_flag(valid.drop("revised_measures")).withColumn("loaded_at", run_ts)


def quarantined_rows(
    typed: DataFrame,
    settings: Settings,
    as_of_year: int,
    run_ts: Column,
    row_col: str = "source_row",
) -> DataFrame:
    """The rejected long rows of typed wide rows. A reject is found again by its wide row and
    indicator."""
    long = long_rows(typed, settings, [row_col]).withColumnRenamed(row_col, "source_row")
    rejected = rejected_rows(long, row_rules(settings, as_of_year))
    return rejected.withColumn("loaded_at", run_ts)
