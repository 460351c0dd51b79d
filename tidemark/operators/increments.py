"""Data-quality checks of tables that grow: the state of what has been checked, and how the rows
added since go into it. Only they, and the earlier rows that may have their keys, are read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import (
    AcceptedRange,
    Check,
    MaxLength,
    NotNull,
    Relationship,
    RowCount,
    Unique,
    key_counts,
    orphans,
    run_checks,
)

NAMES = ("check_name", "table_name", "column_name")
STATE = "check_name string, table_name string, column_name string, value string, failures bigint"
_COUNTED = {NotNull: "not_null", AcceptedRange: "accepted_range", MaxLength: "max_length"}


def check_name(check: Check) -> tuple[str, str, str]:
    """The names that a check has in the results."""
    if isinstance(check, Unique):
        kind = "unique" if len(check.columns) == 1 else "unique_combination"
        return kind, check.table, ",".join(check.columns)
    if isinstance(check, Relationship):
        return "relationships", check.table, check.column
    return _COUNTED[type(check)], check.table, check.column


def refuse_ambiguous(checks: Sequence[Check]) -> None:
    """Raise ValueError for a check that has no state, or two that share one."""
    if any(isinstance(c, RowCount) for c in checks):
        raise ValueError("a number of rows is not checked by increments")
    if len({check_name(c) for c in checks}) < len(checks):
        raise ValueError("two checks have the same name, table and column")


def first_state(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """The state of whole tables: a row per check with its failures, and for a relationship a row
    per value without a parent, so that a parent may still come."""
    refuse_ambiguous(checks)
    counted = [c for c in checks if not isinstance(c, Relationship)]
    parts = [_orphans(tables[c.table], tables, c) for c in checks if isinstance(c, Relationship)]
    if counted:
        null = F.lit(None).cast("string").alias("value")
        parts.append(run_checks(tables, counted).select(*NAMES, null, "failures"))
    return reduce(DataFrame.unionByName, parts)


def next_state(
    state: DataFrame,
    tables: Mapping[str, DataFrame],
    added: Mapping[str, DataFrame],
    earlier: Mapping[str, DataFrame],
    checks: Sequence[Check],
) -> DataFrame:
    """The state after the rows ``added`` came to the tables of these names. Other tables were
    replaced and are checked whole, from ``tables``. ``earlier`` has the rows before, at least all
    those whose keys an added row may have. Parents may have gained rows but not lost any."""
    refuse_ambiguous(checks)
    whole = [c for c in checks if c.table not in added]
    parts = [first_state(tables, whole)] if whole else []
    grown = [c for c in checks if c.table in added]
    own = [c for c in grown if not isinstance(c, Unique | Relationship)]
    if own:
        parts.append(first_state(added, own))
    for check in grown:
        if isinstance(check, Unique):
            parts.append(_newly_repeated(added[check.table], earlier[check.table], check))
        elif isinstance(check, Relationship):
            parts += [_orphans(added[check.table], tables, check), _still_orphans(state, tables, check)]
    kept = [check_name(c) for c in grown if not isinstance(c, Relationship)]
    if kept:
        mine = reduce(lambda a, b: a | b, (_named(n) for n in kept))
        parts.append(state.where(mine))
    return (
        reduce(DataFrame.unionByName, parts).groupBy(*NAMES, "value").agg(F.sum("failures").alias("failures"))
    )


def results(state: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_name, table_name, column_name, failures), a row per check."""
    named = [F.struct(*(F.lit(x).alias(n) for x, n in zip(check_name(c), NAMES, strict=True))) for c in checks]
    every = state.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*named)))
    failed = state.select(*NAMES, "failures").unionByName(every.withColumn("failures", F.lit(0).cast("bigint")))
    return failed.groupBy(*NAMES).agg(F.sum("failures").alias("failures"))


def _named(names: tuple[str, str, str]):
    return reduce(lambda a, b: a & b, (F.col(n) == x for n, x in zip(NAMES, names, strict=True)))


def _rows(df: DataFrame, names: tuple[str, str, str], value, failures) -> DataFrame:
    return df.select(
        *(F.lit(x).alias(n) for x, n in zip(names, NAMES, strict=True)),
        value.cast("string").alias("value"), failures.cast("bigint").alias("failures"),
    )


def _orphans(child: DataFrame, tables: Mapping[str, DataFrame], check: Relationship) -> DataFrame:
    found = orphans(child, check.column, tables[check.to_table], check.to_column)
    return _rows(found, check_name(check), F.col("value"), F.col("n_records"))


def _still_orphans(state: DataFrame, tables: Mapping[str, DataFrame], check: Relationship) -> DataFrame:
    parent = tables[check.to_table].select(F.col(check.to_column).cast("string").alias("_known")).distinct()
    before = state.where(_named(check_name(check)))
    return before.join(parent, F.col("value") == F.col("_known"), "left_anti")


def _newly_repeated(added: DataFrame, earlier: DataFrame, check: Unique) -> DataFrame:
    """How many keys occur more than once now and did not before. Both sides are counts by key, so a
    hot key is one row; earlier keys that no added row has do not go through the second shuffle."""
    keys = list(check.columns)
    if len(keys) == 1:
        added, earlier = added.dropna(subset=keys), earlier.dropna(subset=keys)
    new = key_counts(added, keys).withColumnRenamed("n_records", "n_added")
    theirs = [f"_{i}" for i in range(len(keys))]
    old = earlier.select(*(F.col(k).alias(t) for k, t in zip(keys, theirs, strict=True)))
    alike = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(t)) for k, t in zip(keys, theirs, strict=True)))
    met = key_counts(old.join(new, alike, "left_semi"), theirs)
    before = F.coalesce("n_records", F.lit(0))
    repeated = F.count_if((before <= 1) & (before + F.col("n_added") > 1)).alias("n")
    failures = new.join(met, alike, "left").agg(repeated)
    return _rows(failures, check_name(check), F.lit(None), F.col("n"))
