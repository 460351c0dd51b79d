"""Values that changed since the prior snapshot.

Both sides hold one row per key when the data is clean. When it is not (keys repeated, or null),
every old value of a key meets every new one, which grows with the square of the group. The same
facts are kept here in linear size: a row per revised key with the number of rows on each side,
and for keys with several values a list of those values with their numbers of rows. The number of
differing row pairs follows from the two exactly, see ``pair_total``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import quoted

NULL_KEYS = ("match", "drop")


def _both_sides(
    current: DataFrame, prior: DataFrame, keys: Sequence[str], values: Sequence[str], null_keys: str
) -> DataFrame:
    """(keys, values, _new) of both snapshots under each other."""
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys must be one of {NULL_KEYS}, not {null_keys!r}")

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        kept = df.dropna(subset=list(keys)) if null_keys == "drop" else df
        return kept.select(*map(quoted, [*keys, *values]), F.lit(is_new).alias("_new"))

    return side(current, True).unionByName(side(prior, False))


def detect_revisions(
    current: DataFrame,
    prior: DataFrame,
    keys: Sequence[str],
    values: Sequence[str] = ("value",),
    measure_col: str | None = None,
    prior_date: date | str | None = None,
    null_keys: str = "match",
) -> DataFrame:
    """One row per key, and per column of ``values``, that differs between the snapshots.

    ``measure_col`` names a column for the name of the value column, so wide rows can be compared
    before they are unpivoted: the keys travel once for all their values. Only keys with a value
    on both sides count; a value that appears or disappears is no revision. ``old_value`` and
    ``new_value`` are set where that side has a single value, else see ``revision_values``;
    ``old_rows`` and ``new_rows`` say how many rows have one. Null keys match each other, or are
    left out with ``null_keys="drop"``.

    A single aggregation on the keys. Its buffers are numbers, so it hashes, and a key that holds
    a third of all rows is one row per task before anything is shuffled."""
    both = _both_sides(current, prior, keys, values, null_keys)
    new = F.col("_new")
    columns, found, revised = [], [], []
    for i, value in enumerate(values):
        old_side, new_side = F.when(~new, quoted(value)), F.when(new, quoted(value))
        low_old, high_old, low_new, high_new, old_rows, new_rows = (f"_{n}{i}" for n in "abcdef")
        columns += [
            F.min(old_side).alias(low_old),
            F.max(old_side).alias(high_old),
            F.min(new_side).alias(low_new),
            F.max(new_side).alias(high_new),
            F.count(old_side).alias(old_rows),
            F.count(new_side).alias(new_rows),
        ]
        one_old, one_new = F.col(low_old) == F.col(high_old), F.col(low_new) == F.col(high_new)
        on_both = (F.col(old_rows) > 0) & (F.col(new_rows) > 0)
        same = one_old & one_new & (F.col(low_old) == F.col(low_new))
        revised.append(on_both & ~same)
        found.append(
            F.struct(
                F.lit(value).alias(measure_col or "_measure"),
                F.when(one_old, F.col(low_old)).alias("old_value"),
                F.when(one_new, F.col(low_new)).alias("new_value"),
                F.col(old_rows).alias("old_rows"),
                F.col(new_rows).alias("new_rows"),
                revised[-1].alias("_revised"),
            )
        )
    # Most keys are as they were; only the others are taken apart into a row per value.
    per_key = both.groupBy(*map(quoted, keys)).agg(*columns).where(reduce(Column.__or__, revised))
    label = None if prior_date is None else str(prior_date)
    listed = per_key.select(*map(quoted, keys), F.inline(F.array(*found))).where("_revised")
    out = listed.drop("_revised").withColumn("prior_snapshot", F.lit(label).cast("string"))
    return out if measure_col else out.drop("_measure")


def several_values(revisions: DataFrame) -> DataFrame:
    """The revisions whose key has more than one value on a side."""
    return revisions.where(F.col("old_value").isNull() | F.col("new_value").isNull())


def rows_with_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose keys occur in ``wanted``, null keys included."""
    copies = wanted.select(*[quoted(k).alias(f"_k_{k}") for k in keys]).distinct()
    return df.join(copies, same_keys(keys), "left_semi")


def revision_values(
    current: DataFrame,
    prior: DataFrame,
    revisions: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    null_keys: str = "match",
) -> DataFrame:
    """(keys, value, old_rows, new_rows): the values of the ``revisions`` with several of them.

    Rows are counted by (key, value) after the keys of interest are picked out; clean data has
    none, and then nothing is read. A hot key spreads over its values."""
    both = _both_sides(current, prior, keys, [value], null_keys)
    present = both.where(quoted(value).isNotNull())
    wanted = rows_with_keys(present, several_values(revisions), keys)
    return wanted.groupBy(*map(quoted, [*keys, value])).agg(
        F.count_if(~F.col("_new")).alias("old_rows"), F.count_if("_new").alias("new_rows")
    )


def pair_total(revisions: DataFrame, values: DataFrame) -> DataFrame:
    """One row, ``revisions_detected``: the number of (old row, new row) pairs that differ.

    All pairs of the revised keys, less the pairs of equal values. A decimal: the products of row
    counts outgrow a bigint."""

    def pairs(sign: int) -> Column:
        old, new = (F.col(c).cast("decimal(18,0)") for c in ("old_rows", "new_rows"))
        return (old * new * F.lit(sign)).cast("decimal(38,0)").alias("pairs")

    terms = revisions.select(pairs(1)).unionByName(values.select(pairs(-1)))
    total = F.coalesce(F.sum("pairs"), F.lit(0)).cast("decimal(38,0)")
    return terms.agg(total.alias("revisions_detected"))


def same_keys(keys: Sequence[str], prefix: str = "_k_") -> Column:
    """Null-safe equality of ``keys`` with their prefixed copies on the other side of a join."""
    return reduce(
        lambda a, b: a & b, [quoted(k).eqNullSafe(quoted(prefix + k)) for k in keys]
    )


def _look_up(df: DataFrame, unique: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the other columns of ``unique``, whose keys are unique; null where not found."""
    copies = unique.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return df.join(copies, same_keys(keys), "left").drop(*[f"_k_{k}" for k in keys])


def flag_revised(df: DataFrame, revisions: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Add ``is_revised``: is the row's key among the revisions? Never adds or drops a row."""
    if revisions is None:
        return df.withColumn("is_revised", F.lit(False))
    marked = revisions.select(*map(quoted, keys)).distinct().withColumn("_found", F.lit(True))
    flagged = _look_up(df, marked, keys)
    return flagged.withColumn("is_revised", F.col("_found").isNotNull()).drop("_found")


def revised_measures(
    wide: DataFrame,
    revisions: DataFrame | None,
    keys: Sequence[str],
    measure_col: str,
    into: str = "revised_measures",
) -> DataFrame:
    """Add to wide rows the list of their measures that are revised, empty for none.

    The same as ``flag_revised`` on the unpivoted rows, for a fraction of the rows to join. The
    list holds each measure once at most."""
    nothing = F.array().cast("array<string>")
    if revisions is None:
        return wide.withColumn(into, nothing)
    lists = revisions.groupBy(*map(quoted, keys)).agg(F.collect_set(measure_col).alias(into))
    return _look_up(wide, lists, keys).withColumn(into, F.coalesce(into, nothing))
