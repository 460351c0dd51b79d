"""The value of each key over all snapshots, as intervals of snapshot dates.

An interval (``valid_from``, ``valid_to``) says that a key had a value in every snapshot from the first
date up to, and without, the second; ``valid_to`` is null while the newest snapshot has it. A key that
is missing from a snapshot, or has no value there, has no interval then. A key that a snapshot has
several times counts with its last row.

Snapshots are merged one by one: only open intervals meet the new snapshot, in one join on the key,
and closed ones are not touched again. ``history_of`` makes the same table of all snapshots at once,
which is the way after an older snapshot was changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import quoted
from tidemark.operators.revisions import same_keys

INTERVAL = ("valid_from", "valid_to")


def last_values(
    rows: DataFrame, keys: Sequence[str], value: str | Sequence[str] = "value", order_col: str = "source_row"
) -> DataFrame:
    """A row per key with a value: that of its last row that has one. Combined before the shuffle, so
    a repeated key is a row per task. Of several columns of values each has a last row of its own;
    wide rows move once for all of them."""
    values = [value] if isinstance(value, str) else list(value)
    has_any = reduce(Column.__or__, [quoted(v).isNotNull() for v in values])
    present = rows.dropna(subset=list(keys)).where(has_any)
    last = [
        F.max(F.when(quoted(v).isNotNull(), F.struct(quoted(order_col).alias("row"), quoted(v).alias("v"))))["v"]
        for v in values
    ]
    return present.groupBy(*map(quoted, keys)).agg(*(c.alias(v) for c, v in zip(last, values, strict=True)))


def merge_snapshot(
    open_intervals: DataFrame, snapshot: DataFrame, day: str, keys: Sequence[str], value: str = "value"
) -> DataFrame:
    """Open intervals and those closed by the snapshot of ``day``, which is later than all merged so
    far: kept where the value is the same, closed where it changed or went, begun where it is new.
    ``snapshot`` has a row per key, see ``last_values``."""
    at, none = F.lit(day).cast("date"), F.lit(None).cast("date")
    new = snapshot.select(*(quoted(k).alias(f"_k_{k}") for k in keys), quoted(value).alias("_new"))
    both = open_intervals.join(new, same_keys(keys), "full")
    old, fresh, same = quoted(value).isNotNull(), F.col("_new").isNotNull(), quoted(value) == F.col("_new")
    key = F.struct(*(F.coalesce(quoted(k), quoted(f"_k_{k}")).alias(k) for k in keys))

    def interval(v, begins, ends):
        return F.struct(v.alias("v"), begins.alias("valid_from"), ends.alias("valid_to"))

    kept = F.when(old, interval(quoted(value), F.col("valid_from"), F.when(fresh & same, none).otherwise(at)))
    begun = F.when(fresh & ~(old & same), interval(F.col("_new"), at, none))
    rows = both.select(key.alias("k"), F.explode(F.array_compact(F.array(kept, begun))).alias("i"))
    return rows.select(
        *(F.col("k")[k].alias(k) for k in keys), F.col("i.v").alias(value), *(F.col(f"i.{c}") for c in INTERVAL)
    )


def history_of(
    snapshots: DataFrame, keys: Sequence[str], value: str = "value", date_col: str = "snapshot_date"
) -> DataFrame:
    """The intervals of all snapshots at once; ``snapshots`` has a row per key and date. A window per
    key holds as many rows as there are snapshots."""
    dates = snapshots.select(F.col(date_col).alias("_d")).distinct()
    # A row per date that was landed; numbering them is no work that grows with the data.
    numbered = dates.select("_d", F.row_number().over(Window.orderBy("_d")).alias("_n"))
    following = numbered.select((F.col("_n") - 1).alias("_m"), F.col("_d").alias("_next"))
    calendar = numbered.join(following, F.col("_n") == F.col("_m"), "left").drop("_m")
    rows = snapshots.join(F.broadcast(calendar), F.col(date_col) == F.col("_d"))
    per_key = Window.partitionBy(*map(quoted, keys)).orderBy("_n")
    before = F.lag(F.struct("_n", quoted(value).alias("v"))).over(per_key)
    goes_on = (before["_n"] == F.col("_n") - 1) & (before["v"] == quoted(value))
    begun = rows.withColumn("_begun", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    island = F.sum("_begun").over(per_key)
    return begun.withColumn("_i", island).groupBy(*map(quoted, keys), "_i", quoted(value)).agg(
        F.min("_d").alias("valid_from"), F.max_by("_next", "_n").alias("valid_to")
    ).drop("_i")


def as_of(history: DataFrame, day: str) -> DataFrame:
    """The value of each key in the newest snapshot of ``day`` or before."""
    at = F.lit(day).cast("date")
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
