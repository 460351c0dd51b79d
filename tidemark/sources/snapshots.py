"""The dated snapshots: landing them, and finding out which are there."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What tells the files of a date apart, and a corrected file from the one that was landed.
IDENTITY = ("snapshot_date", "folder", "file", "file_bytes", "file_modified")
_IDENTITIES = "snapshot_date date, folder string, file string, file_bytes bigint, file_modified timestamp"


def land_snapshot(df: DataFrame, root: str, snapshot_date: date | str) -> None:
    """Write ``df`` as the snapshot of one date. Landing a date again replaces that date alone.

    In dynamic mode the old files go only when the new ones are complete, so a job that dies half
    way leaves the old snapshot in place."""
    (
        df.withColumn("snapshot_date", F.lit(str(snapshot_date)).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(root)
    )


def read_snapshot(spark: SparkSession, root: str, snapshot_date: date | str) -> DataFrame:
    """One landed snapshot. Only its own folder is listed, however long the history is."""
    return (
        spark.read.option("basePath", root)
        .parquet(f"{root}/snapshot_date={snapshot_date}")
        .drop("snapshot_date")
    )


def as_date(col: Column) -> Column:
    """A date column as it is; text that is not an ISO date is null."""
    return F.try_to_date(col.cast("string"), "yyyy-MM-dd")


def prior_snapshot_date(
    df: DataFrame, as_of: date | str, date_col: str = "snapshot_date"
) -> DataFrame:
    """One row: the newest snapshot date before ``as_of``, null where there is none."""
    day = as_date(F.col(date_col))
    return df.where(day < F.lit(str(as_of)).cast("date")).agg(F.max(day).alias("prior_snapshot"))


def pending_snapshots(
    files: DataFrame, landed: DataFrame, keys: Sequence[str] = ("snapshot_date", "file")
) -> DataFrame:
    """The files not landed yet. Both sides shrink to their distinct keys first, so it does not
    matter how many rows a file has."""
    return files.select(*keys).distinct().join(
        landed.select(*keys).distinct(), list(keys), "left_anti"
    )


def changed_dates(files: DataFrame, landed: DataFrame, keys: Sequence[str] = IDENTITY) -> DataFrame:
    """The dates of ``files`` whose files are not those that were landed: one is new, was changed, or
    is no longer there. Each side shrinks to its distinct keys, and one aggregation compares them."""
    sides = [df.select(*keys, F.lit(i).alias("_side")) for i, df in enumerate((files, landed))]
    seen = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.min("_side").alias("_first"), F.max("_side").alias("_last")
    )
    moved = seen.groupBy("snapshot_date").agg(
        F.min("_first").alias("_first"), F.max((F.col("_first") == F.col("_last")).cast("int")).alias("_moved")
    )
    # Dates with landed files only have no folder any more; what was landed of them stays.
    return moved.where((F.col("_first") == 0) & (F.col("_moved") == 1)).select("snapshot_date")


def record_files(files: DataFrame, raw: str) -> None:
    """Write down the identities of the files that were landed. A date's list replaces its earlier
    one, after its rows were landed: a job that dies between the two lands the date once more."""
    (
        files.select(*IDENTITY).coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(files_root(raw))
    )


def recorded_files(spark: SparkSession, raw: str) -> DataFrame:
    """The identities of the landed files; none where nothing was landed or written down."""
    try:
        return spark.read.schema(_IDENTITIES).parquet(files_root(raw)).select(*IDENTITY)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _IDENTITIES)


def files_root(raw: str) -> str:
    return f"{raw}_files"


def source_row_counts(
    df: DataFrame, keys: Sequence[str] = ("snapshot_date", "file")
) -> DataFrame:
    """Rows per source file."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
