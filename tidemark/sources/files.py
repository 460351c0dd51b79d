"""Reading snapshot files and the alias table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.config import NA_TOKENS
from tidemark.functions.text import null_if_in, quoted, strip_text

ALIAS_SCHEMA = "alias string, iso_code string, notes string"
_LINE = "_line"
_FILE_BITS = 42  # for the place in a file: four terabytes
_SNAPSHOT_DATE = r"(?:^|[/=])(\d{4}-\d{2}-\d{2})/[^/]+$"


def normalised_columns(df: DataFrame, na_tokens: Sequence[str] = NA_TOKENS) -> list[Column]:
    """The columns of ``df``, null where a text field holds one of the "no value" tokens."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return [
        null_if_in(quoted(c), na_tokens).alias(c) if c in text else quoted(c) for c in df.columns
    ]


def read_wide(
    spark: SparkSession,
    path: str | Sequence[str],
    renames: Mapping[str, str],
    na_tokens: Sequence[str] = NA_TOKENS,
    row_id: str | None = None,
    file_col: str | None = None,
    multi_line: bool = False,
    malformed_col: str | None = None,
) -> DataFrame:
    """A wide snapshot, columns taken from the header and all read as text.

    ``row_id`` names a column that numbers the rows in file order, see ``file_order``; land the
    snapshot before relying on it. ``file_col`` names a column for the name of the file.
    ``enforceSchema=False`` makes files whose header differs from the first one fail rather than
    be read by position. A line with fewer fields than the header ends in nulls. One with more is
    never cut: reading fails, unless ``malformed_col`` names a column for such lines as they are;
    their other columns are null. Quoted line breaks need ``multi_line``, at the price of one task
    per file."""
    options = dict(header=True, quote='"', escape='"', enforceSchema=False, multiLine=multi_line)
    header = spark.read.csv(path, **options).schema
    schema = StructType([*header.fields, StructField(_LINE, StringType())])
    raw = spark.read.option("columnPruning", "false").csv(
        path, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE, **options
    )
    # The reader keeps each line whose number of fields is not the header's.
    bare = F.regexp_replace(_LINE, r'"[^"]*"?', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    too_many = F.col(_LINE).isNotNull() & (commas >= len(header.fields))
    if malformed_col:
        bad, more = F.lit(None).cast("string"), [F.when(too_many, F.col(_LINE)).alias(malformed_col)]
    else:
        bad, more = F.raise_error(F.concat(F.lit("too many fields: "), F.col(_LINE))), []
    if row_id:
        raw, order = file_order(raw, path)
        more.append(order.alias(row_id))
    if file_col:
        more.append(F.col("_metadata.file_name").alias(file_col))
    columns = [
        F.when(too_many, bad).otherwise(null_if_in(quoted(c), na_tokens)).alias(c)
        for c in header.names
    ]
    return raw.select(*columns, *more).withColumnsRenamed(dict(renames))


def file_order(raw: DataFrame, path: str | Sequence[str]) -> tuple[DataFrame, Column]:
    """``raw``, read from the files at ``path``, and a number that grows with file and line.

    Files are in order of their paths. Within one, a row counts from the first byte of its split,
    which is larger than the number of any row before it: a row has a byte at least, and a split
    that others follow fills its task alone. One row per file is listed, none is opened."""
    files = raw.sparkSession.read.format("binaryFile").load(path)
    by_path = Window.orderBy("_path")
    ranks = files.select(F.col("_metadata.file_path").alias("_path")).select(
        "_path", (F.row_number().over(by_path) - 1).cast("bigint").alias("_rank")
    )
    placed = raw.select("*", F.col("_metadata"), F.monotonically_increasing_id().alias("_id"))
    placed = placed.join(ranks, placed["_metadata.file_path"] == F.col("_path"), "left")
    row = F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    return placed, F.col("_rank") * 2**_FILE_BITS + F.col("_metadata.file_block_start") + row


def read_aliases(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The alias table with a row number in file order; no rows where there is no such file."""
    try:
        raw = spark.read.csv(path, header=True, quote='"', escape='"')
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ALIAS_SCHEMA + ", alias_row bigint")
    columns = normalised_columns(raw)
    raw, order = file_order(raw, path)
    return raw.select(*columns, order.alias("alias_row")).select(
        strip_text(F.col("alias")).alias("alias"),
        strip_text(F.col("iso_code")).alias("iso_code"),
        "notes",
        "alias_row",
    )


def storage(spark: SparkSession, path: str):
    """The path and the file system it is on, as Hadoop objects."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def dated_folders(spark: SparkSession, root: str) -> list[str]:
    """The dates of the snapshot folders directly below ``root``, oldest first.

    One listing of one folder, whatever the number of files further down. Folders that are not
    named by a date are left out."""
    top, store = storage(spark, root)
    if not store.exists(top):
        return []
    names = [f.getPath().getName() for f in store.listStatus(top) if f.isDirectory()]
    return sorted(d for d in (n.removeprefix("snapshot_date=") for n in names) if _is_date(d))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below ``path``."""
    where, store = storage(spark, path)
    return store.getContentSummary(where).getLength()


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all below it."""
    where, store = storage(spark, path)
    return store.delete(where, True)


def _is_date(text: str) -> bool:
    try:
        return date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


def snapshot_files(spark: SparkSession, root: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """One row per file in the dated folders below ``root``, with the length and modification time
    that tell a corrected file from the one before. No file is opened."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return with_snapshot_date(
        listing.select(
            "path", F.col("length").alias("file_bytes"), F.col("modificationTime").alias("file_modified")
        )
    )


def with_snapshot_date(listing: DataFrame) -> DataFrame:
    """(snapshot_date, file, folder, path) for each ``path`` below a folder named by a date, and
    what else the listing has."""
    found = F.regexp_extract("path", _SNAPSHOT_DATE, 1)
    return listing.select(
        F.try_to_date(F.when(found != "", found), "yyyy-MM-dd").alias("snapshot_date"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.regexp_replace("path", "/[^/]+$", "").alias("folder"),
        *listing.columns,
    ).where(F.col("snapshot_date").isNotNull())
