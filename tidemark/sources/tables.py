"""Tables of a run: written to folders of their own, then made current all at once.

A run never touches the files an earlier run published. When all its tables are complete, one row
per table (or kept folder) is added to ``<root>/published`` in a single file; readers look there for
the current folders. So a job that dies leaves the last published state whole, and empty tables
replace full ones like any other.

The files of ``published`` are numbered, and a number is taken once: a run that was begun on the state
of one number can only become the next. Of two runs begun on one state the second to end is refused."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from time import time_ns
from urllib.parse import unquote
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import folder_bytes, storage
from tidemark.sources.schemas import CLUSTERS, PARTITIONS, SCHEMAS, STAGING, conform

# ``refresh`` replaces like ``replace``, and keeps the folders of partitions whose rows are the same.
MODES = ("replace", "append", "refresh")
# An appending run adds rows to these; it writes the others whole.
GROWING = (*STAGING, "fact_health_indicator", "value_history_closed")
# What runs compare themselves with; nobody asks for it by name, nor is it among a run's figures.
BOOKKEEPING = ("partition_marks",)
RUN = "run"
_VERSION = "version-"
_PUBLISHED = ("published_ns", "run_id", "run_ts", "mode", "table_name", "path")
_PUBLISHED_TYPES = ("bigint", "string", "timestamp", "string", "string", "string")


def new_run_id(run_ts: datetime) -> str:
    """Never used before, also when a run is repeated with its old time."""
    return f"{run_ts:%Y%m%dT%H%M%S}-{uuid4().hex}"


def table_path(root: str, run_id: str, name: str) -> str:
    """The folder of one table of a run. Those of a partitioned table lie side by side with the run
    as one more partition, so that the folders of several runs are read in one scan."""
    if name in PARTITIONS:
        return f"{root}/{name}/{RUN}={run_id}"
    return f"{root}/runs/{run_id}/{name}"


def run_folder(path: str) -> str | None:
    """The folder of a run's part of a partitioned table that ``path`` is, or is a partition in; None
    for a path in another layout."""
    above, mark, below = path.rpartition(f"/{RUN}=")
    return f"{above}{mark}{below.split('/')[0]}" if mark else None


def same_table(a: str, b: str) -> bool:
    """Whether two folders belong to one partitioned table, as one scan needs them."""
    tables = {None if f is None else f.split("/")[-2] for f in map(run_folder, (a, b))}
    return len(tables) == 1 and None not in tables


def write_table(df: DataFrame, root: str, run_id: str, name: str, dealt: bool = False) -> int:
    """Write one table of a run and return its number of rows, counted during the write.

    A partitioned table is dealt by ranges of its partition and cluster columns, and sorted: a task
    writes one stretch of it, small folders share a task, and a folder with a third of the data is
    split over many tasks, each with a range of its own. Rows that are ``dealt`` already, by ranges of
    some of these columns, are sorted where they are."""
    out = conform(df, name)
    parts = PARTITIONS.get(name, ())
    if parts:
        order = [*parts, *CLUSTERS.get(name, ())]
        out = (out if dealt else out.repartitionByRange(*order)).sortWithinPartitions(*order)
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(table_path(root, run_id, name))
    return seen.get["rows"]


def write_tables(
    frames: Mapping[str, DataFrame], root: str, run_id: str, dealt: Sequence[str] = ()
) -> dict[str, int]:
    """Write tables that do not depend on each other at the same time, so that executors done
    with one go on with the next; ``dealt`` as in ``write_table``. Returns their numbers of rows."""
    with ThreadPoolExecutor(len(frames)) as pool:
        rows = pool.map(lambda name: write_table(frames[name], root, run_id, name, name in dealt), frames)
        return dict(zip(frames, rows))


def read_paths(spark: SparkSession, name: str, paths: Sequence[str]) -> DataFrame:
    """A table kept in one or more folders, read with its fixed schema."""
    reader, own = spark.read.schema(SCHEMAS[name]), run_folder(paths[0])
    if name not in PARTITIONS or own is None:
        return reader.parquet(*paths)
    table = reader.option("basePath", own.rsplit("/", 1)[0]).parquet(*paths)
    return table.select(SCHEMAS[name].names)


def partition_folders(spark: SparkSession, name: str, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The folders below ``paths`` by the values of their partition columns, as text. As many as
    indicators and years have rows; no file is listed."""
    found: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        depth = len(PARTITIONS[name]) - (path.count("/") - (run_folder(path) or path).count("/"))
        where, store = storage(spark, path + "/*" * depth)
        for status in store.globStatus(where) or ():
            folder = status.getPath().toString()
            values = [unquote(part.partition("=")[2]) for part in folder.split("/")[-len(PARTITIONS[name]) :]]
            if status.isDirectory() and all("=" in x for x in folder.split("/")[-len(PARTITIONS[name]) :]):
                found.setdefault(tuple(values), []).append(folder)
    return found


class ConcurrentRun(RuntimeError):
    """Another run was published after this one had begun."""


def published_version(spark: SparkSession, root: str) -> int:
    """The number of the state that is published now; 0 before the first."""
    top, store = storage(spark, f"{root}/published")
    if not store.exists(top):
        return 0
    names = [f.getPath().getName() for f in store.listStatus(top)]
    return max((int(n[len(_VERSION) : -len(".parquet")]) for n in names if n.startswith(_VERSION)), default=0)


def publish(
    spark: SparkSession,
    root: str,
    run_id: str,
    run_ts: datetime,
    mode: str,
    names: Sequence[str],
    kept: Mapping[str, Sequence[str]] | None = None,
    base: int | None = None,
) -> None:
    """Make the tables of a run current. ``append`` keeps the earlier staging rows and facts beside
    them; ``kept`` names the folders of earlier runs that stay part of a table.

    ``base`` is the number of the state that the run was begun on. The file is written aside and
    renamed to the next number, which fails if that is there: ConcurrentRun."""
    check_mode(mode)
    kept, now = kept or {}, time_ns()
    listed = []
    for n in names:
        paths = [*kept.get(n, ()), table_path(root, run_id, n)]
        first = "append" if mode == "append" and n in GROWING else "replace"
        listed += [(n, p, "append" if i else first) for i, p in enumerate(paths)]
    rows = [(now + i, run_id, run_ts, how, n, p) for i, (n, p, how) in enumerate(listed)]
    base = published_version(spark, root) if base is None else base
    aside = f"{root}/published/_{run_id}"
    constant_rows(spark, rows, _PUBLISHED).write.parquet(aside)
    where, store = storage(spark, aside)
    (part,) = [f.getPath() for f in store.listStatus(where) if f.getPath().getName().endswith(".parquet")]
    target, _ = storage(spark, f"{root}/published/{_VERSION}{base + 1:010d}.parquet")
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(part, target, spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0))
    except Py4JJavaError as refused:
        if "FileAlreadyExistsException" not in str(refused.java_exception):
            raise
        raise ConcurrentRun(f"{root} was published to after run {run_id} had begun; run it again") from None
    finally:
        store.delete(where, True)


def constant_rows(
    spark: SparkSession, rows: Sequence[Sequence[object]], columns: Sequence[str]
) -> DataFrame:
    """A handful of known rows as one partition, without going through a Python worker."""
    structs = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, columns)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def published_rows(spark: SparkSession, root: str) -> list:
    """What was published, oldest first: a row per run and table, or kept folder. So the driver holds
    a list of folders, not data."""
    schema = ", ".join(map(" ".join, zip(_PUBLISHED, _PUBLISHED_TYPES)))
    try:
        return spark.read.schema(schema).parquet(f"{root}/published").orderBy("published_ns").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def current_paths(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Table name to the folders that make it up now; empty before the first run."""
    return paths_after(published_rows(spark, root))


def paths_after(rows: Iterable) -> dict[str, list[str]]:
    """Table name to its folders after ``rows`` were published."""
    paths: dict[str, list[str]] = {}
    for row in rows:
        if row.mode == "replace":
            paths[row.table_name] = [row.path]
        elif row.path not in paths.setdefault(row.table_name, []):
            paths[row.table_name].append(row.path)
    return paths


def published_bytes(spark: SparkSession, root: str) -> int:
    """The size of all tables that are current, for sizing jobs that read them."""
    paths = (p for own in current_paths(spark, root).values() for p in own)
    return sum(folder_bytes(spark, p) for p in paths)


def read_published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every published table by name, as of now."""
    return {n: read_paths(spark, n, p) for n, p in current_paths(spark, root).items()}


def key_conflicts(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``new`` that are already in ``existing``."""
    return new.select(*keys).distinct().join(
        existing.select(*keys).distinct(), list(keys), "left_semi"
    )


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Make each frame a temporary view of its session."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
