"""What the operators need from the cluster: this package on every worker, folders all can reach."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_dir

_SHIPPED: set[str] = set()
# Rows of a few numbers or words that the last step before a file reads.
FILE_ROWS = 1 << 17


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    # The archive is read by Spark's own file service on the driver; no executor looks for it here.
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent).as_posix())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def folder(spark: SparkSession, purpose: str) -> str:
    """The name of a new folder that all executors and the driver can reach."""
    return f"{shared_dir(spark)}/{purpose}-{uuid4().hex}"


def files_for(spark: SparkSession, rows: int, waves: int = 1) -> int:
    """Files for a table of small rows whose last step reads ``rows``: in proportion to them, and so
    many at least that all cores have ``waves`` tasks."""
    return max(waves * spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))


def written(df: DataFrame, purpose: str, files: int | None = None, dealt: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and a lost executor
    costs no recomputation of what came before.

    ``files`` is the most files there will be. Without it there is one for each partition that has
    rows, however few, and to make a file costs more than some thousand rows do; on a local disk,
    Hadoop starts a process for each permission that it sets, which for a moment has all the memory
    of the executor. The last step then runs in as many tasks; if it works hard, its few rows are
    dealt to the files (``dealt``)."""
    spark, path = df.sparkSession, folder(df.sparkSession, purpose)
    if files is not None:
        df = df.repartition(files) if dealt else df.coalesce(files)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
