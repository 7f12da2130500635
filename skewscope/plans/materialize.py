"""Cut lineage of a frame that several jobs reuse.

The frame is written once as a Parquet table under the shared checkpoint folder
(``spark.checkpoint.dir``) and read back: one write job, and later readers get
column pruning, partition pruning and row counts from the footers. A lost
executor re-reads files instead of recomputing the upstream plan (e.g. a model
``transform`` over a whole split). Local runs fall back to a temporary folder
only when the setting is absent (see ``skewscope.session``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from skewscope.session import ensure_checkpoint_dir

_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession) -> str:
    """A new path under the shared checkpoint folder, removed by ``drop_tables``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/skewscope-tables/{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def table_path(df: DataFrame) -> str:
    return scratch_path(df.sparkSession)


def written() -> int:
    """How many tables this process has materialised and not dropped."""
    return len(_WRITTEN)


def drop_tables(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables this process materialised (after the first ``since``); frames reading them become invalid."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while len(_WRITTEN) > since:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        if path.getFileSystem(conf).delete(path, True):
            n += 1
    return n


def session_with(spark: SparkSession, **settings: str) -> SparkSession:
    """A session of the same context with the same settings but for ``settings`` (names with _ for the dots)."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key.replace("_", "."), value)
    return own


def one_file_per_task(spark: SparkSession) -> SparkSession:
    """A session whose scans never put two files into one task.

    Otherwise a scan packs files by their bytes, and rows that are small on disk may be many hundred bytes in memory.
    """
    return session_with(spark, spark_sql_files_openCostInBytes=spark.conf.get("spark.sql.files.maxPartitionBytes"))


def materialize(df: DataFrame, partition_by: Sequence[str] = (), rows_per_task: int | None = None) -> DataFrame:
    """The saved frame. With ``rows_per_task`` no file has more rows and each is read by a task of its own, so that what
    a task holds does not grow with the input (and no shuffle is needed for it)."""
    path = table_path(df)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_task:
        writer = writer.option("maxRecordsPerFile", rows_per_task)
    writer.parquet(path)
    reader = one_file_per_task(df.sparkSession) if rows_per_task else df.sparkSession
    out = reader.read.parquet(path)
    # Partition columns come back last; keep the caller's column order.
    return out.select(*df.columns)
