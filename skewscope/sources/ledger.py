"""Staging of batch files that arrive over time, with a ledger of what is staged.

``stage_new`` lists the files behind a glob, leaves out those that the ledger holds with the same path, length and time of
change, reads only the others, and writes them as one Parquet folder under ``root/batches``. The ledger rows (path,
length, modified, rows, checksum) are written last, so a stage that broke off left no trace in the ledger: its folder is
never read, and the next run stages its files again. A file that has changed is staged again and replaces its rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skewscope.plans import files
from skewscope.sources.batches import scan_batches

LEDGER = "path string, file string, length long, modified timestamp, batch string, n_rows long, checksum decimal(38,0), staged timestamp"
FILE = "_file"


def listing(spark: SparkSession, glob: str) -> DataFrame:
    """(path, file, length, modified) of the files; their content is not read. ``file`` is the name rows carry."""
    return spark.read.format("binaryFile").load(glob).select(
        "path", F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Every file ever staged whole, one row per stage of it."""
    path = f"{root.rstrip('/')}/ledger"
    if not [n for n in files.names(spark, path) if n.endswith(".parquet")]:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The ledger's last row of each file."""
    last = Window.partitionBy("path").orderBy(F.desc("staged"), F.desc("batch"))
    return ledger(spark, root).withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def file_sums(rows: DataFrame) -> DataFrame:
    """(file, n_rows, checksum) of staged rows; the checksum does not depend on their order or partitions."""
    cols = sorted(c for c in rows.columns if c != FILE)
    return rows.groupBy(F.col(FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).cast("decimal(38,0)").alias("checksum"))


def stage_new(spark: SparkSession, glob: str, root: str, fmt: str = "csv", schema=None, infer_schema: bool = False) -> int:
    """Stage the files behind ``glob`` that are new or changed; returns how many there were."""
    root = root.rstrip("/")
    have = current(spark, root).select("path", "length", "modified")
    new = listing(spark, glob).join(have, ["path", "length", "modified"], "left_anti").select(
        "path", "file", "length", "modified").collect()  # one row per new file
    if not new:
        return 0
    batch = uuid.uuid4().hex
    # A file that changes from now on has another length or time in the next listing and is staged again.
    rows = scan_batches(spark, [r["path"] for r in new], fmt=fmt, schema=schema, infer_schema=infer_schema)
    rows.select("*", F.col("_metadata.file_path").alias(FILE)).write.parquet(f"{root}/batches/{batch}")
    sums = file_sums(spark.read.parquet(f"{root}/batches/{batch}"))
    listed = spark.createDataFrame(new, "path string, file string, length long, modified timestamp")
    entry = listed.join(sums, "file", "left").select(
        "path", "file", "length", "modified", F.lit(batch).alias("batch"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce("checksum", F.lit(0)).cast("decimal(38,0)").alias("checksum"), F.current_timestamp().alias("staged"))
    entry.coalesce(1).write.mode("append").parquet(f"{root}/ledger")
    return len(new)


def staged(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the files as last staged, with ``_file``."""
    root = root.rstrip("/")
    now = current(spark, root).where("n_rows > 0").select(F.col("file").alias(FILE), "batch")
    names = [r["batch"] for r in now.select("batch").distinct().collect()]  # one per stage
    if not names:
        raise FileNotFoundError(f"nothing is staged under {root}")
    out = None
    for name in names:
        one = spark.read.parquet(f"{root}/batches/{name}").withColumn("batch", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if ledger(spark, root).count() > current(spark, root).count():  # some file was replaced
        out = out.join(now, [FILE, "batch"], "left_semi")
    return out.drop("batch")


def mismatches(spark: SparkSession, root: str) -> DataFrame:
    """Files whose staged rows are not those that the ledger states."""
    want = current(spark, root).select("file", "n_rows", "checksum")
    got = file_sums(staged(spark, root)).withColumnsRenamed({"n_rows": "got_rows", "checksum": "got_checksum"})
    met = want.join(got, "file", "full")
    same = F.coalesce("n_rows", F.lit(0)).eqNullSafe(F.coalesce("got_rows", F.lit(0))) & F.coalesce(
        "checksum", F.lit(0)).eqNullSafe(F.coalesce("got_checksum", F.lit(0)))
    return met.where(~same)


def sweep(spark: SparkSession, root: str) -> int:
    """Delete the folders of stages that broke off (no ledger row names them); only while no stage is running."""
    root = root.rstrip("/")
    known = {r["batch"] for r in ledger(spark, root).select("batch").distinct().collect()}
    broken = [n for n in files.names(spark, f"{root}/batches") if n not in known]
    return sum(files.delete(spark, f"{root}/batches/{n}") for n in broken)
