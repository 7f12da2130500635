"""A few operations on the file system behind a path (local, HDFS or an object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """The entries of a folder by name, [] when it is not there."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, seen whole or not at all: written beside its place, then renamed to it. Fails if it exists."""
    p, fs = _at(spark, path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(beside, p):
        fs.delete(beside, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
                     if size else b"").decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.delete(p, True)
