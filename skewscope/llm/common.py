"""Helpers shared by the text operators.

Row identity: a document row is known by ``(doc_id, row_hash(text))``, so rows that
repeat a ``doc_id`` with other text stay apart and exact repeats share one result.
Joins on it are null-safe. A null text counts as the empty text everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewscope.plans.materialize import table_path

ROW = ("doc_id", "row_hash")


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and row_hash; every other column is left out."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("row_hash"))


def save(df: DataFrame) -> DataFrame:
    """Write once under the shared checkpoint folder and read back (cuts lineage)."""
    path = table_path(df)
    df.write.mode("errorifexists").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete saved tables that no later plan reads."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.saved_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_bytes(spark, limit: int) -> Iterator[None]:
    """Actions meanwhile hand rows to Python in batches of about ``limit`` bytes; a longer row is one of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def attach(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """Join the columns ``names`` of ``right`` to ``left`` on the row identity."""
    r = right.select(F.col("doc_id").alias("_r_doc"), F.col("row_hash").alias("_r_hash"), *names)
    cond = left["doc_id"].eqNullSafe(r["_r_doc"]) & (left["row_hash"] == r["_r_hash"])
    return left.join(r, cond, how).drop("_r_doc", "_r_hash")


def decide(docs: DataFrame, decisions: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with all its own columns plus ``names`` of ``decisions`` (one row per identity).

    Used by pipeline stages; the caller picks ``names`` that start with ``_llm_``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    left = docs.withColumn("_llm_hash", F.xxhash64(text))
    r = decisions.select(F.col("doc_id").alias("_llm_doc"), F.col("row_hash").alias("_llm_rhash"), *names)
    cond = left["doc_id"].cast("long").eqNullSafe(r["_llm_doc"]) & (left["_llm_hash"] == r["_llm_rhash"])
    return left.join(r, cond, "left").drop("_llm_hash", "_llm_doc", "_llm_rhash")


def hits(text: str, pattern: str, needs: str | None = None) -> Column:
    """The leftmost non-overlapping matches of ``pattern`` in the column ``text``.

    ``needs``: a character class that every match holds; texts without it skip the costlier search.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    if needs is None:
        return found
    return F.when(F.col(text).rlike(needs), found).otherwise(F.expr("cast(array() as array<string>)"))


def place(text: str, pattern: str, found: Column) -> Column:
    """array<struct<start int, end int, hit string>> of the matches ``found`` of ``pattern``.

    Offsets in code points, end exclusive: the lengths of the matches and of the pieces between them add up to them.
    """
    empty = F.expr("cast(array() as array<struct<start:int,end:int,hit:string>>)")
    pieces = F.split(F.col(text), pattern, -1)
    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("gap"), found.alias("hit"))
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, x):
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["hit"])
        return F.struct(e.alias("at"), F.array_append(
            acc["out"], F.struct(s.alias("start"), e.alias("end"), x["hit"].alias("hit"))).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step, lambda a: a["out"])).otherwise(empty)


def join_spans(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed (field ``rank``), comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
