"""File-stream scan with running class and split balance.

A quantile over an unbounded stream has no exact value, so the label threshold
is fixed up front (e.g. ``labels.threshold_value`` over a reference batch). The
running counts are a stateful streaming aggregate keyed by (split, label):
a handful of state rows however large the stream grows, checkpointed in the
query's checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skewscope.operators.splits import assign_split


def stream_batches(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv",
                   header: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of batch files landing under ``path`` (schema is required)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def running_balance(stream: DataFrame, score_col: str, threshold: float, group_col: str,
                    id_col: str | None = None, method: str = "xxhash64") -> DataFrame:
    """Streaming (split, label, rows) counts after cleaning, labelling and the group split."""
    cols = [c for c in (group_col, score_col, id_col) if c]
    clean = stream.dropna(subset=[score_col] + ([id_col] if id_col else []))
    score = F.col(score_col).try_cast("double")
    key = F.nullif(F.col(group_col).cast("string"), F.lit(""))
    if id_col:
        key = F.coalesce(key, F.col(id_col).cast("string"))
    lab = clean.select(*cols, score.alias("_score"), key.alias("_key")).where(F.col("_score").isNotNull())
    lab = lab.withColumn("label", F.when(F.col("_score") >= F.lit(float(threshold)), 1).otherwise(0))
    split = assign_split(lab, "_key", method=method)
    return split.groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"))


def write_balance(counts: DataFrame, checkpoint: str, sink: str = "memory", name: str = "running_balance",
                  path: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the counting query; ``memory`` sink for inspection, else any format with ``path``."""
    w = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    if sink == "memory":
        return w.format("memory").queryName(name).start()
    return w.format(sink).option("path", path).start()
