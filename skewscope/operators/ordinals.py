"""A stable number for every row within its key, for keys that repeat.

Samplers draw from a row's key, so rows that share a key would be kept or dropped together. ``number_within_key`` numbers them
1, 2, .. in the order of a hash of their content, which does not depend on partitioning, and ``draw_key`` makes keys that differ.

No key is gathered: equal rows are first counted (partial aggregates), then all rows are cut into ranges of (key, content), so a
key with a third of the rows covers a third of the ranges. Each range numbers its own rows; keys that reach over several
ranges, at most one per boundary, get the counts of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skewscope.plans.materialize import materialize
from skewscope.plans.prefix import BROADCAST_ROW_LIMIT

#: Largest number of copies one row expands to inside a single task.
COPY_CHUNK = 10_000


def repeat_rows(df: DataFrame, times_col: str, most: int, place_col: str = "_copy") -> DataFrame:
    """Every row ``times_col`` times, with the copy's number from 0 in ``place_col``; ``most`` bounds ``times_col``.

    Beyond ``COPY_CHUNK`` copies a row is first cut into chunks that are spread over tasks.
    """
    cols = [c for c in df.columns if c != times_col]
    times = F.col(times_col).cast("long")
    if most <= COPY_CHUNK:
        return df.where(times >= 1).select(*cols, F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias(place_col))
    n_chunks = F.ceil(times / F.lit(COPY_CHUNK)).cast("long")
    chunks = df.where(times >= 1).select("*", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)).alias("_chunk"))
    first = F.col("_chunk") * F.lit(COPY_CHUNK)
    last = F.least(first + F.lit(COPY_CHUNK), times) - 1
    spread = chunks.repartition(F.xxhash64(*[F.col(c) for c in cols], F.col("_chunk")))
    return spread.select(*cols, F.explode(F.sequence(first, last)).alias(place_col))


def content_hash(cols: list[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in cols])


def number_within_key(df: DataFrame, key_col: str, content: Column | None = None, out: str = "ordinal") -> DataFrame:
    """``df`` with ``out``: 1, 2, .. within each key (null keys are one key), by ``content`` (default: a hash of all columns).

    Equal rows get successive numbers. All columns must be groupable.
    """
    cols = df.columns
    content = content_hash(cols) if content is None else content
    some = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).withColumn("_content", content)
    ranged = some.repartitionByRange(F.col(key_col), F.col("_content"), F.xxhash64(*[F.col(c) for c in cols]))
    ranged = materialize(ranged.withColumn("_part", F.spark_partition_id()))
    before = (Window.partitionBy("_part", key_col).orderBy("_content", *cols)
              .rowsBetween(Window.unboundedPreceding, -1))
    own = ranged.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    per = ranged.groupBy(key_col, "_part").agg(F.sum("_n").alias("_sum"))
    # Keys of several ranges: at most one reaches over each boundary.
    wide = per.groupBy(key_col).agg(F.count(F.lit(1)).alias("_ranges")).where("_ranges > 1").select(F.col(key_col).alias("_wide"))
    over = per.join(wide, per[key_col].eqNullSafe(F.col("_wide")), "left_semi")
    offsets = materialize(over.select(F.col(key_col).alias("_key"), F.col("_part").alias("_at"), F.coalesce(F.sum("_sum").over(
        Window.partitionBy(key_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset")))
    side = F.broadcast(offsets) if offsets.count() <= BROADCAST_ROW_LIMIT else offsets
    met = own.join(side, (F.col("_part") == F.col("_at")) & F.col(key_col).eqNullSafe(F.col("_key")), "left")
    first = F.col("_before") + F.coalesce("_offset", F.lit(0)) + 1
    most = ranged.agg(F.max("_n")).first()[0] or 1
    placed = met.select(*cols, "_n", first.alias("_first"))
    return repeat_rows(placed, "_n", int(most)).select(*cols, (F.col("_first") + F.col("_copy")).cast("long").alias(out))


def draw_key(key_col: str, ordinal_col: str = "ordinal") -> Column:
    """The key itself for a key's first row, key#ordinal for the others: unique keys draw as they always did."""
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    return F.when((F.col(ordinal_col) == 1) & F.col(key_col).isNotNull(), key).otherwise(
        F.concat(key, F.lit("#"), F.col(ordinal_col).cast("string")))


def with_draw_key(df: DataFrame, key_col: str, out: str = "draw_key", content: Column | None = None) -> DataFrame:
    """``df`` with a key that no two rows share, for any sampler's ``key_col``."""
    return number_within_key(df, key_col, content, "_ordinal").withColumn(out, draw_key(key_col, "_ordinal")).drop("_ordinal")
