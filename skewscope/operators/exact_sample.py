"""Samples of an exact size: the rows with the least draws.

The size-th least draw comes from the distributed exact quantile; rows below it are kept by a narrow filter. Only
rows that tie at it (repeated keys, or two keys with one 52-bit draw) are numbered, by ``number_within_key``. Draws depend on the
key, the seed and the purpose alone, so samples of one purpose nest: a smaller one lies within every larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewscope.functions.hashing import draw_method, unit_draw
from skewscope.operators.labels import quantile_threshold
from skewscope.operators.ordinals import content_hash, number_within_key


def draw(key_col: str, seed: int = 42, method: str = "hash", purpose: str = "sample") -> Column:
    """The draw that ``exact_sample`` takes its rows by; to be saved with rows that several samples are taken of."""
    return unit_draw(F.coalesce(F.col(key_col).cast("string"), F.lit("")), seed, draw_method(method), purpose)


def exact_sample(df: DataFrame, size: int, key_col: str, seed: int = 42, method: str = "hash", purpose: str = "sample",
                 rows: int | None = None, content: Column | None = None, draw_col: str | None = None) -> DataFrame:
    """Exactly min(size, rows) rows of ``df`` without replacement. Null keys draw as the text ''.

    ``content`` orders rows that tie at the last draw (default: a hash of all columns). ``draw_col``: the column of ``df``
    that holds ``draw`` of the same key, seed, method and purpose; the sample is without it.
    """
    cols = [c for c in df.columns if c != draw_col]
    if size <= 0:
        return df.select(*cols).limit(0)
    drawn = df.withColumn("_draw", F.col(draw_col) if draw_col else draw(key_col, seed, method, purpose))
    n = df.count() if rows is None else rows
    if n <= size:
        return df.select(*cols)
    last = quantile_threshold(drawn, "_draw", (size - 0.5) / n, "disc").first()["threshold"]  # rank ceil(size - 0.5)
    got = drawn.agg(F.count(F.when(F.col("_draw") < last, 1)).alias("below"),
                    F.count(F.when(F.col("_draw") <= last, 1)).alias("upto")).first()
    if got["upto"] == size:
        return drawn.where(F.col("_draw") <= last).select(*cols)
    tied = number_within_key(drawn.where(F.col("_draw") == last), "_draw", content_hash(cols) if content is None else content, "_place")
    tied = tied.where(F.col("_place") <= size - got["below"])
    return drawn.where(F.col("_draw") < last).select(*cols).unionByName(tied.select(*cols))
