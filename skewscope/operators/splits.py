"""Group-aware train/valid/test split by hashing a group key.

The split is a narrow projection (no shuffle): every row of a group hashes to
the same bucket, so no group can cross splits however skewed the groups are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewscope.functions.hashing import draw_method, hash_bucket, unit_draw
from skewscope.operators.exact_sample import exact_sample

# Bucket ranges of the 80/10/10 split over 100 buckets.
TRAIN_BELOW = 80
VALID_BELOW = 90
BUCKETS = 100


def group_key(df: DataFrame, key_col: str, fallback_col: str, out: str = "group_key",
              empty_as_group: bool = False) -> DataFrame:
    """Group key with a per-record fallback when the key is missing.

    By default an empty string counts as missing; ``empty_as_group=True``
    keeps '' as one shared group (only null falls back).
    """
    key = F.col(key_col).cast("string")
    if not empty_as_group:
        key = F.nullif(key, F.lit(""))
    return df.withColumn(out, F.coalesce(key, F.col(fallback_col).cast("string")))


def split_of(bucket: Column, train_below: int = TRAIN_BELOW, valid_below: int = VALID_BELOW) -> Column:
    return (F.when(bucket < train_below, F.lit("train"))
            .when(bucket < valid_below, F.lit("valid"))
            .otherwise(F.lit("test")))


def assign_split(df: DataFrame, key_col: str, split_col: str = "split", bucket_col: str = "bucket",
                 method: str = "xxhash64", buckets: int = BUCKETS, train_below: int = TRAIN_BELOW,
                 valid_below: int = VALID_BELOW) -> DataFrame:
    """Add ``bucket`` (hash of the key mod ``buckets``) and ``split``."""
    b = hash_bucket(F.col(key_col), buckets, method)
    return df.withColumn(bucket_col, b).withColumn(split_col, split_of(F.col(bucket_col), train_below, valid_below))


def split_frames(df: DataFrame, split_col: str = "split") -> dict[str, DataFrame]:
    """Three filtered views; the filter is on a deterministic column, so each
    split prunes at the scan when the frame is read back from partitioned files."""
    return {s: df.where(F.col(split_col) == s).drop(split_col) for s in ("train", "valid", "test")}


def _split_code(split_col: str) -> Column:
    # Int code so min/max run in the hash aggregate (string min/max would sort).
    return F.array_position(F.array(*[F.lit(x) for x in ("train", "valid", "test")]), F.col(split_col)).cast("int")


def leakage(df: DataFrame, key_col: str, split_col: str = "split") -> DataFrame:
    """Groups seen in more than one split (should be empty).

    min/max aggregate partially on the map side, so a group holding a third of
    the rows is a handful of rows by the time it is shuffled.
    """
    per = df.groupBy(key_col).agg(F.min(_split_code(split_col)).alias("first_split"),
                                  F.max(_split_code(split_col)).alias("last_split"))
    return per.where(F.col("first_split") != F.col("last_split"))


def leakage_summary(df: DataFrame, key_col: str, split_col: str = "split") -> DataFrame:
    """One row: groups, leaking_groups."""
    per = df.groupBy(key_col).agg(F.min(_split_code(split_col)).alias("a"), F.max(_split_code(split_col)).alias("b"))
    return per.agg(F.count(F.lit(1)).alias("groups"),
                   F.sum(F.when(F.col("a") != F.col("b"), 1).otherwise(0)).cast("long").alias("leaking_groups"))


def cap_rows(df: DataFrame, cap: int, seed: int = 42, method: str = "hash", key_col: str | None = None,
             rows: int | None = None, exact: bool = False) -> DataFrame:
    """Keep about ``cap`` rows when the frame is larger (Bernoulli at cap/rows), or, with ``exact``, just as many.

    ``method="hash"`` keeps a row when its keyed draw is below the fraction
    (partition-independent, needs ``key_col``); ``"native"`` uses
    ``DataFrame.sample``. Frames at or below the cap are returned unchanged.
    """
    n = df.count() if rows is None else rows
    if not cap or n <= cap:
        return df
    if exact and method != "native":
        if key_col is None:
            raise ValueError("hash sampling needs key_col")
        return exact_sample(df, cap, key_col, seed, method, "cap", rows=n)
    return fraction_sample(df, cap / float(n), seed, method, key_col, purpose="cap")


def fraction_sample(df: DataFrame, fraction: float, seed: int = 42, method: str = "hash",
                    key_col: str | None = None, purpose: str = "sample") -> DataFrame:
    """Sample without replacement at ``fraction`` (clamped to [0, 1]).

    ``method``: ``"hash"`` (md5), ``"xxhash64"`` or ``"native"``. ``purpose``
    names the draw, so that samples of samples stay independent.
    """
    fraction = min(max(fraction, 0.0), 1.0)
    if method == "native":
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    if key_col is None:
        raise ValueError("hash sampling needs key_col")
    return df.where(unit_draw(F.col(key_col), seed, draw_method(method), purpose) < F.lit(fraction))
