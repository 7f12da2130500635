"""Class-balance aggregations: one partial+final hash aggregate each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLITS = ("train", "valid", "test")


def _pos(label_col: str) -> F.Column:
    return F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("long")


def _neg(label_col: str) -> F.Column:
    return F.sum(F.when(F.col(label_col) == 0, 1).otherwise(0)).cast("long")


def _fractions(rows: str = "rows") -> list[F.Column]:
    r = F.col(rows)
    return [
        F.when(r > 0, F.col("positive") / r).otherwise(F.lit(0.0)).alias("positive_fraction"),
        F.when(r > 0, F.col("negative") / r).otherwise(F.lit(0.0)).alias("negative_fraction"),
    ]


def class_balance(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, count) ordered by label."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count")).orderBy(label_col)


def class_counts(df: DataFrame, label_col: str = "label") -> tuple[int, int]:
    """(n_pos, n_neg) on the driver: two numbers from one aggregate."""
    row = df.agg(_pos(label_col).alias("p"), _neg(label_col).alias("n")).first()
    return int(row["p"] or 0), int(row["n"] or 0)


def split_summary(df: DataFrame, split_col: str = "split", label_col: str = "label",
                  splits: Sequence[str] = SPLITS) -> DataFrame:
    """Rows, positives, negatives and both fractions per split, in one pass.

    Every listed split is reported, empty ones with zeros; ``split_order`` keeps
    the listed order.
    """
    spark = df.sparkSession
    spine = spark.createDataFrame([(s, i) for i, s in enumerate(splits)], f"{split_col} string, split_order int")
    agg = (df.where(F.col(split_col).isin(list(splits)))
           .groupBy(split_col)
           .agg(F.count(F.lit(1)).alias("rows"), _pos(label_col).alias("positive"), _neg(label_col).alias("negative")))
    # Both sides hold at most len(splits) rows.
    joined = spine.join(F.broadcast(agg), on=split_col, how="left")
    filled = joined.select(
        split_col, "split_order",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("rows", "positive", "negative")])
    return filled.select(split_col, "split_order", "rows", "positive", "negative", *_fractions())


def overall_balance(df: DataFrame, label_col: str = "label", feature_mode: str | None = None) -> DataFrame:
    """One row: total_rows, positive, negative, both fractions, feature_mode."""
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"), F.coalesce(_pos(label_col), F.lit(0)).cast("long").alias("positive"),
                 F.coalesce(_neg(label_col), F.lit(0)).cast("long").alias("negative"))
    return agg.select("total_rows", "positive", "negative", *_fractions("total_rows"),
                      F.lit(feature_mode).cast("string").alias("feature_mode"))


def pos_weight(df: DataFrame, label_col: str = "label") -> DataFrame:
    """One row: n_pos, n_neg, pos_weight = n_neg / n_pos (1.0 without positives)."""
    agg = df.agg(_pos(label_col).alias("n_pos"), _neg(label_col).alias("n_neg"))
    agg = agg.select(F.coalesce("n_pos", F.lit(0)).cast("long").alias("n_pos"),
                     F.coalesce("n_neg", F.lit(0)).cast("long").alias("n_neg"))
    w = F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos")).otherwise(F.lit(1.0))
    return agg.select("n_pos", "n_neg", w.alias("pos_weight"))


def imbalance_ratio(balance: DataFrame) -> DataFrame:
    """Negatives per positive from an ``overall_balance`` row: (1-f)/f, null if f=0."""
    f = F.col("positive_fraction")
    ratio = F.when(f > 0, (F.lit(1.0) - f) / f)
    return balance.select("total_rows", "positive", "negative", "positive_fraction", ratio.alias("imbalance_ratio"))
