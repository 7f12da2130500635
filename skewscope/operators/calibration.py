"""Reliability (calibration) table: equal-width probability bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.plans.joins import join_groups


def bin_index(score_col: str, bins: int) -> F.Column:
    """floor(score * bins); scores >= 1 go to the last bin, NaN to none."""
    s = F.col(score_col)
    return F.when(F.isnan(s), F.lit(None)).when(s >= 1.0, F.lit(bins - 1)).otherwise(F.floor(s * F.lit(bins))).cast("int")


def bin_label(idx: F.Column, bins: int) -> F.Column:
    """'[0.0,0.1)' style label; the last bin is closed."""
    start = idx.cast("double") / F.lit(float(bins))
    end = (idx + 1).cast("double") / F.lit(float(bins))
    close = F.when(idx == bins - 1, F.lit("]")).otherwise(F.lit(")"))
    return F.format_string("[%.1f,%.1f%s", start, end, close)


def calibration_table(df: DataFrame, label_col: str = "label", score_col: str = "p1", bins: int = 10,
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per bin (all bins, empty ones as 0): bin_index, bin, mean_pred,
    empirical_pos_rate, count. Scores below 0, null or NaN fall in no bin."""
    group_cols = list(group_cols)
    b = bin_index(score_col, bins)
    # One pass: rows outside every bin keep a null bin, so their groups still
    # appear (and get all-empty bins) without a second scan of the input.
    agg = (df.select(*group_cols, F.when(b.between(0, bins - 1), b).alias("bin_index"), score_col, label_col)
           .groupBy(*group_cols, "bin_index")
           .agg(F.avg(score_col).alias("mean_pred"),
                F.avg(F.col(label_col).cast("double")).alias("empirical_pos_rate"),
                F.count(F.lit(1)).alias("count")))
    binned = agg.where(F.col("bin_index").isNotNull())
    if group_cols:
        # groups x bins rows, made by exploding the fixed bin range per group.
        spine = agg.select(*group_cols).distinct().select(
            *group_cols, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin_index"))
    else:
        spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin_index"))
    # binned holds at most groups x bins rows (bins is a small parameter).
    out = join_groups(spine, binned, [*group_cols, "bin_index"], "left")
    return out.select(
        *group_cols, "bin_index", bin_label(F.col("bin_index"), bins).alias("bin"),
        F.coalesce("mean_pred", F.lit(0.0)).alias("mean_pred"),
        F.coalesce("empirical_pos_rate", F.lit(0.0)).alias("empirical_pos_rate"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def calibration_points(table: DataFrame) -> DataFrame:
    """Bins with at least one row (the plotted curve)."""
    return table.where(F.col("count") > 0)
