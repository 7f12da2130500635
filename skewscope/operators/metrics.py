"""Confusion counts and the metric records built on the threshold table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.functions import rates
from skewscope.operators import curves
from skewscope.plans.joins import join_groups
from skewscope.plans.prefix import BROADCAST_ROW_LIMIT, DEFAULT_ROWS_PER_RANGE

RATE_NAMES = ["precision", "recall", "f1", "balanced_accuracy", "MCC"]
SPLIT_RECORD = ["PR_AUC", "ROC_AUC", *RATE_NAMES, "TP", "FP", "TN", "FN", "applied_threshold"]
OPT_NAMES = ["opt_threshold_policy", "opt_threshold", "opt_precision", "opt_recall", "opt_f1",
             "opt_balanced_accuracy", "opt_MCC"]


def confusion(df: DataFrame, label_col: str = "label", pred_col: str = "yhat",
              group_cols: Sequence[str] = ()) -> DataFrame:
    """TP, FP, TN, FN as four conditional sums in one pass (0 on empty input)."""
    y, yhat = F.col(label_col), F.col(pred_col)

    def cnt(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")

    return df.groupBy(*group_cols).agg(
        cnt((y == 1) & (yhat == 1)).alias("TP"), cnt((y == 0) & (yhat == 1)).alias("FP"),
        cnt((y == 0) & (yhat == 0)).alias("TN"), cnt((y == 1) & (yhat == 0)).alias("FN"))


def threshold_metrics(conf: DataFrame) -> DataFrame:
    """Append precision, recall, f1, balanced_accuracy, MCC to TP/FP/TN/FN rows."""
    return conf.select("*", *rates.rate_columns())


def _attach_thresholds(table: DataFrame, thresholds: DataFrame, group_cols: Sequence[str],
                       rows: int | None = None) -> DataFrame:
    # One threshold per group: broadcast only behind a checked (or known) row count.
    n = thresholds.count() if rows is None else rows
    side = F.broadcast(thresholds) if n <= BROADCAST_ROW_LIMIT else thresholds
    return join_groups(table, side, group_cols)


def evaluate_scores(df: DataFrame, label_col: str = "label", score_col: str = "p1",
                    threshold: float | DataFrame = 0.5, group_cols: Sequence[str] = (),
                    policy: str | None = None, rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
                    reuse: bool = True, threshold_rows: int | None = None) -> DataFrame:
    """The split record, one row per group, from a single threshold table.

    Columns: PR_AUC, ROC_AUC, precision, recall, f1, balanced_accuracy, MCC,
    TP, FP, TN, FN, applied_threshold; with ``policy`` also the opt_* fields of
    the best-threshold search. ``threshold`` is a number or a frame of
    (group_cols..., applied_threshold) rows; ``threshold_rows`` is its row
    count when known (skips a counting job).
    """
    group_cols = list(group_cols)
    table = curves.threshold_table(df, label_col, score_col, group_cols, rows_per_range, reuse)
    return evaluate_table(table, threshold, group_cols, policy, threshold_rows)


def evaluate_table(table: DataFrame, threshold: float | DataFrame = 0.5, group_cols: Sequence[str] = (),
                   policy: str | None = None, threshold_rows: int | None = None) -> DataFrame:
    """``evaluate_scores`` over an existing threshold table (one aggregate, no new table)."""
    group_cols = list(group_cols)
    if isinstance(threshold, DataFrame):
        if not group_cols:
            raise ValueError("a threshold frame needs group columns")
        table = _attach_thresholds(table, threshold.select(*group_cols, "applied_threshold"), group_cols,
                                   threshold_rows)
        t = F.col("applied_threshold")
        applied = F.first("applied_threshold").alias("applied_threshold")
    else:
        t = F.lit(float(threshold))
        applied = F.lit(float(threshold)).alias("applied_threshold")
    aggs = [*curves.area_aggregates(), *curves.confusion_aggregates(t), applied]
    if policy is not None:
        aggs += curves.best_threshold_aggregates(policy)
    rec = table.groupBy(*group_cols).agg(*aggs)
    extra = [c for c in OPT_NAMES if policy is not None]
    return rec.select(*group_cols, "PR_AUC", "ROC_AUC", *rates.rate_columns(), "TP", "FP", "TN", "FN",
                      "applied_threshold", *extra)
