"""Report tables: ordered projections of the result frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.functions.scoring import display_name


def report_split_table(summary: DataFrame) -> DataFrame:
    """Split, rows, positive, negative, positive fraction; train/valid/test order."""
    return summary.select(F.initcap("split").alias("split"), "rows", "positive", "negative",
                          "positive_fraction", "split_order").orderBy("split_order")


def report_metrics(metrics: DataFrame) -> DataFrame:
    """Validation metrics sorted by model key, with display names."""
    cols = [c for c in ("PR_AUC", "ROC_AUC", "precision", "recall", "f1", "balanced_accuracy", "MCC", "fit_time_s")
            if c in metrics.columns]
    return metrics.select("model", display_name("model").alias("display_name"), *cols).orderBy("model")


def report_confusion_2x2(record: DataFrame) -> DataFrame:
    """2x2 confusion matrix: (actual, predicted_negative, predicted_positive)."""
    keep = [c for c in ("model",) if c in record.columns]
    return record.select(*keep, F.expr("stack(2, 'Neg', TN, FP, 'Pos', FN, TP)").alias(
        "actual", "predicted_negative", "predicted_positive"))


def report_scaling_table(scaling: DataFrame) -> DataFrame:
    """Scaling rows with display names (missing model = weighted LR), in run order if given."""
    model = F.coalesce(F.col("model"), F.lit("logistic_regression_weighted"))
    keep = [c for c in ("train_rows", "train_time_s", "pr_auc", "series_pos") if c in scaling.columns]
    return scaling.select(model.alias("model"), display_name(model).alias("display_name"), *keep)
