"""Model evaluation records: validation (15 fields) and test (12 fields)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.operators import metrics, models


def evaluate_model(est, train: DataFrame, valid: DataFrame, label_col: str = "label", name: str = "model",
                   policy: str = "mcc", threshold: float = 0.5) -> tuple[object, DataFrame]:
    """Fit, score validation, and return (fitted, 15-field record with fit_time_s)."""
    fitted, secs = models.fit_timed(est, models.training_table(train))
    scored = models.score_all({name: fitted}, valid, label_col)
    rec = metrics.evaluate_scores(scored, label_col, "p1", threshold=threshold, group_cols=["model"], policy=policy)
    rec = rec.withColumn("fit_time_s", F.lit(round(secs, 2)))
    return fitted, order_validation_record(rec)


VALID_FIELDS = ["model", "PR_AUC", "ROC_AUC", "precision", "recall", "f1", "balanced_accuracy", "MCC", "fit_time_s",
                "opt_threshold_policy", "opt_threshold", "opt_precision", "opt_recall", "opt_f1",
                "opt_balanced_accuracy", "opt_MCC"]
TEST_FIELDS = ["model", "PR_AUC", "ROC_AUC", "precision", "recall", "f1", "balanced_accuracy", "MCC",
               "TP", "FP", "TN", "FN", "applied_threshold"]


def order_validation_record(rec: DataFrame) -> DataFrame:
    extra = [c for c in rec.columns if c not in VALID_FIELDS]
    return rec.select(*VALID_FIELDS, *extra)
