"""Model selection and comparisons over a metrics table (one row per model)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.functions.scoring import display_name
from skewscope.operators import metrics as metric_ops
from skewscope.operators.experiments import model_order

# The four LR variants in display order, and the remedy groups
# compared across families.
LR_STRATEGY_ORDER = ["logistic_regression", "logistic_regression_weighted", "logistic_regression_undersampled",
                     "logistic_regression_oversampled"]
REMEDY_GROUPS = [("Class-weighted", "_weighted"), ("Undersampled", "_undersampled"), ("Oversampled", "_oversampled")]
DEFAULT_SCALING_MODEL = "logistic_regression_weighted"


def select_best(metrics: DataFrame, metric: str = "PR_AUC", model_col: str = "model") -> DataFrame:
    """One row (model, <metric>, opt_threshold): highest metric, first listed model on ties."""
    order = model_order(model_col) if "model_order" not in metrics.columns else F.col("model_order")
    carry = [c for c in ("opt_threshold",) if c in metrics.columns]
    best = F.max(F.struct(F.col(metric).alias("m"), (-order).alias("o"), F.col(model_col).alias("model"),
                          *[F.col(c) for c in carry]))
    out = metrics.agg(best.alias("b"))
    return out.select(F.col("b.model").alias("best_model"), F.col("b.m").alias(metric),
                      *[F.col(f"b.{c}").alias(c) for c in carry]).where(F.col("best_model").isNotNull())


def test_at_best_threshold(best: DataFrame, test_scored: DataFrame, label_col: str = "label",
                           score_col: str = "p1", model_col: str = "model") -> DataFrame:
    """Test record of the winning model at its validation-chosen threshold.

    ``best`` holds at most one row (from ``select_best``); its model name and
    threshold are two scalars, applied as literals so the test plan does not
    re-run the validation evaluation.
    """
    row = best.first()
    if row is None:
        return metric_ops.evaluate_scores(test_scored.where(F.lit(False)), label_col, score_col, group_cols=[model_col])
    chosen = test_scored.where(F.col(model_col) == F.lit(row["best_model"]))
    return metric_ops.evaluate_scores(chosen, label_col, score_col, threshold=float(row["opt_threshold"]),
                                      group_cols=[model_col])


def compare_lr_strategies(metrics: DataFrame, model_col: str = "model") -> DataFrame:
    """The four LR variants present, in fixed order: position, display label, PR_AUC, f1 (0 if absent)."""
    pos = F.array_position(F.array(*[F.lit(k) for k in LR_STRATEGY_ORDER]), F.col(model_col)).cast("int")
    f1 = F.coalesce(F.col("f1"), F.lit(0.0)) if "f1" in metrics.columns else F.lit(0.0)
    return (metrics.where(F.col(model_col).isin(LR_STRATEGY_ORDER))
            .select(pos.alias("position"), F.col(model_col), display_name(F.col(model_col)).alias("label"),
                    "PR_AUC", f1.alias("f1"))
            .orderBy("position"))


def compare_lr_rf(metrics: DataFrame, model_col: str = "model", metric: str = "PR_AUC") -> DataFrame:
    """Remedy x family grid of ``metric``: (position, strategy, lr, rf)."""
    rows = []
    for i, (label, suffix) in enumerate(REMEDY_GROUPS):
        for fam, prefix in (("lr", "logistic_regression"), ("rf", "random_forest")):
            rows.append((prefix + suffix, i, label, fam))
    spark = metrics.sparkSession
    keys = spark.createDataFrame(rows, f"{model_col} string, position int, strategy string, family string")
    # keys is a fixed six-row table.
    joined = metrics.select(model_col, metric).join(F.broadcast(keys), model_col)
    return (joined.groupBy("position", "strategy").pivot("family", ["lr", "rf"]).agg(F.first(metric))
            .orderBy("position"))


def scaling_series(scaling: DataFrame) -> DataFrame:
    """Scaling rows grouped by model (missing model = weighted LR), ordered by rows."""
    from pyspark.sql import Window
    m = F.coalesce(F.col("model"), F.lit(DEFAULT_SCALING_MODEL)).alias("model")
    df = scaling.select(m, *[c for c in scaling.columns if c != "model"])
    # Windows per model: one partition per model key, each holding a few sizes.
    w = Window.partitionBy("model").orderBy("train_rows")
    return df.withColumn("series_pos", F.row_number().over(w)).orderBy("model", "train_rows")
