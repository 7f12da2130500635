"""MLlib estimators of the model grid and model scoring.

Fitting is MLlib's own distributed training (tree aggregation per iteration or
tree level); scoring is a narrow ``transform`` plus a native p1 projection.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.functions.scoring import positive_probability
from skewscope.plans.materialize import materialize

# Hyper-parameters of the reference grid.
LR_MAX_ITER = 50
RF_NUM_TREES = 80
RF_MAX_DEPTH = 12
RF_MAX_BINS = 64
RF_SUBSAMPLING_RATE = 0.8
RF_FEATURE_SUBSET = "sqrt"
SEED = 42
# Execution settings (not hyper-parameters): deep trees keep per-row node ids
# cached instead of re-evaluating the trees each level, and a larger node-stat
# budget lets one data pass split more nodes. Forests of few trees are walked
# again each level: their node ids cost more than the walk, a second copy per row.
RF_CACHE_NODE_IDS = True
RF_CACHE_FROM_TREES = 8
RF_MAX_MEMORY_MB = 1024
#: Rows of one task of a fit: MLlib keeps 150 bytes and more of each row in memory, whatever its file says.
FIT_ROWS = 250_000

FAMILIES = {"lr": "logistic_regression", "rf": "random_forest"}


def logistic_regression(features_col: str = "features", label_col: str = "label", weight_col: str | None = None,
                        max_iter: int = LR_MAX_ITER) -> LogisticRegression:
    kw = {"weightCol": weight_col} if weight_col else {}
    return LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter, **kw)


def random_forest(features_col: str = "features", label_col: str = "label", weight_col: str | None = None,
                  num_trees: int = RF_NUM_TREES, max_depth: int = RF_MAX_DEPTH, max_bins: int = RF_MAX_BINS,
                  subsampling_rate: float = RF_SUBSAMPLING_RATE, feature_subset: str = RF_FEATURE_SUBSET,
                  seed: int = SEED, bootstrap: bool = True) -> RandomForestClassifier:
    kw = {"weightCol": weight_col} if weight_col else {}
    return RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=num_trees, bootstrap=bootstrap,
                                  maxDepth=max_depth, maxBins=max_bins, subsamplingRate=subsampling_rate,
                                  featureSubsetStrategy=feature_subset, seed=seed,
                                  cacheNodeIds=RF_CACHE_NODE_IDS and num_trees >= RF_CACHE_FROM_TREES,
                                  maxMemoryInMB=RF_MAX_MEMORY_MB, **kw)


def estimator(family: str, features_col: str, label_col: str, weight_col: str | None = None, **params):
    if family == "lr":
        return logistic_regression(features_col, label_col, weight_col, **params)
    if family == "rf":
        return random_forest(features_col, label_col, weight_col, **params)
    raise ValueError(f"unknown family {family!r}")


def training_table(train: DataFrame) -> DataFrame:
    """``train`` saved for fits: tasks of at most FIT_ROWS rows. MLlib passes over its input several times before it
    caches it, so what ``train`` is made of is worked out once."""
    return materialize(train, rows_per_task=FIT_ROWS)


def fit_timed(est, df: DataFrame):
    """(fitted model, wall seconds of ``fit``)."""
    start = time.time()
    fitted = est.fit(df)
    return fitted, time.time() - start


def score(fitted, df: DataFrame, label_col: str = "label", keep: Sequence[str] = (),
          model_name: str | None = None) -> DataFrame:
    """(model?, keep..., label, p1) where p1 = P(class 1) (0.0 for one-class fits)."""
    out = fitted.transform(df).select(*keep, label_col, positive_probability("probability").alias("p1"))
    if model_name is not None:
        out = out.select(F.lit(model_name).alias("model"), *out.columns)
    return out


def score_all(fitted: dict, df: DataFrame, label_col: str = "label") -> DataFrame:
    """Saved table (model, label, p1) of every model in one read of ``df``.

    Each model predicts once per row: the scores are written before anything filters or groups them.
    """
    out = df
    for k, model in enumerate(fitted.values()):
        one = model.copy()
        one.setProbabilityCol(f"_probability{k}")
        one.setRawPredictionCol("")
        one.setPredictionCol("")
        out = one.transform(out)
    each = [F.struct(F.lit(name).alias("model"), positive_probability(f"_probability{k}").alias("p1"))
            for k, name in enumerate(fitted)]
    out = out.select(label_col, F.explode(F.array(*each)).alias("_s"))
    return materialize(out.select(F.col("_s.model").alias("model"), label_col, F.col("_s.p1").alias("p1")))
