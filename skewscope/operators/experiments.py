"""The remedy grid and the scaling study.

Fits run one after another (MLlib parallelises each fit); scoring is lazy and
all scored validation frames are evaluated together: one union keyed by
``model`` feeds one threshold table, so every metric of every model comes from
a single distributed job.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.functions.scoring import MODEL_KEYS
from skewscope.operators import metrics, models, resample, splits
from skewscope.operators.balance import class_counts
from skewscope.operators.evaluate import order_validation_record
from skewscope.operators.exact_sample import draw, exact_sample
from skewscope.plans.materialize import materialize

log = logging.getLogger("skewscope")

STRATEGIES = ("baseline", "weighted", "undersampled", "oversampled")
SUFFIX = {"baseline": "", "weighted": "_weighted", "undersampled": "_undersampled", "oversampled": "_oversampled"}


def model_key(family: str, strategy: str) -> str:
    return models.FAMILIES[family] + SUFFIX[strategy]


def model_order(col: str = "model") -> F.Column:
    """Position of a model key in the reference listing (unknown keys last)."""
    expr = F.lit(len(MODEL_KEYS))
    for i, k in reversed(list(enumerate(MODEL_KEYS))):
        expr = F.when(F.col(col) == k, F.lit(i)).otherwise(expr)
    return expr.cast("int")


def _fit_all(jobs, parallelism: int, registry=None) -> dict:
    """{name: (fitted, seconds)} for (name, estimator, frame) jobs, ``parallelism`` at a time."""
    def fit(name, est, df):
        return models.fit_timed(est, df) if registry is None else registry.fit(est, df, name)

    if parallelism <= 1:
        return {name: fit(name, est, df) for name, est, df in jobs}
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    def run(job):
        name, est, df = job
        return name, fit(name, est, df)

    spark = jobs[0][2].sparkSession if jobs else None
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return dict(pool.map(inheritable_thread_target(spark)(run), jobs))


@dataclass
class GridResult:
    metrics: DataFrame                       # one 15-field record per model
    scored: DataFrame                        # (model, label, p1) on validation
    fitted: dict = field(default_factory=dict)
    pos_weight: float = 1.0


def strategy_views(train: DataFrame, label_col: str, key_col: str | None, seed: int = 42,
                   method: str = "hash", pos_weight: float | None = None) -> dict[str, DataFrame]:
    """Training view per remedy; ``weighted`` carries a ``weight`` column."""
    if pos_weight is None:
        n_pos, n_neg = class_counts(train, label_col)
        pos_weight = (n_neg / n_pos) if n_pos else 1.0
    return {
        "baseline": train,
        "weighted": resample.class_weights(train, label_col, "weight", pos_weight),
        # Narrow views of the materialised train frame; MLlib caches its own input.
        "undersampled": resample.undersample(train, label_col, seed, method, key_col),
        "oversampled": resample.oversample(train, label_col, seed, method, key_col),
    }


def strategy_grid(train: DataFrame, valid: DataFrame, label_col: str = "label", features_col: str = "features",
                  key_col: str | None = None, families: Sequence[str] = ("lr", "rf"),
                  strategies: Sequence[str] = STRATEGIES, policy: str = "mcc", seed: int = 42,
                  method: str = "hash", rf_params: dict | None = None, lr_params: dict | None = None,
                  materialized: bool = False, parallelism: int = 1, registry=None) -> GridResult:
    """Fit every (family, remedy) pair on ``train`` and evaluate all on ``valid`` at once.

    ``materialized=True`` says both frames already read a written table (as
    from ``plans.study.prepare``), so they are not written again.
    ``parallelism`` > 1 submits that many fits at once (as MLlib's tuning
    does); each fit_time_s is then wall time under shared load. With a
    ``registry`` (``plans.registry.FitRegistry``) fits that an earlier run has
    finished on the same rows are loaded instead of done again.
    """
    train = train.select(*[c for c in (key_col, label_col, features_col) if c])
    valid = valid.select(label_col, features_col)
    if not materialized:
        train, valid = models.training_table(train), materialize(valid)
    n_pos, n_neg = class_counts(train, label_col)
    pw = (n_neg / n_pos) if n_pos else 1.0
    views = strategy_views(train, label_col, key_col, seed, method, pw)
    jobs = []
    for strategy in strategies:
        for family in families:
            params = (rf_params if family == "rf" else lr_params) or {}
            weight = "weight" if strategy == "weighted" else None
            est = models.estimator(family, features_col, label_col, weight, **params)
            jobs.append((model_key(family, strategy), est, views[strategy]))
    results = _fit_all(jobs, parallelism, registry)
    fitted, times = {}, []
    for name, _, _ in jobs:
        fitted[name], secs = results[name]
        times.append((name, round(secs, 2)))
    scored = models.score_all(fitted, valid, label_col)
    rec = metrics.evaluate_scores(scored, label_col, "p1", threshold=0.5, group_cols=["model"], policy=policy)
    spark = valid.sparkSession
    # One row per fitted model: a bounded, driver-made table.
    fit_times = spark.createDataFrame(times, "model string, fit_time_s double")
    rec = rec.join(F.broadcast(fit_times), "model").withColumn("model_order", model_order())
    # A few rows that several outputs read: evaluated once.
    rec = materialize(order_validation_record(rec).coalesce(1))
    return GridResult(rec.orderBy("model_order"), scored, fitted, pw)


def scaling_study(train: DataFrame, valid: DataFrame, sizes: Sequence[int], label_col: str = "label",
                  features_col: str = "features", key_col: str | None = None, families: Sequence[str] = ("lr", "rf"),
                  seed: int = 42, method: str = "hash", pos_weight: float | None = None,
                  rf_params: dict | None = None, lr_params: dict | None = None,
                  materialized: bool = False, with_size: bool = False, exact: bool = True,
                  registry=None) -> DataFrame:
    """(model, train_rows, train_time_s, pr_auc) per size and weighted family.

    ``train`` should be the whole training split (no cap). A size larger than
    it is skipped with a warning, as is an empty sample. Samples have exactly the size asked for and
    nest (``exact=False``, and the native method, draw each row at size / rows instead).
    ``with_size`` adds the size asked for.
    """
    train = train.select(*[c for c in (key_col, label_col, features_col) if c])
    valid = valid.select(label_col, features_col)
    drawn = exact and method != "native" and key_col is not None
    saved_draw = "_scale_draw" if drawn and not materialized else None
    if not materialized:
        # The samples nest by one draw: worked out once, where each sample would hash every key several times.
        train = train.withColumn(saved_draw, draw(key_col, seed, method, "scale")) if saved_draw else train
        train, valid = models.training_table(train), materialize(valid)
    n_pos, n_neg = class_counts(train, label_col)
    n = n_pos + n_neg
    pw = pos_weight if pos_weight is not None else ((n_neg / n_pos) if n_pos else 1.0)
    rows, fits = [], {}
    for size in sizes:
        if n < size:
            log.warning("scaling study: size %d skipped, the training split has %d rows", size, n)
            continue
        if drawn:
            sample = exact_sample(train, size, key_col, seed, method, "scale", rows=n, draw_col=saved_draw)
        else:
            sample = splits.fraction_sample(train, size / float(n), seed, method, key_col, purpose="scale")
        sample = resample.class_weights(sample, label_col, "weight", pw)
        if not (saved_draw and size == n):  # then it is the saved table itself
            sample = models.training_table(sample)
        actual = sample.count()
        if actual == 0:
            log.warning("scaling study: size %d skipped, its sample is empty", size)
            continue
        for family in families:
            params = (rf_params if family == "rf" else lr_params) or {}
            est = models.estimator(family, features_col, label_col, "weight", **params)
            name = model_key(family, "weighted")
            fitted, secs = models.fit_timed(est, sample) if registry is None else registry.fit(est, sample, f"{name}@{size}")
            tag = f"{name}@{size}"
            rows.append((tag, name, int(size), int(actual), round(secs, 2)))
            fits[tag] = fitted
    spark = valid.sparkSession
    runs = spark.createDataFrame(rows, "run string, model string, size long, train_rows long, train_time_s double")
    head = ["model", *(["size"] if with_size else []), "train_rows", "train_time_s"]
    if not fits:
        return runs.select(*head, F.lit(None).cast("double").alias("pr_auc"))
    scored = models.score_all(fits, valid, label_col)
    auc = metrics.evaluate_scores(scored.withColumnRenamed("model", "run"), label_col, "p1", group_cols=["run"])
    out = runs.join(F.broadcast(auc.select("run", "PR_AUC")), "run")
    return materialize(out.select(*head, F.round("PR_AUC", 4).alias("pr_auc")).coalesce(1))
