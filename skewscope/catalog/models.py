"""Model queries (rows 11, 33-37, 47, 52): MLlib fits, checked by what any right fit must satisfy.

Fitted values differ between engines, so a query returns what SQL can state: the class counts
behind the confusion record, whether every rate is in its range, for a score its distance
from the logistic function, and for a logistic regression whether the (weighted) sum of p1
equals the (weighted) sum of labels on the training rows, as it does at the optimum.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.catalog._registry import register
from skewscope.catalog.fixtures import document_features, embedding_splits
from skewscope.catalog.splitting import MD5_BUCKET, SPLIT, U
from skewscope.functions.scoring import MODEL_KEYS
from skewscope.operators import evaluate, experiments, models, splits

RATES = ("PR_AUC", "ROC_AUC", "precision", "recall", "f1", "balanced_accuracy")
SUM_TOLERANCE = 1e-3


def in_range() -> F.Column:
    """Every rate of a record within [0, 1] and MCC within [-1, 1] (to rounding)."""
    eps = 1e-9
    ok = F.abs(F.col("MCC")) <= 1 + eps
    for c in RATES:
        ok = ok & F.col(c).between(-eps, 1 + eps)
    return ok


def record_check(rec: DataFrame, *keep: str) -> DataFrame:
    """A record reduced to what SQL can restate: class counts and ranges."""
    return rec.select(*keep, (F.col("TP") + F.col("FN")).alias("positives"),
                      (F.col("FP") + F.col("TN")).alias("negatives"), in_range().alias("in_range"))


def split_sql(key: str) -> str:
    return SPLIT.format(b=MD5_BUCKET.format(k=key))


COUNTS_SQL = ("CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives, "
              "TRUE AS in_range")
EMBEDDINGS_SQL = f"""WITH e AS (
SELECT CAST(vec_id AS VARCHAR) AS key, CAST(CASE WHEN label = 0 THEN 1 ELSE 0 END AS INTEGER) AS label,
       {split_sql('CAST(vec_id AS VARCHAR)')} AS split
FROM embeddings)"""


@register("score_p1", EMBEDDINGS_SQL + """
SELECT key, label, 0e0 AS p1_error FROM e WHERE split = 'valid'""")
def score_p1(spark, sf):
    s = embedding_splits(spark, sf)
    fitted, _ = models.fit_timed(models.logistic_regression(), s["train"])
    scored = models.score(fitted, s["valid"], "label", keep=["key", "features"])
    w = F.array(*[F.lit(float(c)) for c in fitted.coefficients])
    margin = F.aggregate(F.zip_with(vector_to_array("features"), w, lambda x, c: x * c),
                         F.lit(float(fitted.intercept)), lambda acc, x: acc + x)
    return scored.select("key", "label", F.round(F.abs(F.col("p1") - 1 / (1 + F.exp(-margin))), 9).alias("p1_error"))


def _fit_record(spark, sf, family, weighted):
    s = embedding_splits(spark, sf)
    train = s["train"]
    weight = None
    if weighted:
        from skewscope.operators.resample import class_weights
        train, weight = class_weights(train, "label"), "weight"
    est = models.estimator(family, "features", "label", weight)
    name = experiments.model_key(family, "weighted" if weighted else "baseline")
    fitted, rec = evaluate.evaluate_model(est, train, s["valid"], "label", name)
    out = record_check(rec, "model")
    if family != "lr":
        return out
    w = F.col(weight) if weight else F.lit(1.0)
    sums = models.score(fitted, train, "label", keep=[weight] if weight else []).agg(
        F.sum(w * F.col("p1")).alias("p"), F.sum(w * F.col("label")).alias("y")).first()
    return out.withColumn("sums_agree", F.lit(abs(sums["p"] - sums["y"]) <= SUM_TOLERANCE * sums["y"]))


def _fit_sql(model: str, extra: str = "") -> str:
    return f"{EMBEDDINGS_SQL}\nSELECT '{model}' AS model, {COUNTS_SQL}{extra} FROM e WHERE split = 'valid'"


@register("fit_lr", _fit_sql("logistic_regression", ", TRUE AS sums_agree"))
def fit_lr(spark, sf):
    return _fit_record(spark, sf, "lr", False)


@register("fit_rf", _fit_sql("random_forest"))
def fit_rf(spark, sf):
    return _fit_record(spark, sf, "rf", False)


@register("fit_lr_weighted", _fit_sql("logistic_regression_weighted", ", TRUE AS sums_agree"))
def fit_lr_weighted(spark, sf):
    return _fit_record(spark, sf, "lr", True)


@register("fit_rf_weighted", _fit_sql("random_forest_weighted"))
def fit_rf_weighted(spark, sf):
    return _fit_record(spark, sf, "rf", True)


@register("strategy_grid", EMBEDDINGS_SQL + f""",
c AS (SELECT {COUNTS_SQL} FROM e WHERE split = 'valid')
SELECT m.model, c.* FROM (SELECT unnest({list(MODEL_KEYS)}) AS model) m, c""")
def strategy_grid(spark, sf):
    s = embedding_splits(spark, sf)
    grid = experiments.strategy_grid(s["train"], s["valid"], "label", "features", key_col="key")
    return record_check(grid.metrics, "model")


@register("evaluate_model", f"""WITH d AS (
SELECT l.toxic AS label, {split_sql('CAST(d.doc_id AS VARCHAR)')} AS split
FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'logistic_regression' AS model, {COUNTS_SQL} FROM d WHERE split = 'valid'""")
def evaluate_model(spark, sf):
    docs = document_features(spark, sf)
    parts = splits.split_frames(splits.assign_split(docs, "key", method="md5"))
    train = parts["train"].unionByName(parts["test"])  # labelled docs are few: train on non-valid rows
    _, rec = evaluate.evaluate_model(models.logistic_regression(), train, parts["valid"], "label",
                                     "logistic_regression")
    return record_check(rec, "model")


SCALING_FRACTIONS = (0.1, 0.5, 1.0)


@register("scaling_study", EMBEDDINGS_SQL + f""",
t AS (SELECT {U.format(k='key', p='scale')} AS u FROM e WHERE split = 'train'),
n AS (SELECT count(*) AS n FROM t),
z AS (SELECT greatest(1, CAST(floor(n.n * f.f) AS BIGINT)) AS size, n.n
      FROM n, (SELECT unnest([{', '.join(f'{f}e0' for f in SCALING_FRACTIONS)}]) AS f) f),
r AS (SELECT z.size, count(*) AS train_rows FROM t JOIN z ON t.u < z.size / CAST(z.n AS DOUBLE) GROUP BY z.size)
SELECT m.model, r.size, r.train_rows, TRUE AS in_range
FROM r, (SELECT unnest(['logistic_regression_weighted', 'random_forest_weighted']) AS model) m""")
def scaling_study(spark, sf):
    s = embedding_splits(spark, sf)
    n = s["train"].count()
    sizes = [max(1, int(n * f)) for f in SCALING_FRACTIONS]
    out = experiments.scaling_study(s["train"], s["valid"], sizes, "label", "features", key_col="key", with_size=True,
                                    exact=False)
    return out.select("model", "size", "train_rows", F.col("pr_auc").between(0, 1).alias("in_range"))


@register("study_documents", f"""WITH q AS (SELECT quantile_disc(n_chars, 0.8) AS t FROM documents),
d AS (SELECT CAST(CASE WHEN n_chars >= (SELECT t FROM q) THEN 1 ELSE 0 END AS INTEGER) AS label,
             {split_sql('md5(text)')} AS split
      FROM documents WHERE text IS NOT NULL AND n_chars IS NOT NULL)
SELECT {COUNTS_SQL}, TRUE AS known_model FROM d WHERE split = 'test'""")
def study_documents(spark, sf):
    """Whole pipeline on documents: label long texts (n_chars >= q80), split by text hash,
    eight-way remedy grid, select by PR-AUC, test record at the chosen threshold."""
    from skewscope.catalog.fixtures import document_study_frame
    from skewscope.plans import study

    data = study.prepare(document_study_frame(spark, sf), "n_chars", "group", "key", hash_method="md5")
    res = study.run_study(data, key_col="key")
    known = F.col("model").isin(*MODEL_KEYS).alias("known_model")
    return record_check(res.test_record.withColumn("known_model", known), "known_model")
