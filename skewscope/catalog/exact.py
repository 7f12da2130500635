"""Fitted models with exact oracles (rows 11, 33-37, 47, 52).

``lineitem`` rows fall in ten bands of l_quantity; the label is the top fifth of a score that rises with the band. The features
are nine indicators of the bands, so the optimum of a logistic regression is the (weighted) share of positives in each band,
and a tree over all rows (no bagging, all features) cuts off one band after the other by the best gain, then joins
leaves of one class again: SQL can say both. Every strategy, metric and threshold of the eight models follows from them,
so a model that is not fitted, or scores all rows alike, cannot pass.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skewscope.catalog._registry import register, rounded
from skewscope.catalog.fixtures import embedding_splits
from skewscope.catalog.metrics import RATES_SQL
from skewscope.catalog.models import EMBEDDINGS_SQL
from skewscope.catalog.selection import _record_sql
from skewscope.catalog.splitting import LI_KEY, MD5_BUCKET, SPLIT, U
from skewscope.functions.scoring import MODEL_KEYS
from skewscope.operators import evaluate, experiments, forest, labels, models, optimum, resample, splits
from skewscope.plans.materialize import materialize
from skewscope.sources.tables import table

BANDS = 10
#: Three equal trees: no bagging, all features at each cut.
TREES = {"num_trees": 3, "max_depth": 12, "subsampling_rate": 1.0, "feature_subset": "all", "bootstrap": False}
#: A logistic regression is at its optimum to about six digits of p1.
P1_DIGITS = 3
GRADIENT_TOLERANCE = 1e-5
SCORE = "l_extendedprice + 300 * l_quantity + CASE WHEN l_quantity > 42 THEN 45000 ELSE 0 END"
BAND = "CAST(floor((l_quantity - 1) / 5) AS INTEGER)"
ROW_KEY = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


def banded_lineitem(spark, sf):
    """key, label, band, features, split of every row."""
    li = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"), F.col("l_orderkey").cast("string").alias("group"),
        F.expr(SCORE).alias("score"), F.expr(BAND).alias("band"))
    li = labels.label_by_quantile(li, "score", "label", p=0.8, method="disc")
    li = li.withColumn("features", array_to_vector(F.array(*[(F.col("band") == b).cast("double") for b in range(1, BANDS)])))
    return splits.assign_split(li, "group", method="md5").select("key", "label", "band", "features", "split")


def banded_splits(spark, sf):
    return splits.split_frames(banded_lineitem(spark, sf))


def _draws(*purposes: str) -> str:
    return ", ".join(f"{U.format(k='key', p=p)} AS u_{p}" for p in purposes)


ROWS = f"""s0 AS (SELECT {ROW_KEY} AS key, {LI_KEY} AS grp, {SCORE} AS score, {BAND} AS band FROM lineitem),
lb AS (SELECT key, band, CAST(CASE WHEN score >= (SELECT quantile_disc(score, 0.8) FROM s0) THEN 1 ELSE 0 END AS INTEGER) AS y,
             {SPLIT.format(b=MD5_BUCKET.format(k='grp'))} AS split, {_draws('under', 'over', 'scale')} FROM s0),
tr AS (SELECT * FROM lb WHERE split = 'train'),
n AS (SELECT sum(y) AS n1, sum(1 - y) AS n0 FROM tr)"""
#: Weights of both classes by band, per strategy (class 1 is the smaller one).
STRATEGIES = """st AS (
SELECT 'baseline' AS strategy, band, sum(1 - y) * 1e0 AS n0, sum(y) * 1e0 AS n1 FROM tr GROUP BY band
UNION ALL SELECT 'weighted', band, sum(1 - y) * 1e0, sum(y) * (SELECT n0 * 1e0 / n1 FROM n) FROM tr GROUP BY band
UNION ALL SELECT 'undersampled', band, sum(CASE WHEN u_under < (SELECT n1 * 1e0 / n0 FROM n) THEN 1 - y ELSE 0 END) * 1e0,
       sum(y) * 1e0 FROM tr GROUP BY band
UNION ALL SELECT 'oversampled', band, sum(1 - y) * 1e0, sum(y * floor((SELECT n0 * 1e0 / n1 FROM n) + u_over)) FROM tr GROUP BY band)"""


def _gini(a: str, b: str) -> str:
    return f"(({a} + {b}) - ({a} * {a} + {b} * {b}) / ({a} + {b}))"


#: step by step the band with the best gain is cut off, until all bands that are left have one class.
TREE = f"""chain(strategy, step, rest, cut) AS (
    SELECT strategy, 0, list(band ORDER BY band), CAST(NULL AS INTEGER) FROM st GROUP BY strategy
    UNION ALL
    SELECT strategy, step + 1, list_filter(rest, lambda z: z <> best), best
    FROM (SELECT strategy, step, rest, arg_max(band, gain) AS best
          FROM (SELECT *, {_gini('t0', 't1')} - {_gini('n0', 'n1')} - {_gini('(t0 - n0)', '(t1 - n1)')} AS gain
                FROM (SELECT c.strategy, c.step, c.rest, s.band, s.n0, s.n1, sum(s.n0) OVER w AS t0, sum(s.n1) OVER w AS t1,
                             min(CAST(s.n1 > s.n0 AS INTEGER)) OVER w AS lo, max(CAST(s.n1 > s.n0 AS INTEGER)) OVER w AS hi
                      FROM chain c JOIN st s ON s.strategy = c.strategy AND list_contains(c.rest, s.band)
                      WINDOW w AS (PARTITION BY c.strategy))
                WHERE lo <> hi AND band > 0)
          GROUP BY strategy, step, rest)),
ends AS (SELECT strategy, rest FROM (SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY step DESC) AS r FROM chain) WHERE r = 1),
leaves AS (
    SELECT s.strategy, s.band, s.n1 / (s.n0 + s.n1) AS p1 FROM chain c JOIN st s ON s.strategy = c.strategy AND s.band = c.cut
    UNION ALL
    SELECT e.strategy, s.band, sum(s.n1) OVER w / (sum(s.n0) OVER w + sum(s.n1) OVER w)
    FROM ends e JOIN st s ON s.strategy = e.strategy AND list_contains(e.rest, s.band) WINDOW w AS (PARTITION BY e.strategy))"""
SUFFIXES = "CASE strategy " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in experiments.SUFFIX.items()) + " END"
FITTED = f"""WITH RECURSIVE {ROWS}, {STRATEGIES}, {TREE},
fit AS (SELECT 'logistic_regression' || {SUFFIXES} AS model, band, n1 / (n0 + n1) AS p1 FROM st
        UNION ALL SELECT 'random_forest' || {SUFFIXES}, band, p1 FROM leaves)"""
GRID = f"""{FITTED},
ms AS (SELECT f.model, lb.y, f.p1, lb.split FROM lb JOIN fit f USING (band)),
{_record_sql("split = 'valid'")}"""
RECORD = f"""
SELECT k.model, round(PR_AUC, 9) AS PR_AUC, round(ROC_AUC, 9) AS ROC_AUC, TP, FP, TN, FN, {RATES_SQL},
       round(b.threshold, {P1_DIGITS}) AS opt_threshold, round(b.val, 9) AS opt_MCC
FROM k JOIN b ON k.model = b.model"""


def _record(rec):
    rec = rec.select("model", "PR_AUC", "ROC_AUC", "TP", "FP", "TN", "FN", "precision", "recall", "f1", "balanced_accuracy", "MCC",
                     F.round("opt_threshold", P1_DIGITS).alias("opt_threshold"), "opt_MCC")
    return rounded(rec)


@register("grid_records", GRID + RECORD)
def grid_records(spark, sf):
    """All eight models of the grid: every metric and the best threshold of each."""
    s = banded_splits(spark, sf)
    grid = experiments.strategy_grid(s["train"], s["valid"], "label", "features", key_col="key", rf_params=TREES)
    return _record(grid.metrics)


@register("evaluate_records", GRID + RECORD + "\nWHERE k.model IN ('logistic_regression', 'random_forest')")
def evaluate_records(spark, sf):
    """``evaluate_model`` of one estimator of either family."""
    s = banded_splits(spark, sf)
    out = []
    for family, params in (("lr", {}), ("rf", TREES)):
        est = models.estimator(family, "features", "label", **params)
        out.append(evaluate.evaluate_model(est, s["train"], s["valid"], "label", models.FAMILIES[family])[1])
    return _record(out[0].unionByName(out[1]))


@register("band_scores", FITTED + f"""
SELECT model, band, count(*) AS n_rows, round(p1, {P1_DIGITS}) AS least_p1, round(p1, {P1_DIGITS}) AS most_p1
FROM lb JOIN fit USING (band) WHERE split = 'test' GROUP BY model, band, p1""")
def band_scores(spark, sf):
    """p1 of every test row by all eight models; forests by their node tables instead of MLlib's transform."""
    s = banded_splits(spark, sf)
    views = experiments.strategy_views(models.training_table(s["train"].select("key", "label", "features")), "label", "key")
    test = materialize(s["test"].select("band", "features"))
    regressions, walked = {}, None
    for strategy, train in views.items():
        weight = "weight" if strategy == "weighted" else None
        regressions[experiments.model_key("lr", strategy)], _ = models.fit_timed(
            models.logistic_regression("features", "label", weight), train)
        rf, _ = models.fit_timed(models.random_forest("features", "label", weight, **TREES), train)
        one = forest.walk(test, forest.node_table(rf)).withColumn("model", F.lit(experiments.model_key("rf", strategy)))
        walked = one if walked is None else walked.unionByName(one)
    scored = models.score_all(regressions, test, "band").unionByName(walked)
    return scored.groupBy("model", "band").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.min("p1"), P1_DIGITS).alias("least_p1"),
        F.round(F.max("p1"), P1_DIGITS).alias("most_p1"))


@register("forest_nodes", f"""WITH RECURSIVE {ROWS}, {STRATEGIES}, {TREE}
SELECT t.tree, CAST(c.step AS INTEGER) AS level, round(sum(s.n0), 6) AS votes0, round(sum(s.n1), 6) AS votes1, 0e0 AS miscounted
FROM chain c JOIN st s ON s.strategy = c.strategy AND list_contains(c.rest, s.band), (SELECT unnest([0, 1, 2]) AS tree) t
WHERE c.strategy = 'weighted' GROUP BY t.tree, c.step
UNION ALL
SELECT t.tree, CAST(c.step AS INTEGER), round(s.n0, 6), round(s.n1, 6), 0e0
FROM chain c JOIN st s ON s.strategy = c.strategy AND s.band = c.cut, (SELECT unnest([0, 1, 2]) AS tree) t
WHERE c.strategy = 'weighted'""")
def forest_nodes(spark, sf):
    """The node table of the weighted forest, and whether the training rows that pass a node make up its votes."""
    train = resample.class_weights(models.training_table(banded_splits(spark, sf)["train"].select("label", "features")), "label")
    fitted, _ = models.fit_timed(models.random_forest("features", "label", "weight", **TREES), train)
    n = forest.node_counts(train, forest.node_table(fitted), weight_col="weight")
    off = F.abs(F.col("met0") - F.col("votes0")) + F.abs(F.col("met1") - F.col("votes1"))
    return n.select("tree", "level", F.round("votes0", 6).alias("votes0"), F.round("votes1", 6).alias("votes1"),
                    F.round(off, 6).alias("miscounted"))


def _walk(spark, sf, weighted: bool):
    s = embedding_splits(spark, sf)
    train, weight = (resample.class_weights(s["train"], "label"), "weight") if weighted else (s["train"], None)
    fitted, _ = models.fit_timed(models.random_forest("features", "label", weight), train)
    scored = models.score(fitted, s["valid"], "label", keep=["key", "features"]).withColumnRenamed("p1", "mllib")
    return forest.walk(scored, forest.node_table(fitted)).select(
        "key", "label", F.round(F.abs(F.col("p1") - F.col("mllib")), 9).alias("p1_error"), F.col("p1").between(0, 1).alias("in_range"))


_WALK_SQL = EMBEDDINGS_SQL + "\nSELECT key, label, 0e0 AS p1_error, TRUE AS in_range FROM e WHERE split = 'valid'"


@register("forest_walk", _WALK_SQL)
def forest_walk(spark, sf):
    """The bagged forest of 80 trees: p1 by walking its node table against MLlib's, on every row."""
    return _walk(spark, sf, False)


@register("forest_walk_weighted", _WALK_SQL)
def forest_walk_weighted(spark, sf):
    return _walk(spark, sf, True)


def _gradient(spark, sf, weighted: bool):
    s = embedding_splits(spark, sf)
    train, weight = (resample.class_weights(s["train"], "label"), "weight") if weighted else (s["train"], None)
    fitted, _ = models.fit_timed(models.logistic_regression("features", "label", weight), train)
    g = optimum.lr_gradient(fitted, train, weight_col=weight)
    return g.select("coordinate", F.round("scale", 3).alias("scale"), (F.col("relative") <= GRADIENT_TOLERANCE).alias("at_optimum"))


def _gradient_sql(weight: str) -> str:
    return EMBEDDINGS_SQL + f""",
x AS (SELECT CAST(vec_id AS VARCHAR) AS key, embedding AS v FROM embeddings),
w AS (SELECT key, label, {weight} AS w FROM e WHERE split = 'train'),
c AS (SELECT unnest(range(len(v))) AS coordinate, unnest(v) AS c, w FROM w JOIN x USING (key))
SELECT CAST(coordinate AS INTEGER) AS coordinate, round(sum(w * abs(CAST(c AS DOUBLE))), 3) AS scale, TRUE AS at_optimum FROM c GROUP BY 1
UNION ALL SELECT -1, round(sum(w), 3), TRUE FROM w"""


@register("fit_lr_gradient", _gradient_sql("1e0"))
def fit_lr_gradient(spark, sf):
    """Every coordinate of the gradient on the training rows, within 1e-5 of its scale."""
    return _gradient(spark, sf, False)


@register("fit_lr_weighted_gradient", _gradient_sql(
    "CASE WHEN label = 1 THEN (SELECT sum(1 - label) * 1e0 / sum(label) FROM e WHERE split = 'train') ELSE 1e0 END"))
def fit_lr_weighted_gradient(spark, sf):
    return _gradient(spark, sf, True)


assert set(MODEL_KEYS) == {models.FAMILIES[f] + x for f in models.FAMILIES for x in experiments.SUFFIX.values()}
