"""Metric, curve, threshold and calibration queries (inventory rows 12, 38-46, 48, 56)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skewscope.catalog._registry import register, rounded
from skewscope.catalog.fixtures import model_scores_sql, scored_lineitem, scored_models
from skewscope.functions.scoring import apply_threshold as threshold_col
from skewscope.operators import calibration as calib
from skewscope.operators import curves, metrics

# DuckDB text of the scored view and of its threshold table.
SCORED = """q AS (SELECT quantile_disc(l_extendedprice, 0.8) AS t FROM lineitem),
s AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_linenumber AS ln,
             CAST(CASE WHEN l_extendedprice >= (SELECT t FROM q) THEN 1 ELSE 0 END AS INTEGER) AS y,
             l_quantity / 50 AS p1 FROM lineitem)"""
TABLE = SCORED + """,
c AS (SELECT p1 AS threshold, CAST(sum(y) AS BIGINT) AS pos, count(*) AS n FROM s GROUP BY p1),
tt AS (SELECT threshold, pos, n,
              CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
              CAST(sum(n) OVER (ORDER BY threshold DESC) AS BIGINT) AS cn,
              CAST(sum(pos) OVER () AS BIGINT) AS np, CAST(sum(n) OVER () AS BIGINT) AS nt FROM c)"""


def _table(spark, sf):
    return curves.threshold_table(scored_lineitem(spark, sf), "y", "p1")


@register("apply_threshold", f"""
WITH {SCORED}
SELECT l_orderkey, l_linenumber, p1, CAST(p1 >= 0.5 AS INTEGER) AS yhat FROM s""")
def apply_threshold(spark, sf):
    s = scored_lineitem(spark, sf)
    return s.select("l_orderkey", "l_linenumber", "p1", threshold_col("p1", 0.5).alias("yhat"))


CONF_SQL = f"""
WITH {SCORED}, p AS (SELECT y, CAST(p1 >= 0.5 AS INTEGER) AS yhat FROM s),
k AS (SELECT CAST(sum(CASE WHEN y = 1 AND yhat = 1 THEN 1 ELSE 0 END) AS BIGINT) AS TP,
             CAST(sum(CASE WHEN y = 0 AND yhat = 1 THEN 1 ELSE 0 END) AS BIGINT) AS FP,
             CAST(sum(CASE WHEN y = 0 AND yhat = 0 THEN 1 ELSE 0 END) AS BIGINT) AS TN,
             CAST(sum(CASE WHEN y = 1 AND yhat = 0 THEN 1 ELSE 0 END) AS BIGINT) AS FN FROM p)"""


@register("confusion", CONF_SQL + "\nSELECT * FROM k")
def confusion(spark, sf):
    s = scored_lineitem(spark, sf).withColumn("yhat", threshold_col("p1", 0.5))
    return metrics.confusion(s, "y", "yhat")


RATES_SQL = """
       round(CASE WHEN TP + FP > 0 THEN TP / (TP + FP) ELSE 0 END, 9) AS precision,
       round(CASE WHEN TP + FN > 0 THEN TP / (TP + FN) ELSE 0 END, 9) AS recall,
       round(CASE WHEN TP + FP > 0 AND TP + FN > 0 AND TP > 0
                  THEN 2 * (TP / (TP + FP)) * (TP / (TP + FN)) / ((TP / (TP + FP)) + (TP / (TP + FN)))
                  ELSE 0 END, 9) AS f1,
       round(0.5 * ((CASE WHEN TP + FN > 0 THEN TP / (TP + FN) ELSE 0 END)
                  + (CASE WHEN TN + FP > 0 THEN TN / (TN + FP) ELSE 0 END)), 9) AS balanced_accuracy,
       round((TP * 1e0 * TN - FP * 1e0 * FN)
             / sqrt(greatest((TP + FP) * 1e0 * (TP + FN) * (TN + FP) * (TN + FN), 1e-12)), 9) AS MCC"""


@register("threshold_metrics", CONF_SQL + "\nSELECT TP, FP, TN, FN," + RATES_SQL + "\nFROM k")
def threshold_metrics(spark, sf):
    s = scored_lineitem(spark, sf).withColumn("yhat", threshold_col("p1", 0.5))
    return rounded(metrics.threshold_metrics(metrics.confusion(s, "y", "yhat")))


@register("pr_auc", f"""
WITH {TABLE}
SELECT round(CASE WHEN max(np) > 0 THEN sum((tp * 1e0 / cn) * pos / np) ELSE 0 END, 9) AS PR_AUC FROM tt""")
def pr_auc(spark, sf):
    return rounded(curves.areas(_table(spark, sf)).select("PR_AUC"))


@register("roc_auc", f"""
WITH {TABLE}
SELECT round(CASE WHEN max(np) > 0 AND max(nt - np) > 0
                  THEN sum(((n - pos) * 1e0 / (nt - np)) * ((2 * tp - pos) * 1e0 / (2 * np))) ELSE 0 END, 9)
       AS ROC_AUC FROM tt""")
def roc_auc(spark, sf):
    return rounded(curves.areas(_table(spark, sf)).select("ROC_AUC"))


@register("pr_curve_points", f"""
WITH {TABLE}
SELECT threshold, round(tp * 1e0 / cn, 9) AS precision,
       round(CASE WHEN np > 0 THEN tp * 1e0 / np ELSE 0 END, 9) AS recall FROM tt""")
def pr_curve_points(spark, sf):
    return rounded(curves.pr_points(_table(spark, sf)))


@register("roc_curve_points", f"""
WITH {TABLE}
SELECT threshold, round((cn - tp) * 1e0 / greatest(nt - np, 1), 9) AS fpr,
       round(tp * 1e0 / greatest(np, 1), 9) AS tpr FROM tt
UNION ALL SELECT NULL, 0.0, 0.0 UNION ALL SELECT NULL, 1.0, 1.0""")
def roc_curve_points(spark, sf):
    return rounded(curves.roc_points(_table(spark, sf)))


def _best_sql(policy: str) -> str:
    value = ("tp * 1e0 / pf + (CASE WHEN tn + fp > 0 THEN tn * 1e0 / (tn + fp) ELSE 0 END) - 1"
             if policy == "youden" else "mcc")
    return f"""
WITH {TABLE},
f AS (SELECT threshold, tp, cn - tp AS fp, greatest(np, 1) AS pf, greatest(nt - np, 1) AS nf FROM tt),
g AS (SELECT threshold, tp, fp, pf, pf - tp AS fn, nf - fp AS tn FROM f),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp * 1e0 / (tp + fp) ELSE 0 END AS prec, tp * 1e0 / pf AS rec,
             CASE WHEN (tp + fp) * 1e0 * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0
                  ELSE (tp * 1e0 * tn - fp * 1e0 * fn) / sqrt((tp + fp) * 1e0 * (tp + fn) * (tn + fp) * (tn + fn))
             END AS mcc FROM g),
v AS (SELECT *, round({value}, 9) AS val,
             CASE WHEN tn + fp > 0 THEN tn * 1e0 / (tn + fp) ELSE 0 END AS tnr FROM m),
b AS (SELECT * FROM v WHERE val > -1 ORDER BY val DESC, threshold DESC LIMIT 1)
SELECT '{policy}' AS opt_threshold_policy, threshold AS opt_threshold,
       round(prec, 9) AS opt_precision, round(rec, 9) AS opt_recall,
       round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END, 9) AS opt_f1,
       round(0.5 * (rec + tnr), 9) AS opt_balanced_accuracy, round(mcc, 9) AS opt_MCC,
       round(val, 9) AS opt_value
FROM b"""


@register("best_threshold_mcc", _best_sql("mcc"))
def best_threshold_mcc(spark, sf):
    return rounded(curves.best_threshold(_table(spark, sf), "mcc"))


@register("best_threshold_youden", _best_sql("youden"))
def best_threshold_youden(spark, sf):
    return rounded(curves.best_threshold(_table(spark, sf), "youden"))


CALIB_SQL = f"""
WITH {SCORED},
b AS (SELECT CAST(CASE WHEN p1 >= 1 THEN 9 ELSE floor(p1 * 10) END AS INTEGER) AS bin_index, p1, y FROM s),
a AS (SELECT bin_index, avg(p1) AS mean_pred, avg(y * 1e0) AS empirical_pos_rate, count(*) AS cnt
      FROM b WHERE bin_index BETWEEN 0 AND 9 GROUP BY bin_index),
spine AS (SELECT CAST(range AS INTEGER) AS bin_index FROM range(10)),
cal AS (SELECT spine.bin_index,
               printf('[%.1f,%.1f%s', spine.bin_index / 10, (spine.bin_index + 1) / 10,
                      CASE WHEN spine.bin_index = 9 THEN ']' ELSE ')' END) AS bin,
               round(coalesce(mean_pred, 0), 9) AS mean_pred,
               round(coalesce(empirical_pos_rate, 0), 9) AS empirical_pos_rate,
               CAST(coalesce(cnt, 0) AS BIGINT) AS count
        FROM spine LEFT JOIN a ON spine.bin_index = a.bin_index)"""


@register("calibration", CALIB_SQL + "\nSELECT * FROM cal")
def calibration(spark, sf):
    return rounded(calib.calibration_table(scored_lineitem(spark, sf), "y", "p1", 10))


@register("calibration_points", CALIB_SQL + "\nSELECT * FROM cal WHERE count > 0")
def calibration_points(spark, sf):
    return rounded(calib.calibration_points(calib.calibration_table(scored_lineitem(spark, sf), "y", "p1", 10)))


def _split_record_sql(threshold: str) -> str:
    return f"""
WITH {TABLE},
a AS (SELECT CASE WHEN max(np) > 0 THEN sum((tp * 1e0 / cn) * pos / np) ELSE 0 END AS PR_AUC,
             CASE WHEN max(np) > 0 AND max(nt - np) > 0
                  THEN sum(((n - pos) * 1e0 / (nt - np)) * ((2 * tp - pos) * 1e0 / (2 * np))) ELSE 0 END AS ROC_AUC,
             CAST(sum(CASE WHEN threshold >= {threshold} THEN pos ELSE 0 END) AS BIGINT) AS TP,
             CAST(sum(CASE WHEN threshold >= {threshold} THEN n - pos ELSE 0 END) AS BIGINT) AS FP,
             max(np) AS np, max(nt) AS nt FROM tt),
k AS (SELECT PR_AUC, ROC_AUC, TP, FP, nt - np - FP AS TN, np - TP AS FN FROM a)"""


@register("evaluate_split", _split_record_sql("0.5") + """
SELECT round(PR_AUC, 9) AS PR_AUC, round(ROC_AUC, 9) AS ROC_AUC,""" + RATES_SQL + """,
       TP, FP, TN, FN, CAST(0.5 AS DOUBLE) AS applied_threshold FROM k""")
def evaluate_split(spark, sf):
    return rounded(metrics.evaluate_scores(scored_lineitem(spark, sf), "y", "p1", threshold=0.5))


@register("curves_by_model", f"""
WITH {SCORED}, {model_scores_sql()},
c AS (SELECT model, p1 AS threshold, CAST(sum(y) AS BIGINT) AS pos, count(*) AS n FROM ms GROUP BY model, p1),
tt AS (SELECT model, threshold, pos, n,
              CAST(sum(pos) OVER (PARTITION BY model ORDER BY threshold DESC) AS BIGINT) AS tp,
              CAST(sum(n) OVER (PARTITION BY model ORDER BY threshold DESC) AS BIGINT) AS cn,
              CAST(sum(pos) OVER (PARTITION BY model) AS BIGINT) AS np,
              CAST(sum(n) OVER (PARTITION BY model) AS BIGINT) AS nt FROM c)
SELECT model, round(threshold, 9) AS threshold, round(tp * 1e0 / cn, 9) AS precision,
       round(CASE WHEN np > 0 THEN tp * 1e0 / np ELSE 0 END, 9) AS recall,
       round((cn - tp) * 1e0 / greatest(nt - np, 1), 9) AS fpr, round(tp * 1e0 / greatest(np, 1), 9) AS tpr
FROM tt""")
def curves_by_model(spark, sf):
    table = curves.threshold_table(scored_models(spark, sf), "y", "p1", ["model"])
    return rounded(curves.curve_points(table, ["model"]))



# Groups by l_returnflag, where N counts as missing: a third of the rows has no group.
_FLAGGED = """q AS (SELECT quantile_disc(l_extendedprice, 0.8) AS t FROM lineitem),
s AS (SELECT nullif(l_returnflag, 'N') AS flag, CAST(CASE WHEN l_extendedprice >= (SELECT t FROM q) THEN 1 ELSE 0 END AS INTEGER) AS y,
             l_quantity / 50 AS p1 FROM lineitem)"""


def _flagged(spark, sf):
    s = scored_lineitem(spark, sf)
    return s.select(F.nullif("l_returnflag", F.lit("N")).alias("flag"), "y", "p1")


@register("evaluate_null_groups", f"""
WITH {_FLAGGED},
c AS (SELECT flag, p1 AS threshold, CAST(sum(y) AS BIGINT) AS pos, count(*) AS n FROM s GROUP BY flag, p1),
tt AS (SELECT flag, threshold, pos, n, sum(pos) OVER (PARTITION BY flag ORDER BY threshold DESC) AS tp,
              sum(n) OVER (PARTITION BY flag ORDER BY threshold DESC) AS cn,
              sum(pos) OVER (PARTITION BY flag) AS np, sum(n) OVER (PARTITION BY flag) AS nt FROM c),
k AS (SELECT flag, sum((tp * 1e0 / cn) * pos / np) AS PR_AUC,
             sum(((n - pos) * 1e0 / (nt - np)) * ((2 * tp - pos) * 1e0 / (2 * np))) AS ROC_AUC,
             CAST(sum(CASE WHEN threshold >= 0.5 THEN pos ELSE 0 END) AS BIGINT) AS TP,
             CAST(sum(CASE WHEN threshold >= 0.5 THEN n - pos ELSE 0 END) AS BIGINT) AS FP, max(np) AS np, max(nt) AS nt
      FROM tt GROUP BY flag)
SELECT flag, round(PR_AUC, 9) AS PR_AUC, round(ROC_AUC, 9) AS ROC_AUC, TP, FP, CAST(nt - np - FP AS BIGINT) AS TN,
       CAST(np - TP AS BIGINT) AS FN FROM k""")
def evaluate_null_groups(spark, sf):
    """A record per group, rows without a group being one; scores cut into ranges of a few."""
    rec = metrics.evaluate_scores(_flagged(spark, sf), "y", "p1", group_cols=["flag"], rows_per_range=20)
    return rounded(rec.select("flag", "PR_AUC", "ROC_AUC", "TP", "FP", "TN", "FN"))


@register("calibration_null_groups", f"""
WITH {_FLAGGED},
g AS (SELECT flag, CAST(least(floor(p1 * 10), 9) AS INTEGER) AS bin_index, avg(p1) AS mean_pred, avg(y) AS rate, count(*) AS n
      FROM s GROUP BY 1, 2),
spine AS (SELECT DISTINCT flag, CAST(unnest(range(10)) AS INTEGER) AS bin_index FROM s)
SELECT spine.flag, spine.bin_index, round(coalesce(mean_pred, 0), 9) AS mean_pred, round(coalesce(rate, 0), 9) AS empirical_pos_rate,
       CAST(coalesce(n, 0) AS BIGINT) AS count
FROM spine LEFT JOIN g ON g.flag IS NOT DISTINCT FROM spine.flag AND g.bin_index = spine.bin_index""")
def calibration_null_groups(spark, sf):
    return rounded(calib.calibration_table(_flagged(spark, sf), "y", "p1", 10, ["flag"]).drop("bin"))
