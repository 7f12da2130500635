"""Selection, comparison and report queries (rows 13, 49-50, 53-57).

The eight model keys are scored by the lineitem score columns of
``fixtures.MODEL_SCORES``; validation and test are the md5 split of l_orderkey.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skewscope.catalog._registry import register, rounded
from skewscope.catalog.fixtures import MODEL_SCORES, model_scores_sql, scored_models
from skewscope.catalog.metrics import RATES_SQL
from skewscope.functions.hashing import unit_draw
from skewscope.functions.scoring import MODEL_DISPLAY_NAMES, display_name
from skewscope.operators import experiments, metrics, report, select

KEYS = list(MODEL_SCORES)
ORDER_SQL = "CASE model " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KEYS)) + f" ELSE {len(KEYS)} END"
NAME_SQL = "coalesce(CASE model " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in MODEL_DISPLAY_NAMES.items()) + " END, model)"
BASE = """q AS (SELECT quantile_disc(l_extendedprice, 0.8) AS t FROM lineitem),
s AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
             CAST(CASE WHEN l_extendedprice >= (SELECT t FROM q) THEN 1 ELSE 0 END AS INTEGER) AS y,
             CASE WHEN (('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100) < 80 THEN 'train'
                  WHEN (('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100) < 90 THEN 'valid'
                  ELSE 'test' END AS split,
             (('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || ':42'),
                              1, 13))::BIGINT / 4503599627370496.0) AS u
      FROM lineitem), """ + model_scores_sql()


def _record_sql(where: str, groups: str = "model", threshold: str = "0.5", prefix: str = "") -> str:
    """CTEs {prefix}tt, {prefix}k (12-field counts) and {prefix}b (best MCC row) per ``groups``."""
    p = prefix
    return f"""{p}c AS (SELECT {groups}, p1 AS threshold, CAST(sum(y) AS BIGINT) AS pos, count(*) AS n
       FROM ms WHERE {where} GROUP BY {groups}, p1),
{p}tt AS (SELECT {groups}, threshold, pos, n,
              CAST(sum(pos) OVER (PARTITION BY {groups} ORDER BY threshold DESC) AS BIGINT) AS tp,
              CAST(sum(n) OVER (PARTITION BY {groups} ORDER BY threshold DESC) AS BIGINT) AS cn,
              CAST(sum(pos) OVER (PARTITION BY {groups}) AS BIGINT) AS np,
              CAST(sum(n) OVER (PARTITION BY {groups}) AS BIGINT) AS nt FROM {p}c),
{p}a AS (SELECT {groups}, CASE WHEN max(np) > 0 THEN sum((tp * 1e0 / cn) * pos / np) ELSE 0 END AS PR_AUC,
             CASE WHEN max(np) > 0 AND max(nt - np) > 0
                  THEN sum(((n - pos) * 1e0 / (nt - np)) * ((2 * tp - pos) * 1e0 / (2 * np))) ELSE 0 END AS ROC_AUC,
             CAST(sum(CASE WHEN threshold >= {threshold} THEN pos ELSE 0 END) AS BIGINT) AS TP,
             CAST(sum(CASE WHEN threshold >= {threshold} THEN n - pos ELSE 0 END) AS BIGINT) AS FP,
             max(np) AS np, max(nt) AS nt FROM {p}tt GROUP BY {groups}),
{p}k AS (SELECT {groups}, PR_AUC, ROC_AUC, TP, FP, nt - np - FP AS TN, np - TP AS FN FROM {p}a),
{p}g AS (SELECT {groups}, threshold, tp, cn - tp AS fp, greatest(np, 1) - tp AS fn,
                greatest(nt - np, 1) - (cn - tp) AS tn FROM {p}tt),
{p}v AS (SELECT {groups}, threshold,
             round(CASE WHEN (tp + fp) * 1e0 * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0
                  ELSE (tp * 1e0 * tn - fp * 1e0 * fn) / sqrt((tp + fp) * 1e0 * (tp + fn) * (tn + fp) * (tn + fn))
                  END, 9) AS val FROM {p}g),
{p}b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY val DESC, threshold DESC) AS rn
                        FROM {p}v WHERE val > -1) WHERE rn = 1)"""


METRICS_SQL = f"""WITH {BASE},
{_record_sql("split = 'valid'")},
mt AS (SELECT k.model, round(PR_AUC, 9) AS PR_AUC, round(ROC_AUC, 9) AS ROC_AUC, {RATES_SQL},
              b.threshold AS opt_threshold, {ORDER_SQL.replace('model', 'k.model')} AS model_order
       FROM k LEFT JOIN b ON k.model = b.model)"""


def _valid_metrics(spark, sf):
    valid = scored_models(spark, sf, extra=("split",)).where(F.col("split") == "valid")
    rec = metrics.evaluate_scores(valid, "y", "p1", threshold=0.5, group_cols=["model"], policy="mcc")
    return rounded(rec.withColumn("model_order", experiments.model_order()))


@register("model_display_name", f"""WITH {BASE}
SELECT model, {NAME_SQL} AS display_name, count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS positives,
       round(avg(p1), 9) AS mean_score FROM ms GROUP BY model""")
def model_display_name(spark, sf):
    m = scored_models(spark, sf).groupBy("model").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("y").alias("positives"), F.round(F.avg("p1"), 9).alias("mean_score"))
    return m.select("model", display_name("model").alias("display_name"), "n_rows", "positives", "mean_score")


@register("select_best", METRICS_SQL + """
SELECT model AS best_model, PR_AUC, opt_threshold FROM mt ORDER BY PR_AUC DESC, model_order ASC LIMIT 1""")
def select_best(spark, sf):
    return select.select_best(_valid_metrics(spark, sf))


TEST_SQL = METRICS_SQL + """,
best AS (SELECT model AS best_model, opt_threshold FROM mt ORDER BY PR_AUC DESC, model_order ASC LIMIT 1),
""" + _record_sql("split = 'test' AND model = (SELECT best_model FROM best)",
                  threshold="(SELECT opt_threshold FROM best)", prefix="t")


@register("test_at_best_threshold", TEST_SQL + """
SELECT model, round(PR_AUC, 9) AS PR_AUC, round(ROC_AUC, 9) AS ROC_AUC, """ + RATES_SQL + """,
       TP, FP, TN, FN, (SELECT opt_threshold FROM best) AS applied_threshold FROM tk""")
def test_at_best_threshold(spark, sf):
    best = select.select_best(_valid_metrics(spark, sf))
    test = scored_models(spark, sf, extra=("split",)).where(F.col("split") == "test")
    return rounded(select.test_at_best_threshold(best, test, "y", "p1"))


@register("report_confusion_2x2", TEST_SQL + """
SELECT model, 'Neg' AS actual, TN AS predicted_negative, FP AS predicted_positive FROM tk
UNION ALL SELECT model, 'Pos', FN, TP FROM tk""")
def report_confusion_2x2(spark, sf):
    best = select.select_best(_valid_metrics(spark, sf))
    test = scored_models(spark, sf, extra=("split",)).where(F.col("split") == "test")
    return report.report_confusion_2x2(select.test_at_best_threshold(best, test, "y", "p1"))


@register("compare_lr_strategies", METRICS_SQL + """
SELECT CAST(CASE model WHEN 'logistic_regression' THEN 1 WHEN 'logistic_regression_weighted' THEN 2
            WHEN 'logistic_regression_undersampled' THEN 3 ELSE 4 END AS INTEGER) AS position,
       model, """ + NAME_SQL + """ AS label, PR_AUC, f1
FROM mt WHERE model IN ('logistic_regression', 'logistic_regression_weighted',
                        'logistic_regression_undersampled', 'logistic_regression_oversampled')""")
def compare_lr_strategies(spark, sf):
    return select.compare_lr_strategies(_valid_metrics(spark, sf))


@register("compare_lr_rf", METRICS_SQL + """,
r AS (SELECT CASE WHEN model LIKE '%_weighted' THEN 0 WHEN model LIKE '%_undersampled' THEN 1 ELSE 2 END AS position,
             CASE WHEN model LIKE 'logistic%' THEN 'lr' ELSE 'rf' END AS family, PR_AUC
      FROM mt WHERE model LIKE '%_weighted' OR model LIKE '%_undersampled' OR model LIKE '%_oversampled')
SELECT CAST(position AS INTEGER) AS position,
       CASE position WHEN 0 THEN 'Class-weighted' WHEN 1 THEN 'Undersampled' ELSE 'Oversampled' END AS strategy,
       max(CASE WHEN family = 'lr' THEN PR_AUC END) AS lr, max(CASE WHEN family = 'rf' THEN PR_AUC END) AS rf
FROM r GROUP BY position""")
def compare_lr_rf(spark, sf):
    return select.compare_lr_rf(_valid_metrics(spark, sf))


@register("report_metrics", METRICS_SQL + """
SELECT model, """ + NAME_SQL + """ AS display_name, PR_AUC, ROC_AUC, precision, recall, f1,
       balanced_accuracy, MCC FROM mt""")
def report_metrics(spark, sf):
    return report.report_metrics(_valid_metrics(spark, sf).drop("model_order"))


SCALING_MODELS = ["logistic_regression_weighted", "random_forest_weighted"]
FRACTIONS = (0.25, 0.5, 1.0)


@register("scaling_series", f"""WITH {BASE},
fr AS (SELECT * FROM (VALUES (0.25), (0.5), (1.0)) t(fraction)),
sm AS (SELECT ms.model, ms.y, ms.p1, fr.fraction FROM ms, fr
       WHERE ms.model IN ('logistic_regression_weighted', 'random_forest_weighted') AND ms.u < fr.fraction),
""" + _record_sql("TRUE", groups="model, fraction").replace("FROM ms WHERE TRUE", "FROM sm") + """
SELECT model, CAST(TP + FP + TN + FN AS BIGINT) AS train_rows, round(PR_AUC, 4) AS pr_auc,
       CAST(row_number() OVER (PARTITION BY model ORDER BY TP + FP + TN + FN) AS INTEGER) AS series_pos
FROM k""")
def scaling_series(spark, sf):
    out = select.scaling_series(_scaling_runs(spark, sf))
    return out.withColumn("series_pos", F.col("series_pos").cast("int"))


def _scaling_runs(spark, sf):
    sm = scored_models(spark, sf, keys=SCALING_MODELS, extra=("row_key",))
    u = unit_draw(F.col("row_key"), 42)
    samples = None
    for f in FRACTIONS:
        part = sm.where(u < F.lit(f)).withColumn("fraction", F.lit(f))
        samples = part if samples is None else samples.unionByName(part)
    rec = metrics.evaluate_scores(samples, "y", "p1", group_cols=["model", "fraction"])
    return rec.select("model", (F.col("TP") + F.col("FP") + F.col("TN") + F.col("FN")).alias("train_rows"),
                      F.round("PR_AUC", 4).alias("pr_auc"))


@register("calibration_best_model", METRICS_SQL + """,
best AS (SELECT model AS best_model FROM mt ORDER BY PR_AUC DESC, model_order ASC LIMIT 1),
bb AS (SELECT CAST(CASE WHEN p1 >= 1 THEN 9 ELSE floor(p1 * 10) END AS INTEGER) AS bin_index, p1, y FROM ms
       WHERE split = 'valid' AND model = (SELECT best_model FROM best)),
cb AS (SELECT bin_index, avg(p1) AS mean_pred, avg(y * 1e0) AS empirical_pos_rate, count(*) AS cnt
      FROM bb WHERE bin_index BETWEEN 0 AND 9 GROUP BY bin_index),
spine AS (SELECT CAST(range AS INTEGER) AS bin_index FROM range(10))
SELECT (SELECT best_model FROM best) AS model, spine.bin_index,
       printf('[%.1f,%.1f%s', spine.bin_index / 10, (spine.bin_index + 1) / 10,
              CASE WHEN spine.bin_index = 9 THEN ']' ELSE ')' END) AS bin,
       round(coalesce(mean_pred, 0), 9) AS mean_pred, round(coalesce(empirical_pos_rate, 0), 9) AS empirical_pos_rate,
       CAST(coalesce(cnt, 0) AS BIGINT) AS count
FROM spine LEFT JOIN cb ON spine.bin_index = cb.bin_index""")
def calibration_best_model(spark, sf):
    from skewscope.operators import calibration as calib
    best = select.select_best(_valid_metrics(spark, sf)).first()["best_model"]
    valid = scored_models(spark, sf, extra=("split",)).where((F.col("split") == "valid") & (F.col("model") == best))
    return rounded(calib.calibration_table(valid, "y", "p1", 10, group_cols=["model"]))


@register("report_scaling_table", f"""WITH {BASE},
fr AS (SELECT * FROM (VALUES (0.25), (0.5), (1.0)) t(fraction)),
sm AS (SELECT ms.model, ms.y, ms.p1, fr.fraction FROM ms, fr
       WHERE ms.model IN ('logistic_regression_weighted', 'random_forest_weighted') AND ms.u < fr.fraction),
""" + _record_sql("TRUE", groups="model, fraction").replace("FROM ms WHERE TRUE", "FROM sm") + """
SELECT model, """ + NAME_SQL + """ AS display_name, CAST(TP + FP + TN + FN AS BIGINT) AS train_rows, round(PR_AUC, 4) AS pr_auc,
       CAST(row_number() OVER (PARTITION BY model ORDER BY TP + FP + TN + FN) AS INTEGER) AS series_pos
FROM k""")
def report_scaling_table(spark, sf):
    out = report.report_scaling_table(select.scaling_series(_scaling_runs(spark, sf)))
    return out.withColumn("series_pos", F.col("series_pos").cast("int"))
