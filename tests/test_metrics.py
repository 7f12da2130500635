import numpy as np
import pytest
from pyspark.sql import functions as F

from skewscope.catalog.fixtures import scored_lineitem
from skewscope.operators import calibration, curves, metrics
from tests.conftest import SF01
from tests.helpers import average_precision, mcc_by_threshold, pair_auc


def _scored(spark, y, s):
    return spark.createDataFrame([(int(a), None if b is None else float(b)) for a, b in zip(y, s)],
                                 "y int, p1 double")


def test_golden_counts_to_rates(spark):
    # Published test record: four counts in, five rates out.
    conf = spark.createDataFrame([(29991, 5558, 145252, 6308)], "TP long, FP long, TN long, FN long")
    r = metrics.threshold_metrics(conf).first()
    assert r["precision"] == pytest.approx(0.8436524234155672, abs=1e-12)
    assert r["recall"] == pytest.approx(0.8262211080195047, abs=1e-12)
    assert r["f1"] == pytest.approx(0.8348457855472664, abs=1e-12)
    assert r["balanced_accuracy"] == pytest.approx(0.8946833940071, abs=1e-12)
    assert r["MCC"] == pytest.approx(0.795674166221368, abs=1e-12)
    # TP+FN and FP+TN are the published test positives and negatives.
    assert 29991 + 6308 == 36299 and 5558 + 145252 == 150810


def test_canonical_scored_view(spark):
    s = scored_lineitem(spark, SF01)
    rec = metrics.evaluate_scores(s, "y", "p1", threshold=0.5, policy="mcc").first()
    assert rec["PR_AUC"] == pytest.approx(0.202326743, abs=1e-9)
    assert rec["ROC_AUC"] == pytest.approx(0.502061178, abs=1e-9)
    assert (rec["TP"], rec["FP"], rec["TN"], rec["FN"]) == (6251, 24768, 23231, 5750)
    assert rec["opt_threshold"] == pytest.approx(0.94)
    assert rec["opt_MCC"] == pytest.approx(0.008953, abs=1e-6)
    table = curves.threshold_table(s, "y", "p1")
    yj = curves.best_threshold(table, "youden").first()
    assert yj["opt_threshold"] == pytest.approx(0.34)
    assert yj["opt_value"] == pytest.approx(0.006075, abs=1e-6)


def test_distinct_scores_equal_definitions(spark):
    rng = np.random.default_rng(11)
    n = 800
    s = rng.permutation(n) / n
    y = (rng.random(n) < 0.2 + 0.5 * s).astype(int)
    rec = metrics.evaluate_scores(_scored(spark, y, s), "y", "p1", policy="mcc").first()
    assert rec["PR_AUC"] == pytest.approx(average_precision(y, s), abs=1e-9)
    assert rec["ROC_AUC"] == pytest.approx(pair_auc(y, s), abs=1e-9)
    mcc = mcc_by_threshold(y, s)
    assert rec["opt_MCC"] == pytest.approx(max(mcc.values()), abs=1e-9)
    assert mcc[rec["opt_threshold"]] == pytest.approx(max(mcc.values()), abs=1e-9)


def test_roc_symmetry_and_bounds(spark):
    rng = np.random.default_rng(5)
    s = rng.integers(0, 20, size=500) / 20
    y = (rng.random(500) < 0.3).astype(int)
    a = metrics.evaluate_scores(_scored(spark, y, s), "y", "p1").first()
    b = metrics.evaluate_scores(_scored(spark, y, -s), "y", "p1").first()
    assert a["ROC_AUC"] == pytest.approx(1 - b["ROC_AUC"], abs=1e-12)
    assert 0 <= a["PR_AUC"] <= 1


def test_multi_range_threshold_table_matches_single(spark):
    rng = np.random.default_rng(2)
    s = rng.random(3000)
    y = (rng.random(3000) < s).astype(int)
    df = _scored(spark, y, s)
    one = metrics.evaluate_scores(df, "y", "p1", policy="mcc").first()
    many = metrics.evaluate_scores(df, "y", "p1", policy="mcc", rows_per_range=250).first()
    for k in ("PR_AUC", "ROC_AUC", "TP", "FP", "opt_threshold", "opt_MCC"):
        assert one[k] == pytest.approx(many[k], abs=1e-12)


@pytest.mark.parametrize("case", ["empty", "no_pos", "no_neg", "all_tied", "null_scores"])
def test_edge_cases(spark, case):
    data = {
        "empty": ([], []),
        "no_pos": ([0, 0, 0], [0.1, 0.5, 0.9]),
        "no_neg": ([1, 1], [0.2, 0.7]),
        "all_tied": ([1, 0, 1, 0], [0.5, 0.5, 0.5, 0.5]),
        "null_scores": ([1, 0, 1, 0], [0.9, None, None, float("nan")]),
    }[case]
    rec = metrics.evaluate_scores(_scored(spark, *data), "y", "p1", policy="mcc").first()
    if case == "empty":
        assert (rec["PR_AUC"], rec["ROC_AUC"], rec["TP"], rec["opt_threshold"], rec["opt_MCC"]) == (0.0, 0.0, 0, 0.5, 0.0)
    if case == "no_pos":
        assert rec["PR_AUC"] == 0.0 and rec["ROC_AUC"] == 0.0 and rec["MCC"] == 0.0
    if case == "no_neg":
        assert rec["PR_AUC"] == pytest.approx(1.0) and rec["ROC_AUC"] == 0.0
    if case == "all_tied":
        assert rec["ROC_AUC"] == pytest.approx(0.5) and rec["PR_AUC"] == pytest.approx(0.5)
    if case == "null_scores":
        assert rec["TP"] + rec["FP"] + rec["TN"] + rec["FN"] == 1


def test_roc_and_pr_points(spark):
    df = _scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.8, 0.1])
    table = curves.threshold_table(df, "y", "p1")
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in curves.pr_points(table).collect()}
    assert pr[0.9] == (1.0, 0.5) and pr[0.8] == (2 / 3, 1.0)
    roc = curves.roc_points(table).collect()
    assert len(roc) == 3 + 2
    ends = sorted((r["fpr"], r["tpr"]) for r in roc if r["threshold"] is None)
    assert ends == [(0.0, 0.0), (1.0, 1.0)]


def test_confusion_direct_and_from_table_agree(spark):
    s = scored_lineitem(spark, SF01)
    direct = metrics.confusion(s.withColumn("yhat", (F.col("p1") >= 0.5).cast("int")), "y", "yhat").first()
    rec = metrics.evaluate_scores(s, "y", "p1", threshold=0.5).first()
    assert tuple(direct) == (rec["TP"], rec["FP"], rec["TN"], rec["FN"])


def test_mcc_large_counts_do_not_overflow(spark):
    conf = spark.createDataFrame([(3_000_000_000, 1_000_000_000, 9_000_000_000, 2_000_000_000)],
                                 "TP long, FP long, TN long, FN long")
    r = metrics.threshold_metrics(conf).first()
    assert -1 <= r["MCC"] <= 1


def test_calibration_bins(spark):
    df = _scored(spark, [1, 0, 1, 1, 0], [0.05, 0.05, 0.55, 1.0, 0.999])
    rows = calibration.calibration_table(df, "y", "p1", 10).orderBy("bin_index").collect()
    assert len(rows) == 10
    assert rows[0]["bin"] == "[0.0,0.1)" and rows[9]["bin"] == "[0.9,1.0]"
    assert rows[9]["count"] == 2 and rows[9]["empirical_pos_rate"] == 0.5
    assert rows[3]["count"] == 0 and rows[3]["mean_pred"] == 0.0
    assert sum(r["count"] for r in rows) == 5
    pts = calibration.calibration_points(calibration.calibration_table(df, "y", "p1", 10))
    assert pts.count() == 3


def test_golden_calibration_labels(spark):
    df = spark.range(10).select((F.col("id") / 10 + 0.01).alias("p1"), F.lit(1).alias("y"))
    labels_ = [r["bin"] for r in calibration.calibration_table(df, "y", "p1", 10).orderBy("bin_index").collect()]
    golden = ["[0.0,0.1)", "[0.1,0.2)", "[0.2,0.3)", "[0.3,0.4)", "[0.4,0.5)", "[0.5,0.6)", "[0.6,0.7)",
              "[0.7,0.8)", "[0.8,0.9)", "[0.9,1.0]"]
    assert labels_ == golden


def test_grouped_paths(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.4), ("a", 1, 0.6), ("b", 0, 0.7), ("b", 1, 0.2), ("b", 0, 1.0)]
    df = spark.createDataFrame(rows, "model string, y int, p1 double")
    thr = spark.createDataFrame([("a", 0.5), ("b", 0.1)], "model string, applied_threshold double")
    rec = {r["model"]: r for r in metrics.evaluate_scores(df, "y", "p1", threshold=thr, group_cols=["model"]).collect()}
    assert (rec["a"]["TP"], rec["a"]["FP"], rec["a"]["TN"], rec["a"]["FN"]) == (2, 0, 1, 0)
    assert (rec["b"]["TP"], rec["b"]["FP"]) == (1, 2) and rec["b"]["applied_threshold"] == 0.1
    assert rec["a"]["PR_AUC"] == pytest.approx(1.0) and rec["b"]["ROC_AUC"] == pytest.approx(0.0)
    table = curves.threshold_table(df, "y", "p1", ["model"])
    ends = curves.roc_points(table, ["model"]).where("threshold IS NULL").groupBy("model").count().collect()
    assert {r["model"]: r["count"] for r in ends} == {"a": 2, "b": 2}
    cal = calibration.calibration_table(df, "y", "p1", 5, group_cols=["model"])
    per = {r["model"]: r["n"] for r in cal.groupBy("model").agg(F.sum("count").alias("n")).collect()}
    assert per == {"a": 3, "b": 3} and cal.count() == 10


def test_nan_scores_fall_in_no_bin(spark):
    rows = calibration.calibration_table(_scored(spark, [1, 0, 1], [0.95, 1.0, float("nan")]), "y", "p1", 10).collect()
    last = [r for r in rows if r["bin_index"] == 9][0]
    assert last["count"] == 2 and last["mean_pred"] == pytest.approx(0.975)
    assert sum(r["count"] for r in rows) == 2
