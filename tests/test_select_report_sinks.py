import json
from pathlib import Path

import pytest

from skewscope.operators import report, select
from skewscope.sinks import writers

# Published validation metrics (model, PR_AUC, f1) and split counts used as goldens.
VALID = [
    ("logistic_regression", 0.9256670758185347, 0.8348970883196252, 0.4681962101067738),
    ("random_forest", 0.7644660758031476, 0.29841958475364116, 0.3168764196398154),
    ("logistic_regression_weighted", 0.9235278470051952, 0.8145154791098217, 0.7717660679610858),
    ("logistic_regression_undersampled", 0.9216503339465293, 0.8110843373493976, 0.7539517913747589),
    ("logistic_regression_oversampled", 0.9228932750315361, 0.8149053991693586, 0.7639622084957816),
    ("random_forest_weighted", 0.7481908236308814, 0.6493947399132161, 0.5722575365819182),
    ("random_forest_undersampled", 0.7467070332045281, 0.6450779670347121, 0.603358001284478),
    ("random_forest_oversampled", 0.7515074227856745, 0.652679181784719, 0.5730356269090081),
]
SPLITS = [("train", 0, 501090, 103489, 397601), ("valid", 1, 187591, 38213, 149378), ("test", 2, 187109, 36299, 150810)]
SPLIT_STATS_TXT = """split\trows\tpositive\tnegative\tpositive_frac\tnegative_frac
train\t501090\t103489\t397601\t0.206528\t0.793472
valid\t187591\t38213\t149378\t0.203704\t0.796296
test\t187109\t36299\t150810\t0.193999\t0.806001
"""


@pytest.fixture
def valid_metrics(spark):
    return spark.createDataFrame(VALID, "model string, PR_AUC double, f1 double, opt_threshold double")


def _summary(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(SPLITS, "split string, split_order int, rows long, positive long, negative long")
    return df.select("*", (F.col("positive") / F.col("rows")).alias("positive_fraction"),
                     (F.col("negative") / F.col("rows")).alias("negative_fraction"))


def test_select_best_golden(spark, valid_metrics):
    best = select.select_best(valid_metrics).first()
    assert best["best_model"] == "logistic_regression"
    assert best["opt_threshold"] == pytest.approx(0.4681962101067738)


def test_select_best_first_listed_wins_ties(spark):
    df = spark.createDataFrame([("random_forest", 0.5), ("logistic_regression", 0.5)], "model string, PR_AUC double")
    assert select.select_best(df).first()["best_model"] == "logistic_regression"


def test_compare_lr_strategies_golden(spark, valid_metrics):
    rows = select.compare_lr_strategies(valid_metrics.where("model != 'logistic_regression_undersampled'")).collect()
    assert [r["label"] for r in rows] == ["Logistic Regression", "Logistic Regression (class-weighted)",
                                         "Logistic Regression (oversampled)"]
    assert rows[0]["PR_AUC"] == pytest.approx(0.9256670758185347)


def test_compare_lr_rf_golden(spark, valid_metrics):
    rows = select.compare_lr_rf(valid_metrics).collect()
    assert [r["strategy"] for r in rows] == ["Class-weighted", "Undersampled", "Oversampled"]
    assert rows[0]["lr"] == pytest.approx(0.9235278470051952) and rows[2]["rf"] == pytest.approx(0.7515074227856745)


def test_scaling_series_golden(spark):
    scaling = spark.createDataFrame([
        ("random_forest_weighted", 161496, 13.62, 0.751), ("logistic_regression_weighted", 32473, 5.4, 0.8832),
        (None, 323863, 5.3, 0.9227), ("random_forest_weighted", 32473, 5.43, 0.7485),
        ("logistic_regression_weighted", 161496, 5.27, 0.9184)],
        "model string, train_rows long, train_time_s double, pr_auc double")
    rows = select.scaling_series(scaling).collect()
    lr = [(r["train_rows"], r["series_pos"]) for r in rows if r["model"] == "logistic_regression_weighted"]
    assert lr == [(32473, 1), (161496, 2), (323863, 3)]


def test_report_tables(spark, valid_metrics):
    rec = spark.createDataFrame([("logistic_regression", 29991, 5558, 145252, 6308)],
                                "model string, TP long, FP long, TN long, FN long")
    m = {r["actual"]: (r["predicted_negative"], r["predicted_positive"]) for r in report.report_confusion_2x2(rec).collect()}
    assert m == {"Neg": (145252, 5558), "Pos": (6308, 29991)}
    keys = [r["model"] for r in report.report_metrics(valid_metrics).collect()]
    assert keys == sorted(k for k, *_ in VALID)
    table = report.report_split_table(_summary(spark)).collect()
    assert [r["split"] for r in table] == ["Train", "Valid", "Test"]


def test_split_stats_text_golden(spark, tmp_path):
    writers.write_split_stats(_summary(spark), str(tmp_path / "s"))
    part = next(Path(tmp_path / "s").glob("part-*"))
    assert part.read_text() == SPLIT_STATS_TXT


def test_json_and_csv_round_trip(spark, tmp_path, valid_metrics):
    writers.write_json(valid_metrics, str(tmp_path / "j"))
    back = [json.loads(x) for p in Path(tmp_path / "j").glob("part-*") for x in p.read_text().splitlines()]
    assert {r["model"] for r in back} == {k for k, *_ in VALID}
    writers.write_csv(valid_metrics, str(tmp_path / "c"), ["model", "PR_AUC"])
    got = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "c"))
    assert got.columns == ["model", "PR_AUC"] and got.count() == 8
    with pytest.raises(ValueError):
        writers.write_scaling_csv(valid_metrics, str(tmp_path / "x"))


def test_metrics_csv_skips_empty(spark, tmp_path, valid_metrics):
    assert writers.write_metrics_csv(valid_metrics.limit(0), str(tmp_path / "m")) is False


# Published artefacts, as written by the reference (fixed values for golden tests).
CALIBRATION_CSV = """bin,mean_pred,empirical_pos_rate,count
"[0.0,0.1)",0.01026193225894989,0.011491244949009044,129925
"[0.1,0.2)",0.1444259970282777,0.15032302722658053,8668
"[0.2,0.3)",0.24723956924408824,0.2624741103370363,5311
"[0.3,0.4)",0.34815570141141955,0.3567554240631164,4056
"[0.4,0.5)",0.44830715431229645,0.43997750913691314,3557
"[0.5,0.6)",0.549796793268358,0.5349628712871287,3232
"[0.6,0.7)",0.6510040177215604,0.6324453756360371,3341
"[0.7,0.8)",0.7509822968305331,0.7367717797969,3742
"[0.8,0.9)",0.8534973945136451,0.8325809617271835,5095
"[0.9,1.0]",0.9758335635337205,0.9760936895083236,20664
"""
SCALING_CSV = """model,train_rows,train_time_s,pr_auc
logistic_regression_weighted,32473,5.4,0.8832
random_forest_weighted,32473,5.43,0.7485
logistic_regression_weighted,161496,5.27,0.9184
random_forest_weighted,161496,13.62,0.751
logistic_regression_weighted,323863,5.3,0.9227
random_forest_weighted,323863,24.68,0.7448
"""


def _csv_frame(spark, text, schema):
    import csv
    import io
    rows = list(csv.reader(io.StringIO(text)))[1:]
    fields = [x.split(":") for x in schema.split(",")]
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c, _ in fields))
    return raw.selectExpr(*[f"CAST(`{c}` AS {t}) AS `{c}`" for c, t in fields])


def _written(folder):
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_calibration_csv_golden(spark, tmp_path):
    from pyspark.sql import functions as F
    df = _csv_frame(spark, CALIBRATION_CSV, "bin:string,mean_pred:double,empirical_pos_rate:double,count:bigint")
    df = df.withColumn("bin_index", F.monotonically_increasing_id())
    writers.write_calibration_csv(df, str(tmp_path / "cal"))
    assert _written(tmp_path / "cal") == CALIBRATION_CSV
    assert sum(r["count"] for r in df.collect()) == 187591


def test_scaling_csv_golden(spark, tmp_path):
    df = _csv_frame(spark, SCALING_CSV, "model:string,train_rows:bigint,train_time_s:double,pr_auc:double")
    writers.write_scaling_csv(df, str(tmp_path / "sc"))
    assert _written(tmp_path / "sc") == SCALING_CSV


METRICS_VALID_CSV = """model,PR_AUC,ROC_AUC,precision,recall,f1,balanced_accuracy,MCC,fit_time_s,opt_threshold_policy,opt_threshold,opt_precision,opt_recall,opt_f1,opt_balanced_accuracy,opt_MCC
logistic_regression,0.9256670758185347,0.9764309383522523,0.8596496091367745,0.8115301075550205,0.8348970883196252,0.8888181137997357,0.7946896197399437,7.44,mcc,0.4681962101067738,0.8488284406140587,0.8247716745610133,0.8366271584619672,0.8935979300920318,0.7957144453857895
random_forest,0.7644660758031476,0.9090836852810004,0.9678391959798995,0.1764059351529584,0.29841958475364116,0.5874531918397576,0.37256654575506737,37.63,mcc,0.3168764196398154,0.7481301731875145,0.5889618716143721,0.6590722736324236,0.7691191020699557,0.5907606066287655
"""
METRICS_TEST_CSV = """model,PR_AUC,ROC_AUC,precision,recall,f1,balanced_accuracy,MCC,TP,FP,TN,FN,applied_threshold
logistic_regression,0.9230462591237937,0.977138909451667,0.8436524234155672,0.8262211080195047,0.8348457855472664,0.8946833940071,0.795674166221368,29991,5558,145252,6308,0.4681962101067738
"""


def test_metrics_csv_golden(spark, tmp_path):
    from skewscope.operators.evaluate import TEST_FIELDS, VALID_FIELDS
    types = {"model": "string", "opt_threshold_policy": "string", "TP": "bigint", "FP": "bigint", "TN": "bigint",
             "FN": "bigint"}
    v = _csv_frame(spark, METRICS_VALID_CSV, ",".join(f"{c}:{types.get(c, 'double')}" for c in VALID_FIELDS))
    writers.write_metrics_csv(v.withColumn("model_order", v["PR_AUC"] * 0), str(tmp_path / "v"))
    assert _written(tmp_path / "v") == METRICS_VALID_CSV
    t = _csv_frame(spark, METRICS_TEST_CSV, ",".join(f"{c}:{types.get(c, 'double')}" for c in TEST_FIELDS))
    writers.write_metrics_csv(t, str(tmp_path / "t"), test=True)
    assert _written(tmp_path / "t") == METRICS_TEST_CSV
    with pytest.raises(ValueError):
        writers.write_metrics_csv(v.withColumn("surprise", v["PR_AUC"]), str(tmp_path / "x"))


BALANCE_BY_SPLIT = {
    "train": {"rows": 501090, "positive": 103489, "negative": 397601,
              "positive_fraction": 0.2065277694625716, "negative_fraction": 0.7934722305374284},
    "valid": {"rows": 187591, "positive": 38213, "negative": 149378,
              "positive_fraction": 0.2037038024212249, "negative_fraction": 0.7962961975787751},
    "test": {"rows": 187109, "positive": 36299, "negative": 150810,
             "positive_fraction": 0.19399921970616057, "negative_fraction": 0.8060007802938394},
}


def test_keyed_json_golden(spark, tmp_path):
    summary = _summary(spark).repartition(3)
    writers.write_json_text(writers.keyed_json(summary, "split", "split_order"), str(tmp_path / "b"))
    got = json.loads(_written(tmp_path / "b"))
    assert list(got) == ["train", "valid", "test"]
    for split, vals in BALANCE_BY_SPLIT.items():
        for k, v in vals.items():
            assert got[split][k] == pytest.approx(v, rel=1e-15)
    rec = spark.createDataFrame([("logistic_regression", 0.9230462591237937, 29991)], "model string, PR_AUC double, TP long")
    out = json.loads(writers.test_record_json(rec).first()["json"])
    assert out == {"best_model": "logistic_regression", "metrics": {"PR_AUC": 0.9230462591237937, "TP": 29991}}
