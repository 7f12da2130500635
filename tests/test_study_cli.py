"""End-to-end: CSV.gz batches built from the embeddings table, through every artefact."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from skewscope.plans.study import run_from_batches
from skewscope.sources.tables import table
from tests.conftest import SF001


def _batches(spark, folder):
    emb = table(spark, SF001, "embeddings")
    bits = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, F.lit("1")).otherwise(F.lit("0"))), "")
    df = emb.select(F.concat(F.lit("m"), F.col("vec_id")).alias("SMILES"),
                    F.format_number(F.col("embedding")[0] * 10 + F.col("label"), 4).alias("SA_score"),
                    F.when(F.col("vec_id") % 7 == 0, F.lit("")).otherwise(
                        F.concat(F.lit("s"), (F.col("vec_id") % 40).cast("string"))).alias("scaffold"),
                    bits.alias("fp_bits"))
    df.repartition(3).write.option("header", True).csv(str(folder), compression="gzip")


def test_run_from_batches_writes_all_artefacts(spark, tmp_path):
    _batches(spark, tmp_path / "in")
    out = tmp_path / "out"
    res = run_from_batches(spark, str(tmp_path / "in" / "*.csv.gz"), str(out), group_col="scaffold",
                           width=64, cap=300, scaling_sizes=(50, 350, 10**9), parallelism=2, keep_tables=True,
                           rf_params={"num_trees": 3, "max_depth": 3}, lr_params={"max_iter": 5})
    names = {p.name for p in out.iterdir()}
    assert {"metrics_valid.json", "metrics_valid.csv", "metrics_test.json", "metrics_test.csv",
            "class_balance_overall.json", "class_balance_by_split.json", "split_stats.txt",
            "calibration_valid.csv", "scaling_results.csv", "scaling_results.json"} <= names

    def text(name):
        return "".join(p.read_text() for p in sorted((out / name).glob("part-*")))

    overall = json.loads(text("class_balance_overall.json"))
    assert overall["feature_mode"] == "fp_bits" and overall["total_rows"] == 500
    by_split = json.loads(text("class_balance_by_split.json"))
    assert list(by_split) == ["train", "valid", "test"]
    assert by_split["train"]["rows"] <= 360 < by_split["train"]["rows_before_cap"]
    assert text("split_stats.txt").splitlines()[0].startswith("split\trows")
    valid = json.loads(text("metrics_valid.json"))
    assert len(valid) == 8 and "opt_threshold" in valid["logistic_regression"]
    test = json.loads(text("metrics_test.json"))
    assert test["best_model"] in valid
    assert len(text("calibration_valid.csv").splitlines()) == 11
    scaling = text("scaling_results.csv").splitlines()
    assert scaling[0] == "model,train_rows,train_time_s,pr_auc" and len(scaling) == 5
    # The size above the cap is sampled from the whole training split.
    assert max(int(x.split(",")[1]) for x in scaling[1:]) > 300
    assert res.best.count() == 1
    assert {"curves_valid.csv", "curves_best_valid.csv", "compare_lr_strategies.csv", "compare_lr_rf.csv",
            "report_metrics.csv", "report_splits.csv", "report_confusion.csv", "report_scaling.csv",
            "scaling_series.csv"} <= names


def test_column_layouts_load_by_header_alone(spark, tmp_path):
    from skewscope.plans.study import load_batches

    for mode, prefix in (("fp_columns", "fp_"), ("numeric_columns", "")):
        cols = [F.expr(f"CAST(id % {k + 2} = 0 AS INT)").alias(f"{prefix}{k}") for k in range(130)]
        df = spark.range(20).select(F.concat(F.lit("m"), "id").alias("SMILES"), F.col("id").cast("string").alias("SA_score"), *cols)
        df.repartition(2).write.option("header", True).csv(str(tmp_path / mode), compression="gzip")
        out, found = load_batches(spark, str(tmp_path / mode / "*.csv.gz"), "SMILES", "SA_score")
        assert found == mode
        row = out.where("SMILES = 'm6'").first()
        assert row["features"].size == 130 and row["SA_score"] == 6.0
        assert row["features"].toArray()[:5].tolist() == [1, 1, 0, 0, 1]  # 6 % 2, 3, 4, 5, 6


def test_recurring_study_stages_and_fits_only_what_is_new(spark, tmp_path, monkeypatch):
    """Three runs: from scratch, again on the same batches, and after one more batch; outputs are published as sets."""
    from skewscope.plans import study
    from skewscope.sinks import publish
    from skewscope.sources import ledger

    made, staged = [], []
    real_registry, real_stage = study.FitRegistry, ledger.stage_new
    monkeypatch.setattr(study, "FitRegistry", lambda *a: made.append(real_registry(*a)) or made[-1])
    monkeypatch.setattr(ledger, "stage_new", lambda *a, **b: staged.append(real_stage(*a, **b)) or staged[-1])
    _batches(spark, tmp_path / "in" / "1")
    out = str(tmp_path / "out")

    def run():
        run_from_batches(spark, str(tmp_path / "in" / "*" / "*.csv.gz"), out, group_col="scaffold", width=64, cap=300, quantile="disc",
                         scaling_sizes=(50,), rf_params={"num_trees": 2, "max_depth": 3}, lr_params={"max_iter": 3},
                         ledger_dir=str(tmp_path / "staged"), models_dir=str(tmp_path / "models"), publish_set=True)
        path = publish.artefact(spark, out, "class_balance_overall.json")
        return json.loads(spark.read.text(path).first()[0])["total_rows"]

    assert run() == 500 and run() == 500
    assert staged[0] >= 1 and staged[1] == 0
    assert len(made[0].fitted) == 10 and made[1].fitted == [] and len(made[1].reused) == 10
    first, second = (publish.current(spark, out)["number"], publish.verify(spark, out))
    assert first == 2 and second.where("intact").count() == second.count() >= 19
    _batches(spark, tmp_path / "in" / "2")
    assert run() == 1000 and staged[2] == staged[0] and len(made[2].fitted) == 10
    assert publish.current(spark, out)["number"] == 3
