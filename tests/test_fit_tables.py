"""Fits read saved rows in tasks of bounded size, and each frame is worked out once."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from skewscope.catalog import QUERIES
from skewscope.operators import evaluate, experiments, forest, models
from skewscope.plans import registry

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def train(spark):
    rows = [(str(i), int(i % 5 == 0), Vectors.dense([float(i % 7), float(i % 3)])) for i in range(1000)]
    return spark.createDataFrame(rows, ["key", "label", "features"]).withColumn("label", F.col("label").cast("int")).coalesce(1)


class Seen(Exception):
    pass


def test_tasks_of_a_fit_hold_a_bounded_number_of_rows(spark, train, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    sizes = []

    def look(est, df):
        sizes.append([r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()])
        raise Seen

    monkeypatch.setattr(models, "fit_timed", look)
    for run in (lambda: experiments.strategy_grid(train, train, key_col="key"),
                lambda: experiments.scaling_study(train, train, [1000], key_col="key"),
                lambda: evaluate.evaluate_model(models.logistic_regression(), train, train)):
        with pytest.raises(Seen):
            run()
    assert sizes == [[100] * 10] * 3


@pytest.mark.parametrize("name", ["evaluate_records", "forest_nodes", "band_scores", "grid_restart"])
def test_fits_do_not_work_their_input_out_again(spark, monkeypatch, name):
    read = []

    def look(est, df, *a):
        read.extend(df.inputFiles())
        raise Seen

    monkeypatch.setattr(models, "fit_timed", look)
    monkeypatch.setattr(registry.FitRegistry, "fit", lambda self, est, df, name="model": look(est, df))
    with pytest.raises(Seen):
        QUERIES[name](spark, SF001)
    assert read and all("skewscope-tables" in f for f in read)


def test_settings_of_the_session_hold_for_saved_rows(spark, train):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        saved = models.training_table(train)
        assert saved.sparkSession.conf.get("spark.sql.shuffle.partitions") == "7"
        assert spark.conf.get("spark.sql.files.openCostInBytes") == before
        assert saved.unionByName(train).join(train.select("key"), "key").count() == 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_walk_reads_its_rows_once(spark, train):
    fitted = models.random_forest(num_trees=3, max_depth=3).fit(train)
    walked = forest.walk(train.select("key", "features"), forest.node_table(fitted))
    plan = walked._jdf.queryExecution().executedPlan().toString()
    assert sum("_row" in line for line in plan.splitlines() if "FileScan" in line) == 1
    want = {r["key"]: r["p1"] for r in models.score(fitted, train, "label", keep=["key"]).collect()}
    got = {r["key"]: r["p1"] for r in walked.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_one_fingerprint_for_the_families_of_a_frame(spark, train, monkeypatch, tmp_path):
    taken = []
    real = registry.fingerprint
    monkeypatch.setattr(registry, "fingerprint", lambda df, cols: taken.append(cols) or real(df, cols))
    reg = registry.FitRegistry(spark, str(tmp_path))
    keys = {reg.key(models.logistic_regression(), train), reg.key(models.random_forest(), train)}
    assert len(keys) == 2 and len(taken) == 1
    assert reg.key(models.random_forest(), train.where("key <> '7'")) not in keys and len(taken) == 2
