from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from skewscope.catalog.fixtures import embedding_splits
from skewscope.functions.scoring import MODEL_KEYS, display_name, positive_probability
from skewscope.operators import experiments
from tests.conftest import SF001


def test_one_class_fit_scores_zero(spark):
    df = spark.range(50).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"),
                                F.lit(0.0).alias("label"))
    m = RandomForestClassifier(numTrees=2, seed=1).fit(df)
    out = m.transform(df).select(F.size(vector_to_array("probability")).alias("n"),
                                 positive_probability().alias("p1")).first()
    assert out["n"] == 1 and out["p1"] == 0.0


def test_display_names(spark):
    df = spark.createDataFrame([("random_forest_oversampled",), ("mystery",)], "m string")
    assert [r[0] for r in df.select(display_name("m")).collect()] == ["Random Forest (oversampled)", "mystery"]


def test_small_strategy_grid(spark):
    s = embedding_splits(spark, SF001)
    grid = experiments.strategy_grid(s["train"], s["valid"], "label", "features", key_col="key",
                                     rf_params={"num_trees": 3, "max_depth": 3}, lr_params={"max_iter": 5})
    rows = grid.metrics.collect()
    assert [r["model"] for r in rows] == list(MODEL_KEYS)
    for r in rows:
        assert 0 <= r["PR_AUC"] <= 1 and r["fit_time_s"] >= 0
        assert r["TP"] + r["FP"] + r["TN"] + r["FN"] == s["valid"].count()


def test_scaling_study_skips_large_sizes(spark):
    s = embedding_splits(spark, SF001)
    out = experiments.scaling_study(s["train"], s["valid"], [50, 10**9], "label", "features", key_col="key",
                                    rf_params={"num_trees": 2, "max_depth": 2}, lr_params={"max_iter": 3})
    rows = out.collect()
    assert {r["model"] for r in rows} == {"logistic_regression_weighted", "random_forest_weighted"}
    assert all(r["train_rows"] < 10**9 for r in rows)


def test_entry_contract(spark):
    import __spark_entry__ as e
    qs, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 50
    df = e.entry(spark)
    assert df.count() == 1
    assert "PR_AUC" in df.columns and "applied_threshold" in df.columns


def test_parallel_grid_matches_sequential(spark):
    s = embedding_splits(spark, SF001)
    kw = dict(rf_params={"num_trees": 3, "max_depth": 3}, lr_params={"max_iter": 5}, key_col="key")
    seq = {r["model"]: r for r in experiments.strategy_grid(s["train"], s["valid"], **kw).metrics.collect()}
    par = {r["model"]: r for r in experiments.strategy_grid(s["train"], s["valid"], parallelism=4, **kw).metrics.collect()}
    assert set(seq) == set(par)
    for k in seq:
        assert seq[k]["PR_AUC"] == par[k]["PR_AUC"] and seq[k]["TP"] == par[k]["TP"]
