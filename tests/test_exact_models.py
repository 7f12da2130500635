"""Node tables, gradients and the exact oracles of fitted models, and that models which are not fitted fail them."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skewscope.catalog import ORACLE_SQL, QUERIES
from skewscope.catalog import exact
from skewscope.operators import forest, models, optimum, resample
from skewscope.plans.materialize import materialize
from tests.conftest import SF001


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)).round(3)
    x[:, 4] = rng.integers(0, 4, 400)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + (x[:, 4] == 2) + rng.normal(size=400) > 0.8).astype(int)
    data = [(int(k), [float(v) for v in r], int(c)) for k, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "k long, x array<double>, label int").withColumn("features", array_to_vector("x")).cache()


def _both(scored, walked):
    met = scored.join(walked, "k")
    return met.agg(F.max(F.abs(F.col("p1") - F.col("q"))).alias("e"), F.count("*").alias("n"), F.countDistinct("p1").alias("d")).first()


@pytest.mark.parametrize("limit", [forest.BROADCAST_NODES, 0])
def test_walk_equals_mllib(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(forest, "BROADCAST_NODES", limit)
    fitted = models.random_forest(num_trees=7, max_depth=6).fit(rows)
    scored = models.score(fitted, rows, "label", keep=["k"]).withColumnRenamed("p1", "q")
    out = _both(scored, forest.walk(rows.select("k", "features"), forest.node_table(fitted)))
    assert out["n"] == 400 and out["e"] < 1e-12 and out["d"] > 20


def test_walk_with_categories_and_arrays(spark, rows):
    indexer = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=6).fit(rows)
    df = indexer.transform(rows).select("k", "label", F.col("indexed").alias("features"))
    fitted = models.random_forest(num_trees=5, max_depth=5).fit(df)
    nodes = forest.node_table(fitted)
    assert nodes.where("categories IS NOT NULL").count() > 0
    scored = models.score(fitted, df, "label", keep=["k"]).withColumnRenamed("p1", "q")
    assert _both(scored, forest.walk(df.select("k", "features"), nodes))["e"] < 1e-12
    plain = df.select("k", F.expr("CAST(NULL AS ARRAY<DOUBLE>)").alias("features")).limit(0)
    assert forest.walk(plain, nodes).collect() == []


def test_walk_keeps_repeated_rows_and_single_leaf(spark, rows):
    twice = rows.unionByName(rows).select("label", "features")
    fitted = models.random_forest(num_trees=3, max_depth=3).fit(rows)
    assert forest.walk(twice, forest.node_table(fitted)).count() == 800
    one = rows.withColumn("label", F.lit(0))
    stump = models.random_forest(num_trees=2, max_depth=3).fit(one)
    assert {r["p1"] for r in forest.walk(rows.select("k", "features"), forest.node_table(stump)).collect()} == {0.0}


def test_training_rows_make_up_the_votes(spark, rows):
    weighted = resample.class_weights(rows, "label")
    fitted = models.random_forest("features", "label", "weight", num_trees=2, max_depth=5, subsampling_rate=1.0,
                                  feature_subset="all", bootstrap=False).fit(weighted)
    n = forest.node_counts(weighted, forest.node_table(fitted), weight_col="weight").collect()
    assert len(n) > 10 and max(r["level"] for r in n) > 2
    for r in n:
        assert math.isclose(r["met0"], r["votes0"], abs_tol=1e-6) and math.isclose(r["met1"], r["votes1"], abs_tol=1e-6)
    # Other rows do not.
    assert any(abs(r["met0"] - r["votes0"]) > 1 for r in forest.node_counts(
        weighted.where("k % 2 = 0"), forest.node_table(fitted), weight_col="weight").collect())


def test_gradient_by_hand_and_untrained_model(spark, rows):
    weighted = resample.class_weights(rows, "label")
    fitted = models.logistic_regression("features", "label", "weight").fit(weighted)
    got = {r["coordinate"]: r for r in optimum.lr_gradient(fitted, weighted, weight_col="weight").collect()}
    data = weighted.collect()
    x, y = np.array([r["x"] for r in data]), np.array([r["label"] for r in data])
    w = np.array([r["weight"] for r in data])
    assert max(r["relative"] for r in got.values()) < exact.GRADIENT_TOLERANCE and set(got) == {-1, *range(5)}
    for k in range(5):
        assert math.isclose(got[k]["scale"], float((w * np.abs(x[:, k])).sum()), rel_tol=1e-9)
    for steps in (0, 1):
        bad = models.logistic_regression("features", "label", "weight", max_iter=steps).fit(weighted)
        grad = {r["coordinate"]: r for r in optimum.lr_gradient(bad, weighted, weight_col="weight").collect()}
        p = 1 / (1 + np.exp(-(x @ bad.coefficients.toArray() + bad.intercept)))
        hand = (w * (p - y)) @ x
        assert all(math.isclose(grad[k]["gradient"], hand[k], rel_tol=1e-6, abs_tol=1e-6) for k in range(5))
        assert max(r["relative"] for r in grad.values()) > 1000 * exact.GRADIENT_TOLERANCE
        assert optimum.log_loss(bad, weighted, weight_col="weight") > optimum.log_loss(fitted, weighted, weight_col="weight")


def _oracle(name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{SF001}/lineitem.parquet'")
    out = con.sql(ORACLE_SQL[name])
    return sorted([dict(zip(out.columns, r)) for r in out.fetchall()], key=lambda r: r["model"])


def _rows(spark, name):
    return sorted((r.asDict() for r in QUERIES[name](spark, SF001).collect()), key=lambda r: r["model"])


def test_records_of_all_models_equal_sql_and_a_constant_score_does_not(spark, monkeypatch):
    want = _oracle("grid_records")
    got = _rows(spark, "grid_records")
    assert [r["model"] for r in got] == [r["model"] for r in want] and len(got) == 8
    for g, w in zip(got, want):
        assert all(g[c] == w[c] or math.isclose(g[c], w[c], abs_tol=1e-6) for c in w), (g, w)
    assert len({r["PR_AUC"] for r in got}) > 2
    real = models.score_all
    monkeypatch.setattr(models, "score_all", lambda *a: materialize(real(*a).withColumn("p1", F.lit(0.3))))
    for g, w in zip(_rows(spark, "grid_records"), want):
        assert any(not math.isclose(g[c], w[c], abs_tol=1e-6) for c in ("PR_AUC", "ROC_AUC", "opt_MCC")), g["model"]
