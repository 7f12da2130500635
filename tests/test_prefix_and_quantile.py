import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skewscope.operators import labels
from skewscope.plans.prefix import running_totals


def _frame(spark, n=5000, groups=3, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        keys = rng.choice(100000, size=n, replace=False).astype(float) / 7.0
        for k in keys:
            rows.append((f"g{g}", float(k), int(rng.integers(0, 5))))
    return spark.createDataFrame(rows, "g string, k double, v long")


@pytest.mark.parametrize("descending", [True, False])
def test_bounded_prefix_equals_global_window(spark, descending):
    df = _frame(spark)
    got = running_totals(df, "k", ["v"], ["g"], descending=descending, rows_per_range=700, reuse=False)
    order = F.col("k").desc() if descending else F.col("k").asc()
    w = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("g", "k", F.sum("v").over(w).alias("ref"), F.sum("v").over(Window.partitionBy("g")).alias("tot"))
    joined = got.join(ref, ["g", "k"])
    assert joined.count() == df.count()
    assert joined.where((F.col("cum_v") != F.col("ref")) | (F.col("total_v") != F.col("tot"))).count() == 0


def test_bounded_prefix_no_groups_with_checkpoint(spark):
    df = _frame(spark, n=3000, groups=1).drop("g")
    got = running_totals(df, "k", ["v"], descending=True, rows_per_range=500, reuse=True)
    w = Window.orderBy(F.col("k").desc())
    ref = df.select("k", F.sum("v").over(w).alias("ref"))
    assert got.join(ref, "k").where(F.col("cum_v") != F.col("ref")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 10, 12, 13, 997])
@pytest.mark.parametrize("p", [0.1, 0.5, 0.8, 0.99])
def test_exact_quantile_matches_spark_percentiles(spark, n, p):
    rng = np.random.default_rng(n)
    vals = [(float(x),) for x in rng.integers(0, max(2, n // 3), size=n)]  # duplicates on purpose
    df = spark.createDataFrame(vals, "x double")
    ref = df.selectExpr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x) AS d", f"percentile(x, {p}) AS c").first()
    assert labels.threshold_value(df, "x", p, "disc") == ref["d"]
    assert labels.threshold_value(df, "x", p, "cont") == pytest.approx(ref["c"], abs=1e-9)


def test_exact_quantile_multi_range_and_nulls(spark):
    rng = np.random.default_rng(3)
    vals = [(float(x),) for x in rng.normal(size=4000)] + [(None,)] * 50
    df = spark.createDataFrame(vals, "x double")
    ref = df.selectExpr("percentile_disc(0.8) WITHIN GROUP (ORDER BY x) AS d").first()["d"]
    got = labels.quantile_threshold(df, "x", 0.8, "disc", rows_per_range=300).first()["threshold"]
    assert got == ref
    full = labels.quantile_threshold_full(df, "x", 0.8, "disc", rows_per_range=300).first()["threshold"]
    assert full == ref


def test_exact_quantile_reads_its_input_twice_at_any_bracket(spark):
    n = 40_000
    read = spark.sparkContext.accumulator(0)

    def passing(x):
        read.add(1)
        return x

    counted = F.udf(passing, "double").asNondeterministic()
    df = spark.range(n).select(counted((F.col("id") * 7919 % n).cast("double")).alias("x"))
    got = labels.quantile_threshold(df, "x", 0.8, "disc", rows_per_range=5).first()["threshold"]
    assert got == 0.8 * n - 1
    assert read.value == 2 * n


def test_empty_quantile_is_null_and_labels_zero(spark):
    df = spark.createDataFrame([], "x double")
    assert labels.threshold_value(df, "x", 0.8) is None
    assert labels.label_by_quantile(df, "x").count() == 0


def test_lineitem_quantiles_and_labels(spark):
    from tests.conftest import SF01
    from skewscope.sources.tables import table
    li = table(spark, SF01, "lineitem")
    assert labels.threshold_value(li, "l_extendedprice", 0.8, "disc") == 84359.61
    approx = labels.threshold_value(li, "l_extendedprice", 0.8, "approx")
    # GK guarantee: the rank of the answer is within 1 % of the target rank.
    below = li.where(F.col("l_extendedprice") <= approx).count() / li.count()
    assert abs(below - 0.8) <= 0.011
    lab = labels.label_by_quantile(li, "l_extendedprice", inclusive=True)
    strict = labels.label_by_quantile(li, "l_extendedprice", inclusive=False)
    assert lab.where("label = 1").count() >= strict.where("label = 1").count()


def test_null_score_gets_label_zero(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "s double")
    out = labels.label_by_quantile(df, "s", threshold=1.5).orderBy("s").collect()
    assert [r["label"] for r in out] == [0, 0, 1]


def test_materialize_round_trip_and_drop(spark):
    from skewscope.plans.materialize import drop_tables, materialize
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("part"))
    m = materialize(df, partition_by=["part"])
    assert m.columns == ["id", "part"] and m.count() == 100
    assert m.where("part = '1'").count() == 33
    assert drop_tables(spark) >= 1


@pytest.mark.parametrize("rows_per_range", [10**6, 20])
def test_null_group_is_a_group(spark, rows_per_range):
    """Running totals, thresholds and bins of rows without a group, in one range and in many."""
    from pyspark.sql import functions as F

    from skewscope.operators import calibration, curves, metrics

    rows = [(g, k % 3 == 0, k / 100) for g in ("a", None) for k in range(100)]
    df = spark.createDataFrame(rows, "g string, y boolean, p1 double").withColumn("y", F.col("y").cast("int"))
    got = curves.threshold_table(df, "y", "p1", ["g"], rows_per_range=rows_per_range)
    assert got.count() == 200
    strip = lambda r: sorted((x["threshold"], x["tp"], x["fp"], x["fn"], x["tn"]) for x in r)
    assert strip(got.where("g IS NULL").collect()) == strip(got.where("g = 'a'").collect())
    own = metrics.evaluate_scores(df, "y", "p1", df.select("g").distinct().withColumn("applied_threshold", F.lit(0.25)), ["g"],
                                  rows_per_range=rows_per_range)
    assert sorted((r["TP"] + r["FP"] for r in own.collect())) == [75, 75]
    bins = calibration.calibration_table(df, "y", "p1", 10, ["g"])
    assert bins.groupBy("g").agg(F.sum("count").alias("n")).where("n = 100").count() == 2
