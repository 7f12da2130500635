import hashlib

import pytest
from pyspark.sql import functions as F

from skewscope.functions.hashing import hash_bucket, unit_draw
from skewscope.operators import balance, ordinals, resample, splits
from skewscope.sources.tables import table
from tests.conftest import SF01


def test_md5_bucket_matches_python(spark):
    keys = ["a", "b", "123", "scaffold-x", ""]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: (r["b"], r["u"]) for r in df.select("k", hash_bucket("k", 100, "md5").alias("b"),
                                                         unit_draw("k", 42).alias("u")).collect()}
    for k in keys:
        h = int(hashlib.md5(k.encode()).hexdigest()[:8], 16)
        u = int(hashlib.md5(f"{k}:42".encode()).hexdigest()[:8], 16) / 2 ** 32
        assert got[k] == (h % 100, pytest.approx(u))


def test_split_covers_rows_once_without_leakage(spark):
    li = table(spark, SF01, "lineitem").withColumn("k", F.col("l_orderkey").cast("string"))
    sp = splits.assign_split(li, "k")  # xxhash64
    counts = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    assert sum(counts.values()) == li.count()
    assert set(counts) == {"train", "valid", "test"}
    assert splits.leakage(sp, "l_orderkey").count() == 0
    assert splits.leakage_summary(sp, "l_orderkey").first()["leaking_groups"] == 0
    # The split does not depend on partitioning.
    again = splits.assign_split(li.repartition(13), "k")
    assert again.groupBy("split").count().collect() and \
        {r["split"]: r["count"] for r in again.groupBy("split").count().collect()} == counts


def test_md5_split_counts_match_survey(spark):
    li = table(spark, SF01, "lineitem").withColumn("k", F.col("l_orderkey").cast("string"))
    counts = {r["split"]: r["count"] for r in splits.assign_split(li, "k", method="md5").groupBy("split").count().collect()}
    assert (counts["train"], counts["valid"], counts["test"]) == (48019, 5887, 6094)


def test_group_key_fallback(spark):
    df = spark.createDataFrame([("s1", "a"), ("", "b"), (None, "c")], "scaffold string, smiles string")
    out = {r["smiles"]: r["group_key"] for r in splits.group_key(df, "scaffold", "smiles").collect()}
    assert out == {"a": "s1", "b": "b", "c": "c"}
    parity = {r["smiles"]: r["group_key"] for r in splits.group_key(df, "scaffold", "smiles", empty_as_group=True).collect()}
    assert parity == {"a": "s1", "b": "", "c": "c"}


def test_cap_rows(spark):
    df = spark.range(10000).withColumn("k", F.col("id").cast("string"))
    assert splits.cap_rows(df, 20000, key_col="k").count() == 10000
    capped = splits.cap_rows(df, 2000, key_col="k").count()
    assert 1700 < capped < 2300
    assert splits.cap_rows(df, 2000, method="native").count() < 2500


def _imbalanced(spark):
    return spark.range(5000).select(F.col("id").cast("string").alias("k"),
                                    F.when(F.col("id") % 5 == 0, 1).otherwise(0).alias("label"))


def test_class_weights_sum(spark):
    df = _imbalanced(spark)
    w = resample.class_weights(df, "label")
    n_pos, n_neg = balance.class_counts(df, "label")
    total = w.agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(2 * n_neg)
    one_class = resample.class_weights(df.where("label = 0"), "label")
    assert one_class.agg(F.max("weight")).first()[0] == 1.0


def test_undersample_is_subset_keeping_minority(spark):
    df = _imbalanced(spark)
    us = resample.undersample(df, "label", key_col="k")
    assert us.subtract(df).count() == 0
    assert us.where("label = 1").count() == 1000
    assert 850 < us.where("label = 0").count() < 1150
    nat = resample.undersample(df, "label", method="native")
    assert nat.where("label = 1").count() == 1000


def test_oversample_replicates_minority(spark):
    df = _imbalanced(spark)
    os_ = resample.oversample(df, "label", key_col="k")
    assert os_.where("label = 0").count() == 4000
    assert 3800 < os_.where("label = 1").count() < 4200
    # every minority row appears floor(4)=4 or 5 times (ratio is exactly 4)
    per = os_.where("label = 1").groupBy("k").count().agg(F.min("count"), F.max("count")).first()
    assert per[0] >= 4 and per[1] <= 5
    assert resample.oversample(df.where("label = 0"), "label", key_col="k").count() == 4000


def test_majority_detected_when_positives_dominate(spark):
    df = _imbalanced(spark).select("k", (1 - F.col("label")).alias("label"))
    us = resample.undersample(df, "label", key_col="k")
    assert us.where("label = 0").count() == 1000


def test_split_summary_reports_empty_splits(spark):
    df = spark.createDataFrame([("train", 1), ("train", 0), ("valid", 0)], "split string, label int")
    rows = {r["split"]: r for r in balance.split_summary(df).collect()}
    assert rows["test"]["rows"] == 0 and rows["test"]["positive_fraction"] == 0.0
    assert rows["train"]["positive_fraction"] == 0.5


def test_oversample_huge_ratio_is_chunked(spark, monkeypatch):
    monkeypatch.setattr(ordinals, "COPY_CHUNK", 100)
    df = spark.range(2500).select(F.col("id").cast("string").alias("k"),
                                  F.when(F.col("id") < 2, 1).otherwise(0).alias("label"))
    out = resample.oversample(df, "label", key_col="k")
    per = {r["k"]: r["count"] for r in out.where("label = 1").groupBy("k").count().collect()}
    draws = {r["k"]: r["u"] for r in df.where("label = 1").select("k", unit_draw("k", 42).alias("u")).collect()}
    for k, u in draws.items():
        assert per[k] == int(1249.0 + u)  # floor(ratio + u), ratio = 2498 / 2
    assert out.where("label = 0").count() == 2498


def test_chained_draws_are_independent(spark):
    from skewscope.operators import resample

    df = spark.range(60_000).selectExpr("id AS k", "CAST(id % 5 = 0 AS INT) AS label")
    capped = splits.cap_rows(df, 15_000, key_col="k")
    n = {r["label"]: r["count"] for r in capped.groupBy("label").count().collect()}
    assert abs(n[0] + n[1] - 15_000) < 4 * (15_000 * 0.75) ** 0.5
    under = {r["label"]: r["count"] for r in resample.undersample(capped, "label", key_col="k").groupBy("label").count().collect()}
    share = n[1] / n[0]
    assert under[1] == n[1] and abs(under[0] - n[1]) < 4 * (n[0] * share * (1 - share)) ** 0.5
    over = {r["label"]: r["count"] for r in resample.oversample(capped, "label", key_col="k").groupBy("label").count().collect()}
    assert over[0] == n[0] and abs(over[1] - n[0]) < 4 * (n[1] * 0.25) ** 0.5 + 4
    for method in ("hash", "xxhash64"):
        half = splits.fraction_sample(capped, 0.5, method=method, key_col="k").count()
        assert abs(half - (n[0] + n[1]) / 2) < 4 * ((n[0] + n[1]) / 4) ** 0.5
