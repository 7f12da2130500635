"""Exact-size samples and numbering within repeated keys."""

import collections

import pytest
from pyspark.sql import functions as F

from skewscope.operators import exact_sample, ordinals, resample, splits


def _keyed(spark):
    rows = [("hot", k // 2) for k in range(3000)]  # each content twice
    rows += [(f"k{k % 500}", k) for k in range(2500)] + [(None, k % 7) for k in range(21)] + [("same", 5)] * 400
    return spark.createDataFrame(rows, "key string, v long").repartition(6)


def test_numbers_run_from_one_within_each_key(spark):
    got = ordinals.number_within_key(_keyed(spark), "key").collect()
    by_key = collections.defaultdict(list)
    for r in got:
        by_key[r["key"]].append(r["ordinal"])
    assert len(got) == 5921
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in by_key.values())
    again = ordinals.number_within_key(_keyed(spark).repartition(3), "key").collect()
    assert sorted(map(str, again)) == sorted(map(str, got))  # whatever the partitions


def test_hot_key_is_spread_over_ranges(spark, monkeypatch):
    seen = {}
    real = ordinals.materialize

    def spy(df, *a):
        out = real(df, *a)
        if "_part" in out.columns and "_n" in out.columns:
            seen.update({r["_part"]: r["n"] for r in out.where("key = 'hot'").groupBy("_part").agg(F.count("*").alias("n")).collect()})
        return out

    monkeypatch.setattr(ordinals, "materialize", spy)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordinals.number_within_key(_keyed(spark), "key").count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(seen) >= 3 and max(seen.values()) < 1000  # 1,500 contents of the hot key


def test_many_copies_are_expanded_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(ordinals, "COPY_CHUNK", 50)
    got = ordinals.number_within_key(_keyed(spark).where("key = 'same'"), "key").collect()
    assert sorted(r["ordinal"] for r in got) == list(range(1, 401))


def test_rows_of_one_key_draw_independently(spark):
    keyed = ordinals.with_draw_key(_keyed(spark), "key")
    assert keyed.select("draw_key").distinct().count() == keyed.count()
    kept = splits.fraction_sample(keyed, 0.3, key_col="draw_key")
    assert 750 < kept.where("key = 'hot'").count() < 1050  # alike, it would be none or all
    unique = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    plain = {r["key"] for r in splits.fraction_sample(unique, 0.3, key_col="key").collect()}
    assert plain == {r["key"] for r in splits.fraction_sample(ordinals.with_draw_key(unique, "key"), 0.3, key_col="draw_key").collect()}


@pytest.mark.parametrize("size", [0, 1, 37, 3000, 5920, 5921, 10_000])
def test_sizes_are_exact_also_with_ties(spark, size):
    df = _keyed(spark)
    got = exact_sample.exact_sample(df, size, "key")
    assert got.columns == df.columns and got.count() == min(size, 5921)
    assert got.exceptAll(df).count() == 0


def test_samples_nest_and_do_not_depend_on_partitions(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("key"))
    some = [{r["key"] for r in exact_sample.exact_sample(df.repartition(p), n, "key").collect()} for n, p in ((100, 3), (1000, 7), (1000, 2), (3999, 5))]
    assert some[0] < some[1] == some[2] < some[3] and len(some[3]) == 3999


def test_exact_cap_and_balanced_classes(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 11 == 0).cast("int").alias("label"))
    assert splits.cap_rows(df, 777, key_col="key", exact=True).count() == 777
    n_pos = df.where("label = 1").count()
    under = resample.undersample(df, key_col="key", exact=True).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in under} == {0: n_pos, 1: n_pos}
    over = resample.oversample(df, key_col="key", exact=True)
    assert {r["label"]: r["count"] for r in over.groupBy("label").count().collect()} == {0: 3000 - n_pos, 1: 3000 - n_pos}
    copies = {r["count"] for r in over.where("label = 1").groupBy("key").count().collect()}
    assert copies <= {(3000 - n_pos) // n_pos, (3000 - n_pos) // n_pos + 1}
    with pytest.raises(ValueError):
        splits.cap_rows(df, 10, exact=True)
