"""Work per task is bounded by rows, not by how the input files are cut."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skewscope.catalog.sources import WIDTH, divisor_bits
from skewscope.operators import features
from skewscope.plans.spread import spread, tasks_for


def test_tasks_follow_the_rows():
    assert [tasks_for(n, 50_000, 8) for n in (0, 5, 20_000, 150_000, 900_000)] == [1, 1, 2, 8, 18]


def test_spread_keeps_rows_and_deals_equal_ones_evenly(spark):
    one_file = spark.range(40_000).select((F.col("id") % 2).alias("k")).coalesce(1)
    out = spread(one_file, 10_000)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 40_000 and len(sizes) >= 4 and max(sizes) < 1.2 * 40_000 / len(sizes)
    assert sorted(map(tuple, out.groupBy("k").count().collect())) == [(0, 20_000), (1, 20_000)]


def test_bit_strings_are_parsed_by_the_batch(spark):
    df = spark.createDataFrame([("0" * 63 + "1",)], "fp_bits string")
    plan = features.bits_to_features(df, width=64)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "split(" not in plan  # 2,048 interpreted lambda calls a row


def test_bits_of_all_kinds_and_bad_ones(spark):
    texts = [" 0010 ", "1111", "0000", "0300"]
    got = features.bits_to_features(spark.createDataFrame([(t,) for t in texts], "fp_bits string").coalesce(1), width=4).collect()
    assert [r["features"].toArray().tolist() for r in got] == [[float(c) for c in t.strip()] for t in texts]
    for bad in ("01x1", "01 1", "é123"):
        with pytest.raises(Exception, match="not a digit"):
            features.bits_to_features(spark.createDataFrame([(bad,)], "fp_bits string"), width=4).collect()
    with pytest.raises(Exception, match="found 0 characters"):
        features.bits_to_features(spark.createDataFrame([(None,)], "fp_bits string"), width=4).collect()


def test_divisor_bits_in_chunks_and_null_keys():
    keys = [0, 1, None, -6, *range(2, 700)]
    got = divisor_bits.func(pa.array(keys, pa.int64())).to_pylist()
    assert got == ["".join("1" if k is not None and k % d == 0 else "0" for d in range(2, WIDTH + 2)) for k in keys]
