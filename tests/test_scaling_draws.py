"""The samples of a scaling study are taken by draws that are saved once."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from skewscope.operators import exact_sample, experiments


def test_a_saved_draw_gives_the_same_rows(spark):
    df = spark.range(500).select((F.col("id") % 300).cast("string").alias("key"), "id")  # 200 keys twice: ties
    kept = df.withColumn("d", exact_sample.draw("key", 42, "hash", "scale"))
    for size in (0, 7, 250, 500, 900):
        want = exact_sample.exact_sample(df, size, "key", purpose="scale")
        got = exact_sample.exact_sample(kept, size, "key", purpose="scale", draw_col="d")
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect()) and got.count() == min(size, 500)


def test_the_study_draws_each_row_once(spark, monkeypatch):
    rows = [(str(i), int(i % 5 == 0), Vectors.dense([float(i % 7)])) for i in range(400)]
    train = spark.createDataFrame(rows, ["key", "label", "features"]).withColumn("label", F.col("label").cast("int"))
    read, real = [], experiments.exact_sample

    def look(df, *a, draw_col=None, **kw):
        read.append((draw_col in df.columns, all("skewscope-tables" in f for f in df.inputFiles())))
        return real(df, *a, draw_col=draw_col, **kw)

    monkeypatch.setattr(experiments, "exact_sample", look)
    out = experiments.scaling_study(train, train, [100, 400], key_col="key", families=("lr",)).collect()
    assert read == [(True, True)] * 2 and sorted(r["train_rows"] for r in out) == [100, 400]
