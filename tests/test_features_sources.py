import gzip

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skewscope.operators import features
from skewscope.sources import batches


def test_numeric_name_order():
    assert features.fp_columns(["fp_10", "fp_2", "x", "fp_1", "fp_bits"]) == ["fp_1", "fp_2", "fp_10"]
    assert features.digit_columns(["10", "2", "a", "1"]) == ["1", "2", "10"]


def test_detect_layouts(spark):
    cols = {f"fp_{i}": float(i % 2) for i in range(5)}
    df = spark.createDataFrame([("C", 1.5, *cols.values())], ["SMILES", "SA_score", *cols.keys()])
    out, mode = features.detect_layout(df, min_columns=4)
    assert mode == "fp_columns" and out.columns == ["SMILES", "SA_score", "features"]
    assert out.select(vector_to_array("features")).first()[0] == [0.0, 1.0, 0.0, 1.0, 0.0]
    digits = df.toDF("SMILES", "SA_score", *[str(i) for i in range(5)])
    assert features.detect_layout(digits, min_columns=4)[1] == "numeric_columns"
    with pytest.raises(ValueError):
        features.detect_layout(df.select("SMILES", "SA_score"))


def test_bits_layout_and_length_check(spark):
    df = spark.createDataFrame([("C", " 1011 ", "ab")], "SMILES string, fp_bits string, fp_hex string")
    out, mode = features.detect_layout(df, width=4)
    assert mode == "fp_bits" and out.columns == ["SMILES", "features"]
    assert out.select(vector_to_array("features")).first()[0] == [1.0, 0.0, 1.0, 1.0]
    bad = spark.createDataFrame([("C", "101")], "SMILES string, fp_bits string")
    with pytest.raises(Exception, match="expected 4 bits in fp_bits, found 3 characters"):
        features.detect_layout(bad, width=4)[0].collect()


def test_csv_gz_scan_declared_vs_inferred(spark, tmp_path):
    path = tmp_path / "batch_1.csv.gz"
    with gzip.open(path, "wt") as fh:
        fh.write("SMILES,SA_score,fp_0\nC,2.5,1\nCC,bad,0\n,3.0,1\nCCC,,0\n")
    declared = batches.scan_batches(spark, str(tmp_path / "batch_*.csv.gz"),
                                    schema="SMILES string, SA_score string, fp_0 double")
    inferred = batches.scan_batches(spark, str(tmp_path / "batch_*.csv.gz"), infer_schema=True)
    assert declared.count() == inferred.count() == 4
    clean = batches.cast_score(batches.drop_missing(declared, ["SMILES", "SA_score"]), "SA_score")
    rows = sorted(clean.collect(), key=lambda r: r["SMILES"])
    assert [(r["SMILES"], r["SA_score"]) for r in rows] == [("C", 2.5), ("CC", None)]


def test_parquet_and_csv_give_same_frame(spark, tmp_path):
    df = spark.range(20).select(F.col("id").cast("string").alias("SMILES"), (F.col("id") / 3).alias("SA_score"))
    df.write.parquet(str(tmp_path / "p"))
    df.write.option("header", True).csv(str(tmp_path / "c"), compression="gzip")
    a = batches.scan_batches(spark, str(tmp_path / "p"), fmt="parquet")
    b = batches.scan_batches(spark, str(tmp_path / "c"), schema="SMILES string, SA_score double")
    assert sorted(a.collect()) == sorted(b.collect())


def test_mostly_zero_bits_are_sparse(spark):
    from pyspark.ml.linalg import SparseVector
    df = spark.createDataFrame([("0" * 63 + "1",), ("1" * 64,)], "fp_bits string")
    few, many = (r["features"] for r in features.bits_to_features(df, width=64).collect())
    assert isinstance(few, SparseVector) and few.toArray().sum() == 1 and few[63] == 1.0
    assert many.toArray().sum() == 64
