"""CSV batches are written by tasks of bounded memory, in files of bounded rows where a batch may have several."""

from pathlib import Path

from pyspark.sql import functions as F

from skewscope.catalog import recurring
from skewscope.sources.tables import table

SF001 = "/root/testdata/sf0.001"


def _files(path):
    return sorted(Path(path.removeprefix("file:")).glob("batch=*/*.csv.gz"))


def test_one_file_per_batch_without_a_sort(spark, monkeypatch):
    tasks, real = [], type(spark.range(1)).repartitionById

    def dealt(self, n, col):
        out = real(self, n, col)
        tasks.append(out.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("batch").alias("n")).collect())
        return out

    monkeypatch.setattr(type(spark.range(1)), "repartitionById", dealt)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    path = recurring._write_csv_batches(spark, SF001)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert [f.parent.name for f in _files(path)] == [f"batch={k}" for k in range(recurring.FILES)]
    assert sorted(r["p"] for r in tasks[0]) == list(range(recurring.FILES)) and {r["n"] for r in tasks[0]} == {1}


def test_files_of_bounded_rows(spark):
    path = recurring._write_csv_batches(spark, SF001, 200)
    n = table(spark, SF001, "lineitem").count()
    sizes = [r["n"] for r in spark.read.option("header", True).csv(path).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == n and len(sizes) >= n / 200 and max(sizes) < 2 * 200
    assert len({f.parent.name for f in _files(path)}) == recurring.FILES
