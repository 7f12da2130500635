import gzip

from pyspark.sql import functions as F

from skewscope.operators import balance, labels, splits
from skewscope.streaming import running_balance, stream_batches, write_balance

SCHEMA = "SMILES string, SA_score string, scaffold string"


def _write_batches(folder, n_files=3, rows=200):
    for f in range(n_files):
        with gzip.open(folder / f"batch_{f}.csv.gz", "wt") as fh:
            fh.write("SMILES,SA_score,scaffold\n")
            for i in range(rows):
                k = f * rows + i
                score = "bad" if k % 97 == 0 else f"{(k * 7919) % 1000 / 100:.2f}"
                fh.write(f"m{k},{score},{'' if k % 5 == 0 else 's' + str(k % 37)}\n")


def test_stream_matches_batch(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    _write_batches(land)
    batch = spark.read.schema(SCHEMA).option("header", True).csv(str(land))
    q = labels.threshold_value(batch.select(F.col("SA_score").try_cast("double").alias("s")), "s", 0.8)
    stream = stream_batches(spark, str(land), SCHEMA, max_files_per_trigger=1)
    query = write_balance(running_balance(stream, "SA_score", q, "scaffold", "SMILES"),
                          str(tmp_path / "ckpt"), name="balance_test")
    query.awaitTermination()
    got = {(r["split"], r["label"]): r["rows"] for r in spark.sql("SELECT * FROM balance_test").collect()}
    # Same counts from the batch operators.
    clean = batch.select("SMILES", "scaffold", F.col("SA_score").try_cast("double").alias("s")).where("s IS NOT NULL")
    lab = labels.label_by_quantile(clean, "s", threshold=q)
    keyed = splits.group_key(lab, "scaffold", "SMILES", out="k")
    ref = balance.split_summary(splits.assign_split(keyed, "k"), "split", "label").collect()
    for r in ref:
        assert got.get((r["split"], 1), 0) == r["positive"]
        assert got.get((r["split"], 0), 0) == r["negative"]
