"""Frames derived from the test tables that several registered queries share.

Mapping (see FIXTURES.md): labels and balance on ``lineitem`` scored by
``l_extendedprice`` at p=0.8; resampling on ``orders`` keyed by ``o_orderkey``;
metrics on the scored view y = price >= disc80, p1 = l_quantity / 50.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewscope.operators.labels import label_by_quantile
from skewscope.sources.tables import table

P = 0.8


def labelled_lineitem(spark: SparkSession, sf_dir: str, inclusive: bool = True) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return label_by_quantile(li, "l_extendedprice", "label", p=P, method="disc", inclusive=inclusive)


def scored_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(y, p1, ...) with 50 distinct scores, heavy ties and p1 = 1.0 present."""
    li = labelled_lineitem(spark, sf_dir)
    return li.select(
        F.col("label").alias("y"),
        (F.col("l_quantity") / F.lit(50.0)).alias("p1"),
        "l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus")


def labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return label_by_quantile(orders, "o_totalprice", "label", p=P, method="disc")


# Stand-ins for eight fitted models: deterministic score columns of lineitem in
# [0, 1], keyed like the model grid. abs() keeps -0.0 discounts out of the keys.
MODEL_SCORES = {
    "logistic_regression": "l_quantity / 50",
    "random_forest": "abs(l_discount) * 10",
    "logistic_regression_weighted": "l_tax * 12.5",
    "logistic_regression_undersampled": "(l_quantity + 50 * abs(l_discount) * 10) / 100",
    "logistic_regression_oversampled": "floor(l_quantity / 5) / 10",
    "random_forest_weighted": "1 - abs(l_discount) * 10",
    "random_forest_undersampled": "(l_quantity / 50) * (1 - l_tax)",
    "random_forest_oversampled": "l_linenumber / 7",
}


def scored_models(spark: SparkSession, sf_dir: str, keys=None, extra=()) -> DataFrame:
    """Long frame (model, y, p1, extra...): every lineitem row once per model key.

    ``extra`` may name ``split`` (md5 split of l_orderkey) and ``row_key``.
    """
    from skewscope.operators import splits

    keys = list(keys or MODEL_SCORES)
    li = labelled_lineitem(spark, sf_dir)
    if "split" in extra:
        li = splits.assign_split(li.withColumn("okey", F.col("l_orderkey").cast("string")), "okey", method="md5")
    if "row_key" in extra:
        li = li.withColumn("row_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    pairs = F.array(*[F.struct(F.lit(k).alias("model"), F.expr(MODEL_SCORES[k]).cast("double").alias("p1"))
                      for k in keys])
    return li.select(F.col("label").alias("y"), *extra, F.explode(pairs).alias("m")).select(
        "m.model", "y", "m.p1", *extra)


def model_scores_sql(keys=None) -> str:
    """DuckDB text of the same long frame, as a CTE body named ``ms``."""
    keys = list(keys or MODEL_SCORES)
    parts = [f"SELECT '{k}' AS model, CAST({MODEL_SCORES[k]} AS DOUBLE) AS p1, * FROM s" for k in keys]
    return "ms AS (" + " UNION ALL ".join(parts) + ")"


def embedding_splits(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """embeddings: label 1 for class 0 (about 10 %), 64-d vector, split by vec_id hash."""
    from pyspark.ml.functions import array_to_vector

    from skewscope.operators import splits

    emb = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("label"),
        array_to_vector("embedding").alias("features"))
    return splits.split_frames(splits.assign_split(emb, "key", method="md5"))


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined to labels; target toxic; features n_chars, words, lines."""
    from pyspark.ml.feature import VectorAssembler

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    joined = docs.join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("key"), F.col("toxic").alias("label"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim("text"), r"\s+")).cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"))
    return VectorAssembler(inputCols=["n_chars", "words", "lines"], outputCol="features").transform(joined)


LINEITEM_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "is_returned", "is_open"]


def document_study_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a study table: score n_chars, features word and line counts of the
    whole text, group = md5 of the text (exact copies share a group)."""
    from pyspark.ml.feature import VectorAssembler

    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("key"), F.md5("text").alias("group"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim("text"), r"\s+")).cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"))
    return VectorAssembler(inputCols=["words", "lines"], outputCol="features").transform(docs)


WIDTH = 2048
WIDE_BITS = 48


def wide_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as rows of 2,048 0/1 features, about 48 of them set (as in a molecule's fingerprint): each part sets its own 40
    and each quantity 8 more; key, group (order), score (price raised with the quantity) and features."""
    from pyspark.ml.feature import HashingTF

    def draws(name: str, col: str, n: int):
        return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.concat_ws(":", F.lit(name), F.col(col).cast("string"), k.cast("string")))

    li = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"), F.col("l_orderkey").cast("string").alias("group"),
        (F.col("l_extendedprice") + 1500 * F.col("l_quantity")).alias("score"),
        F.concat(draws("p", "l_partkey", WIDE_BITS - 8), draws("q", "l_quantity", 8)).alias("drawn"))
    return HashingTF(numFeatures=WIDTH, binary=True, inputCol="drawn", outputCol="features").transform(li).drop("drawn")
