"""Scan, cleaning and feature-layout queries (inventory rows 1-9)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skewscope.catalog._registry import register
from skewscope.operators import features
from skewscope.plans.spread import spread
from skewscope.sources import batches
from skewscope.sources.tables import table

LINEITEM_SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                   "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                   "l_returnflag string, l_linestatus string, l_shipdate timestamp")
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@register("scan_batches", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem""")
def scan_batches(spark, sf):
    return batches.scan_batches(spark, f"{sf}/lineitem.parquet", fmt="parquet", schema=LINEITEM_SCHEMA,
                                columns=["l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag"])


@register("drop_missing", """
SELECT d.doc_id, d.n_chars, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.text IS NOT NULL AND l.toxic IS NOT NULL""")
def drop_missing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    joined = docs.join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return batches.drop_missing(joined, ["text", "toxic"]).select("doc_id", "n_chars", "toxic")


@register("cast_score", """
SELECT l_orderkey, l_linenumber,
       TRY_CAST(CASE WHEN l_returnflag = 'N' THEN 'n/a' ELSE CAST(l_extendedprice AS VARCHAR) END AS DOUBLE)
       AS score
FROM lineitem""")
def cast_score(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "N", F.lit("n/a"))
        .otherwise(F.col("l_extendedprice").cast("string")).alias("score"))
    return batches.cast_score(li, "score")


def _fp_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    # Numbered out of text order on purpose: fp_10 must come after fp_2.
    names = {"l_quantity": "fp_2", "l_extendedprice": "fp_10", "l_discount": "fp_1", "l_tax": "fp_3",
             "l_linenumber": "fp_0"}
    return li.select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(n) for c, n in names.items()])


@register("detect_layout", """
SELECT l_orderkey, l_linenumber, 'fp_columns' AS feature_mode, 5 AS width, CAST(l_linenumber AS DOUBLE) AS feature_0,
       l_discount AS feature_1, l_quantity AS feature_2, l_tax AS feature_3, l_extendedprice AS feature_4
FROM lineitem""")
def detect_layout(spark, sf):
    df, mode = features.detect_layout(_fp_lineitem(spark, sf), min_columns=4)
    arr = vector_to_array("features")
    return df.select(*[c for c in df.columns if c != "features"], F.lit(mode).alias("feature_mode"),
                     F.size(arr).alias("width"), *[arr[i].alias(f"feature_{i}") for i in range(5)])


@register("assemble_features", """
SELECT l_orderkey, l_linenumber,
       round(CAST(l_linenumber AS DOUBLE) + l_discount + l_quantity + l_tax + l_extendedprice, 6) AS feature_sum,
       CAST(l_linenumber AS DOUBLE) AS first_feature
FROM lineitem""")
def assemble_features(spark, sf):
    df, _ = features.detect_layout(_fp_lineitem(spark, sf), min_columns=4)
    arr = vector_to_array("features")
    return df.select("l_orderkey", "l_linenumber",
                     F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"),
                     arr[0].alias("first_feature"))


@register("bits_to_features", """
SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END)) AS DOUBLE) AS ones,
       CAST(len(embedding) AS INTEGER) AS width
FROM embeddings""")
def bits_to_features(spark, sf):
    emb = table(spark, sf, "embeddings")
    bits = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, F.lit("1")).otherwise(F.lit("0"))), "")
    df, mode = features.detect_layout(emb.select("vec_id", bits.alias("fp_bits")), min_columns=4, width=64)
    arr = vector_to_array("features")
    return df.select("vec_id", F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("ones"),
                     F.size(arr).alias("width"))


#: Rows of one task that turns keys of 8 bytes into texts of 2,048.
BIT_ROWS = 50_000
#: Rows whose remainders are worked out at a time.
BIT_CHUNK = 256
WIDTH = features.FP_WIDTH


@F.arrow_udf(StringType())
def divisor_bits(keys: pa.Array) -> pa.Array:
    """Texts of WIDTH bits: bit k is 1 where the key divides by k + 2 (a null key: all 0)."""
    by = np.arange(2, WIDTH + 2)
    keys = keys.fill_null(1).to_numpy(zero_copy_only=False)
    text = np.empty((len(keys), WIDTH), np.uint8)
    for i in range(0, len(keys), BIT_CHUNK):
        text[i:i + BIT_CHUNK] = (keys[i:i + BIT_CHUNK, None] % by == 0) + ord("0")
    ends = np.arange(len(keys) + 1, dtype=np.int32) * WIDTH
    return pa.StringArray.from_buffers(len(keys), pa.py_buffer(ends), pa.py_buffer(text))


@register("wide_bits", """
SELECT CAST(k AS INTEGER) AS coordinate, sum(CASE WHEN o_orderkey % (k + 2) = 0 THEN 1 ELSE 0 END) * 1e0 AS ones
FROM orders, (SELECT unnest(range(2048)) AS k) GROUP BY k""")
def wide_bits(spark, sf):
    """Bit strings of the full width (bit k: the key divides by k + 2) as vectors; ones per coordinate."""
    from pyspark.ml.stat import Summarizer

    keys = spread(table(spark, sf, "orders").select("o_orderkey"), BIT_ROWS)
    vectors = features.bits_to_features(keys.select("o_orderkey", divisor_bits("o_orderkey").alias(features.BITS_COL)))
    sums = vectors.agg(Summarizer.sum(F.col("features")).alias("s"))
    return sums.select(F.posexplode(vector_to_array("s")).alias("coordinate", "ones"))
