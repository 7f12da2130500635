"""The flagship query used by ``entry``: label, split, weight, LR, threshold, test metrics."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewscope.catalog._registry import register, rounded
from skewscope.catalog.fixtures import LINEITEM_FEATURES
from skewscope.catalog.models import COUNTS_SQL, record_check, split_sql
from skewscope.plans import study
from skewscope.sources.tables import table


def lineitem_model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"),
        F.col("l_orderkey").cast("string").alias("group"), "l_extendedprice",
        "l_quantity", "l_discount", "l_tax", F.col("l_linenumber").cast("double").alias("l_linenumber"),
        (F.col("l_returnflag") == "R").cast("double").alias("is_returned"),
        (F.col("l_linestatus") == "O").cast("double").alias("is_open"))
    return VectorAssembler(inputCols=LINEITEM_FEATURES, outputCol="features").transform(li)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = study.prepare(lineitem_model_frame(spark, sf_dir), "l_extendedprice", "group", "key")
    return rounded(study.weighted_lr_test_record(data))


@register("flagship_weighted_lr", f"""WITH q AS (SELECT quantile_disc(l_extendedprice, 0.8) AS t FROM lineitem),
d AS (SELECT CAST(CASE WHEN l_extendedprice >= (SELECT t FROM q) THEN 1 ELSE 0 END AS INTEGER) AS label,
             {split_sql('CAST(l_orderkey AS VARCHAR)')} AS split
      FROM lineitem WHERE l_extendedprice IS NOT NULL)
SELECT 'logistic_regression_weighted' AS model, {COUNTS_SQL} FROM d WHERE split = 'test'""")
def flagship_weighted_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship on the md5 split, reduced to what SQL can restate."""
    data = study.prepare(lineitem_model_frame(spark, sf_dir), "l_extendedprice", "group", "key", hash_method="md5")
    return record_check(study.weighted_lr_test_record(data), "model")
