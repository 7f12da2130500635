"""Labelling and class-balance queries (inventory rows 14-17, 23-28)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skewscope.catalog._registry import register, rounded
from skewscope.catalog.fixtures import P, labelled_lineitem
from skewscope.operators import balance, labels
from skewscope.sources.tables import table

Q80 = "(SELECT quantile_disc(l_extendedprice, 0.8) FROM lineitem)"


@register("quantile_threshold_exact", f"""
SELECT quantile_disc(l_extendedprice, 0.8) AS threshold_disc,
       round(quantile_cont(l_extendedprice, 0.8), 9) AS threshold_cont
FROM lineitem""")
def quantile_threshold_exact(spark, sf):
    li = table(spark, sf, "lineitem")
    disc = labels.quantile_threshold(li, "l_extendedprice", P, "disc").withColumnRenamed("threshold", "threshold_disc")
    cont = labels.threshold_value(li, "l_extendedprice", P, "cont")
    return rounded(disc.select("threshold_disc", F.lit(cont).cast("double").alias("threshold_cont")))


@register("quantile_threshold_approx", "SELECT count(*) AS rows, true AS rank_within_0_01 FROM lineitem")
def quantile_threshold_approx(spark, sf):
    """The approximate value itself is engine-specific: the check is its rank error, 0.01 n at most."""
    li = table(spark, sf, "lineitem")
    q = F.lit(labels.approx_quantile(li, "l_extendedprice", P))
    price = F.col("l_extendedprice").cast("double")
    n, target = F.count("*"), F.count("*") * F.lit(P)
    below, upto = F.sum((price < q).cast("long")), F.sum((price <= q).cast("long"))
    ok = (below <= target + n * 0.01 + 1) & (upto >= target - n * 0.01 - 1)
    return li.agg(n.alias("rows"), ok.alias("rank_within_0_01"))


@register("label_by_quantile", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CAST(CASE WHEN l_extendedprice >= {Q80} THEN 1 ELSE 0 END AS INTEGER) AS label
FROM lineitem""")
def label_by_quantile(spark, sf):
    return labelled_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_extendedprice", "label")


@register("label_by_quantile_strict", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice,
       CAST(CASE WHEN l_extendedprice > {Q80} THEN 1 ELSE 0 END AS INTEGER) AS label
FROM lineitem""")
def label_by_quantile_strict(spark, sf):
    return labelled_lineitem(spark, sf, inclusive=False).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "label")


@register("label_shares", f"""
SELECT label, n, round(n / sum(n) OVER (), 9) AS share
FROM (SELECT CAST(CASE WHEN l_extendedprice > {Q80} THEN 1 ELSE 0 END AS INTEGER) AS label,
             count(*) AS n
      FROM lineitem GROUP BY 1)""")
def label_shares(spark, sf):
    return rounded(labels.label_shares(labelled_lineitem(spark, sf, inclusive=False), "label"))


@register("class_balance", f"""
SELECT CAST(CASE WHEN l_extendedprice >= {Q80} THEN 1 ELSE 0 END AS INTEGER) AS label,
       count(*) AS count
FROM lineitem GROUP BY 1 ORDER BY 1""")
def class_balance(spark, sf):
    return balance.class_balance(labelled_lineitem(spark, sf), "label")


@register("overall_balance", f"""
WITH s AS (SELECT CASE WHEN l_extendedprice >= {Q80} THEN 1 ELSE 0 END AS label FROM lineitem)
SELECT count(*) AS total_rows,
       CAST(sum(label) AS BIGINT) AS positive,
       CAST(sum(1 - label) AS BIGINT) AS negative,
       round(sum(label) / count(*), 9) AS positive_fraction,
       round(sum(1 - label) / count(*), 9) AS negative_fraction,
       'numeric_columns' AS feature_mode
FROM s""")
def overall_balance(spark, sf):
    return rounded(balance.overall_balance(labelled_lineitem(spark, sf), "label", "numeric_columns"))


@register("pos_weight", f"""
WITH s AS (SELECT CASE WHEN l_extendedprice >= {Q80} THEN 1 ELSE 0 END AS label FROM lineitem)
SELECT CAST(sum(label) AS BIGINT) AS n_pos, CAST(sum(1 - label) AS BIGINT) AS n_neg,
       round(CASE WHEN sum(label) > 0 THEN sum(1 - label) / sum(label) ELSE 1.0 END, 9) AS pos_weight
FROM s""")
def pos_weight(spark, sf):
    return rounded(balance.pos_weight(labelled_lineitem(spark, sf), "label"))


@register("imbalance_ratio", f"""
WITH s AS (SELECT CASE WHEN l_extendedprice >= {Q80} THEN 1 ELSE 0 END AS label FROM lineitem),
b AS (SELECT count(*) AS total_rows, CAST(sum(label) AS BIGINT) AS positive,
             CAST(sum(1 - label) AS BIGINT) AS negative, sum(label) / count(*) AS positive_fraction FROM s)
SELECT total_rows, positive, negative, round(positive_fraction, 9) AS positive_fraction,
       round((1 - positive_fraction) / positive_fraction, 9) AS imbalance_ratio
FROM b""")
def imbalance_ratio(spark, sf):
    return rounded(balance.imbalance_ratio(balance.overall_balance(labelled_lineitem(spark, sf), "label")))
