"""Group split, leakage, row cap, split summary and resampling queries (rows 18-22, 25, 29-31, 61)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skewscope.catalog._registry import register, rounded
from skewscope.catalog.fixtures import labelled_lineitem, labelled_orders
from skewscope.operators import balance, resample, splits
from skewscope.sinks.text import split_stats_lines
from skewscope.sources.tables import table

Q80 = "(SELECT quantile_disc(l_extendedprice, 0.8) FROM lineitem)"
OQ80 = "(SELECT quantile_disc(o_totalprice, 0.8) FROM orders)"
MD5_BUCKET = "(('0x' || substr(md5({k}), 1, 8))::BIGINT % 100)"
U = "(('0x' || substr(md5({k} || ':42:{p}'), 1, 13))::BIGINT / 4503599627370496.0)"
SPLIT = "CASE WHEN {b} < 80 THEN 'train' WHEN {b} < 90 THEN 'valid' ELSE 'test' END"
LI_KEY = "CAST(l_orderkey AS VARCHAR)"
LI_SPLIT_SQL = f"""li AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice,
         CAST(CASE WHEN l_extendedprice >= {Q80} THEN 1 ELSE 0 END AS INTEGER) AS label,
         {MD5_BUCKET.format(k=LI_KEY)} AS bucket FROM lineitem),
sp AS (SELECT *, {SPLIT.format(b='bucket')} AS split FROM li)"""
ORD_SQL = f"""o AS (SELECT o_orderkey, o_totalprice,
       CAST(CASE WHEN o_totalprice >= {OQ80} THEN 1 ELSE 0 END AS INTEGER) AS label,
       {U.format(k='CAST(o_orderkey AS VARCHAR)', p='under')} AS u_under,
       {U.format(k='CAST(o_orderkey AS VARCHAR)', p='over')} AS u_over,
       {U.format(k='CAST(o_orderkey AS VARCHAR)', p='cap')} AS u_cap,
       {U.format(k='CAST(o_orderkey AS VARCHAR)', p='sample')} AS u_sample FROM orders),
cnt AS (SELECT sum(label) AS n_pos, sum(1 - label) AS n_neg FROM o)"""


def split_lineitem(spark, sf):
    li = labelled_lineitem(spark, sf).withColumn("key", F.col("l_orderkey").cast("string"))
    return splits.assign_split(li, "key", method="md5")


@register("group_key_fallback", """
SELECT l_orderkey, l_linenumber,
       coalesce(nullif(CASE WHEN l_returnflag = 'N' THEN '' ELSE CAST(l_orderkey AS VARCHAR) END, ''),
                CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)) AS group_key
FROM lineitem""")
def group_key_fallback(spark, sf):
    li = table(spark, sf, "lineitem")
    li = li.select("l_orderkey", "l_linenumber",
                   F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_orderkey").cast("string")).alias("k"),
                   F.concat_ws("-", "l_orderkey", "l_linenumber").alias("record_id"))
    return splits.group_key(li, "k", "record_id").select("l_orderkey", "l_linenumber", "group_key")


@register("hash_bucket", f"""
SELECT l_orderkey, l_linenumber, {MD5_BUCKET.format(k=LI_KEY)} AS bucket FROM lineitem""")
def hash_bucket(spark, sf):
    from skewscope.functions.hashing import hash_bucket as hb
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", hb(F.col("l_orderkey").cast("string"), 100, "md5").alias("bucket"))


@register("hash_bucket_xxhash64", """
SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS keys, true AS in_range, 0::BIGINT AS split_keys FROM lineitem""")
def hash_bucket_xxhash64(spark, sf):
    """Other engines lack this hash: the check is on its properties (range, one bucket per key)."""
    from skewscope.functions.hashing import hash_bucket as hb
    li = table(spark, sf, "lineitem")
    b = li.select("l_orderkey", hb(F.col("l_orderkey").cast("string"), 100).alias("bucket"))
    per = b.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    return per.agg(F.sum("n").alias("rows"), F.count("*").alias("keys"),
                   ((F.min("lo") >= 0) & (F.max("hi") < 100)).alias("in_range"),
                   F.sum((F.col("lo") != F.col("hi")).cast("long")).alias("split_keys"))


@register("group_split", f"""
WITH {LI_SPLIT_SQL}
SELECT l_orderkey, l_linenumber, label, bucket, split FROM sp""")
def group_split(spark, sf):
    return split_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "label", "bucket", "split")


@register("split_leakage", f"""
WITH {LI_SPLIT_SQL},
g AS (SELECT l_orderkey, min(split) AS a, max(split) AS b FROM sp GROUP BY l_orderkey)
SELECT count(*) AS groups, CAST(sum(CASE WHEN a <> b THEN 1 ELSE 0 END) AS BIGINT) AS leaking_groups FROM g""")
def split_leakage(spark, sf):
    return splits.leakage_summary(split_lineitem(spark, sf), "l_orderkey")


SUMMARY_SQL = f"""
WITH {LI_SPLIT_SQL},
a AS (SELECT split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positive,
             CAST(sum(1 - label) AS BIGINT) AS negative FROM sp GROUP BY split),
names AS (SELECT * FROM (VALUES ('train', 0), ('valid', 1), ('test', 2)) t(split, split_order)),
ss AS (SELECT names.split, split_order, CAST(coalesce(rows, 0) AS BIGINT) AS rows,
              CAST(coalesce(positive, 0) AS BIGINT) AS positive, CAST(coalesce(negative, 0) AS BIGINT) AS negative,
              CASE WHEN coalesce(rows, 0) > 0 THEN positive / rows ELSE 0 END AS pf,
              CASE WHEN coalesce(rows, 0) > 0 THEN negative / rows ELSE 0 END AS nf
       FROM names LEFT JOIN a ON names.split = a.split)"""


@register("split_summary", SUMMARY_SQL + """
SELECT split, split_order, rows, positive, negative,
       round(pf, 9) AS positive_fraction, round(nf, 9) AS negative_fraction FROM ss""")
def split_summary(spark, sf):
    return rounded(balance.split_summary(split_lineitem(spark, sf), "split", "label"))


@register("split_stats_text", SUMMARY_SQL + """
SELECT split_order, printf('%s\t%d\t%d\t%d\t%.6f\t%.6f', split, rows, positive, negative, pf, nf) AS line
FROM ss""")
def split_stats_text(spark, sf):
    return split_stats_lines(balance.split_summary(split_lineitem(spark, sf), "split", "label"))


@register("cap_rows", f"""
WITH {LI_SPLIT_SQL},
tr AS (SELECT * FROM sp WHERE split = 'train'),
k AS (SELECT count(*) AS n FROM tr)
SELECT l_orderkey, l_linenumber, label FROM tr, k
WHERE k.n <= 30000
   OR {U.format(k="CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", p='cap')} < 30000.0 / k.n""")
def cap_rows(spark, sf):
    tr = splits.split_frames(split_lineitem(spark, sf))["train"]
    tr = tr.withColumn("row_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return splits.cap_rows(tr, 30000, seed=42, method="hash", key_col="row_key").select(
        "l_orderkey", "l_linenumber", "label")


@register("class_weights", f"""
WITH {ORD_SQL}
SELECT o_orderkey, label,
       round(CASE WHEN label = 1 THEN (SELECT CASE WHEN n_pos > 0 THEN n_neg / n_pos ELSE 1.0 END FROM cnt)
                  ELSE 1.0 END, 9) AS weight
FROM o""")
def class_weights(spark, sf):
    o = labelled_orders(spark, sf)
    return rounded(resample.class_weights(o, "label").select("o_orderkey", "label", "weight"))


@register("undersample", f"""
WITH {ORD_SQL}
SELECT o_orderkey, label FROM o, cnt
WHERE label = 1 OR u_under < n_pos / n_neg""")
def undersample(spark, sf):
    o = labelled_orders(spark, sf)
    return resample.undersample(o, "label", seed=42, method="hash", key_col="o_orderkey").select("o_orderkey", "label")


@register("oversample", f"""
WITH {ORD_SQL},
k AS (SELECT o_orderkey, label,
             CAST(CASE WHEN label = 1 THEN floor(n_neg / n_pos + u_over) ELSE 1 END AS BIGINT) AS copies FROM o, cnt)
SELECT o_orderkey, label FROM k, LATERAL (SELECT unnest(generate_series(1, copies))) g WHERE copies >= 1""")
def oversample(spark, sf):
    o = labelled_orders(spark, sf)
    return resample.oversample(o, "label", seed=42, method="hash", key_col="o_orderkey").select("o_orderkey", "label")


@register("report_split_table", SUMMARY_SQL + """
SELECT upper(substr(split, 1, 1)) || substr(split, 2) AS split, rows, positive, negative,
       round(pf, 9) AS positive_fraction, split_order FROM ss""")
def report_split_table(spark, sf):
    from skewscope.operators import report
    return rounded(report.report_split_table(balance.split_summary(split_lineitem(spark, sf), "split", "label")))


@register("fraction_sample", f"""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE {U.format(k="CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)", p='sample')} < 0.25""")
def fraction_sample(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("row_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return splits.fraction_sample(li, 0.25, 42, "hash", "row_key").select("l_orderkey", "l_linenumber")


# A cap of a third of the orders, then a second sampler: their draws must be independent.
CAPPED_SQL = f"""WITH {ORD_SQL},
k AS (SELECT count(*) AS n, count(*) // 3 AS cap FROM o),
c AS (SELECT o.* FROM o, k WHERE u_cap < cap * 1e0 / n),
ccnt AS (SELECT sum(label) AS n_pos, sum(1 - label) AS n_neg, count(*) AS n FROM c)"""


def _capped_orders(spark, sf):
    o = labelled_orders(spark, sf)
    return splits.cap_rows(o, o.count() // 3, key_col="o_orderkey")


@register("cap_then_undersample", CAPPED_SQL + """
SELECT o_orderkey, label FROM c, ccnt WHERE label = 1 OR u_under < n_pos * 1e0 / n_neg""")
def cap_then_undersample(spark, sf):
    return resample.undersample(_capped_orders(spark, sf), "label", key_col="o_orderkey").select("o_orderkey", "label")


@register("cap_then_oversample", CAPPED_SQL + """,
r AS (SELECT o_orderkey, label,
             CAST(CASE WHEN label = 1 THEN floor(n_neg * 1e0 / n_pos + u_over) ELSE 1 END AS BIGINT) AS copies FROM c, ccnt)
SELECT o_orderkey, label FROM r, LATERAL (SELECT unnest(generate_series(1, copies))) g WHERE copies >= 1""")
def cap_then_oversample(spark, sf):
    return resample.oversample(_capped_orders(spark, sf), "label", key_col="o_orderkey").select("o_orderkey", "label")


@register("cap_then_fraction", CAPPED_SQL + """
SELECT o_orderkey, label FROM c WHERE u_sample < 0.5""")
def cap_then_fraction(spark, sf):
    return splits.fraction_sample(_capped_orders(spark, sf), 0.5, key_col="o_orderkey").select("o_orderkey", "label")
