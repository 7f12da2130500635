"""Samples of exact size, samples of frames whose keys repeat, and the scaling study over them (rows 22, 30-32, 52)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skewscope.catalog._registry import register
from skewscope.catalog.exact import ROWS, TREE, TREES, banded_splits
from skewscope.catalog.fixtures import labelled_orders
from skewscope.catalog.selection import _record_sql
from skewscope.catalog.splitting import LI_SPLIT_SQL, ORD_SQL, U, split_lineitem
from skewscope.operators import exact_sample, experiments, ordinals, resample, splits
from skewscope.sources.tables import table

_ROW_KEY = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
#: Rows of one key in the order of this text's md5; rows with equal texts are equal.
_CONTENT = ("l_orderkey", "l_linenumber", "l_partkey")
_NUMBERED = """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey))) AS ordinal
FROM lineitem"""


def _third(frame):
    return frame.count() // 3


@register("cap_exact", f"""
WITH {LI_SPLIT_SQL},
tr AS (SELECT *, {U.format(k=_ROW_KEY, p='cap')} AS u FROM sp WHERE split = 'train'),
r AS (SELECT *, row_number() OVER (ORDER BY u, l_orderkey, l_linenumber) AS r, count(*) OVER () AS n FROM tr)
SELECT l_orderkey, l_linenumber, label FROM r WHERE r <= n // 3""")
def cap_exact(spark, sf):
    """A cap of a third of the training rows keeps just that many."""
    tr = splits.split_frames(split_lineitem(spark, sf))["train"].select("l_orderkey", "l_linenumber", "label")
    tr = tr.withColumn("row_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return splits.cap_rows(tr, _third(tr), key_col="row_key", exact=True).select("l_orderkey", "l_linenumber", "label")


@register("undersample_exact", f"""
WITH {ORD_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u_under) AS r FROM o)
SELECT o_orderkey, label FROM r, cnt WHERE r <= least(n_pos, n_neg)""")
def undersample_exact(spark, sf):
    o = labelled_orders(spark, sf).select("o_orderkey", "label")
    return resample.undersample(o, "label", key_col="o_orderkey", exact=True)


@register("oversample_exact", f"""
WITH {ORD_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY u_over) AS r FROM o),
k AS (SELECT o_orderkey, label, CASE WHEN label = 1 THEN CAST(n_neg AS BIGINT) // CAST(n_pos AS BIGINT)
             + CASE WHEN r <= CAST(n_neg AS BIGINT) % CAST(n_pos AS BIGINT) THEN 1 ELSE 0 END ELSE 1 END AS copies FROM r, cnt)
SELECT o_orderkey, label FROM k, LATERAL (SELECT unnest(generate_series(1, copies))) g""")
def oversample_exact(spark, sf):
    o = labelled_orders(spark, sf).select("o_orderkey", "label")
    return resample.oversample(o, "label", key_col="o_orderkey", exact=True)


def _flags(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", *_CONTENT)


def _content():
    return F.md5(F.concat_ws("|", *_CONTENT))


@register("number_within_key", _NUMBERED)
def number_within_key(spark, sf):
    """Rows numbered within l_returnflag: three keys with a third of all rows each."""
    return ordinals.number_within_key(_flags(spark, sf), "l_returnflag", _content())


@register("sample_repeated_keys", f"""
WITH o AS ({_NUMBERED}),
k AS (SELECT *, CASE WHEN ordinal = 1 THEN l_returnflag ELSE l_returnflag || '#' || CAST(ordinal AS VARCHAR) END AS draw_key FROM o)
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM k WHERE {U.format(k='draw_key', p='sample')} < 0.25""")
def sample_repeated_keys(spark, sf):
    """A quarter of the rows of a frame that has three keys only: rows of one key draw independently."""
    keyed = ordinals.with_draw_key(_flags(spark, sf), "l_returnflag", content=_content())
    return splits.fraction_sample(keyed, 0.25, 42, "hash", "draw_key").drop("draw_key")


@register("exact_sample_tied", """
WITH o AS (SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)) AS h,
                  """ + U.format(k="l_returnflag", p="sample") + """ AS u FROM lineitem),
r AS (SELECT *, row_number() OVER (ORDER BY u, h) AS r, count(*) OVER () AS n FROM o)
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM r WHERE r <= 2 * n // 5""")
def exact_sample_tied(spark, sf):
    """Two fifths of the rows by three draws: the size is exact although all rows of a key tie."""
    flags = _flags(spark, sf)
    return exact_sample.exact_sample(flags, 2 * flags.count() // 5, "l_returnflag", content=_content())


@register("nested_samples", """
SELECT CAST(n * f // 10 AS BIGINT) AS size, CAST(n * f // 10 AS BIGINT) AS n_rows, 0::BIGINT AS outside_next
FROM (SELECT count(*) AS n FROM orders), (SELECT unnest([1, 3, 7]) AS f)""")
def nested_samples(spark, sf):
    """Samples of three sizes: their rows, and how many rows of each the next larger one lacks."""
    keys = table(spark, sf, "orders").select("o_orderkey")
    n = keys.count()
    frames = [exact_sample.exact_sample(keys, n * f // 10, "o_orderkey", purpose="scale") for f in (1, 3, 7)] + [keys]
    out = None
    for f, small, large in zip((1, 3, 7), frames, frames[1:]):
        met = small.join(large.withColumn("found", F.lit(1)), "o_orderkey", "left")
        one = met.agg(F.lit(n * f // 10).cast("long").alias("size"), F.count(F.lit(1)).alias("n_rows"),
                      (F.count(F.lit(1)) - F.count("found")).alias("outside_next"))
        out = one if out is None else out.unionByName(one)
    return out.select("size", "n_rows", "outside_next")


FRACTIONS = (0.1, 0.5, 1.0)
_SCALING = f"""WITH RECURSIVE {ROWS},
z AS (SELECT CAST(floor((n1 + n0) * f) AS BIGINT) AS size FROM n, (SELECT unnest([{', '.join(f'{f}e0' for f in FRACTIONS)}]) AS f)),
st AS (SELECT z.size AS strategy, band, sum(1 - y) * 1e0 AS n0, sum(y) * (SELECT n0 * 1e0 / n1 FROM n) AS n1
       FROM (SELECT *, row_number() OVER (ORDER BY u_scale) AS r FROM tr) JOIN z ON r <= z.size GROUP BY z.size, band),
{TREE},
fit AS (SELECT 'logistic_regression_weighted' AS model, strategy AS size, band, n1 / (n0 + n1) AS p1 FROM st
        UNION ALL SELECT 'random_forest_weighted', strategy, band, p1 FROM leaves),
ms AS (SELECT f.model, f.size, lb.y, f.p1, lb.split FROM lb JOIN fit f USING (band)),
{_record_sql("split = 'valid'", groups="model, size")}
SELECT model, size, size AS train_rows, round(PR_AUC, 4) AS pr_auc FROM a"""


@register("scaling_records", _SCALING)
def scaling_records(spark, sf):
    """The scaling study at exact sizes, with the PR-AUC of every run."""
    s = banded_splits(spark, sf)
    n = s["train"].count()
    out = experiments.scaling_study(s["train"], s["valid"], [int(n * f) for f in FRACTIONS], "label", "features", key_col="key",
                                    rf_params=TREES, with_size=True)
    return out.select("model", "size", "train_rows", "pr_auc")
