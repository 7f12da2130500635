"""Ranking metrics from one distributed threshold table.

``threshold_table`` collapses rows to one per distinct score (a partial + final
hash aggregate, so a score shared by a third of the rows is still one row after
the map side), then adds running true/false positive counts in descending score
order with the range-bounded prefix sum of ``skewscope.plans.prefix``. PR-AUC,
ROC-AUC, PR/ROC points and the best threshold are all aggregates or projections
of that table; only one-row results ever leave the cluster.

Ties: all rows sharing a score form one step, so results are deterministic and,
for distinct scores, equal the row-wise step-wise AP and trapezoid ROC. ROC with
ties is the Mann-Whitney statistic with half credit for ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewscope.functions import rates
from skewscope.plans.prefix import DEFAULT_ROWS_PER_RANGE, running_totals

POLICIES = ("mcc", "youden")
VALUE_DIGITS = 9


def score_counts(df: DataFrame, label_col: str, score_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per (group, score): pos = rows with label 1, n = rows. Null/NaN scores and null labels are skipped."""
    s = F.col(score_col).cast("double")
    return (df.where(s.isNotNull() & ~F.isnan(s) & F.col(label_col).isNotNull())
            .groupBy(*group_cols, F.col(score_col).cast("double").alias("threshold"))
            .agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                 F.count(F.lit(1)).alias("n")))


def threshold_table(df: DataFrame, label_col: str = "label", score_col: str = "score",
                    group_cols: Sequence[str] = (), rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
                    reuse: bool = True) -> DataFrame:
    """Per (group, distinct score): pos, n, tp, fp, fn, tn, total_pos, total_n.

    tp/fp count rows with score >= threshold, i.e. the confusion counts of the
    rule ``score >= threshold``.
    """
    counts = score_counts(df, label_col, score_col, group_cols)
    run = running_totals(counts, "threshold", ["pos", "n"], group_cols, descending=True,
                         rows_per_range=rows_per_range, reuse=reuse)
    tp, cn = F.col("cum_pos"), F.col("cum_n")
    return run.select(
        *group_cols, "threshold", "pos", "n",
        tp.alias("tp"), (cn - tp).alias("fp"),
        (F.col("total_pos") - tp).alias("fn"),
        (F.col("total_n") - F.col("total_pos") - (cn - tp)).alias("tn"),
        "total_pos", "total_n")


def _neg_total() -> Column:
    return F.col("total_n") - F.col("total_pos")


def pr_points(table: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group, threshold, precision, recall); recall is 0 when there are no positives."""
    d = lambda c: F.col(c).cast("double")
    return table.select(
        *group_cols, "threshold",
        (d("tp") / (d("tp") + d("fp"))).alias("precision"),
        rates.safe_div(d("tp"), d("total_pos")).alias("recall"))


def roc_points(table: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group, threshold, fpr, tpr) with the (0,0) and (1,1) ends (threshold null).

    P and N are floored at 1, so a one-class input still yields finite points.
    """
    d = lambda c: F.col(c).cast("double")
    pts = table.select(
        *group_cols, "threshold",
        (d("fp") / F.greatest(_neg_total(), F.lit(1)).cast("double")).alias("fpr"),
        (d("tp") / F.greatest(F.col("total_pos"), F.lit(1)).cast("double")).alias("tpr"))
    if group_cols:
        groups = table.select(*group_cols).distinct()
    else:
        groups = table.sparkSession.range(1).select()
    # Two fixed end points per group, produced by exploding a literal pair.
    corner = F.explode(F.array(F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")),
                               F.struct(F.lit(1.0).alias("fpr"), F.lit(1.0).alias("tpr"))))
    ends = groups.select(*group_cols, corner.alias("e")).select(
        *group_cols, F.lit(None).cast("double").alias("threshold"), F.col("e.fpr").alias("fpr"),
        F.col("e.tpr").alias("tpr"))
    return pts.unionByName(ends)


def curve_points(table: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group, threshold, precision, recall, fpr, tpr) in one projection of the table."""
    d = lambda c: F.col(c).cast("double")
    return table.select(
        *group_cols, "threshold",
        (d("tp") / (d("tp") + d("fp"))).alias("precision"),
        rates.safe_div(d("tp"), d("total_pos")).alias("recall"),
        (d("fp") / F.greatest(_neg_total(), F.lit(1)).cast("double")).alias("fpr"),
        (d("tp") / F.greatest(F.col("total_pos"), F.lit(1)).cast("double")).alias("tpr"))


def _area_terms() -> tuple[Column, Column]:
    d = lambda c: F.col(c).cast("double")
    p, neg = d("total_pos"), _neg_total().cast("double")
    # Guarded inside the term: under ANSI a division by zero raises even when
    # an outer CASE would discard the value.
    ap_term = rates.safe_div((d("tp") / (d("tp") + d("fp"))) * d("pos"), p)
    roc_term = rates.safe_div((d("n") - d("pos")) * (F.lit(2.0) * d("tp") - d("pos")), F.lit(2.0) * p * neg)
    return ap_term, roc_term


def area_aggregates() -> list[Column]:
    """Aggregate expressions giving PR_AUC and ROC_AUC over a threshold table."""
    ap_term, roc_term = _area_terms()
    has_pos = F.max("total_pos") > 0
    has_both = has_pos & (F.max(_neg_total()) > 0)
    return [
        F.coalesce(F.when(has_pos, F.sum(ap_term)), F.lit(0.0)).alias("PR_AUC"),
        F.coalesce(F.when(has_both, F.sum(roc_term)), F.lit(0.0)).alias("ROC_AUC"),
    ]


def areas(table: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group, PR_AUC, ROC_AUC). Step-wise AP; trapezoid ROC; 0.0 when a class is absent."""
    return table.groupBy(*group_cols).agg(*area_aggregates())


def _search_metrics(policy: str) -> tuple[Column, list[Column]]:
    """Objective and the five metrics at each threshold, with P and N floored at 1."""
    d = lambda c: F.col(c).cast("double")
    p = F.greatest(F.col("total_pos"), F.lit(1)).cast("double")
    n = F.greatest(_neg_total(), F.lit(1)).cast("double")
    tp, fp = d("tp"), d("fp")
    fn, tn = p - tp, n - fp
    prec = rates.safe_div(tp, tp + fp)
    rec = tp / p
    tnr = rates.safe_div(tn, tn + fp)
    mcc = rates.mcc(tp, fp, tn, fn, floor_eps=False)
    metrics = [prec.alias("opt_precision"), rec.alias("opt_recall"), rates.f1(prec, rec).alias("opt_f1"),
               rates.balanced_accuracy(rec, tnr).alias("opt_balanced_accuracy"), mcc.alias("opt_MCC")]
    value = rec + tnr - F.lit(1.0) if policy == "youden" else mcc
    return value, metrics


def best_threshold_aggregates(policy: str = "mcc") -> list[Column]:
    """Aggregates choosing the threshold that maximises MCC (or Youden's J).

    Highest objective wins; among equal objectives (rounded to 9 digits) the
    highest score wins. Only objectives above -1 qualify; without any the
    threshold is 0.5 and all five metrics 0.0. Any policy other than "youden"
    means MCC.
    """
    policy = "youden" if policy == "youden" else "mcc"
    value, metrics = _search_metrics(policy)
    names = ["opt_precision", "opt_recall", "opt_f1", "opt_balanced_accuracy", "opt_MCC"]
    v = F.round(value, VALUE_DIGITS)
    best = F.max(F.when(v > F.lit(-1.0), F.struct(v.alias("v"), F.col("threshold").alias("t"), *metrics)))
    return [
        F.lit(policy).alias("opt_threshold_policy"),
        F.coalesce(best["t"], F.lit(0.5)).alias("opt_threshold"),
        *[F.coalesce(best[m], F.lit(0.0)).alias(m) for m in names],
        F.coalesce(best["v"], F.lit(0.0)).alias("opt_value"),
    ]


def best_threshold(table: DataFrame, policy: str = "mcc", group_cols: Sequence[str] = ()) -> DataFrame:
    return table.groupBy(*group_cols).agg(*best_threshold_aggregates(policy))


def confusion_aggregates(threshold: float | Column | str = 0.5) -> list[Column]:
    """TP, FP, TN, FN of ``score >= threshold`` from a threshold table."""
    t = F.col(threshold) if isinstance(threshold, str) else (
        threshold if isinstance(threshold, Column) else F.lit(float(threshold)))
    hit = F.col("threshold") >= t
    tp = F.coalesce(F.sum(F.when(hit, F.col("pos")).otherwise(0)), F.lit(0)).cast("long")
    pred = F.coalesce(F.sum(F.when(hit, F.col("n")).otherwise(0)), F.lit(0)).cast("long")
    p = F.coalesce(F.max("total_pos"), F.lit(0)).cast("long")
    nt = F.coalesce(F.max("total_n"), F.lit(0)).cast("long")
    return [tp.alias("TP"), (pred - tp).alias("FP"), (nt - p - (pred - tp)).alias("TN"), (p - tp).alias("FN")]
