"""Threshold metrics as column arithmetic over confusion counts.

All arithmetic runs in double: (tp+fp)(tp+fn)(tn+fp)(tn+fn) exceeds int64 near
1e5 rows per cell and would raise under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Floor of the MCC denominator product used for metrics at a fixed threshold.
MCC_EPS = 1e-12


def _d(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """num / den, or 0.0 when den is 0."""
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def precision(tp, fp) -> Column:
    return safe_div(_d(tp), _d(tp) + _d(fp))


def recall(tp, fn) -> Column:
    return safe_div(_d(tp), _d(tp) + _d(fn))


def specificity(tn, fp) -> Column:
    return safe_div(_d(tn), _d(tn) + _d(fp))


def f1(prec: Column, rec: Column) -> Column:
    return safe_div(F.lit(2.0) * prec * rec, prec + rec)


def balanced_accuracy(rec: Column, tnr: Column) -> Column:
    return F.lit(0.5) * (rec + tnr)


def mcc(tp, fp, tn, fn, floor_eps: bool = True) -> Column:
    """Matthews correlation.

    ``floor_eps=True``: denominator sqrt(max(prod, 1e-12)) (metrics at a given
    threshold); ``False``: 0.0 when the product is 0 (threshold search).
    Either way a zero product gives 0.0, because the numerator is then 0.
    """
    tp, fp, tn, fn = _d(tp), _d(fp), _d(tn), _d(fn)
    prod = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    num = tp * tn - fp * fn
    if floor_eps:
        return num / F.sqrt(F.greatest(prod, F.lit(MCC_EPS)))
    return F.when(prod == 0, F.lit(0.0)).otherwise(num / F.sqrt(prod))


def rate_columns(tp="TP", fp="FP", tn="TN", fn="FN") -> list[Column]:
    """precision, recall, f1, balanced_accuracy, MCC from four count columns."""
    p = precision(tp, fp)
    r = recall(tp, fn)
    return [
        p.alias("precision"),
        r.alias("recall"),
        f1(p, r).alias("f1"),
        balanced_accuracy(r, specificity(tn, fp)).alias("balanced_accuracy"),
        mcc(tp, fp, tn, fn).alias("MCC"),
    ]
