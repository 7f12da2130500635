"""Label records by a score quantile.

``quantile_threshold`` returns a one-row frame; ``threshold_value`` brings that
single number to the driver so the label is a literal comparison that Catalyst
can fold and push down.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skewscope.plans.prefix import DEFAULT_ROWS_PER_RANGE, running_totals

APPROX_RELATIVE_ERROR = 0.01


def approx_quantile(df: DataFrame, col: str, p: float = 0.8,
                    relative_error: float = APPROX_RELATIVE_ERROR) -> float | None:
    """Greenwald-Khanna quantile (one pass, bounded summary per task)."""
    out = df.approxQuantile(col, [p], relative_error)
    return float(out[0]) if out else None


def _rank_targets(total: F.Column, p: float, method: str) -> tuple[F.Column, F.Column, F.Column]:
    """1-based ranks (low, high) and interpolation weight for ``method``."""
    if method == "disc":
        r = F.greatest(F.ceil(total * F.lit(p)), F.lit(1)).cast("long")
        return r, r, F.lit(0.0)
    pos = (total - F.lit(1)).cast("double") * F.lit(p)
    lo = F.floor(pos).cast("long")
    return lo + 1, F.ceil(pos).cast("long") + 1, pos - lo


def _pick(ranked: DataFrame, p: float, method: str, total: F.Column) -> DataFrame:
    lo, hi, frac = _rank_targets(total, p, method)
    first = F.col("cum_n") - F.col("n")
    picked = ranked.select(
        F.when((F.col("cum_n") >= lo) & (first < lo), F.col("value")).alias("v_lo"),
        F.when((F.col("cum_n") >= hi) & (first < hi), F.col("value")).alias("v_hi"),
        frac.alias("frac"),
    ).where(F.col("v_lo").isNotNull() | F.col("v_hi").isNotNull())
    agg = picked.agg(F.max("v_lo").alias("v_lo"), F.max("v_hi").alias("v_hi"), F.max("frac").alias("frac"))
    return agg.select((F.col("v_lo") + F.col("frac") * (F.col("v_hi") - F.col("v_lo"))).alias("threshold"))


def _values(df: DataFrame, col: str) -> DataFrame:
    return (df.select(F.col(col).cast("double").alias("value"))
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def quantile_threshold_full(df: DataFrame, col: str, p: float = 0.8, method: str = "disc",
                            rows_per_range: int = DEFAULT_ROWS_PER_RANGE, reuse: bool = True) -> DataFrame:
    """Exact quantile from value counts and a range-bounded running count over all values."""
    counts = _values(df, col).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, "value", ["n"], descending=False, rows_per_range=rows_per_range,
                            reuse=reuse)
    return _pick(ranked, p, method, F.col("total_n"))


BRACKET_ACCURACY = 10000


def quantile_threshold(df: DataFrame, col: str, p: float = 0.8, method: str = "disc",
                       rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """Exact quantile as a one-row frame with column ``threshold``.

    ``method="disc"``: smallest value whose cumulative share is >= p (SQL
    ``percentile_disc``). ``method="cont"``: linear interpolation at rank
    (n-1)p (SQL ``percentile``, pandas' default). Null values are ignored; an
    empty input gives a null threshold.

    Two passes and no global sort: pass 1 counts the rows and brackets the
    target rank with GK sketches at p -/+ 2/accuracy (each within n/accuracy
    ranks, so the bracket always holds the answer); pass 2 groups only the
    values inside the bracket, folding everything below it into one sentinel
    row, and runs the bounded running count over that small set. Should the
    bracket ever miss, the full value-count method is used.
    """
    if method not in ("disc", "cont"):
        raise ValueError(f"method must be 'disc' or 'cont', not {method!r}")
    vals = _values(df, col)
    d = 2.0 / BRACKET_ACCURACY
    probs = [max(0.0, p - d), min(1.0, p + d)]
    row = vals.agg(F.count(F.lit(1)).alias("n"),
                   F.percentile_approx("value", probs, BRACKET_ACCURACY).alias("b")).first()
    spark = df.sparkSession
    if not row["n"]:
        return spark.createDataFrame([(None,)], "threshold double")
    n, (lo, hi) = int(row["n"]), row["b"]
    sentinel = float("-inf")
    inside = (vals.where(F.col("value") <= F.lit(hi))
              .select(F.when(F.col("value") < F.lit(lo), F.lit(sentinel)).otherwise(F.col("value")).alias("value"))
              .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    # lo and hi sit within 3n/accuracy ranks of pn, so the bracket holds at most
    # ~6n/accuracy distinct values plus the sentinel.
    bound = int(6 * n / BRACKET_ACCURACY) + 3
    # A bracket beyond one range is read several times: written once, so the input is not read again.
    small = bound <= rows_per_range
    ranked = running_totals(inside, "value", ["n"], descending=False, rows_per_range=rows_per_range,
                            reuse=not small, rows_hint=bound if small else None)
    res = _pick(ranked, p, method, F.lit(n)).first()["threshold"]
    if res is None or not math.isfinite(res):  # a rank fell outside the bracket
        return quantile_threshold_full(df, col, p, method, rows_per_range)
    return spark.createDataFrame([(float(res),)], "threshold double")


def threshold_value(df: DataFrame, col: str, p: float = 0.8, method: str = "disc") -> float | None:
    """The quantile as a Python float (``method="approx"`` uses GK with error 0.01)."""
    if method == "approx":
        return approx_quantile(df, col, p)
    row = quantile_threshold(df, col, p, method).first()
    return None if row is None or row["threshold"] is None else float(row["threshold"])


def label_by_quantile(df: DataFrame, score_col: str, label_col: str = "label", p: float = 0.8,
                      method: str = "disc", inclusive: bool = True,
                      threshold: float | None = None) -> DataFrame:
    """Add an int label: 1 when score >= q (or > q with ``inclusive=False``).

    A null score compares as not above the threshold and gets 0, as in the
    reference pipeline; drop such rows beforehand with ``drop_missing``.
    """
    q = threshold if threshold is not None else threshold_value(df, score_col, p, method)
    if q is None or (isinstance(q, float) and math.isnan(q)):
        return df.withColumn(label_col, F.lit(0))
    score = F.col(score_col).cast("double")
    hit = score >= F.lit(q) if inclusive else score > F.lit(q)
    return df.withColumn(label_col, F.when(hit, F.lit(1)).otherwise(F.lit(0)))


def label_shares(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Normalised value counts: (label, n, share), share = n / total rows."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    # One row per label value: a single-partition window over it is tiny.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select(label_col, "n", (F.col("n") / total).alias("share"))
