"""First-order conditions of a logistic regression: the gradient of its loss by coordinate.

At the optimum of an unregularised fit the weighted residuals are orthogonal to every feature and sum to zero. All
coordinates come from one aggregate of vector sums (MLlib's ``Summarizer``, merged in a tree), so the cost is one pass and
the result has one row per feature, however many rows were used.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.functions.scoring import positive_probability

INTERCEPT = -1


def lr_gradient(fitted, df: DataFrame, features_col: str = "features", label_col: str = "label",
                weight_col: str | None = None) -> DataFrame:
    """(coordinate, gradient, scale, relative) of the weighted log loss on ``df``; the intercept is coordinate -1.

    gradient_j = sum w (p1 - y) x_j, scale_j = sum w |x_j|, relative = |gradient| / scale (0 where a feature is all zeros).
    """
    w = (F.col(weight_col) if weight_col else F.lit(1.0)).cast("double")
    p1 = positive_probability("probability")
    rows = fitted.transform(df).select(F.col(features_col).alias("x"), w.alias("w"), (w * (p1 - F.col(label_col))).alias("r"))
    # The Summarizer takes weights above zero only: w + r is (r lies between -w and w).
    sums = rows.agg(Summarizer.sum(F.col("x"), F.col("w") + F.col("r")).alias("moved"), Summarizer.sum(F.col("x"), F.col("w")).alias("still"),
                    Summarizer.normL1(F.col("x"), F.col("w")).alias("scale"), F.sum("r").alias("r"), F.sum("w").alias("w"))
    parts = F.arrays_zip(vector_to_array("moved").alias("moved"), vector_to_array("still").alias("still"),
                         vector_to_array("scale").alias("scale"))
    each = sums.select("r", "w", F.posexplode(parts).alias("coordinate", "part")).select(
        "coordinate", (F.col("part.moved") - F.col("part.still")).alias("gradient"), F.col("part.scale").alias("scale"))
    own = sums.select(F.lit(INTERCEPT).alias("coordinate"), F.col("r").alias("gradient"), F.col("w").alias("scale"))
    both = own.unionByName(each)
    return both.withColumn("relative", F.when(F.col("scale") > 0, F.abs("gradient") / F.col("scale")).otherwise(0.0))


def log_loss(fitted, df: DataFrame, label_col: str = "label", weight_col: str | None = None) -> float:
    """The weighted mean log loss, for comparison between fits."""
    w = F.col(weight_col) if weight_col else F.lit(1.0)
    p1 = F.greatest(F.least(positive_probability("probability"), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -F.when(F.col(label_col) == 1, F.log(p1)).otherwise(F.log(1 - p1))
    return fitted.transform(df).agg((F.sum(w * loss) / F.sum(w)).alias("l")).first()["l"]
