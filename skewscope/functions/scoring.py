"""Score columns from fitted models and their display names."""

from __future__ import annotations

from itertools import chain

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Model keys and the display labels the reports use.
MODEL_DISPLAY_NAMES = {
    "logistic_regression": "Logistic Regression",
    "random_forest": "Random Forest",
    "logistic_regression_weighted": "Logistic Regression (class-weighted)",
    "logistic_regression_undersampled": "Logistic Regression (undersampled)",
    "logistic_regression_oversampled": "Logistic Regression (oversampled)",
    "random_forest_weighted": "Random Forest (class-weighted)",
    "random_forest_undersampled": "Random Forest (undersampled)",
    "random_forest_oversampled": "Random Forest (oversampled)",
}

MODEL_KEYS = tuple(MODEL_DISPLAY_NAMES)


def positive_probability(prob_col: str = "probability") -> Column:
    """P(class 1) from an MLlib probability vector; 0.0 when the vector has one entry.

    A classifier fitted on a single class emits a size-1 vector holding
    P(class 0); reading that as the positive score would be wrong, so 0.0.
    """
    arr = vector_to_array(F.col(prob_col))
    return F.when(F.size(arr) > 1, arr.getItem(1)).otherwise(F.lit(0.0))


def apply_threshold(score: Column | str, threshold: float | Column) -> Column:
    """1 when score >= threshold (inclusive), else 0, as int."""
    s = F.col(score) if isinstance(score, str) else score
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (s >= t).cast("int")


def display_name(key: Column | str) -> Column:
    """Human label for a model key; unknown keys are returned unchanged."""
    k = F.col(key) if isinstance(key, str) else key
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(MODEL_DISPLAY_NAMES.items())])
    return F.coalesce(mapping[k], k)
