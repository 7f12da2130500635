"""Imbalance remedies: class weights, majority undersampling, minority oversampling.

All are narrow (no shuffle). Class counts are two numbers from one aggregate.
``method="hash"`` (md5) or ``"xxhash64"`` draws from the row key, the seed and the
step's own purpose, so results do not depend on partitioning and steps stay independent; ``exact=True`` makes both classes equal
in size to the row; ``method="native"`` uses Spark's seeded ``sample`` (Bernoulli without replacement, Poisson with
replacement) like the reference pipeline. Keys that repeat draw alike: give such frames ``ordinals.with_draw_key`` first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.functions.hashing import draw_method, unit_draw
from skewscope.operators.balance import class_counts
from skewscope.operators.exact_sample import exact_sample
from skewscope.operators.ordinals import COPY_CHUNK, repeat_rows


def class_weights(df: DataFrame, label_col: str = "label", weight_col: str = "weight",
                  pos_weight: float | None = None) -> DataFrame:
    """weight = pos_weight for label 1, else 1.0; pos_weight defaults to n_neg/n_pos."""
    if pos_weight is None:
        n_pos, n_neg = class_counts(df, label_col)
        pos_weight = (n_neg / n_pos) if n_pos else 1.0
    return df.withColumn(weight_col, F.when(F.col(label_col) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0)))


def _sides(df: DataFrame, label_col: str):
    n_pos, n_neg = class_counts(df, label_col)
    if n_pos == n_neg:
        return None
    minority, n_min, n_maj = (1, n_pos, n_neg) if n_pos < n_neg else (0, n_neg, n_pos)
    return minority, n_min, n_maj


def undersample(df: DataFrame, label_col: str = "label", seed: int = 42, method: str = "hash",
                key_col: str | None = None, exact: bool = False) -> DataFrame:
    """All minority rows plus majority rows kept with probability n_min/n_maj, or, with ``exact``, n_min of them."""
    sides = _sides(df, label_col)
    if sides is None:
        return df
    minority, n_min, n_maj = sides
    fraction = n_min / float(n_maj)
    is_min = F.col(label_col) == minority
    if method == "native":
        majority = df.where(~is_min).sample(withReplacement=False, fraction=fraction, seed=seed)
        return df.where(is_min).unionByName(majority)
    if key_col is None:
        raise ValueError("hash sampling needs key_col")
    if exact:
        few = exact_sample(df.where(F.col(label_col) == 1 - minority), n_min, key_col, seed, method, "under", rows=n_maj)
        return df.where(is_min).unionByName(few)
    return df.where(is_min | (unit_draw(F.col(key_col), seed, draw_method(method), "under") < F.lit(fraction)))


def oversample(df: DataFrame, label_col: str = "label", seed: int = 42, method: str = "hash",
               key_col: str | None = None, exact: bool = False) -> DataFrame:
    """All majority rows plus minority rows replicated to about n_maj in total.

    Hash method: a minority row appears floor(r + u) times, r = n_maj/n_min, u
    its draw, via ``explode(sequence(...))``; copy counts above ``COPY_CHUNK``
    are exploded in spread-out chunks. Without minority rows the frame is
    returned unchanged. With ``exact`` every minority row appears floor(r) times and the
    n_maj mod n_min rows with the least draws once more: n_maj in all.
    """
    sides = _sides(df, label_col)
    if sides is None or sides[1] == 0:
        return df
    minority, n_min, n_maj = sides
    ratio = n_maj / float(n_min)
    is_min = F.col(label_col) == minority
    if method == "native":
        extra = df.where(is_min).sample(withReplacement=True, fraction=ratio, seed=seed)
        return df.where(~is_min).unionByName(extra)
    if key_col is None:
        raise ValueError("hash sampling needs key_col")
    cols = df.columns
    if exact:
        few = df.where(is_min)
        again = exact_sample(few, n_maj % n_min, key_col, seed, method, "over", rows=n_min)
        whole = repeat_rows(few.withColumn("_copies", F.lit(n_maj // n_min)), "_copies", n_maj // n_min).select(*cols)
        return df.where(F.col(label_col) == 1 - minority).unionByName(whole).unionByName(again)
    draw = unit_draw(F.col(key_col), seed, draw_method(method), "over")
    copies = F.when(is_min, F.floor(F.lit(ratio) + draw)).otherwise(F.lit(1)).cast("long")
    return repeat_rows(df.withColumn("_copies", copies), "_copies", int(ratio) + 1).select(*cols)
