"""Joins on group columns that may be null: null is a group of its own, as in an aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` (inner or left) in which nulls meet; the columns ``on`` are kept once.

    ``<=>`` is an equi-join to Spark, so hash and sort-merge joins and broadcasts work as for ``=``.
    """
    on = list(on)
    renamed = {c: f"_join_{c}" for c in on}
    side = right.withColumnsRenamed(renamed)
    cond = None
    for c in on:
        term = F.col(c).eqNullSafe(F.col(renamed[c]))
        cond = term if cond is None else cond & term
    return left.join(side, cond, how).drop(*renamed.values())
