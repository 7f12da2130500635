"""Bounded, distributed running totals over an ordered key.

A window with ``ORDER BY`` but no ``PARTITION BY`` runs in a single task. That is
fine for a few thousand rows and fatal for billions, so the ordered key is cut
into contiguous ranges first:

1. the input holds one row per (group, key) (the caller has already aggregated
   duplicates, so a hot key is a single row here);
2. ``approxQuantile`` over the key gives ``k - 1`` explicit boundaries, where
   ``k = ceil(rows / rows_per_range)``; explicit boundaries (rather than
   ``repartitionByRange``) stay fixed if a stage is recomputed;
3. per-(group, range) sums are tiny (groups x k rows): an exclusive running sum
   over them gives each range its offset, and a plain sum the group total;
4. the offsets are broadcast back (their size is checked) and the final window is
   partitioned by (group, range), so each task holds at most ~rows_per_range rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skewscope.plans.joins import join_groups
from skewscope.plans.materialize import materialize

# A sorted window over ~2M narrow rows fits comfortably in one task.
DEFAULT_ROWS_PER_RANGE = 2_000_000
# Offsets table (groups x ranges rows of a few longs) is broadcast below this size.
BROADCAST_ROW_LIMIT = 1_000_000

_PID = "_range_id"


def _range_ids(df: DataFrame, key: str, bounds: Sequence[float]) -> DataFrame:
    if not bounds:
        return df.withColumn(_PID, F.lit(0))
    splits = [-math.inf, *bounds, math.inf]
    out = Bucketizer(splits=splits, inputCol=key, outputCol=_PID, handleInvalid="keep").transform(df)
    return out.withColumn(_PID, F.col(_PID).cast("int"))


def range_bounds(df: DataFrame, key: str, rows: int, rows_per_range: int) -> list[float]:
    """Strictly increasing boundaries cutting ``key`` into ~rows/rows_per_range ranges."""
    k = max(1, math.ceil(rows / max(1, rows_per_range)))
    if k == 1:
        return []
    probs = [i / k for i in range(1, k)]
    qs = df.approxQuantile(key, probs, 1.0 / (4 * k))
    return sorted({float(q) for q in qs if q is not None and not math.isnan(q)})


def running_totals(
    df: DataFrame,
    key: str,
    value_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    descending: bool = True,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
    reuse: bool = True,
    rows_hint: int | None = None,
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive running sum in key order) and ``total_<v>``.

    ``df`` must hold at most one row per ``(group_cols, key)``; ``key`` must be
    numeric and not null. A null group is a group like any other. With ``descending=True`` the running sum at a key
    covers every row of the same group whose key is greater or equal.
    ``rows_hint`` is a proven upper bound on the row count (skips counting).
    """
    group_cols = list(group_cols)
    value_cols = list(value_cols)
    if reuse and rows_hint is None:
        df = materialize(df)
    rows = df.count() if rows_hint is None else rows_hint
    key_order = F.col(key).desc() if descending else F.col(key).asc()
    if rows <= rows_per_range:
        # One range: a single sorted window over at most rows_per_range rows.
        grp = Window.partitionBy(*group_cols)
        upto = grp.orderBy(key_order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(
            *df.columns,
            *[F.sum(v).over(upto).cast("long").alias(f"cum_{v}") for v in value_cols],
            *[F.sum(v).over(grp).cast("long").alias(f"total_{v}") for v in value_cols],
        )
    bounds = range_bounds(df, key, rows, rows_per_range)
    ranged = _range_ids(df, key, bounds)

    part = ranged.groupBy(*group_cols, _PID).agg(*[F.sum(v).alias(f"_part_{v}") for v in value_cols])
    order = F.col(_PID).desc() if descending else F.col(_PID).asc()
    grp = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    before = grp.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(
        *group_cols,
        _PID,
        *[F.coalesce(F.sum(f"_part_{v}").over(before), F.lit(0)).cast("long").alias(f"_off_{v}") for v in value_cols],
        *[F.sum(f"_part_{v}").over(grp).cast("long").alias(f"total_{v}") for v in value_cols],
    )
    n_offsets = (len(bounds) + 1) if not group_cols else offsets.count()
    if n_offsets <= BROADCAST_ROW_LIMIT:
        offsets = F.broadcast(offsets)
    joined = join_groups(ranged, offsets, [*group_cols, _PID])

    inside = (Window.partitionBy(*group_cols, _PID).orderBy(key_order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    keep = [c for c in df.columns]
    return joined.select(
        *keep,
        *[(F.sum(v).over(inside) + F.col(f"_off_{v}")).cast("long").alias(f"cum_{v}") for v in value_cols],
        *[F.col(f"total_{v}") for v in value_cols],
    )
