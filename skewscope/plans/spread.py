"""Deal the rows of a frame evenly over tasks of a bounded number of rows.

Files cut a scan by their bytes and row groups, which says little about a task whose rows grow in memory (bit strings, MLlib's
cached points). ``spread`` cuts by rows instead, so what one task holds does not grow with the input.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Below this many rows a task of its own is not worth it.
LEAST_ROWS = 10_000
SEED = 42


def tasks_for(rows: int, rows_per_task: int, cores: int) -> int:
    """Tasks of at most about ``rows_per_task`` rows, and one per core where there are rows for it."""
    return max(1, math.ceil(rows / rows_per_task), min(cores, math.ceil(rows / LEAST_ROWS)))


def spread(df: DataFrame, rows_per_task: int, rows: int | None = None) -> DataFrame:
    """``df`` over tasks of about ``rows_per_task`` rows; ``rows`` is its row count when known (skips a count).

    Dealt by a seeded draw: neither keys that repeat nor equal rows gather, and no task sorts its rows first, as a plain
    ``repartition(n)`` does.
    """
    n = df.count() if rows is None else rows
    return df.repartition(tasks_for(n, rows_per_task, df.sparkSession.sparkContext.defaultParallelism), F.rand(SEED))
