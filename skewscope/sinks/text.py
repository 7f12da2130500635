"""Text renderings of result tables (one formatted line per row, built on executors)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLIT_STATS_HEADER = "split\trows\tpositive\tnegative\tpositive_frac\tnegative_frac"


def split_stats_lines(summary: DataFrame) -> DataFrame:
    """(split_order, line): tab-separated split statistics, fractions at 6 decimals."""
    line = F.format_string("%s\t%d\t%d\t%d\t%.6f\t%.6f", "split", "rows", "positive", "negative",
                           "positive_fraction", "negative_fraction")
    return summary.select("split_order", line.alias("line"))
