"""Write result tables with the DataFrame writer.

Result tables (one row per model, bin or split) are small by construction, so
they are written as a single part file (``coalesce(1)``); large frames keep
their partitioning. Paths are directories, as with any Spark writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.operators.evaluate import TEST_FIELDS, VALID_FIELDS
from skewscope.sinks.text import SPLIT_STATS_HEADER, split_stats_lines

CALIBRATION_FIELDS = ["bin", "mean_pred", "empirical_pos_rate", "count"]
SCALING_FIELDS = ["model", "train_rows", "train_time_s", "pr_auc"]


def _fixed(df: DataFrame, fields: Sequence[str] | None, strict: bool) -> DataFrame:
    if fields is None:
        return df
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    extra = [c for c in df.columns if c not in fields]
    if strict and extra:
        raise ValueError(f"unexpected columns {extra}")
    return df.select(*fields)


def write_json(df: DataFrame, path: str, fields: Sequence[str] | None = None, single_file: bool = False) -> None:
    out = _fixed(df, fields, strict=False)
    (out.coalesce(1) if single_file else out).write.mode("overwrite").json(path)


# Keyed JSON folds a whole result table into one object: only for small tables.
KEYED_JSON_ROW_LIMIT = 10_000


def keyed_json(df: DataFrame, key_col: str, order_col: str | None = None) -> DataFrame:
    """One row, column ``json``: {key: {other columns...}} (e.g. per split or per model).

    Keys follow ``order_col`` (dropped from the values) when given, else key order.
    """
    n = df.count()
    if n > KEYED_JSON_ROW_LIMIT:
        raise ValueError(f"keyed JSON is for result tables; got {n} rows")
    rest = [c for c in df.columns if c not in (key_col, order_col)]
    order = F.col(order_col) if order_col else F.col(key_col).cast("string")
    entries = F.sort_array(F.collect_list(F.struct(order.alias("o"), F.col(key_col).cast("string").alias("k"),
                                                   F.struct(*rest).alias("v"))))
    kv = F.transform(entries, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v")))
    return df.agg(F.to_json(F.map_from_entries(kv)).alias("json"))


def test_record_json(record: DataFrame, model_col: str = "model") -> DataFrame:
    """{"best_model": ..., "metrics": {...}} from the one-row test record."""
    rest = [c for c in record.columns if c != model_col]
    return record.select(F.to_json(F.struct(F.col(model_col).alias("best_model"),
                                            F.struct(*rest).alias("metrics"))).alias("json"))


def write_json_text(json_frame: DataFrame, path: str) -> None:
    json_frame.coalesce(1).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, fields: Sequence[str] | None = None, strict: bool = False,
              sep: str = ",", single_file: bool = False) -> None:
    """``single_file`` is for result tables of bounded size: all rows then pass through one task."""
    out = _fixed(df, fields, strict)
    (out.coalesce(1) if single_file else out).write.mode("overwrite").option("header", True) \
        .option("sep", sep).csv(path)


def write_metrics_csv(metrics: DataFrame, path: str, test: bool = False) -> bool:
    """Validation or test metrics with the fixed header; unknown extra columns raise.

    Columns used only for ordering (``model_order``) are dropped first. Returns
    False (and writes nothing) when the table is empty.
    """
    if metrics.isEmpty():
        return False
    df = metrics.drop("model_order")
    fields = TEST_FIELDS if test else VALID_FIELDS
    if not test and "opt_value" in df.columns:
        df = df.drop("opt_value")
    if not test:
        df = df.drop("TP", "FP", "TN", "FN", "applied_threshold")
    write_csv(df, path, fields, strict=True, single_file=True)
    return True


def write_calibration_csv(calib: DataFrame, path: str) -> None:
    write_csv(calib.orderBy("bin_index"), path, CALIBRATION_FIELDS, single_file=True)


def write_scaling_csv(scaling: DataFrame, path: str) -> None:
    write_csv(scaling, path, SCALING_FIELDS, strict=True, single_file=True)


def write_split_stats(summary: DataFrame, path: str) -> None:
    """Tab-separated split statistics with the fixed header, fractions at 6 decimals."""
    spark = summary.sparkSession
    header = spark.createDataFrame([(SPLIT_STATS_HEADER, -1)], "line string, o int")
    body = split_stats_lines(summary).selectExpr("line", "split_order AS o")
    header.unionByName(body).orderBy("o").select("line").coalesce(1).write.mode("overwrite").text(path)
