"""Batch scans and cleaning.

CSV batches are typed by their header alone: numbered feature columns are
doubles, everything else text (scores are cast later, malformed ones to null).
That needs no pass over the rows; inference stays an option, as does a schema.
Gzip files are not splittable (one task per file), so the study stages text
batches once as Parquet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from skewscope.operators.features import digit_columns, fp_columns


def header_schema(columns: Sequence[str]) -> StructType:
    """``fp_<n>`` and all-digit columns as double, the others as string."""
    numbered = {*fp_columns(list(columns)), *digit_columns(list(columns))}
    return StructType([StructField(c, DoubleType() if c in numbered else StringType()) for c in columns])


def scan_batches(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv",
                 schema: StructType | str | None = None, infer_schema: bool = False,
                 header: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """Read batch files (CSV, optionally gzip, or Parquet) matching ``path``."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header)
        paths = path if isinstance(path, str) else list(path)
        if schema is None and infer_schema:
            reader = reader.option("inferSchema", True)
        elif schema is None and header:
            reader = reader.schema(header_schema(reader.csv(paths).columns))  # reads one line
        df = reader.csv(paths)
    elif fmt == "parquet":
        df = reader.parquet(*([path] if isinstance(path, str) else list(path)))
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return df.select(*columns) if columns else df


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is null.

    Written as IS NOT NULL predicates (same result as ``dropna``) so Catalyst
    pushes them into the scan and can turn an outer join below into an inner one.
    """
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def cast_score(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Score to double; malformed text becomes null instead of failing the job."""
    return df.withColumn(out or col, F.col(col).try_cast("double"))
