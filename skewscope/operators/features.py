"""Feature layouts: numbered columns or a bit string, to one ``features`` vector.

Layouts, tried in order: ``fp_<n>`` columns, all-digit column names, an
``fp_bits`` string. A column layout needs at least ``min_columns`` columns.
Columns are ordered by their number (``fp_2`` before ``fp_10``). Bit strings
are parsed a batch at a time, as one matrix of bytes per Arrow batch.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler, VectorSizeHint
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layout names, the bit-string column, the ignored hex column,
# the expected fingerprint width and the minimum column count.
FP_COLUMNS = "fp_columns"
NUMERIC_COLUMNS = "numeric_columns"
FP_BITS = "fp_bits"
BITS_COL = "fp_bits"
HEX_COL = "fp_hex"
FP_WIDTH = 2048
MIN_COLUMNS = 128

_FP = re.compile(r"^fp_(\d+)$")


def fp_columns(columns: list[str]) -> list[str]:
    return sorted((c for c in columns if _FP.match(c)), key=lambda c: int(c[3:]))


def digit_columns(columns: list[str]) -> list[str]:
    return sorted((c for c in columns if c.isdigit()), key=int)


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """Numeric columns to one vector (null features fail the job by default)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def checked_bits(bits: Column, width: int = FP_WIDTH) -> Column:
    """The trimmed string; a null one or one of another length raises."""
    s = F.trim(bits)
    n = F.coalesce(F.length(s), F.lit(0))
    return F.when(n == width, s).otherwise(
        F.raise_error(F.format_string(f"expected {width} bits in {BITS_COL}, found %d characters", n)))


def digit_rows(texts: pa.Array, width: int) -> np.ndarray:
    """Texts of ``width`` digits as one row of bytes 0-9 each; anything but a digit raises."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    digits = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]] - np.uint8(ord("0"))
    if texts.null_count or len(digits) != len(texts) * width or (digits > 9).any():
        raise ValueError(f"{BITS_COL} holds a character that is not a digit")
    return digits.reshape(len(texts), width)


def vector_structs(rows: np.ndarray) -> pa.StructArray:
    """Rows of numbers as MLlib stores vectors: sparse where that is smaller (``Vector.compressed``), else dense."""
    n, width = rows.shape
    filled = rows != 0
    sparse = 1.5 * (filled.sum(axis=1) + 1.0) < width
    filled |= ~sparse[:, None]  # a dense vector keeps its zeros
    at, place = np.nonzero(filled)
    kept = filled.sum(axis=1)
    ends = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    indices = pa.ListArray.from_arrays(ends(np.where(sparse, kept, 0)), pa.array(place[sparse[at]], pa.int32()), mask=pa.array(~sparse))
    values = pa.ListArray.from_arrays(ends(kept), pa.array(rows[filled], pa.float64()))
    return pa.StructArray.from_arrays(
        [pa.array(np.where(sparse, 0, 1), pa.int8()), pa.array(np.full(n, width), pa.int32(), mask=~sparse), indices, values],
        ["type", "size", "indices", "values"])


def bits_to_features(df: DataFrame, bits_col: str = BITS_COL, out: str = "features",
                     width: int = FP_WIDTH) -> DataFrame:
    """Bit strings to vectors, stored sparse where that is smaller."""
    @F.arrow_udf(VectorUDT())
    def parse(texts: pa.Array) -> pa.Array:
        return vector_structs(digit_rows(texts, width))

    parsed = df.withColumn(out, parse(checked_bits(F.col(bits_col), width)))
    # The width is checked above; the hint spares estimators a look at the first row.
    return VectorSizeHint(inputCol=out, size=width, handleInvalid="optimistic").transform(parsed)


def detect_layout(df: DataFrame, out: str = "features", min_columns: int = MIN_COLUMNS,
                  width: int = FP_WIDTH) -> tuple[DataFrame, str]:
    """(frame with base columns + ``features``, layout name); ValueError if none fits."""
    cols = df.columns
    fp, digits = fp_columns(cols), digit_columns(cols)
    feature_like = set(fp) | set(digits) | {BITS_COL, HEX_COL}
    base = [c for c in cols if c not in feature_like]
    if len(fp) >= min_columns:
        return assemble(df, fp, out).select(*base, out), FP_COLUMNS
    if len(digits) >= min_columns:
        return assemble(df, digits, out).select(*base, out), NUMERIC_COLUMNS
    if BITS_COL in cols:
        keep = [c for c in cols if c not in (BITS_COL, HEX_COL)]
        return bits_to_features(df, BITS_COL, out, width).select(*keep, out), FP_BITS
    raise ValueError(f"no feature layout: need >= {min_columns} fp_<n> or numbered columns, or a {BITS_COL} column")
