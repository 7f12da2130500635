"""Deterministic per-key hashing: buckets and uniform draws.

Results depend only on the key, never on partitioning, so a split or a sample is
identical after a repartition, a retry or a lost executor.

``xxhash64`` is Spark's native 64-bit hash; ``md5`` (leading hex digits as a
number: 32 bits for buckets, 52 for draws) has the same value in any SQL engine with ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_52 = 4503599627370496.0
METHODS = ("xxhash64", "md5")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def md5_u32(text: Column) -> Column:
    """First 32 bits of md5(text) as a bigint in [0, 2^32)."""
    return F.conv(F.substring(F.md5(text.cast("string")), 1, 8), 16, 10).cast("long")


def hash_bucket(key: Column | str, buckets: int = 100, method: str = "xxhash64") -> Column:
    """Bucket in [0, buckets): pmod(xxhash64(key), n) or md5 prefix mod n."""
    k = _c(key)
    if method == "xxhash64":
        return F.pmod(F.xxhash64(k), F.lit(buckets)).cast("long")
    if method == "md5":
        return (md5_u32(k) % F.lit(buckets)).cast("long")
    raise ValueError(f"method must be one of {METHODS}")


def unit_draw(key: Column | str, seed: int = 42, method: str = "md5", purpose: str = "") -> Column:
    """Uniform 52-bit draw in [0, 1) fixed by (key, seed, purpose).

    Steps that follow one another must name different purposes: rows that one
    draw has kept are not uniform in the same draw any more.
    """
    k = F.concat(_c(key).cast("string"), F.lit(f":{seed}" + (f":{purpose}" if purpose else "")))
    if method == "md5":
        return F.conv(F.substring(F.md5(k), 1, 13), 16, 10).cast("long").cast("double") / F.lit(TWO_52)
    if method == "xxhash64":
        return F.pmod(F.xxhash64(k), F.lit(1 << 52)).cast("double") / F.lit(TWO_52)
    raise ValueError(f"method must be one of {METHODS}")


def draw_method(method: str) -> str:
    """The hash behind a sampler's ``method``: ``"hash"`` is md5, ``"xxhash64"`` itself."""
    return "md5" if method == "hash" else method
