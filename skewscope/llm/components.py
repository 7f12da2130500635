"""Connected components of an edge table by alternating large and small stars.

Every round is written under the checkpoint folder, so lineage stays short; only two numbers per
round reach the driver. Rounds are logarithmic in the longest path in practice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.llm.common import discard, save


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: link each node's larger neighbours to its least one; small: its smaller ones and itself."""
    if large:
        rows = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        rows = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = rows.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    met = rows.join(least, rows["a"] == least["k"])
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Saved table (node, component) of the edges (a, b); component is the least node reachable."""
    now = save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while True:
        then = save(_star(_star(now, True), False))
        discard(now)
        now, before, state = then, state, _state(then)
        if state == before:
            break
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return save(ends.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
