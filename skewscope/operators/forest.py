"""A fitted forest as a table of nodes, and the walk of rows through it.

``node_table`` reads back what MLlib's own writer stores: one row per node, with the feature and cut of a split or the
class votes of a leaf. ``walk`` takes rows through all trees level by level: each level is one join of (tree, node) with
that level's nodes. The first levels have few nodes that all rows meet, so they are broadcast (behind a count); a level beyond
``BROADCAST_NODES`` is a shuffle join on (tree, node), whose keys are many by then. A row's votes are averaged over the trees by
one aggregate at the end, so nothing but the node counts per level reaches the driver.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skewscope.plans.materialize import materialize, scratch_path

#: Nodes of one level that are broadcast (about 60 bytes each).
BROADCAST_NODES = 500_000
#: MLlib grows no tree deeper.
MAX_DEPTH = 30


def node_table(fitted) -> DataFrame:
    """Saved: tree, node, level, feature, cut, categories, left, right, votes0, votes1, rows of a fitted forest.

    Leaves have a null feature. ``votes`` are the class weights of the training rows in the node; categories (null for
    a numeric split) are the values that go left.
    """
    spark = SparkSession.active()
    path = scratch_path(spark)
    fitted.write().save(path)
    data = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    cuts = F.col("split.leftCategoriesOrThreshold")
    by_value = F.col("split.numCategories") >= 0
    flat = data.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ~by_value, F.get(cuts, F.lit(0))).alias("cut"), F.when(inner & by_value, cuts).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.get("impurityStats", F.lit(0)).alias("votes0"), F.get("impurityStats", F.lit(1)).alias("votes1"),
        F.col("rawCount").alias("rows"))
    return with_levels(flat)


def with_levels(nodes: DataFrame) -> DataFrame:
    """Saved: the nodes with their distance from the root (node 0 of its tree)."""
    nodes = materialize(nodes)
    edges = nodes.where("feature IS NOT NULL").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    here = materialize(nodes.where("node = 0").select("tree", "node", F.lit(0).alias("level")))
    levels = [here]
    while len(levels) <= MAX_DEPTH:
        here = materialize(levels[-1].join(edges, ["tree", "node"]).select(
            "tree", F.col("child").alias("node"), F.lit(len(levels)).alias("level")))
        if here.isEmpty():
            break
        levels.append(here)
    known = levels[0]
    for more in levels[1:]:
        known = known.unionByName(more)
    return materialize(nodes.join(known, ["tree", "node"]))


def _side(small: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(small) if rows <= BROADCAST_NODES else small


def _goes_left() -> Column:
    value = F.get("_x", F.col("feature"))
    return F.when(F.col("categories").isNull(), value <= F.col("cut")).otherwise(F.array_contains("categories", value))


def visits(rows: DataFrame, nodes: DataFrame, features_col: str = "features", every: bool = False) -> DataFrame:
    """The columns of ``rows`` with (tree, node): the leaf that each row reaches in each tree, or, with ``every``, all
    nodes on the way."""
    keep = [c for c in rows.columns if c != features_col]
    counts = {r["level"]: (r["inner"], r["n"]) for r in nodes.groupBy("level").agg(
        F.count("feature").alias("inner"), F.count(F.lit(1)).alias("n")).collect()}  # at most MAX_DEPTH + 1 rows
    trees = [r["tree"] for r in nodes.where("level = 0").select("tree").collect()]  # one number per tree
    x = F.col(features_col)
    x = x if rows.schema[features_col].dataType.typeName() == "array" else vector_to_array(x)
    state = rows.select(*keep, x.alias("_x"), F.explode(F.array(*map(F.lit, trees))).alias("tree"), F.lit(0).alias("node"))
    seen = [state.drop("_x")]
    for level in sorted(counts):
        inner, _ = counts[level]
        if not inner:
            continue
        splits = nodes.where((F.col("level") == level) & F.col("feature").isNotNull()).select(
            "tree", "node", "feature", "cut", "categories", "left", "right")
        met = state.join(_side(splits, inner), ["tree", "node"], "left")
        moved = F.when(_goes_left(), F.col("left")).otherwise(F.col("right"))
        state = met.select(*keep, "_x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(moved).alias("node"),
                           F.col("feature").isNotNull().alias("_moved"))
        if every:
            state = materialize(state)
            seen.append(state.where("_moved").drop("_x", "_moved"))
        state = state.drop("_moved")
    if not every:
        return state.drop("_x")
    out = seen[0]
    for more in seen[1:]:
        out = out.unionByName(more)
    return out


def walk(rows: DataFrame, nodes: DataFrame, features_col: str = "features", out: str = "p1") -> DataFrame:
    """``rows`` without the features, with ``out``: the mean over the trees of the leaf's share of votes for class 1.

    Rows are numbered in a table written first, so repeated rows stay apart.
    """
    keep = [c for c in rows.columns if c != features_col]
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()))
    leaves = nodes.where("feature IS NULL").select(
        "tree", "node", F.when(F.col("votes0") + F.col("votes1") > 0, F.col("votes1") / (F.col("votes0") + F.col("votes1")))
        .otherwise(0.0).alias("_share"))
    # The kept columns come along, so that a row's leaves are brought together once and not joined to it again.
    at = visits(rows, nodes, features_col)
    met = at.join(_side(leaves, leaves.count()), ["tree", "node"])
    return met.groupBy("_row", *keep).agg(F.avg("_share").alias(out)).drop("_row")


def node_counts(rows: DataFrame, nodes: DataFrame, features_col: str = "features", label_col: str = "label",
                weight_col: str | None = None) -> DataFrame:
    """Per node the class weights of ``rows`` that pass it, beside the votes stored at the fit."""
    w = F.col(weight_col) if weight_col else F.lit(1.0)
    rows = rows.select(F.col(label_col).alias("_y"), w.cast("double").alias("_w"), features_col)
    met = visits(rows, nodes, features_col, every=True).groupBy("tree", "node").agg(
        F.sum(F.when(F.col("_y") == 1, 0.0).otherwise(F.col("_w"))).alias("met0"),
        F.sum(F.when(F.col("_y") == 1, F.col("_w")).otherwise(0.0)).alias("met1"))
    return nodes.select("tree", "node", "level", "votes0", "votes1").join(met, ["tree", "node"], "left").na.fill(0.0, ["met0", "met1"])
