"""A random forest as a table of nodes: read from a stored model, pruned, and scored by joins.

The same results as the model's own, open to SQL: every probability can be followed from the root to its leaves.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmill.functions import rules
from riskmill.plans.training import MAX_DEPTH
from riskmill.schemas import FEATURES

MIN_ROWS_TO_SPLIT = 10  # fixed value: an inner node has at least as many rows
BROADCAST_NODES = 2_000_000  # of about 50 bytes; a larger forest is walked by blocks of rows and trees
BROADCAST_WALK = 10_000_000  # rows times trees; more are walked by blocks, not by a join per level
ROWS_PER_BLOCK = 100_000  # rows that one task walks down its trees
NODES_PER_BLOCK = 500_000  # nodes of the trees that one task holds

#: feature and threshold are NULL in a leaf; a value up to the threshold goes left, any other, and NULL, right.
NODES = "tree int, node int, feature int, threshold double, left int, right int, rows bigint, weights array<double>"


def stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of the forest in a stored pipeline, as the training left them.

    ``rows`` is how many rows of the tree's sample reached the node, ``weights`` their weight per class.
    """
    stored = spark.read.parquet(f"{path}/stages/*RandomForest*/data")
    inner = F.col("nodeData.leftChild") >= 0
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.when(inner, F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.col("nodeData.rawCount").alias("rows"),
        F.col("nodeData.impurityStats").alias("weights"),
    )


def pruned(nodes: DataFrame, least: int = MIN_ROWS_TO_SPLIT, depth: int = MAX_DEPTH) -> DataFrame:
    """The forest without splits of fewer than ``least`` rows: such a node becomes a leaf with its own weights.

    A node never has more rows than its parent, so this is the forest that a minimum split size leaves behind. Nodes
    that can't be reached any more are left out, level by level from the roots.
    """
    stays = F.col("rows") >= least
    split = ["feature", "threshold", "left", "right"]
    cut = nodes.withColumns({c: F.when(stays, F.col(c)) for c in split})
    level = cut.filter("node = 0").select("tree", "node")
    reached = level
    children = F.explode(F.array("left", "right")).alias("node")
    for _ in range(depth):
        level = cut.join(level, ["tree", "node"]).filter("feature IS NOT NULL").select("tree", children)
        reached = reached.unionByName(level)
    return cut.join(reached, ["tree", "node"])


def probability(rows: DataFrame, nodes: DataFrame, key: str, values: str, depth: int = MAX_DEPTH) -> DataFrame:
    """``key``, probability of class 1 and prediction, from ``rows`` (``key``, unique, and the array ``values``).

    Each row walks down every tree, one join per level, with node numbers alone; a leaf leads to itself. The nodes are
    broadcast if they are no more than BROADCAST_NODES, so rows move only to be averaged, reduced to one per row in
    each task. A tie is class 0. A larger forest, or more rows times trees than BROADCAST_WALK, is walked by blocks.
    """
    place = (F.col("tree").cast("bigint") * F.lit(2**31) + F.col("node")).alias("place")
    at = F.col("tree").cast("bigint") * F.lit(2**31)
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    steps = nodes.select(
        place,
        F.coalesce("feature", F.lit(0)).alias("feature"),
        "threshold",
        F.coalesce(at + F.col("left"), place).alias("left"),
        F.coalesce(at + F.col("right"), place).alias("right"),
    )
    leaves = nodes.filter("feature IS NULL").select(place, (F.get("weights", F.lit(1)) / total).alias("share"))
    counts = nodes.agg(F.count("*"), F.collect_set("tree")).first()
    n_rows = rows.count() if counts[0] <= BROADCAST_NODES else None
    if n_rows is None or n_rows * len(counts[1]) > BROADCAST_WALK:
        return _by_blocks(rows, nodes, key, values, depth, counts[0], len(counts[1]), n_rows)
    steps, leaves = F.broadcast(steps), F.broadcast(leaves)
    roots = F.explode(F.array(*[F.lit(t * 2**31) for t in sorted(counts[1])])).alias("place")
    walk = rows.select(key, values, roots)
    goes_left = F.col("threshold").isNotNull() & (F.get(values, F.col("feature")) <= F.col("threshold"))
    for _ in range(depth):
        walk = walk.join(steps, "place").select(key, values, F.when(goes_left, F.col("left")).otherwise(F.col("right")).alias("place"))
    chance = F.avg("share").alias("probability")
    scored = walk.join(leaves, "place").groupBy(key).agg(chance)
    return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


def _by_blocks(
    rows: DataFrame, nodes: DataFrame, key: str, values: str, depth: int, n_nodes: int, n_trees: int, n_rows: int | None
) -> DataFrame:
    """``probability`` for a forest too large to broadcast, with the same results.

    Rows are dealt into blocks by a hash, trees into blocks by their number; each pair of blocks meets in one task,
    which walks every row of its block down every tree of its block. A row moves once to each block of trees, a node
    once to each block of rows, and only sums and counts of the leaves' shares move on to be averaged.
    """
    row_blocks = max(1, -(-(rows.count() if n_rows is None else n_rows) // ROWS_PER_BLOCK))
    tree_blocks = max(1, min(n_trees, -(-n_nodes // NODES_PER_BLOCK)))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.select(
        F.col(key).alias("_key"),
        F.col(values).alias("_x"),
        F.transform(values, lambda v: v.isNull()).alias("_null"),
        F.pmod(F.xxhash64(key, values), F.lit(row_blocks)).alias("_rb"),
        spread(tree_blocks).alias("_tb"),
    )
    held = nodes.select(
        "tree", "node", "feature", "threshold", "left", "right", "weights",
        F.pmod("tree", F.lit(tree_blocks)).alias("_tb"), spread(row_blocks).alias("_rb"),
    )
    kind = rows.schema[key].dataType.simpleString()
    schema = f"_key {kind}, _sum double, _shares long, _leaves long"
    both = dealt.withColumn("_node", F.lit(False)).unionByName(held.withColumn("_node", F.lit(True)), allowMissingColumns=True)
    walked = both.groupBy("_rb", "_tb").applyInPandas(_walk_block(depth), schema)
    per_key = walked.groupBy(F.col("_key").alias(key)).agg(
        F.try_divide(F.sum("_sum"), F.sum("_shares")).alias("probability"), F.sum("_leaves").alias("_leaves")
    )
    scored = per_key.filter("_leaves > 0").drop("_leaves")
    return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


def _walk_block(depth: int):
    """A pandas function of the rows and nodes of one pair of blocks, as ``probability`` walks them in joins."""

    def walk(block):
        import numpy as np
        import pandas as pd

        rows, nodes = block[~block["_node"]].reset_index(drop=True), block[block["_node"]].reset_index(drop=True)

        out = {"_key": [], "_sum": [], "_shares": [], "_leaves": []}
        if len(rows) == 0 or len(nodes) == 0:
            return pd.DataFrame(out)
        width = max([0, *(len(v) for v in rows["_x"] if v is not None)])
        x = np.full((len(rows), width), np.nan)
        missing = np.ones((len(rows), width), dtype=bool)  # NULL, or no such entry
        for i, (v, n) in enumerate(zip(rows["_x"], rows["_null"])):
            if v is not None and len(v):
                x[i, : len(v)] = np.asarray([np.nan if e is None else e for e in v], dtype=float)
                missing[i, : len(v)] = np.asarray(n, dtype=bool)
        nodes = nodes.sort_values(["tree", "node"], kind="stable").reset_index(drop=True)
        place = nodes["tree"].to_numpy(np.int64) * 2**31 + nodes["node"].to_numpy(np.int64)
        leaf = nodes["feature"].isna().to_numpy()
        feature = nodes["feature"].fillna(0).to_numpy(np.int64)
        threshold = nodes["threshold"].to_numpy(float)
        no_threshold = nodes["threshold"].isna().to_numpy() | leaf
        at = nodes["tree"].to_numpy(np.int64) * 2**31
        left = np.where(leaf | nodes["left"].isna().to_numpy(), place, at + nodes["left"].fillna(0).to_numpy(np.int64))
        right = np.where(leaf | nodes["right"].isna().to_numpy(), place, at + nodes["right"].fillna(0).to_numpy(np.int64))

        def share(w):
            if w is None or len(w) < 2 or w[1] is None or any(e is None for e in w):
                return np.nan
            total = float(np.sum(np.asarray(w, dtype=float)))
            return np.nan if total == 0 else float(w[1]) / total

        shares = np.array([share(w) for w in nodes["weights"]], dtype=float)

        def find(wanted):
            """Index of each place among the nodes, -1 where there is none."""
            i = np.clip(np.searchsorted(place, wanted), 0, len(place) - 1)
            return np.where(place[i] == wanted, i, -1)

        total = np.zeros(len(rows))
        counted = np.zeros(len(rows), dtype=np.int64)
        reached = np.zeros(len(rows), dtype=np.int64)
        rows_at = np.arange(len(rows))
        for tree in np.unique(nodes["tree"].to_numpy(np.int64)):
            i = np.full(len(rows), find(np.array([tree * 2**31]))[0])
            for _ in range(depth):
                ok = i >= 0
                j = np.where(ok, i, 0)
                f = feature[j]
                inside = f < width
                fi = np.where(inside, f, 0)
                value, null = x[rows_at, fi] if width else np.full(len(rows), np.nan), (missing[rows_at, fi] if width else np.ones(len(rows), dtype=bool))
                with np.errstate(invalid="ignore"):
                    goes_left = ~no_threshold[j] & inside & ~null & ((value <= threshold[j]) | np.isnan(threshold[j]))
                i = np.where(ok, find(np.where(goes_left, left[j], right[j])), -1)
            ok = i >= 0
            j = np.where(ok, i, 0)
            ended = ok & leaf[j]
            s = np.where(ended, shares[j], np.nan)
            reached += ended
            counted += ~np.isnan(s)
            total += np.where(np.isnan(s), 0.0, s)
        keys = rows["_key"].to_numpy(dtype=object)  # not a column of Arrow's chunks
        return pd.DataFrame({"_key": keys, "_sum": total, "_shares": counted, "_leaves": reached})

    return walk


def score_by_nodes(silver: DataFrame, model: PipelineModel, nodes: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """TransactionID, prediction, probability, action: means filled in as the model does, then the walk."""
    inputs = [F.col(c).cast("double").alias(c) for c in FEATURES]
    filled = silver.select("TransactionID", *inputs)
    for part in model.stages[:-1]:
        filled = part.transform(filled)
    rows = filled.select("TransactionID", vector_to_array("features").alias("x"))
    return _decided(probability(rows, nodes, "TransactionID", "x", depth))


def score_plain(silver: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """The same on the inputs as they are, NULLs included."""
    values = F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("x")
    return _decided(probability(silver.select("TransactionID", values), nodes, "TransactionID", "x", depth))


def _decided(scored: DataFrame) -> DataFrame:
    action: Column = rules.action(F.col("prediction"))
    return scored.select("TransactionID", "prediction", "probability", action.alias("action"))
