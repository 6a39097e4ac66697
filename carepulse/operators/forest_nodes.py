"""The saved forest as a relation, and scoring and importance as plans over it.

A forest that Spark ML saved holds one row per tree node. ``node_table`` gives them as (tree, node, depth, feature, threshold,
left_node, right_node, gain, rows, class_probabilities); inner nodes have a feature index from 0, leaves -1. ``score_nodes`` walks
all trees level by level over the nodes of each tree, so a row's way through a tree can be checked against any other engine over the
same relation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.schemas import quote

#: Trees are broadcast together up to so many nodes (about 60 bytes each); more are walked in groups of whole trees.
BROADCAST_NODES = 2_000_000
#: Levels that are one generated method; longer ones the JVM doesn't compile.
LEVELS_TOGETHER = 8
#: Rows of a task: each is a hundred walks, and the sums of all stay in memory.
WALKED_ROWS = 50_000
LEAF = -1


def node_table(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of the random forest in a saved pipeline (one group per tree, as large as one tree)."""
    saved = spark.read.parquet(f"{model_path.rstrip('/')}/stages/*_RandomForestClassifi*/data").select("treeID", "nodeData.*")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda s, x: s + x)
    nodes = saved.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        F.col("leftChild").alias("left_node"), F.col("rightChild").alias("right_node"), "gain", F.col("rawCount").alias("rows"),
        F.transform("impurityStats", lambda x: x / total).alias("class_probabilities"))

    def with_depth(one: pd.DataFrame) -> pd.DataFrame:
        depth, below = {0: 0}, dict(zip(one["node"], zip(one["left_node"], one["right_node"])))
        todo = [0]
        while todo:
            node = todo.pop()
            for child in below[node]:
                if child >= 0:
                    depth[child] = depth[node] + 1
                    todo.append(child)
        return one.assign(depth=one["node"].map(depth).astype("int32"))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return nodes.groupBy("tree").applyInPandas(with_depth, f"{fields}, depth int")


def _tree_groups(sizes: Sequence[tuple[int, int]]) -> list[list[int]]:
    """The trees of (tree, nodes), in groups of `BROADCAST_NODES` nodes at most (or one tree)."""
    groups, room = [], 0
    for tree, n in sorted(sizes):
        if not groups or n > room:
            groups.append([])
            room = BROADCAST_NODES
        groups[-1].append(tree)
        room -= n
    return groups


def _tree_arrays(nodes: DataFrame, classes: int) -> DataFrame:
    """One row for each tree: arrays by node number; a leaf's way leads to itself."""
    feature, node = F.greatest(F.col("feature"), F.lit(0)), F.col("node").cast("int")
    own = F.struct(node.alias("node"), feature.cast("int").alias("feature"), F.coalesce("threshold", F.lit(0.0)).alias("threshold"),
                   F.when(F.col("feature") == LEAF, node).otherwise(F.col("left_node")).cast("int").alias("left"),
                   F.when(F.col("feature") == LEAF, node).otherwise(F.col("right_node")).cast("int").alias("right"),
                   *[F.col("class_probabilities")[c].alias(f"p{c}") for c in range(classes)])
    trees = nodes.groupBy(F.col("tree").cast("int").alias("tree")).agg(F.array_sort(F.collect_list(own)).alias("own"))
    return trees.select("tree", *[F.col(f"own.{f}").alias(f"_{f}") for f in ("feature", "threshold", "left", "right", *[f"p{c}" for c in range(classes)])])


def _walked(trees: DataFrame, group: Sequence[int], depth: int, rows: DataFrame, names: Sequence[str], classes: int) -> DataFrame:
    """For each key the sums of its leaves' class probabilities over the trees of a group, and their number."""
    walk = rows.select("*", F.explode(F.array(*[F.lit(t) for t in group])).alias("tree")).withColumn("node", F.lit(0))
    own = F.broadcast(trees.where(F.col("tree").isin(list(group))))
    for first in range(0, max(depth, 1), LEVELS_TOGETHER):
        walk = walk.join(own, "tree")  # a method's rows hold their tree by reference, and leave it before they are copied
        for _ in range(first, min(first + LEVELS_TOGETHER, depth)):
            left = F.get("x", F.get("_feature", "node")) <= F.get("_threshold", "node")
            walk = walk.withColumn("node", F.when(left, F.get("_left", "node")).otherwise(F.get("_right", "node")))
        if first + LEVELS_TOGETHER < depth:
            walk = walk.select(*names, "x", "tree", "node").observe(f"depth {first}", F.count(F.lit(1)).alias("visits"))  # ends the generated method
    leaves = walk.select(*names, *[F.get(f"_p{c}", "node").alias(f"_p{c}") for c in range(classes)])
    return leaves.groupBy(*names).agg(*[F.sum(f"_p{c}").alias(f"_p{c}") for c in range(classes)], F.count(F.lit(1)).alias("_n"))


def score_nodes(nodes: DataFrame, df: DataFrame, features: Sequence[str], key: Sequence[str], positive_index: int = 1) -> DataFrame:
    """Class, P(class ``positive_index``) x 100 and all class probabilities of each ``key``, by walking the nodes.

    ``key`` identifies a row of ``df``; the nodes of a tree are numbered from 0, as `node_table` gives them, and read for each group of
    trees, so store them. The rows are exchanged by key into tasks of `WALKED_ROWS` before they visit the trees, and the visits of a row are added up
    in the same task: however large the forest, no visit is exchanged.
    """
    per = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.max("node").alias("last"), F.max("depth").alias("depth"), F.max(F.size("class_probabilities")).alias("k")).collect()  # one row per tree
    if not per:
        raise ValueError("a forest without nodes can't score")
    if any(r["last"] + 1 != r["n"] for r in per):
        raise ValueError("the nodes of a tree are numbered from 0")
    depth, classes = max(r["depth"] for r in per), max(r["k"] for r in per)
    names = [f"_key{i}" for i in range(len(key))]
    rows = df.select(*[F.col(quote(k)).alias(n) for k, n in zip(key, names)], F.array(*[F.col(quote(f)).cast("double") for f in features]).alias("x"))
    tasks = max(1, -(-df.count() // WALKED_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(tasks, *names)
    trees = _tree_arrays(nodes, classes)
    parts = [_walked(trees, group, depth, rows, names, classes) for group in _tree_groups([(r["tree"], r["n"]) for r in per])]
    sums = parts[0]
    if parts[1:]:
        sums = reduce(DataFrame.unionAll, parts).groupBy(*names).agg(*[F.sum(f"_p{c}").alias(f"_p{c}") for c in range(classes)], F.sum("_n").alias("_n"))
    probabilities = F.col("_probabilities")
    return sums.select(*names, F.array(*[F.col(f"_p{c}") / F.col("_n") for c in range(classes)]).alias("_probabilities")).select(
        *[F.col(n).alias(k) for n, k in zip(names, key)],
        (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int").alias("readmission_prediction"),
        (F.try_element_at(probabilities, F.lit(positive_index + 1)) * 100.0).alias("readmission_probability_pct"),
        probabilities.alias("class_probabilities"))


def node_importance(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """M6 (feature, importance) from the relation: gains weighted by rows, each tree's sum 1, then the forest's sum 1."""
    gains = nodes.where(F.col("feature") != LEAF).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    trees = gains.groupBy("tree").agg(F.sum("g").alias("all"))
    shares = gains.join(trees, "tree").where(F.col("all") > 0).groupBy("feature").agg(F.sum(F.col("g") / F.col("all")).alias("s"))
    total = shares.agg(F.sum("s").alias("t"))
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "feature int, name string")  # one row for each feature
    found = names.join(shares, "feature", "left").join(F.broadcast(total), F.lit(True), "left")
    return found.select(F.col("name").alias("feature"), F.coalesce(F.col("s") / F.col("t"), F.lit(0.0)).alias("importance"))
