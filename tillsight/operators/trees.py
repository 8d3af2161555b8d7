"""Fitted trees as tables of nodes, and their probabilities rebuilt by walking the nodes inside Spark expressions.

One fit then serves every prefix of an ensemble: the value of each tree is an array column, and its running means or sums are those of
the ensemble after one tree, two trees and so on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialise, new_folder


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(tree, node, feature, threshold, left, right, weight, rows, positives, value) of a pipeline's tree, forest or boosted trees.

    A leaf has feature -1 and null children. ``value`` is the share of positives for a classifier, the prediction for boosted trees. All
    features are continuous: at most the threshold goes left.
    """
    stage = model.stages[-1]
    path = new_folder(spark, "trees")
    stage.write().save(path)
    raw = spark.read.parquet(f"{path}/data")
    if "treeID" in raw.columns:
        weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(stage.treeWeights)], "treeID int, weight double")
        raw = raw.select("treeID", "nodeData.*").join(F.broadcast(weights), "treeID")
    else:
        raw = raw.select(F.lit(0).alias("treeID"), "*", F.lit(1.0).alias("weight"))
    inner = F.col("leftChild") >= 0
    stats = F.col("impurityStats")
    boosted = stage.__class__.__name__.startswith("GBT")
    value = F.col("prediction") if boosted else stats[1] / (stats[0] + stats[1])
    return materialise(raw.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).otherwise(-1).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"), F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"), "weight", F.lit(None).cast("double").alias("rows") if boosted else (stats[0] + stats[1]).alias("rows"),
        F.lit(None).cast("double").alias("positives") if boosted else stats[1].alias("positives"), value.alias("value")), "nodes")


def _packed(nodes: DataFrame) -> Column:
    """All trees as one array of structs of arrays by node: a scalar subquery. Its size is the model's, whatever the data."""
    by_node = F.sort_array(F.collect_list(F.struct("node", "feature", "threshold", "left", "right", "value")))
    trees = nodes.groupBy("tree", "weight").agg(by_node.alias("n"))
    field = lambda c: F.transform("n", lambda x: x[c]).alias(c)
    one = F.struct("tree", "weight", *[field(c) for c in ("feature", "threshold", "left", "right", "value")])
    return trees.agg(F.sort_array(F.collect_list(one)).alias("t")).scalar()


def walk(df: DataFrame, nodes: DataFrame, cols: Sequence[str], out: str = "values") -> DataFrame:
    """Add an array with each tree's weighted value for the row: no row is multiplied by trees and nothing is shuffled.

    Missing features count as 0, as in fitting.
    """
    depth = _depth(nodes)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    ready = df.withColumns({"_trees": _packed(nodes), "_x": x})
    step = "(at, i) -> IF(get(t.feature, at) < 0, at, IF(get(_x, get(t.feature, at)) <= get(t.threshold, at), get(t.left, at), get(t.right, at)))"
    leaf = f"aggregate(sequence(1, {depth}), 0, {step})" if depth else "0"
    return ready.withColumn(out, F.expr(f"transform(_trees, t -> t.weight * get(t.value, {leaf}))")).drop("_trees", "_x")


def _depth(nodes: DataFrame) -> int:
    """Longest way from a root to a leaf; one pass over the nodes a level."""
    level = nodes.where("node = 0").select("tree", "left", "right")
    depth, children = 0, nodes.select("tree", F.col("node").alias("child"), "left", "right")
    while True:
        below = level.where("left IS NOT NULL").select("tree", F.explode(F.array("left", "right")).alias("child"))
        level = materialise(below.join(F.broadcast(children), ["tree", "child"]).select("tree", "left", "right"), "level")
        if level.isEmpty():
            return depth
        depth += 1


def forest_probability(values: str, k: int | Column | None = None) -> Column:
    """Mean of the first ``k`` trees' values (all of them without k)."""
    v = F.col(values) if k is None else F.slice(values, 1, k)
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)


def boosted_probability(values: str, k: int | Column | None = None) -> Column:
    """1 / (1 + exp(-2 F)) with the sum of the first ``k`` rounds' values."""
    v = F.col(values) if k is None else F.slice(values, 1, k)
    return 1.0 / (1.0 + F.exp(-2.0 * F.aggregate(v, F.lit(0.0), lambda a, x: a + x)))


def prefix_scores(walked: DataFrame, counts: Sequence[int], keep: Sequence[str], values: str = "values", boosted: bool = False) -> DataFrame:
    """(keep..., n_trees, score) for ensembles of the first trees, ``counts`` of them, from one model.

    A row's values are added up once: each sum goes on from that of the next smaller count.
    """
    rows, before, upto = walked.select(*keep, values), F.lit(0.0), 0
    for k in sorted(set(counts)):
        # Sums of their own projections: used twice each, they are not repeated in the next.
        rows = rows.withColumn(f"_s{k}", F.aggregate(F.slice(values, upto + 1, k - upto), before, lambda a, x: a + x))
        before, upto = F.col(f"_s{k}"), k
    score = (lambda k: 1.0 / (1.0 + F.exp(-2.0 * F.col(f"_s{k}")))) if boosted else (lambda k: F.col(f"_s{k}") / F.least(F.size(values), F.lit(k)))
    each = F.array(*[F.struct(F.lit(k).alias("n_trees"), score(k).alias("score")) for k in counts])
    return rows.select(*keep, F.inline(each))
