"""Score rows with tree ensembles that are tables of nodes, in the JVM alone.

A node is (tree, id, left, right, feature, threshold, output); ids of a tree count
from 0, its root, and ``left`` is negative in a leaf. A row goes left where its value
is at most the threshold; a NaN goes right. Its score is the sum of the outputs of the
leaves it reaches, tree by tree.

Trees travel as array columns in one value of at most ``PACKED_NODES`` nodes, and
``aggregate`` walks them, so scoring is a row-level expression: no Python worker, no
shuffle, no state, on batches and on streams. A larger model is cut into several such
packs at the borders of trees. A batch is written after each pack, so an executor never
holds more than one; a stream carries them all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.attribution import node_table
from panelwright.operators.ensemble import StackedEnsemble
from panelwright.session import materialize
from panelwright.sources.state import read_table, write_table

PACKED_NODES = 1 << 18  # 28 bytes each
NODE_COLUMNS = ["tree", "id", "left", "right", "feature", "threshold", "output"]
PACK_SCHEMA = (
    "trees array<struct<depth int, left array<int>, right array<int>, feature array<int>, "
    "threshold array<double>, output array<double>>>"
)


def node_columns(nodes: DataFrame) -> DataFrame:
    kinds = ["int"] * 5 + ["double"] * 2
    return nodes.select(*[F.col(c).cast(kind).alias(c) for c, kind in zip(NODE_COLUMNS, kinds)])


def packs(nodes: DataFrame, most: int = PACKED_NODES) -> list[DataFrame]:
    """The model as tables of one row, with at most ``most`` nodes, but one tree at least, in each."""
    given = node_columns(nodes)
    sizes = given.groupBy("tree").count().orderBy("tree").collect()  # one row per tree
    groups: list[list[int]] = []
    room = 0
    for r in sizes:
        if not groups or r["count"] > room:
            groups.append([])
            room = most
        groups[-1].append(r.tree)
        room -= r["count"]
    # Trees of a pack are neighbours in order, so a range finds them.
    return [_pack(given.where(F.col("tree").between(g[0], g[-1]))) for g in groups]


def _pack(nodes: DataFrame) -> DataFrame:
    table = nodes.toPandas().sort_values(["tree", "id"])  # bounded by the size of a pack
    trees = []
    for tree, part in table.groupby("tree", sort=True):
        left, right, feature = (part[c].fillna(-1).to_numpy(np.int32) for c in ("left", "right", "feature"))
        inner = left >= 0
        ends = np.concatenate([left[inner], right[inner]])
        if not np.array_equal(part["id"], np.arange(len(part))) or not np.array_equal(np.sort(ends), np.arange(1, len(part))):
            raise ValueError(f"the nodes of tree {tree} do not form one tree with ids from 0")
        trees.append((
            _depth(left, right), left.tolist(), right.tolist(), feature.tolist(),
            part["threshold"].fillna(0.0).tolist(), part["output"].tolist(),
        ))
    return nodes.sparkSession.createDataFrame([(trees,)], PACK_SCHEMA)


def _depth(left: np.ndarray, right: np.ndarray) -> int:
    depth, level = 0, np.array([0])
    while True:
        level = level[left[level] >= 0]
        if not len(level):
            return depth
        depth, level = depth + 1, np.concatenate([left[level], right[level]])


def leaf_sum(trees: Column, x: Column, start: Column) -> Column:
    """``start`` and the outputs of the leaves that the array ``x`` reaches."""

    def reached(t: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            goes_left = F.get(x, F.get(t["feature"], node)) <= F.get(t["threshold"], node)
            below = F.when(goes_left, F.get(t["left"], node)).otherwise(F.get(t["right"], node))
            return F.when(F.get(t["left"], node) < 0, node).otherwise(below)

        return F.get(t["output"], F.aggregate(F.array_repeat(F.lit(0), t["depth"]), F.lit(0), step))

    return F.aggregate(trees, start, lambda total, t: total + reached(t))


def add_score(rows: DataFrame, model: list[DataFrame], name: str, x: str) -> DataFrame:
    """Add the sum over all trees for the array ``x``, 0 for a model without trees."""
    out = rows.withColumn(name, F.lit(0.0))
    for i, pack in enumerate(model):
        # One value, held by the plan: no join and nothing that grows with the rows.
        out = out.withColumn("_trees", pack.scalar()).withColumn(name, leaf_sum(F.col("_trees"), F.col(x), F.col(name))).drop("_trees")
        if i + 1 < len(model) and not rows.isStreaming:
            out = materialize(out, "scores")
    return out


@dataclass
class NodeStack:
    """A fitted stack as plain tables; ``predict`` returns the columns of ``StackedEnsemble.predict``.

    Forest outputs add up to the probability of the larger class, booster outputs to its
    log-odds; ``weights`` are intercept, forest and booster weight of the logistic model.
    """

    classes: list[str]
    forest: DataFrame
    booster: DataFrame
    weights: tuple[float, float, float]
    most: int = PACKED_NODES

    def __post_init__(self) -> None:
        if len(self.classes) != 2:
            raise ValueError(f"a stack needs exactly two classes; got {self.classes}")
        self._packs: tuple[list[DataFrame], list[DataFrame]] | None = None

    @classmethod
    def of(cls, spark: SparkSession, stack: StackedEnsemble) -> NodeStack:
        stack._fitted()
        forest, booster = (materialize(node_columns(node_table(m, spark)), "nodes") for m in (stack.rf, stack.gbt))
        weights = (float(stack.meta.intercept), *(float(v) for v in stack.meta.coefficients))
        return cls(list(stack.classes), forest, booster, weights)

    def predict(self, rows: DataFrame) -> DataFrame:
        if self._packs is None:
            self._packs = packs(self.forest, self.most), packs(self.booster, self.most)
        forest, booster = self._packs
        out = rows.withColumn("_x", vector_to_array("features"))
        out = add_score(add_score(out, forest, "p_rf", "_x"), booster, "p_gbt", "_x")
        out = out.withColumn("p_gbt", 1.0 / (1.0 + F.exp(-F.col("p_gbt"))))
        base, w_rf, w_gbt = (F.lit(w) for w in self.weights)
        odds = base + w_rf * F.col("p_rf") + w_gbt * F.col("p_gbt")
        names = F.array(*[F.lit(name) for name in self.classes])
        return (
            out.withColumn("score", 1.0 / (1.0 + F.exp(-odds)))
            .withColumn("probabilities", F.array(1.0 - F.col("score"), F.col("score")))
            .withColumn("predicted_code", F.when(F.col("score") > 1.0 - F.col("score"), 1).otherwise(0))
            .withColumn("prediction", names[F.col("predicted_code")])
            .drop("_x")
        )

    def save(self, path: str) -> None:
        write_table(self.forest, f"{path}/forest")
        write_table(self.booster, f"{path}/booster")
        described = SparkSession.active().createDataFrame(
            [(self.classes, list(self.weights))], "classes array<string>, weights array<double>"
        )
        write_table(described, f"{path}/weights")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NodeStack:
        described = read_table(spark, f"{path}/weights").first()
        forest, booster = read_table(spark, f"{path}/forest"), read_table(spark, f"{path}/booster")
        return cls(list(described.classes), forest, booster, tuple(described.weights))
