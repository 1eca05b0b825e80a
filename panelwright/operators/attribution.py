"""Exact path-dependent Tree SHAP as a Spark job.

Each root-to-leaf path of the model is one row: the interval that the path
allows for each feature on it, and the share of training weight that follows
the path at those splits. Samples stay in blocks of bounded size, and the paths of a
model are streamed past each block.

For a path with leaf value v, features M, d = |M|, indicator o_j (the sample is
inside the interval of j) and share z_j, the Shapley value of j is

    v (o_j - z_j) * integral_0^1  prod_{i in M, i != j} (z_i (1-t) + o_i t) dt

because the Shapley weights are Beta integrals. The integrand is a polynomial
of degree d - 1, so Gauss-Legendre nodes give the integral exactly.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import DEEPEST, AttributionConfig
from panelwright.operators.boosting import BoostedTrees
from panelwright.operators.ensemble import StackedEnsemble
from panelwright.operators.forest import GrownForest
from panelwright.operators.split import subsample
from panelwright.session import materialize, new_path, ship_package

log = logging.getLogger(__name__)

PATH_SCHEMA = (
    "tree int, leaf int, value double, base double, "
    "features array<int>, low array<double>, high array<double>, share array<double>"
)
BATCH_CELLS = 4_000_000  # samples * path entries held by a task at a time


def node_table(model, spark) -> DataFrame:
    """Nodes of a saved tree ensemble with their training weight (cover) and
    their output on the explained scale.

    Boosted trees explain log-odds of the positive class, and their cover is the sum
    of hessians; the forest explains its probability.
    """
    if isinstance(model, (BoostedTrees, GrownForest)):
        return model.table(spark)
    path = new_path(spark, "model")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    cover = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    output = F.col("impurityStats")[1] / cover / F.lit(float(model.getNumTrees))
    return nodes.select(
        F.col("treeID").alias("tree"), "id", cover.alias("cover"), output.alias("output"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )


def tree_paths(nodes: pd.DataFrame) -> pd.DataFrame:
    """Paths of one tree, which MLlib itself built as one object."""
    at = nodes.set_index("id")
    cover, output = at["cover"].to_dict(), at["output"].to_dict()
    left, right = at["left"].to_dict(), at["right"].to_dict()
    feature, threshold = at["feature"].to_dict(), at["threshold"].to_dict()
    tree = int(nodes["tree"].iloc[0])
    rows = []
    stack: list[tuple[int, dict]] = [(0, {})]
    while stack:
        node, steps = stack.pop()
        if left[node] < 0:
            share = [s[2] for s in steps.values()]
            rows.append((
                tree, int(node), float(output[node]), float(output[node]) * float(np.prod(share)),
                list(steps), [s[0] for s in steps.values()], [s[1] for s in steps.values()], share,
            ))
            continue
        f, cut = int(feature[node]), float(threshold[node])
        low, high, share = steps.get(f, (-np.inf, np.inf, 1.0))
        for child, interval in ((left[node], (low, min(high, cut))), (right[node], (max(low, cut), high))):
            part = share * cover[child] / cover[node]
            stack.append((child, {**steps, f: (*interval, part)}))
    columns = ["tree", "leaf", "value", "base", "features", "low", "high", "share"]
    return pd.DataFrame(rows, columns=columns)


def path_table(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("tree").applyInPandas(tree_paths, PATH_SCHEMA)


@dataclass
class PathBlock:
    """Paths with the same number of distinct features, as arrays [path, entry]."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def pack(paths: pd.DataFrame) -> list[PathBlock]:
    depth = paths["features"].map(len)
    blocks = []
    for d, part in paths[depth > 0].groupby(depth[depth > 0]):
        stacked = [np.array(part[c].tolist()) for c in ("features", "low", "high", "share")]
        blocks.append(PathBlock(*stacked, part["value"].to_numpy()))
    return blocks


def shapley(x: np.ndarray, blocks: list[PathBlock], out: np.ndarray) -> None:
    """Add the Shapley values of every sample to ``out`` [sample, feature]."""
    for block in blocks:
        n_paths, d = block.features.shape
        nodes, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
        nodes, weights = (nodes + 1) / 2, weights / 2
        step = max(1, BATCH_CELLS // (max(1, len(x)) * d))
        for start in range(0, n_paths, step):
            part = slice(start, start + step)
            which, z = block.features[part], block.share[part]
            v = x[:, which]
            o = ((v > block.low[part]) & (v <= block.high[part])).astype(np.float64)
            integral = np.zeros_like(o)
            for t, w in zip(nodes, weights):
                factor = z * (1 - t) + o * t
                integral += w * factor.prod(axis=2, keepdims=True) / factor
            phi = (block.value[part][:, None] * (o - z) * integral).reshape(len(x), -1)
            flat = which.ravel()
            order = np.argsort(flat, kind="stable")
            firsts = np.flatnonzero(np.r_[True, np.diff(flat[order]) > 0])
            out[:, flat[order][firsts]] += np.add.reduceat(phi[:, order], firsts, axis=1)


def explain_in_blocks(rows: DataFrame, paths: DataFrame, blocks: int, width: int, chunk: int) -> DataFrame:
    """``(sample_id, x, phi)``: each block of rows meets all paths, streamed past it.

    A task holds the rows of one block and ``chunk`` paths. Neither the driver
    nor an executor ever holds the whole model.
    """
    columns = [f.name for f in paths.schema]
    row = rows.select(
        F.pmod(F.xxhash64("sample_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "sample_id", "x",
        *[F.lit(None).cast(paths.schema[c].dataType).alias(c) for c in columns],
    )
    path = paths.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
        F.lit(None).cast("string").alias("sample_id"), F.lit(None).cast("array<double>").alias("x"), *columns,
    )
    slices = min(blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = row.unionByName(path).repartition(slices, "block").sortWithinPartitions("block", "kind", "tree", "leaf")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held, x, phi = None, [], None, None

        def done():
            # A block without rows, or rows without paths, which get zeros.
            table = pd.concat(held, ignore_index=True)
            values = phi if phi is not None else np.zeros((len(table), width))
            return table.assign(phi=list(values.astype(np.float32)))

        for batch in batches:
            for number, part in batch.groupby("block", sort=True):
                if number != block:
                    if held:
                        yield done()
                    block, held, x, phi = number, [], None, None
                of_rows, of_paths = part[part["kind"] == 0], part[part["kind"] == 1]
                if len(of_rows):
                    held.append(of_rows[["sample_id", "x"]])
                if not held or not len(of_paths):
                    continue
                if x is None:
                    x = np.stack([v for table in held for v in table["x"]])
                    phi = np.zeros((len(x), width))
                for low in range(0, len(of_paths), chunk):
                    shapley(x, pack(of_paths.iloc[low : low + chunk]), phi)
        if held:
            yield done()

    return met.mapInPandas(run, "sample_id string, x array<double>, phi array<float>")


class TreeAttribution:
    """Signed attributions of one base learner towards the positive class."""

    def __init__(self, stack: StackedEnsemble, names: list[str], config: AttributionConfig | None = None) -> None:
        if stack.meta is None:
            raise RuntimeError("the ensemble must be fitted before it can be explained")
        if len(stack.classes) != 2:
            raise ValueError(f"attribution needs two classes; got {stack.classes}")
        self.config = config or AttributionConfig()
        self.model = stack.gbt if self.config.learner == "gbt" else stack.rf
        if len(names) != self.model.numFeatures:
            raise ValueError(f"got {len(names)} names for {self.model.numFeatures} features")
        self.names = list(names)
        self.negative, self.positive = stack.classes
        self.base_value: float | None = None
        self.values: DataFrame | None = None  # sample_id, phi, x

    def fit(self, rows: DataFrame) -> TreeAttribution:
        """Explain ``(sample_id, features)``, or an exact subsample of it."""
        spark = rows.sparkSession
        ship_package(spark)
        c = self.config
        depth = self.model.depth if isinstance(self.model, (BoostedTrees, GrownForest)) else self.model.getOrDefault("maxDepth")
        if not isinstance(self.model, BoostedTrees) and depth >= DEEPEST:
            log.warning("explaining a forest of unlimited depth: work grows with its number of leaves")
        paths = materialize(path_table(node_table(self.model, spark)), "paths")
        self.base_value = float(paths.agg(F.sum("base")).first()[0])
        used = subsample(rows.select("sample_id", "features"), c.max_samples, seed=c.seed)
        used = materialize(used.select("sample_id", vector_to_array("features").alias("x")), "explained")
        blocks = max(1, -(-used.count() // c.rows_per_block))
        self.values = materialize(explain_in_blocks(used, paths, blocks, len(self.names), c.paths_per_chunk), "shap")
        return self

    def _fitted(self) -> DataFrame:
        if self.values is None:
            raise RuntimeError("TreeAttribution is not fitted: call fit() first")
        return self.values

    def long(self) -> DataFrame:
        """``(sample_id, feature, feature_pos, shap_value)``."""
        names = F.array(*[F.lit(n) for n in self.names])
        cells = self._fitted().select("sample_id", F.posexplode("phi").alias("feature_pos", "shap_value"))
        return cells.withColumn("feature", names[F.col("feature_pos")])

    def ranking(self) -> DataFrame:
        return rank_attributions(self.long())

    def top(self, n: int | None = None, direction: str | None = None) -> DataFrame:
        n = self.config.n_top if n is None else n
        return top_ranked(self.ranking(), n, direction)

    def summary_points(self) -> DataFrame:
        """Per-sample attribution and value of the most important features."""
        shown = materialize(self.top(self.config.max_display).drop("mean_shap"), "shown")
        pairs = self._fitted().select(
            "sample_id", F.posexplode(F.arrays_zip("phi", "x")).alias("feature_pos", "pair")
        )
        return pairs.join(shown, "feature_pos").select(
            "sample_id", "feature", F.col("pair.phi").alias("shap_value"), F.col("pair.x").alias("feature_value"),
            "mean_abs_shap",
        )

    def bars(self) -> DataFrame:
        return self.top(self.config.max_display).select("feature", "mean_abs_shap")


def rank_attributions(long: DataFrame) -> DataFrame:
    """Mean and mean absolute attribution per feature, largest size first."""
    value = F.col("shap_value").cast("double")
    table = long.groupBy("feature", "feature_pos").agg(
        F.avg(value).alias("mean_shap"), F.avg(F.abs(value)).alias("mean_abs_shap")
    )
    return table.orderBy(F.desc("mean_abs_shap"), "feature_pos")


def top_ranked(ranking: DataFrame, n: int, direction: str | None = None) -> DataFrame:
    """The first n by size, or by signed mean; the sign orders, it does not filter."""
    orders = {
        None: F.desc("mean_abs_shap"),
        "positive": F.desc("mean_shap"),
        "negative": F.asc("mean_shap"),
    }
    if direction not in orders:
        raise ValueError(f"direction must be None, 'positive' or 'negative'; got {direction!r}")
    return ranking.orderBy(orders[direction], "feature_pos").limit(n)
