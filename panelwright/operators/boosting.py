"""Boosted trees by second-order histograms, with an L2 penalty on leaves.

Each round takes gradient and hessian of the logistic loss of every row, adds them up
per (node, feature, bin), and splits level by level where

    GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)

is largest; a leaf is -rate * G / (H + l2). Rows are drawn per round by a hash of their
id, columns per tree by a hash of their place. Sums are whole multiples of a power of
two that doubles hold exactly, so a tree does not depend on partitions, and the two
ways to grow it give the same numbers:

- histograms by a Spark job per level, folded in each task and added up by a shuffle;
  the margins of rows are written every ``REFRESH`` rounds;
- a whole fit inside one task, where all binned rows are at most ``TASK_CELLS`` bytes;
  histograms of a sibling are then those of the parent less the other's.

Bins come from a mergeable sketch of each feature that takes the weights of rows in. Trees are a table of nodes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.quantile_sketch import quantiles, sketch
from panelwright.session import materialize, ship_package
from panelwright.sources.state import read_table, write_table

TASK_CELLS = 32_000_000  # binned values that one task may hold
REFRESH = 20  # rounds between two writes of the margins
LEAST_GAIN = 1e-6
NODE_SCHEMA = (
    "tree int, id int, left int, right int, feature int, threshold double, output double, cover double"
)


@dataclass(frozen=True)
class BoosterParams:
    rounds: int = 300
    depth: int = 6
    rate: float = 0.05
    subsample: float = 0.8
    colsample: float = 0.8
    l2: float = 1.0
    least_hessian: float = 1.0
    bins: int = 256
    seed: int = 42

    def __post_init__(self) -> None:
        if not 2 <= self.bins <= 256:
            raise ValueError(f"bins must be in 2..256; got {self.bins}")


# -- bins -----------------------------------------------------------------------


def bin_edges(rows: DataFrame, bins: int, accuracy: int = 32) -> list[np.ndarray]:
    """Upper ends of all bins but the last, per feature of the array ``x``.

    They cut the weight ``w`` of the rows evenly, by a sketch with ``accuracy`` points for
    each bin. Returns features * bins numbers at most.
    """
    cells = rows.select("w", F.posexplode("x").alias("feature", "x"))
    summaries = sketch(cells, weight="w", points=accuracy * bins)
    found = quantiles(summaries, [i / bins for i in range(1, bins)]).collect()
    edges = {r.feature: np.unique(np.array(r.quantiles, dtype=np.float64)) for r in found}
    width = rows.select(F.size("x").alias("n")).first()
    return [edges.get(j, np.zeros(0)) for j in range(width.n if width else 0)]


def binned_rows(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """key (hash of the id), y, w, and the bins of a row as one byte each."""
    shared = rows.sparkSession.sparkContext.broadcast(edges)
    ship_package(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        for batch in batches:
            n = len(batch)
            x = batch.column("x").flatten().to_numpy().reshape(n, len(cuts))
            out = np.empty((n, len(cuts)), dtype=np.uint8)
            for j, e in enumerate(cuts):
                out[:, j] = np.searchsorted(e, x[:, j])
            ends = np.arange(n + 1, dtype=np.int32) * len(cuts)
            packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(out.tobytes())])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("key", "y", "w")], packed], names=["key", "y", "w", "bins"])

    return rows.select("key", "y", "w", "x").mapInArrow(run, "key bigint, y double, w double, bins binary")


# -- shared by both ways to grow a tree -------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function, for draws that depend on their key alone."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(key: np.ndarray, round_no: int, p: BoosterParams) -> np.ndarray:
    """Which rows take part in a round."""
    if p.subsample >= 1.0:
        return np.ones(len(key), dtype=bool)
    salt = mixed(np.array([p.seed * 1_000_003 + round_no], dtype=np.uint64))
    return (mixed(key.view(np.uint64) ^ salt) >> np.uint64(11)).astype(np.float64) < p.subsample * 2.0**53


def columns_of(width: int, round_no: int, p: BoosterParams) -> np.ndarray:
    """The columns of a round's tree, in order."""
    n = max(1, int(round(p.colsample * width)))
    salt = np.uint64((p.seed * 7_368_787 + round_no * 1_000_033) % (1 << 62))
    order = np.argsort(mixed(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt), kind="stable")
    return np.sort(order[:n])


def unit_of(total_weight: float) -> float:
    """A power of two such that sums over all rows stay exact in a double."""
    return 2.0 ** min(40, 51 - int(np.ceil(np.log2(total_weight + 2))))


def gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian in whole units."""
    chance = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(w * (chance - y) * unit), np.rint(np.maximum(w * chance * (1.0 - chance), 1e-16) * unit)


def best_splits(g: np.ndarray, h: np.ndarray, n_edges: np.ndarray, unit: float, p: BoosterParams):
    """column, bin, gain, GL, HL of each node for histograms [node, column, bin]; a gain of -inf or so if nothing gains.

    Ties go to the earlier column, then the lower bin.
    """
    total_g, total_h = g[:, 0].sum(axis=1)[:, None, None] / unit, h[:, 0].sum(axis=1)[:, None, None] / unit
    gl, hl = np.cumsum(g, axis=2)[:, :, :-1] / unit, np.cumsum(h, axis=2)[:, :, :-1] / unit
    gr, hr = total_g - gl, total_h - hl
    gain = gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - total_g * total_g / (total_h + p.l2)
    allowed = (hl >= p.least_hessian) & (hr >= p.least_hessian) & (np.arange(g.shape[2] - 1) < n_edges[:, None])
    gain = np.where(allowed, gain, -np.inf).reshape(len(g), -1)
    at, each = np.argmax(gain, axis=1), np.arange(len(g))
    column, cut = np.divmod(at, g.shape[2] - 1)
    return column, cut, gain[each, at], gl[each, column, cut], hl[each, column, cut]


def best_split(g: np.ndarray, h: np.ndarray, n_edges: np.ndarray, unit: float, p: BoosterParams):
    """(column, bin, gain, GL, HL) for histograms [column, bin]; None if nothing gains."""
    column, cut, gain, gl, hl = (v[0] for v in best_splits(g[None], h[None], n_edges, unit, p))
    return (int(column), int(cut), float(gain), float(gl), float(hl)) if gain > LEAST_GAIN else None


class Tree:
    """A tree while it grows: arrays over its nodes; -1 stands for no child or feature."""

    def __init__(self):
        self.left, self.right, self.feature, self.cut, self.g, self.h = [-1], [-1], [-1], [-1], [0.0], [0.0]

    def split(self, node: int, feature: int, cut: int, gl: float, hl: float) -> tuple[int, int]:
        first = len(self.left)
        self.left[node], self.right[node], self.feature[node], self.cut[node] = first, first + 1, feature, cut
        for g, h in ((gl, hl), (self.g[node] - gl, self.h[node] - hl)):
            for values, value in zip((self.left, self.right, self.feature, self.cut, self.g, self.h), (-1, -1, -1, -1, g, h)):
                values.append(value)
        return first, first + 1

    def outputs(self, p: BoosterParams) -> np.ndarray:
        return -p.rate * np.array(self.g) / (np.array(self.h) + p.l2)

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node of each row so far."""
        left, right, feature, cut = (np.array(v) for v in (self.left, self.right, self.feature, self.cut))
        at = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins))
        while len(rows):
            node = at[rows]
            inner = left[node] >= 0
            rows, node = rows[inner], node[inner]
            goes_left = bins[rows, feature[node]] <= cut[node]
            at[rows] = np.where(goes_left, left[node], right[node])
        return at

    def rows(self, tree: int, edges: list[np.ndarray], p: BoosterParams) -> Iterator[tuple]:
        for i, output in enumerate(self.outputs(p).tolist()):
            f = self.feature[i]
            threshold = float(edges[f][self.cut[i]]) if f >= 0 else None
            yield tree, i, self.left[i], self.right[i], f, threshold, output, self.h[i]


# -- one task ---------------------------------------------------------------------


def histograms(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``g`` and ``h`` per [slot, column, bin]."""
    out = np.zeros((2, slots, bins.shape[1], size))
    for j in range(bins.shape[1]):
        cell = slot * size + bins[:, j]
        out[0, :, j] = np.bincount(cell, g, slots * size).reshape(slots, size)
        out[1, :, j] = np.bincount(cell, h, slots * size).reshape(slots, size)
    return out[0], out[1]


def fit_rows(key, y, w, bins: np.ndarray, edges: list[np.ndarray], unit: float, p: BoosterParams) -> Iterator[Tree]:
    """All trees of a fit, for rows that are at hand."""
    n_edges = np.array([len(e) for e in edges])
    size = int(n_edges.max(initial=0)) + 1
    margin = np.zeros(len(y))
    for round_no in range(p.rounds):
        g, h = gradients(margin, y, w, unit)
        taken = drawn(key, round_no, p)
        used = np.flatnonzero(taken)
        columns = columns_of(bins.shape[1], round_no, p)
        some, g, h = np.ascontiguousarray(bins[used][:, columns]), g[used], h[used]
        cells, tree = some.ravel(), Tree()
        tree.g[0], tree.h[0] = g.sum() / unit, h.sum() / unit
        at = np.zeros(len(used), dtype=np.int64)
        nodes, hg, hh = np.zeros(0, dtype=np.int64), None, None  # open nodes and their histograms
        if size > 1 and len(used):
            nodes, (hg, hh) = np.zeros(1, dtype=np.int64), histograms(some, at, g, h, 1, size)
        for level in range(p.depth):
            # A node with less hessian than two children need has no split.
            able = np.flatnonzero(hh[:, 0].sum(axis=1) / unit >= 2 * p.least_hessian) if len(nodes) else nodes
            if not len(able):
                break
            nodes, hg, hh = nodes[able], hg[able], hh[able]
            column, cut, gain, gl, hl = best_splits(hg, hh, n_edges[columns], unit, p)
            split = np.flatnonzero(gain > LEAST_GAIN)
            if not len(split):
                break
            first = np.full(len(tree.left), -1)
            by_column, by_cut = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
            for i in split.tolist():
                node = int(nodes[i])
                first[node] = tree.split(node, int(columns[column[i]]), int(cut[i]), float(gl[i]), float(hl[i]))[0]
                by_column[node], by_cut[node] = column[i], cut[i]
            own = first[at]
            moved = np.flatnonzero(own >= 0)
            own = at[moved]
            at[moved] = first[own] + (cells[moved * len(columns) + by_column[own]] > by_cut[own])
            if level + 1 == p.depth:
                break
            # Rows of the smaller child are added up; the other is what is left of the parent.
            pairs = first[nodes[split]]
            rows_of = np.bincount(at[moved], minlength=len(tree.left))
            left_is_small = 2 * rows_of[pairs] <= rows_of[pairs] + rows_of[pairs + 1]
            slot = np.full(len(tree.left), -1)
            slot[pairs + ~left_is_small] = np.arange(len(pairs))
            rows = moved[slot[at[moved]] >= 0]
            small = histograms(some[rows], slot[at[rows]], g[rows], h[rows], len(pairs), size)
            both = []
            for part, whole in zip(small, (hg[split], hh[split])):
                rest, on_left = whole - part, left_is_small[:, None, None]
                both.append(np.stack([np.where(on_left, part, rest), np.where(on_left, rest, part)], axis=1).reshape(-1, *part.shape[1:]))
            nodes, (hg, hh) = np.stack([pairs, pairs + 1], axis=1).ravel(), both
        outputs, others = tree.outputs(p), np.flatnonzero(~taken)
        margin[used] += outputs[at]
        margin[others] += outputs[tree.places(bins[others])]
        yield tree


def _unpacked(batch: pa.RecordBatch, width: int):
    raw = np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(len(batch), width)
    return batch.column("key").to_numpy(), batch.column("y").to_numpy(), batch.column("w").to_numpy(), raw


def _fit_in_task(binned: DataFrame, edges, unit: float, p: BoosterParams) -> list[tuple]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpacked(b, len(edges)) for b in batches]
        if not parts:
            return
        key, y, w, bins = (np.concatenate(c) for c in zip(*parts))
        for t, tree in enumerate(fit_rows(key, y, w, bins, edges, unit, p)):
            yield pa.RecordBatch.from_pylist([dict(zip(NAMES, row)) for row in tree.rows(t, edges, p)], schema=NODE_ARROW)

    found = binned.coalesce(1).mapInArrow(run, NODE_SCHEMA)
    return sorted(tuple(r) for r in found.collect())  # rounds * 2^(depth + 1) nodes at most


NAMES = [c.split(" ")[0] for c in NODE_SCHEMA.split(", ")]
NODE_ARROW = pa.schema([(n, pa.int32() if i < 5 else pa.float64()) for i, n in enumerate(NAMES)])


# -- many tasks -------------------------------------------------------------------


def _fit_in_jobs(binned: DataFrame, edges, unit: float, p: BoosterParams) -> list[tuple]:
    spark = binned.sparkSession
    n_edges = np.array([len(e) for e in edges])
    size, width = int(n_edges.max(initial=0)) + 1, len(edges)
    state = materialize(binned.withColumn("margin", F.lit(0.0)), "booster-rows")
    out, since = [], []  # trees that the margins of ``state`` do not have yet
    for round_no in range(p.rounds):
        columns = columns_of(width, round_no, p)
        tree, level_nodes = Tree(), [0]
        for level in range(p.depth):
            found = _level(state, since, tree, level_nodes, columns, round_no, size, width, n_edges, unit, p)
            if level == 0 and found:
                tree.g[0], tree.h[0] = found[0].g, found[0].h
            below = []
            for r in found:  # one row per node
                if r.column is not None:
                    below += tree.split(r.node, int(columns[r.column]), r.cut, r.gl, r.hl)
            level_nodes = below
            if not below:
                break
        out += tree.rows(round_no, edges, p)
        since.append(tree)
        if len(since) == REFRESH and round_no + 1 < p.rounds:
            state, since = materialize(_with_margins(state, since, width, p), "booster-rows"), []
    return out


def _margins(margin: np.ndarray, bins: np.ndarray, since: list[Tree], p: BoosterParams) -> np.ndarray:
    for tree in since:
        margin = margin + tree.outputs(p)[tree.places(bins)]
    return margin


def _with_margins(state: DataFrame, since: list[Tree], width: int, p: BoosterParams) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast(since)  # REFRESH trees

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _unpacked(batch, width)[3]
            margin = _margins(batch.column("margin").to_numpy(), bins, shared.value, p)
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

    return state.mapInArrow(run, state.schema)


def _level(state, since, tree, nodes, columns, round_no, size, width, n_edges, unit, p: BoosterParams) -> list:
    """(node, g, h, column, cut, gl, hl) of each of ``nodes``; column null: no split."""
    spark = state.sparkSession
    shared = spark.sparkContext.broadcast((since, tree))  # REFRESH trees and one

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        since, tree = shared.value
        slot = np.full(len(tree.left), -1)
        slot[nodes] = np.arange(len(nodes))
        total = np.zeros((2, len(nodes), len(columns), size))
        for batch in batches:
            key, y, w, bins = _unpacked(batch, width)
            margin = _margins(batch.column("margin").to_numpy(), bins, since, p)
            g, h = gradients(margin, y, w, unit)
            own = slot[tree.places(bins)]
            rows = np.flatnonzero((own >= 0) & drawn(key, round_no, p))
            hists = histograms(bins[np.ix_(rows, columns)], own[rows], g[rows], h[rows], len(nodes), size)
            total += np.stack(hists)
        cells = np.flatnonzero(total[1].ravel())
        slot_of, column, cut = np.unravel_index(cells, total[1].shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(nodes, dtype=np.int32)[slot_of]), pa.array(column.astype(np.int32)), pa.array(cut.astype(np.int32)),
             pa.array(total[0].ravel()[cells]), pa.array(total[1].ravel()[cells])],
            names=["node", "column", "bin", "g", "h"],
        )

    cells = state.mapInArrow(add_up, "node int, column int, bin int, g double, h double")
    # Doubles that hold whole numbers: their sum does not depend on the order.
    whole = cells.groupBy("node", "column", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        """One node: at most columns * bins rows."""
        g, h = np.zeros((len(columns), size)), np.zeros((len(columns), size))
        g[part["column"], part["bin"]], h[part["column"], part["bin"]] = part["g"], part["h"]
        found = best_split(g, h, n_edges[columns], unit, p) or (None, None, None, None, None)
        column, cut, _, gl, hl = found
        row = (int(part["node"].iloc[0]), g[0].sum() / unit, h[0].sum() / unit, column, cut, gl, hl)
        return pd.DataFrame([row], columns=["node", "g", "h", "column", "cut", "gl", "hl"]).astype({"column": "Int32", "cut": "Int32"})

    best = whole.groupBy("node").applyInPandas(choose, "node int, g double, h double, column int, cut int, gl double, hl double")
    found = sorted(best.collect(), key=lambda r: r.node)
    shared.destroy()
    return found


# -- the model --------------------------------------------------------------------


class BoostedTrees:
    """A fitted booster: one row per node, and log-odds as the sum over its trees."""

    def __init__(self, nodes: list[tuple], n_features: int, depth: int):
        self.nodes, self.numFeatures, self.depth = nodes, n_features, depth
        self._shared = None

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    def log_odds(self, rows: DataFrame, name: str, features: str = "features") -> DataFrame:
        """Add the log-odds of the positive class; narrow, so it also runs on a stream."""
        ship_package(rows.sparkSession)
        if self._shared is None:
            columns = list(zip(*self.nodes)) if self.nodes else [()] * len(NAMES)
            at = {c: np.array(v) for c, v in zip(NAMES, columns)}
            # Nodes of all trees one behind the other; a child is an offset into them.
            first = np.flatnonzero(at["id"] == 0)
            base = np.repeat(first, np.diff(np.append(first, len(at["id"]))))
            left, right = (np.where(at[c] >= 0, at[c] + base, -1) for c in ("left", "right"))
            threshold = np.array([np.nan if t is None else t for t in at["threshold"]])
            self._shared = rows.sparkSession.sparkContext.broadcast((first, left, right, at["feature"], threshold, at["output"]))
        shared, width = self._shared, self.numFeatures

        def run(x: pd.Series) -> pd.Series:
            first, left, right, feature, threshold, output = shared.value
            values = np.array(x.tolist(), dtype=np.float64).reshape(len(x), width)
            total, each = np.zeros(len(values)), np.arange(len(values))
            for root in first.tolist():
                node, rows = np.full(len(values), root), each
                while len(rows):
                    rows = rows[left[node[rows]] >= 0]
                    own = node[rows]
                    node[rows] = np.where(values[rows, feature[own]] <= threshold[own], left[own], right[own])
                total += output[node]
            return pd.Series(total)

        return rows.withColumn(name, F.pandas_udf(run, "double")(vector_to_array(features)))

    def save(self, path: str) -> None:
        write_table(self.table(SparkSession.active()).coalesce(1), f"{path}/nodes")
        described = SparkSession.active().createDataFrame([(self.numFeatures, self.depth)], "n_features int, depth int")
        write_table(described, f"{path}/shape")

    @classmethod
    def load(cls, path: str) -> BoostedTrees:
        spark = SparkSession.active()
        nodes = sorted(tuple(r) for r in read_table(spark, f"{path}/nodes").collect())
        shape = read_table(spark, f"{path}/shape").first()
        return cls(nodes, shape.n_features, shape.depth)


class SecondOrderBooster:
    """Fits ``(sample_id, code, w_gbt, features)``."""

    def __init__(self, params: BoosterParams | None = None, task_cells: int = TASK_CELLS):
        self.params, self.task_cells = params or BoosterParams(), task_cells

    def fit(self, rows: DataFrame) -> BoostedTrees:
        p = self.params
        given = rows.select(
            F.xxhash64(F.col("sample_id").cast("string")).alias("key"), F.col("code").cast("double").alias("y"),
            F.col("w_gbt").cast("double").alias("w"), vector_to_array("features").alias("x"),
        )
        edges = bin_edges(given, p.bins)
        if not edges:
            raise ValueError("boosting needs rows and features")
        binned = materialize(binned_rows(given, edges), "booster-bins")
        seen = binned.agg(F.count("*").alias("n"), F.sum("w").alias("w")).first()
        fit = _fit_in_task if seen.n * len(edges) <= self.task_cells else _fit_in_jobs
        return BoostedTrees(fit(binned, edges, unit_of(seen.w), p), len(edges), p.depth)


