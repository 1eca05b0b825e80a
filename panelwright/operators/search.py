"""All trials of a search over stacks at once, where one task can hold the binned rows.

A trial is a stack per outer fold, and a stack has base learners for each of its inner
folds and for all its rows: a *set* of rows to learn from and one to score. All trials
share the sets, so rows are placed, binned and dealt out once for all of them, and each
task grows the models of one set and sums up what they give to the rows to score. No
model is written or sent anywhere.

Draws of a forest are seeded by tree, level by level. So the forest of a trial is the
first trees, cut at its depth, of the largest forest with the same ``min_leaf``: each
distinct tree is grown once and walked for all trials that have it.

What is found is what a fit per trial and fold finds: the same folds, edges, trees and
weights, the same meta-model and the same metric.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.config import DEEPEST, EnsembleConfig
from panelwright.operators.boosting import TASK_CELLS, fit_rows, unit_of
from panelwright.operators.evaluate import ranking_metrics
from panelwright.operators.forest import BATCH_ROWS, MANY_TREES, ForestParams, grow_many
from panelwright.operators.quantile_sketch import quantiles, sketch
from panelwright.operators.split import hash_ranks
from panelwright.session import materialize, new_path, ship_package

PARTS = 4  # tasks that share the models of a set, at least
HELD_OUT = -1  # the inner fold of rows that the stack of an outer fold does not see
SCORES = "trial int, outer int, slot int, row array<bigint>, code array<int>, rf array<double>, gbt array<double>"
SCORES_ARROW = pa.schema([
    *[(c, pa.int32()) for c in ("trial", "outer", "slot")], ("row", pa.list_(pa.int64())), ("code", pa.list_(pa.int32())),
    ("rf", pa.list_(pa.float64())), ("gbt", pa.list_(pa.float64())),
])


def goes_together(draws: list[EnsembleConfig]) -> bool:
    """Whether the trials share their sets, and all of their forests are grown tree by tree."""
    return len({(d.folds, d.seed, d.max_bins) for d in draws}) == 1 and all(
        d.rf_trees >= MANY_TREES and d.max_bins <= 256 for d in draws
    )


def depth_of(c: EnsembleConfig) -> int:
    return DEEPEST if c.rf_max_depth is None else c.rf_max_depth


# -- one set --------------------------------------------------------------------


def forest_sums(y, w, bins: np.ndarray, held: np.ndarray, draws: list[EnsembleConfig], part: int, parts: int) -> np.ndarray:
    """[trial, row of ``held``]: what every ``parts``-th tree of the trial's forest gives, added up."""
    out = np.zeros((len(draws), len(held)))
    groups: dict[int, list[int]] = {}
    for i, d in enumerate(draws):
        groups.setdefault(d.rf_min_leaf, []).append(i)
    n_batch = max(1, BATCH_ROWS // max(1, len(y)))
    for min_leaf, trials in groups.items():
        own = list(range(part, max(draws[i].rf_trees for i in trials), parts))
        for at in range(0, len(own), n_batch):
            trees = own[at : at + n_batch]
            wanted = [(depth_of(draws[i]), i) for i in trials if draws[i].rf_trees > trees[0]]
            deepest = max(wanted)[0]
            c = draws[trials[0]]
            grown = grow_many(y, w, bins, trees, ForestParams(0, deepest, min_leaf, c.max_bins, c.seed))
            sizes = [len(t[0]) for t in grown]
            first = np.cumsum([0, *sizes[:-1]])
            left, feature, cut, output = (np.concatenate([t[j] for t in grown]) for j in range(4))
            left = np.where(left >= 0, left + np.repeat(first, sizes), -1)
            output = output.astype(np.float32)
            node = np.repeat(first, len(held))
            row, going = np.tile(np.arange(len(held)), len(trees)), np.arange(len(node))
            for depth in range(deepest + 1):
                stops = [i for d, i in wanted if d == depth]
                if stops:
                    given = output[node].reshape(len(trees), len(held))
                    for i in stops:
                        out[i] += given[: np.searchsorted(trees, draws[i].rf_trees)].sum(axis=0, dtype=np.float64)
                going = going[left[node[going]] >= 0]
                at_node = node[going]
                node[going] = left[at_node] + (held[row[going], feature[at_node]] > cut[at_node])
    return out


def booster_sums(key, y, w, bins: np.ndarray, held: np.ndarray, edges: list[np.ndarray], c: EnsembleConfig) -> np.ndarray:
    """The log-odds of each row of ``held``."""
    from panelwright.operators.ensemble import booster

    p, total = booster(c).params, np.zeros(len(held))
    for tree in fit_rows(key, y, w, bins, edges, unit_of(w.sum()), p):
        total += tree.outputs(p)[tree.places(held)]
    return total


# -- all sets -------------------------------------------------------------------


def placed_rows(data: DataFrame, high: str, outer_folds: int, c: EnsembleConfig) -> DataFrame:
    """``(outer, inner, row, key, code, x)``: each row once per outer fold, with its fold inside."""
    numbered = materialize(
        data.select(
            F.monotonically_increasing_id().alias("row"), "sample_id", "label", "search_fold",
            F.xxhash64(F.col("sample_id").cast("string")).alias("key"), (F.col("label") == high).cast("int").alias("code"),
            vector_to_array("features").alias("x"),
        ),
        "search-rows",
    )
    every = numbered.select("row", "sample_id", "label", "search_fold", F.explode(F.sequence(F.lit(0), F.lit(outer_folds - 1))).alias("outer"))
    # As ``stratified_folds`` does, for all outer folds in one pass.
    ranked = hash_ranks(every.where("outer != search_fold"), "sample_id", f"fold-{c.seed}", ("outer", "label"))
    inner = ranked.select("row", "outer", ((F.col("hash_rank") - 1) % c.folds).cast("int").alias("inner"))
    held = numbered.select("row", F.col("search_fold").alias("outer"), F.lit(HELD_OUT).alias("inner"))
    rows = inner.unionByName(held).join(numbered.select("row", "key", "code", "x"), "row")
    return materialize(rows.select("outer", "inner", "row", "key", "code", "x"), "search-placed")


def set_edges(placed: DataFrame, ratio: float, width: int, n_sets: int, c: EnsembleConfig) -> list[list[list[np.ndarray]]]:
    """[forest or booster][set]: the edges of each feature, as ``bin_edges`` finds them in the rows of the set."""
    learned = placed.where(F.col("inner") != HELD_OUT).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(c.folds))))
    number = F.col("outer") * (c.folds + 1) + F.col("slot")
    boosted = F.when(F.col("code") == 1, F.lit(ratio)).otherwise(F.lit(1.0))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), w.alias("w")) for k, w in ((0, F.lit(1.0)), (1, boosted))]))
    weighted = learned.where("slot != inner").select(number.alias("set"), "x", kinds.alias("k"))
    cells = weighted.select("set", "k.kind", "k.w", F.posexplode("x").alias("feature", "x"))
    cells = cells.select(((F.col("kind") * n_sets + F.col("set")) * width + F.col("feature")).alias("group"), "x", "w")
    summaries = sketch(cells, "group", weight="w", points=32 * c.max_bins)
    found = quantiles(summaries, [i / c.max_bins for i in range(1, c.max_bins)], "group").toLocalIterator()
    edges = {r.group: np.unique(np.array(r.quantiles, dtype=np.float64)) for r in found}
    return [
        [[edges.get((k * n_sets + s) * width + j, np.zeros(0)) for j in range(width)] for s in range(n_sets)] for k in (0, 1)
    ]


def base_scores(placed: DataFrame, edges, ratio: float, n_outer: int, draws: list[EnsembleConfig]) -> DataFrame:
    """``(trial, outer, slot, row, code, p_rf, p_gbt)`` for the rows that a set has to score, one file or so per trial and outer fold."""
    spark, folds, width = placed.sparkSession, draws[0].folds, len(edges[0][0])
    n_sets = n_outer * (folds + 1)
    parts = max(PARTS, -(-4 * spark.sparkContext.defaultParallelism // n_sets))
    ship_package(spark)
    shared = spark.sparkContext.broadcast(edges)

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outer, inner, row, key, code = (batch.column(c).to_numpy() for c in ("outer", "inner", "row", "key", "code"))
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), width)
            for o in np.unique(outer).tolist():
                for slot in range(folds + 1):
                    rows = np.flatnonzero((outer == o) & ((inner != HELD_OUT) | (slot == folds)))
                    held, number = (inner[rows] == slot) | (inner[rows] == HELD_OUT), o * (folds + 1) + slot
                    out = np.empty((len(rows), 2 * width), dtype=np.uint8)
                    for k in (0, 1):
                        for j, e in enumerate(shared.value[k][number]):
                            out[:, k * width + j] = np.searchsorted(e, x[rows, j])
                    ends = np.arange(len(rows) + 1, dtype=np.int32) * 2 * width
                    packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(out.tobytes())])
                    number = pa.array(np.full(len(rows), number, dtype=np.int32))
                    columns = [number, pa.array(held), *[pa.array(v[rows]) for v in (row, key, code)], packed]
                    yield pa.RecordBatch.from_arrays(columns, names=["set", "held", "row", "key", "code", "bins"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, task = [], None
        for batch in batches:
            if len(batch):
                task = batch.column("task")[0].as_py()
                raw = np.frombuffer(b"".join(batch.column("bins").to_pylist()), dtype=np.uint8).reshape(len(batch), 2 * width)
                found.append((batch.column("held").to_numpy(zero_copy_only=False), *[batch.column(c).to_numpy() for c in ("row", "key", "code")], raw))
        if not found:
            return
        number, part = divmod(task, parts)
        held, row, key, code, bins = (np.concatenate(c) for c in zip(*found))
        scored = np.flatnonzero(held)
        scored = scored[np.argsort(row[scored], kind="stable")]
        row, below = row[scored], bins[scored]
        codes = code[scored]
        key, y, bins = key[~held], code[~held].astype(np.float64), bins[~held]
        counts = [np.count_nonzero(y == 0), np.count_nonzero(y == 1)]
        balanced = [len(y) / (2 * n) if n else 1.0 for n in counts]
        w = np.where(y == 1, balanced[1], balanced[0])
        order = np.lexsort((w, y, *bins[:, :width].T, key))  # as ``grown_trees`` has them
        sums = forest_sums(y[order], w[order], np.ascontiguousarray(bins[order, :width]), below[:, :width], draws, part, parts)
        boosted, bins, below = np.where(y == 1, ratio, 1.0), np.ascontiguousarray(bins[:, width:]), below[:, width:]
        for i, d in enumerate(draws):
            margin = np.zeros(len(row))
            if i % parts == part:
                margin = booster_sums(key, y, boosted, bins, below, shared.value[1][number], d)
            columns = (i, number // (folds + 1), number % (folds + 1), row, codes, sums[i], margin)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(columns, SCORES_ARROW)], schema=SCORES_ARROW)

    def together(table: pa.Table) -> pa.Table:
        """One trial and set: the parts have their rows in the same order."""
        rf, gbt = (sum(np.array(v.values.to_numpy()) for v in table.column(c)) for c in ("rf", "gbt"))
        first = [table.column(c)[0] for c in ("trial", "outer", "slot")]
        row, code = (table.column(c)[0].values for c in ("row", "code"))
        columns = [*[pa.array([v.as_py()] * len(row), pa.int32()) for v in first], row, code, pa.array(rf / trees[first[0].as_py()]), pa.array(gbt)]
        return pa.table(columns, names=["trial", "outer", "slot", "row", "code", "p_rf", "margin"])

    trees = [d.rf_trees for d in draws]
    # Each set is binned once and then goes to its tasks.
    sets = placed.select("outer", "inner", "row", "key", "code", "x").mapInArrow(
        binned, "set int, held boolean, row bigint, key bigint, code int, bins binary"
    )
    every = F.explode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda part: F.col("set") * parts + part)).alias("task")
    tasks = sets.select("held", "row", "key", "code", "bins", every).repartitionById(n_sets * parts, F.col("task"))
    partial = materialize(tasks.mapInArrow(run, SCORES), "search-parts")
    whole = partial.groupBy("trial", "outer", "slot").applyInArrow(
        together, "trial int, outer int, slot int, row bigint, code int, p_rf double, margin double"
    )
    scores = whole.withColumn("p_gbt", 1.0 / (1.0 + F.exp(-F.col("margin")))).drop("margin")
    path = new_path(spark, "search-scores")
    scores.repartition("trial", "outer").write.partitionBy("trial", "outer").parquet(path)
    return spark.read.schema(scores.schema).parquet(path)


def trial_scores(
    data: DataFrame, labels: dict, ratio: float | None, outer_folds: int, draws: list[EnsembleConfig], parallelism: int
) -> list[list[float | None]] | None:
    """ROC-AUC per trial and outer fold; None where the trials have to be fitted one by one."""
    from panelwright.operators.ensemble import _in_parallel, meta_model

    if not goes_together(draws) or len(labels) != 2 or None in labels:
        return None
    c, first = draws[0], data.select(F.size(vector_to_array("features")).alias("n")).first()
    if not first or not first.n or sum(labels.values()) * first.n > TASK_CELLS:
        return None
    placed = placed_rows(data, max(labels), outer_folds, c)
    n_of: dict[tuple[int, int], list[int]] = {}  # rows of [code] per outer and inner fold
    for r in placed.groupBy("outer", "inner", "code").count().collect():  # 2 * outer folds * (folds + 1) rows
        n_of.setdefault((r.outer, r.inner), [0, 0])[r.code] = r["count"]
    inside = [[n_of.get((o, i), [0, 0]) for i in range(c.folds)] for o in range(outer_folds)]
    for of in inside:
        if not all(map(sum, zip(*of))) or any(sum(map(sum, of)) == sum(own) for own in of):
            return None  # an outer fold without a class, or an inner one with all rows
    n_rows = [sum(map(sum, of)) for of in inside]
    edges = set_edges(placed, ratio, first.n, outer_folds * (c.folds + 1), c)
    scores = base_scores(placed, edges, ratio, outer_folds, draws)

    def meta(trial: int, outer: int) -> tuple:
        own = scores.where((F.col("trial") == trial) & (F.col("outer") == outer) & (F.col("slot") < c.folds))
        model = meta_model(draws[trial], n_rows[outer]).fit(own.select("code", array_to_vector(F.array("p_rf", "p_gbt")).alias("meta")))
        return trial, outer, float(model.intercept), *map(float, model.coefficients.toArray())

    pairs = [(t, o) for t in range(len(draws)) for o in range(outer_folds)]
    metas = _in_parallel(data.sparkSession, [lambda t=t, o=o: meta(t, o) for t, o in pairs], parallelism)
    weights = data.sparkSession.createDataFrame(metas, "trial int, outer int, intercept double, of_rf double, of_gbt double")
    margin = F.col("of_rf") * F.col("p_rf") + F.col("of_gbt") * F.col("p_gbt") + F.col("intercept")
    held = scores.where(F.col("slot") == c.folds).join(F.broadcast(weights), ["trial", "outer"])
    scored = held.select("trial", "outer", "code", (1.0 - 1.0 / (1.0 + F.exp(margin))).alias("score"))
    found = {(r.trial, r.outer): r.roc_auc for r in ranking_metrics(scored, label="code", by=("trial", "outer")).collect()}
    return [[found.get((t, o)) for o in range(outer_folds)] for t in range(len(draws))]
