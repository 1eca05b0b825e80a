"""Quantiles of weighted values, per group, from one pass and summaries that merge.

A summary has points: a value and the weight it stands for. Sorted points are cut into
``points`` cells of equal weight; a cell of several points is replaced by the one at its
middle, so the weight up to any value moves by what lies on one side of it, at most
total / points. What moved is kept with the summary and errors of merged summaries add up
like their weights: ``error``, as a share of the weight, bounds how far the rank of any
value is off. A group with at most ``points`` distinct values is exact.

A task holds ``HELD`` cells, sends their summaries on and starts anew. Summaries of a
group meet ``FAN`` at a time, in as many rounds as that takes, so no task holds a group.
Null and NaN values and weights that are not positive do not count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.session import materialize, ship_package

HELD = 2_000_000
FAN = 64
POINTS = 8192


def pruned(group: np.ndarray, value: np.ndarray, weight: np.ndarray, points: int):
    """Points of all groups, sorted by group and value, with at most ``points`` for each.

    Returns group, value and weight of the points that are left, then the groups and by
    how much weight a rank in each may have moved.
    """
    order = np.lexsort((value, group))
    group, value, weight = group[order], value[order], weight[order]
    if not len(group):
        return group, value, weight, group, weight
    first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (value[1:] != value[:-1])))
    group, value, weight = group[first], value[first], np.add.reduceat(weight, first)
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(start, len(group)))
    owner = np.repeat(np.arange(len(start)), size)
    upto = np.cumsum(weight)
    own = upto - weight - (upto - weight)[start][owner]
    total = np.add.reduceat(weight, start)
    cell = np.minimum((own / total[owner] * points).astype(np.int64), points - 1)
    # Groups that are small enough keep every point.
    cell = np.where(size[owner] <= points, np.arange(len(group)) - start[owner], cell)
    head = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (cell[1:] != cell[:-1])))
    tail = np.append(head[1:], len(group)) - 1
    held = np.add.reduceat(weight, head)
    before = (upto - weight)[head]
    middle = np.clip(np.searchsorted(upto, before + held / 2), head, tail)
    moved = np.maximum((upto - weight)[middle] - before, upto[tail] - upto[middle])
    moved[head == tail] = 0.0
    return group[head], value[middle], held, group[start], np.maximum.reduceat(moved, np.searchsorted(head, start))


def _cut(group, value, weight, names: list, moved: np.ndarray, part: int, key: pa.DataType) -> pa.RecordBatch:
    """One row per group; ``names`` has the groups of the numbers 0, 1, ..."""
    ends = np.searchsorted(group, np.arange(len(names) + 1)).astype(np.int32)
    totals = np.add.reduceat(np.append(weight, 0.0), ends[:-1]) if len(names) else np.zeros(0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, key), pa.array(np.full(len(names), part, dtype=np.int64)), pa.array(totals), pa.array(moved),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(value)), pa.ListArray.from_arrays(pa.array(ends), pa.array(weight)),
        ],
        names=["_group", "_part", "total", "moved", "values", "weights"],
    )


def _summaries(cells: DataFrame, points: int, held: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        waiting: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            codes = pc.dictionary_encode(table.column("_group")).combine_chunks()
            if isinstance(codes, pa.ChunkedArray):
                codes = codes.chunk(0)
            group, value, weight, _, moved = pruned(
                codes.indices.to_numpy(), table.column("_x").to_numpy(), table.column("_w").to_numpy(), points
            )
            return _cut(group, value, weight, codes.dictionary.to_pylist(), moved, part, codes.dictionary.type)

        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += len(batch)
            if rows >= held:
                yield out()
                waiting, rows, part = [], 0, part + 1
        if rows:
            yield out()

    kind = cells.schema["_group"].dataType.simpleString()
    return cells.mapInArrow(run, f"_group {kind}, _part bigint, total double, moved double, values array<double>, weights array<double>")


def sketch(
    values: DataFrame, group: str = "feature", value: str = "x", weight: str | None = None, points: int = POINTS, held: int = HELD, fan: int = FAN
) -> DataFrame:
    """(group, total, error, values, weights): one summary per group, ``error`` a share of the total."""
    if points < 2 or fan < 2:
        raise ValueError(f"points and fan must be at least 2; got {points} and {fan}")
    ship_package(values.sparkSession)
    cells = values.select(
        F.col(group).alias("_group"), F.col(value).cast("double").alias("_x"),
        (F.col(weight) if weight else F.lit(1)).cast("double").alias("_w"),
    ).where("_group IS NOT NULL AND _x IS NOT NULL AND NOT isnan(_x) AND _w > 0")
    found = materialize(_summaries(cells, points, held), "summaries")

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        v, w = np.concatenate(part["values"].to_list()), np.concatenate(part["weights"].to_list())
        _, v, w, _, moved = pruned(np.zeros(len(v), dtype=np.int64), v, w, points)
        row = (part["_group"].iloc[0], part["_slot"].iloc[0], w.sum(), part["moved"].sum() + moved[0], v, w)
        return pd.DataFrame([row], columns=["_group", "_part", "total", "moved", "values", "weights"])

    while True:
        most = found.groupBy("_group").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        slots = -(-most // fan)
        slot = F.pmod(F.xxhash64("_part"), F.lit(slots)).alias("_slot")
        found = materialize(found.select("*", slot).groupBy("_group", "_slot").applyInPandas(merge, found.schema), "summaries")
    return found.select(F.col("_group").alias(group), "total", (F.col("moved") / F.col("total")).alias("error"), "values", "weights")


def quantiles(summaries: DataFrame, shares: list[float], group: str = "feature") -> DataFrame:
    """(group, error, quantiles): the smallest value that each share of the weight is up to."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for v, w in zip(part["values"], part["weights"]):
                upto = np.cumsum(w)
                # Shares that sums of weights miss by rounding alone are met.
                place = np.searchsorted(upto, np.array(shares) * upto[-1] * (1 - 1e-12))
                found.append(v[np.minimum(place, len(v) - 1)])
            yield pd.DataFrame({group: part[group], "error": part["error"], "quantiles": found})

    kind = summaries.schema[group].dataType.simpleString()
    return summaries.select(group, "error", "values", "weights").mapInPandas(run, f"{group} {kind}, error double, quantiles array<double>")


def sketched_medians(
    values: DataFrame, group: str = "feature", value: str = "x", weight: str | None = None, points: int = POINTS
) -> DataFrame:
    """(group, median, error): as ``order_stats.medians``, each middle rank off by a share ``error`` at most.

    Weights are whole numbers. A group with at most ``points`` distinct values gets its exact median.
    """

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for v, w in zip(part["values"], part["weights"]):
                upto = np.cumsum(w)
                lower, upper = np.searchsorted(upto, upto[-1] / 2), np.searchsorted(upto, upto[-1] / 2, "right")
                found.append((v[lower] + v[min(upper, len(v) - 1)]) / 2)
            yield pd.DataFrame({group: part[group], "median": found, "error": part["error"]})

    summaries = sketch(values, group, value, weight, points)
    kind = summaries.schema[group].dataType.simpleString()
    return summaries.select(group, "error", "values", "weights").mapInPandas(run, f"{group} {kind}, median double, error double")


def sketched_mad(
    values: DataFrame, group: str = "feature", value: str = "x", weight: str | None = None, points: int = POINTS
) -> DataFrame:
    """``(group, median, mad, error)``: two passes over the values, whatever their number.

    ``error`` is the larger of the rank errors of both medians; deviations are from the median found.
    """
    centre = materialize(sketched_medians(values, group, value, weight, points), "medians")
    count = (F.col(weight) if weight else F.lit(1)).alias("weight")
    away = values.join(centre, group).select(group, F.abs(F.col(value).cast("double") - F.col("median")).alias("away"), count)
    spread = sketched_medians(away, group, "away", "weight", points).select(group, F.col("median").alias("mad"), F.col("error").alias("_error"))
    return centre.join(spread, group).select(group, "median", "mad", F.greatest("error", "_error").alias("error"))
