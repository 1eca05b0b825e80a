"""Nearest neighbours by multi-index hashing over learned binary codes.

Vectors are turned by a learned rotation (principal axes, then alternating
rotation and signs on a bounded, documented sample) and their signs are the
code. Codes are split into substrings, and each block of rows has an index per
substring: for a radius r over m substrings, a code within r differs in at
most r // m bits on at least one of the first r % m + 1 substrings, or in fewer
on another, so probing those lists retrieves every code within the radius.
Candidates within it are reranked by the exact distance in double precision.

The radius is learned on the same sample: the smallest that holds a wanted
share of exact neighbours. In a larger table neighbours are closer, so the
share only grows. Queries that find fewer than k candidates look again with
the full radius, which reaches every row.

Rules: vectors that are null, zero, of another length than most, or hold a null
or non-finite component take no part, neither as queries nor as candidates;
repeated rows are candidates on their own, and a query never finds its own
row; ties go to the smaller id, a null id is no query. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import map_batches
from panelwright.session import materialize

SUBSTRINGS = 8
PARITY = np.array([[bin(a ^ b).count("1") for b in range(256)] for a in range(256)], dtype=np.uint8)


def learn_rotation(x: np.ndarray, rounds: int = 30, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection to 64 signed coordinates; with fewer dimensions,
    further rotations of the same axes fill the code."""
    centre = x.mean(axis=0)
    z = x - centre
    _, axes = np.linalg.eigh(z.T @ z)
    axes = axes[:, ::-1][:, :64]
    rng = np.random.default_rng(seed)
    parts, bits = [], 0
    while bits < 64:
        b = axes.shape[1]
        y = z @ axes
        rotation, _ = np.linalg.qr(rng.normal(size=(b, b)))
        for _ in range(rounds):
            signs = np.where(y @ rotation >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ y)
            rotation = (u @ v).T
        parts.append(axes @ rotation)
        bits += b
    return centre, np.concatenate(parts, axis=1)[:, :64]


def codes_of(x: np.ndarray, centre: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Eight bytes per vector."""
    return np.packbits((x - centre) @ projection >= 0, axis=1)


def distances(query: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - query) ** 2).sum(axis=1))


def learn_radius(x: np.ndarray, codes: np.ndarray, k: int, share: float, queries: int = 200) -> int:
    """Smallest radius that holds ``share`` of the k nearest of some sample rows."""
    found = []
    for i in range(0, len(x), max(1, len(x) // queries)):
        d = distances(x[i], x)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:k]
        near = near[np.isfinite(d[near])]
        found.append(PARITY[codes[i], codes[near]].sum(axis=1))
    bits = np.concatenate(found) if found else np.array([64])
    return int(np.ceil(np.quantile(bits, share))) if len(bits) else 64


class Index:
    """Lists per substring and value over the rows of one block."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(SUBSTRINGS)]
        self.begin = [np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs in at most ``radius`` bits, ascending."""
        n = len(self.codes)
        if radius >= 64:
            return np.arange(n)
        each, rest = divmod(radius, SUBSTRINGS)
        hit = np.zeros(n, dtype=bool)
        for j in range(SUBSTRINGS):
            allowed = each if j <= rest else each - 1
            if allowed < 0:
                continue
            values = np.flatnonzero(PARITY[code[j]] <= allowed)
            begin, end = self.begin[j][values], self.begin[j][values + 1]
            size = end - begin
            if size.sum():
                at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                hit[self.order[j][at]] = True
        rows = np.flatnonzero(hit)
        return rows[PARITY[code, self.codes[rows]].sum(axis=1) <= radius]


def clean_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """row_no, vec_id, x of the rows that take part, written once."""
    x = F.transform(F.col(f"`{embedding}`"), lambda v: v.cast("double"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    taken = (
        rows.select(F.col(f"`{vec_id}`").alias("vec_id"), x.alias("x"))
        .where(F.col("x").isNotNull() & ~F.exists("x", bad) & F.exists("x", lambda v: v != 0))
        .withColumn("row_no", F.monotonically_increasing_id())
    )
    written = materialize(taken, "ann-vectors")
    usual = written.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return written.where(F.size("x") == (usual.d if usual else 0))


def search(
    rows: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 10,
    sample_rows: int = 10_000, share: float = 0.97, block_rows: int = 16_384,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query.

    ``is_query(column)`` says which ids are queries. ``sample_rows`` bounds the
    rows that the rotation and the radius are learned from.
    """
    vectors = clean_vectors(rows, vec_id, embedding)
    sample = vectors.orderBy(F.xxhash64("vec_id", "x")).limit(sample_rows).select("x").toPandas()
    n = vectors.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    x = np.array(sample["x"].tolist(), dtype=np.float64)
    centre, projection = learn_rotation(x)
    radius = learn_radius(x, codes_of(x, centre, projection), k, share)
    blocks = -(-n // block_rows)
    near = _top(_in_blocks(vectors, vectors.where(is_query(F.col("vec_id"))), blocks, centre, projection, radius, k), k)
    near = materialize(near, "ann-near")
    few = (
        vectors.where(is_query(F.col("vec_id")))
        .join(near.where(F.col("rank") == min(k, n - 1)).select(F.col("query_no").alias("row_no")), "row_no", "left_anti")
    )
    again = _top(_in_blocks(vectors, materialize(few, "ann-few"), blocks, centre, projection, 64, k), k)
    whole = near.join(again.select("query_no").distinct(), "query_no", "left_anti").unionByName(again)
    return whole.select("query_id", "rank", "vec_id", "score")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of the few that each block has found per query."""
    order = Window.partitionBy("query_no").orderBy("score", F.asc_nulls_last("vec_id"), "row_no")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _in_blocks(vectors, queries, blocks: int, centre, projection, radius: int, k: int) -> DataFrame:
    """Each block of rows meets the queries, which are streamed past its index.

    A task holds one block of rows and one batch of queries at a time.
    """
    rows = vectors.select(
        F.pmod(F.xxhash64("row_no"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "row_no", "vec_id", "x"
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "row_no", "vec_id", "x"
    )
    model = vectors.sparkSession.sparkContext.broadcast((centre, projection))
    n = min(blocks, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = rows.unionByName(asked).repartition(n, "block").sortWithinPartitions("block", "kind", "row_no")
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, projection = model.value
        width = projection.shape[0]
        block, held, index = None, [], None

        def matrix(column):
            return column.flatten().to_numpy().reshape(-1, width)

        for batch in batches:
            blocks_of, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((blocks_of[1:] != blocks_of[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kinds)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if blocks_of[a] != block:
                    block, held, index = blocks_of[a], [], None
                if kinds[a] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue  # a block without rows
                if index is None:
                    ids = pa.concat_arrays([p.column("vec_id") for p in held])
                    numbers = np.concatenate([p.column("row_no").to_numpy() for p in held])
                    x = np.concatenate([matrix(p.column("x")) for p in held])
                    index = Index(codes_of(x, centre, projection))
                    # Ties by id: rows in order of id, null ids last.
                    keys = np.array([(v is None, v or 0) for v in ids.to_pylist()], dtype=[("n", "?"), ("v", "i8")])
                    place = np.empty(len(keys), dtype=np.int64)
                    place[np.argsort(keys, order=("n", "v"), kind="stable")] = np.arange(len(keys))
                q = matrix(part.column("x"))
                codes = codes_of(q, centre, projection)
                own = part.column("row_no").to_numpy()
                rows_found, whose, scores = [], [], []
                for i in range(len(q)):
                    hit = index.within(codes[i], radius)
                    hit = hit[numbers[hit] != own[i]]
                    d = distances(q[i], x[hit])
                    best = np.lexsort((place[hit], d))[:k]
                    rows_found.append(hit[best])
                    scores.append(d[best])
                    whose.append(np.full(len(best), i))
                hit, i = np.concatenate(rows_found), np.concatenate(whose)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[i]), part.column("vec_id").take(pa.array(i)), ids.take(pa.array(hit)), pa.array(numbers[hit]),
                     pa.array(np.concatenate(scores))],
                    names=["query_no", "query_id", "vec_id", "row_no", "score"],
                )

    return map_batches(met, run, f"query_no bigint, query_id {kind}, vec_id {kind}, row_no bigint, score double")
