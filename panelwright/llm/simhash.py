"""SimHash near-duplicates: fingerprints, an index over byte positions, components.

A fingerprint has eight bytes. Two that differ in at most d bits share at least
8 - d bytes at the same positions, which is the guaranteed minimum of matches.
A posting list per single byte would hold a 256th of all fingerprints, and
tallying within it would grow with the square of the input; so the lists are
kept per combination of 8 - d positions, which is where a pair reaches the
minimum. In lists of up to ``list_limit`` members the shared bytes of a pair are
tallied first, a pair is retained in the list of its first shared positions
only, and what is retained is verified by its bit distance.

Rules: words have A-Z in lower case; a null text has no words and the
fingerprint zero, which links like any other; equal texts share a fingerprint
and count once; a null id is never a component's name unless all its ids are
null. An empty table gives an empty result.

Nothing is capped. Lists of more than ``list_limit`` fingerprints are not
compared in pairs: any two of their members within d bits share a midpoint
within d / 2 bits of each, so every member meets the others at its midpoints,
whose number is fixed. Links go to the smallest member, never to all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import append_columns, fresh, map_batches, texts_of, words
from panelwright.session import materialize

SEED = 42


def fingerprint(text: str, shingle: int = 4) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes."""
    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    n = max(1, len(found) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(found)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for low in range(0, n, 1 << 16):
        part = hashes[low : low + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = 4) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint as a signed number."""

    def run(column):
        found = np.array([fingerprint(t, shingle) for t in texts_of(column)], dtype=np.uint64)
        return [pa.array(found.view(np.int64))]

    return append_columns(docs, run, [("fp", "bigint")], [text], keep)


def position_masks(distance: int) -> list[int]:
    """A mask per combination of 8 - distance byte positions, in order."""
    return [sum(0xFF << 8 * p for p in chosen) for chosen in combinations(range(8), 8 - distance)]


def _links_in_lists(masks: list[int], distance: int, limit: int):
    """Reads lists sorted by (mask, shared); yields links, or members of large lists."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("large", pa.bool_())])
    sizes = np.array(masks, dtype=np.uint64)

    # The first mask within each set of shared bytes, a bit per position.
    within = np.array([sum(1 << p for p in range(8) if m >> 8 * p & 0xFF) for m in masks])
    sets = np.arange(256)[:, None]
    inside = (sets & within) == within
    first_mask = np.where(inside.any(axis=1), inside.argmax(axis=1), len(masks))

    def verified(x, y, mask):
        """Which pairs to link: shared bytes are tallied, a pair is retained in the
        list of its first shared positions, then verified."""
        differ = x ^ y
        equal = differ.view(np.uint8).reshape(-1, 8) == 0
        kept = np.flatnonzero(first_mask[np.packbits(equal, axis=1, bitorder="little")[:, 0]] == mask)
        return kept[np.bitwise_count(differ[kept]) <= distance]

    def lists(mask, fp, starts, stops):
        """The lists of two members or more that are not large, side by side."""
        length = stops - starts
        chosen = (length >= 2) & (length <= limit)
        starts, length = starts[chosen], length[chosen]
        begins = np.cumsum(length) - length
        at = np.repeat(starts - begins, length) + np.arange(int(length.sum()))
        return mask[at], fp[at], begins, begins + length

    def links(mask, fp, starts, stops):
        """Links within whole lists, given as slices of sorted arrays."""
        a, b = [], []
        length = stops - starts
        small = np.repeat(length, length) <= 16
        run = np.repeat(np.arange(len(starts)), length)
        for shift in range(1, min(16, int(length.max(initial=0)))):
            i = np.flatnonzero((run[shift:] == run[:-shift]) & small[shift:])
            ok = i[verified(fp[i], fp[i + shift], mask[i])]
            a.append(fp[ok])
            b.append(fp[ok + shift])
        for s, e in zip(starts[length > 16].tolist(), stops[length > 16].tolist()):
            own, listed = fp[s:e], mask[s]
            root = np.arange(e - s)
            # A spanning forest: each fingerprint that is still apart is linked to an earlier one.
            for i in range(1, e - s):
                j = verified(own[:i], own[i], listed)
                near = np.unique(root[j])
                if len(near):
                    a.append(own[near])
                    b.append(np.full(len(near), own[i]))
                    root[: i + 1][np.isin(root[: i + 1], [*near.tolist(), i])] = near[0]
        return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])

    def out(a, b, large):
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(len(a), large))], schema=schema
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last list of a batch may go on in the next
        flushed = None  # the list that turned out large
        for batch in batches:
            mask = batch.column("mask").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if held is not None:
                mask, fp = np.concatenate([held[0], mask]), np.concatenate([held[1], fp])
            if not len(fp):
                continue
            shared = fp & sizes[mask]
            change = np.flatnonzero((mask[1:] != mask[:-1]) | (shared[1:] != shared[:-1])) + 1
            starts, stops = np.concatenate([[0], change]), np.concatenate([change, [len(fp)]])
            key = (int(mask[0]), int(shared[0]))
            if flushed == key:  # goes on with a large list
                yield out(fp[: stops[0]], fp[: stops[0]], True)
                starts, stops = starts[1:], stops[1:]
                if not len(starts):
                    held = None
                    continue
            last = int(starts[-1])
            if len(fp) - last > limit:
                flushed, held = (int(mask[-1]), int(shared[-1])), None
                yield out(fp[last:], fp[last:], True)
            else:
                flushed, held = None, (mask[last:].copy(), fp[last:].copy())
            starts, stops = starts[:-1], stops[:-1]
            for i in np.flatnonzero(stops - starts > limit).tolist():
                members = fp[starts[i] : stops[i]]
                yield out(members, members, True)
            yield out(*links(*lists(mask, fp, starts, stops)), False)
        if held is not None:
            mask, fp = held
            yield out(*links(*lists(mask, fp, np.array([0]), np.array([len(fp)]))), False)

    return run


def _links_at_midpoints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (middle, fp) sorted by both; links each member to the first at its midpoint."""
    middle_before = first = None
    for batch in batches:
        middle, fp = batch.column("middle").to_numpy(), batch.column("fp").to_numpy()
        if not len(fp):
            continue
        begins = np.concatenate([[middle[0] != middle_before], middle[1:] != middle[:-1]])
        source = np.maximum.accumulate(np.where(begins, np.arange(len(fp)), -1))
        root = np.where(source >= 0, fp[np.maximum(source, 0)], first if first is not None else 0)
        middle_before, first = middle[-1], root[-1]
        apart = root != fp
        yield pa.RecordBatch.from_arrays([pa.array(root[apart]), pa.array(fp[apart])], names=["a", "b"])


def near_pairs(prints: DataFrame, distance: int = 4, list_limit: int = 2048) -> DataFrame:
    """Links (a, b) that connect exactly the distinct ``fp`` of ``prints`` within ``distance`` bits."""
    if distance % 2 or not 0 <= distance <= 6:
        raise ValueError(f"distance must be 0, 2, 4 or 6; got {distance}")
    masks = position_masks(distance)
    indexed = prints.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("mask", "shared")
    )
    slices = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = indexed.repartition(slices, "mask", "shared").sortWithinPartitions("mask", "shared", "fp").select("mask", "fp")
    found = materialize(
        map_batches(lists, _links_in_lists(masks, distance, list_limit), "a bigint, b bigint, large boolean"), "simhash-links"
    )
    direct = found.where("NOT large").select("a", "b")
    members = found.where("large").select(F.col("a").alias("fp")).distinct()
    near = [0, *[sum(1 << b for b in bits) for size in range(1, distance // 2 + 1) for bits in combinations(range(64), size)]]
    ball = np.array(near, dtype=np.uint64)

    def spread(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for low in range(0, len(fp), 256):
                part = fp[low : low + 256]
                middle = (part[:, None] ^ ball).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(middle.view(np.int64)), pa.array(np.repeat(part, len(ball)).view(np.int64))], names=["middle", "fp"]
                )

    middles = map_batches(members, spread, "middle bigint, fp bigint")
    met = middles.repartition(slices, "middle").sortWithinPartitions("middle", "fp")
    at_middle = map_batches(met, _links_at_midpoints, "a bigint, b bigint").distinct()
    return direct.unionByName(at_middle)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def components(links: DataFrame) -> DataFrame:
    """(fp, root) of every linked fingerprint; root is the smallest of its component.

    Alternates two steps: each node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones. Both keep components and shrink
    paths, so the rounds grow with the logarithm of the longest path. Every
    round is written to the shared folder.
    """
    edges = materialize(links.where("a <> b").distinct(), "simhash-edges")
    state = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # Now a < b. Smaller neighbours of b: a.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        edges = materialize(
            small.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(least.select(F.col("m").alias("a"), "b"))
            .where("a <> b").distinct(),
            "simhash-edges",
        )
        signature = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 31) - 1)))).first()
        if signature == state:
            return edges.select(F.col("b").alias("fp"), F.col("a").alias("root"))
        state = signature


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4,
    list_limit: int = 2048, carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, ``carry``, fp, root (one fingerprint per component), component_id (smallest
    id reachable, null if all ids are) of every row."""
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), *carry)
    rows = materialize(fingerprints(named, ["doc_id", *carry], "text", shingle), "simhash-rows")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    roots = components(near_pairs(prints, distance, list_limit))
    placed = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named_roots = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(named_roots, "root").select("fp", "root", "component_id")
    return rows.join(placed, "fp").select("doc_id", *carry, "fp", "root", "component_id")


def hex_digits(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the
    smallest id, and of rows that share it the first read. Components are told apart by
    their fingerprints, so unlike texts stay even where ids are null or repeat; a
    component with null ids only keeps its first row."""
    key = fresh(docs, "row_no")
    numbered = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "simhash-documents")
    found = near_duplicates(numbered, doc_id, text, carry=(key,), **options)
    # Two aggregates with partial sums; a component may hold a large share of all rows.
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(key).alias(key))
    return numbered.join(first.select(key), key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
