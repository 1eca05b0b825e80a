"""Tokens of one tokenizer aligned with those of another, by bytes of the text.

A is a byte-level vocabulary of the tokenizers library over a space and the text; B is
a sentencepiece vocabulary, which adds that space itself. Where tokens of both end at
the same byte, a group ends; all A and B tokens of a group are linked.

Spans are the coarse cuts: character offsets of A, byte spans of B's proto. Tokens
that share a character (A) or are single bytes (B) have no span of their own; their
ends follow from the decoded bytes since the last coarse cut.

Both tokenizers cut a text before a space between two other characters, so a text is
a row of stretches that align on their own, and each distinct stretch is aligned once.
How many documents hold an id pair needs all documents: blocks of documents send
each of their pairs once, counts meet the pairs again in a join, and a block adds
them up per stretch, then per document. Neither pairs nor counts are ever broadcast;
the highest count of each A id, one number per id of the vocabulary, is.

Rules: a text that is null, empty, or not what its A or B tokens decode to (one with
U+2581, which B reads as a space) has no tokens and only zeros. Strings of special
tokens are plain text. Rows may repeat: each is one document and gives one row. An
empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.bpe import model_of
from panelwright.llm.common import byte_slices, map_batches
from panelwright.llm.idfiles import token_bytes
from panelwright.llm.stretches import Numbers, Pool, cut, joined, runs
from panelwright.session import materialize

MARK = "▁"  # a space in a piece
NORMAL, USER_DEFINED, BYTE = 1, 4, 6  # kinds of pieces in a model file
BLOCK = 4_000_000  # bytes of texts of a block, whole documents
SLICE = 2_000_000  # bytes of texts that are cut together


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the spans of texts."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec
        from tokenizers import Tokenizer

        # Spark runs a task per core; threads of their own would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_file.decode())
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.a_bytes = token_bytes(self.a)
        model = spec.ModelProto()
        model.ParseFromString(b_file)
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models that leave texts as they are and add one space in front are supported")
        if any(MARK in p.piece.lstrip(MARK) for p in model.pieces if p.type == NORMAL) or any(p.type == USER_DEFINED for p in model.pieces):
            raise ValueError("a piece has a space inside")
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.b_bytes = [p.piece.replace(MARK, " ").encode() if p.type != BYTE else bytes([int(p.piece[3:5], 16)]) for p in model.pieces]
        self.is_byte = np.array([p.type == BYTE for p in model.pieces])
        self.a_length = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_length = np.array(list(map(len, self.b_bytes)), dtype=np.int64)

    def a_ends(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text: A's ids and the byte at which each ends."""
        for text, found in zip(texts, self.a.encode_batch(texts, add_special_tokens=False)):
            ids = np.array(found.ids, dtype=np.int64)
            spans = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
            if text.isascii():
                upto = spans[:, 1]
            else:
                # First byte of each character, and the end.
                raw = np.frombuffer(text.encode(), dtype=np.uint8)
                upto = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))[spans[:, 1]]
            # A token that shares its last character with the next has no end of its own.
            coarse = np.append(spans[1:, 0] >= spans[:-1, 1], True) if len(ids) else np.zeros(0, dtype=bool)
            yield ids, refined(upto, coarse, self.a_length[ids])

    def b_ends(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text, which begins with a space: B's ids and the byte at which each ends."""
        for found in self.b.encode([t[1:] for t in texts], return_type="proto", num_threads=1):
            pieces = found.pieces
            ids = np.array([p.id for p in pieces], dtype=np.int64)
            # Spans do not know of the space that B adds.
            upto = np.array([p.end for p in pieces], dtype=np.int64) + 1
            coarse = ~self.is_byte[ids]
            yield ids, refined(upto, coarse, self.b_length[ids])


def refined(upto: np.ndarray, coarse: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``upto`` where a cut is coarse, else the last coarse cut and the decoded bytes since."""
    if coarse.all():
        return upto
    decoded = np.cumsum(length)
    last = np.maximum.accumulate(np.where(coarse, np.arange(len(upto)), -1))
    since = decoded - np.where(last >= 0, decoded[np.maximum(last, 0)], 0)
    return np.where(coarse, upto, np.where(last >= 0, upto[np.maximum(last, 0)], 0) + since)


def linked(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, n_groups: int):
    """(group, a, b, times): links of all groups; tokens are sorted by group.

    The same id of a group is taken once with its number, so a long group costs its
    distinct ids and not its tokens squared.
    """

    def distinct(ids, group):
        key, times = np.unique(group << 32 | ids, return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, times

    if len(a_group) > 2 * n_groups or len(b_group) > 2 * n_groups:
        a_group, a, a_times = distinct(a, a_group)
        b_group, b, b_times = distinct(b, b_group)
    else:
        a_times, b_times = np.ones(len(a), dtype=np.int64), np.ones(len(b), dtype=np.int64)
    first = np.searchsorted(b_group, a_group)
    size = np.searchsorted(b_group, a_group, "right") - first
    with_a = np.repeat(np.arange(len(a)), size)
    with_b = runs(first, size)
    return a_group[with_a], a[with_a], b[with_b], a_times[with_a] * b_times[with_b]


class Aligner:
    """Alignment of each stretch that a worker has met: whether tokens give its bytes,
    numbers of tokens, groups and links, groups as text, and its distinct pairs."""

    def __init__(self, vocabularies: Vocabularies, most: int = 250_000):
        self.v = vocabularies
        self.wide = len(vocabularies.b_bytes)  # a pair is a * wide + b
        self.numbers = Numbers(self._learn, self._clear, most)
        self._clear()

    def _clear(self) -> None:
        self.ok = Pool(bool)
        self.n_a, self.n_b, self.n_groups, self.n_links = (Pool(np.int64) for _ in range(4))
        self.begin, self.count = Pool(np.int64), Pool(np.int64)
        self.pair, self.times = Pool(np.int64), Pool(np.int32)
        self.texts: list[str] = []

    def _learn(self, names: pa.Array) -> None:
        order, texts, counts = joined(names)
        sizes = pc.binary_length(names).to_numpy()[order].astype(np.int64)
        n = len(names)
        written: list[str] = [""] * n
        ok, totals = np.ones(n, dtype=bool), np.zeros((4, n), dtype=np.int64)
        begin, count = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        at = 0
        for low in range(0, len(texts), 256):
            some = texts[low : low + 256]
            a_found, b_found = self.v.a_ends(some), self.v.b_ends(some)
            for text, size, (a, a_end), (b, b_end) in zip(some, counts[low : low + 256].tolist(), a_found, b_found):
                own = order[at : at + size]
                border = np.cumsum(sizes[at : at + size])
                at += size
                raw = text.encode()
                # A is lossless by construction; its length is tested all the same.
                if a_end[-1] != len(raw) or b"".join([self.v.b_bytes[i] for i in b.tolist()]) != raw:
                    if size > 1:
                        self._alone(names, own, ok, totals, begin, count, written)
                    else:
                        ok[own] = False
                    continue
                self._align(a, a_end, b, b_end, own, border, ok, totals, begin, count, written)
        self.ok.extend(ok)
        for pool, values in zip((self.n_a, self.n_b, self.n_groups, self.n_links, self.begin, self.count), (*totals, begin, count)):
            pool.extend(values)
        self.texts += written

    def _alone(self, names, own, ok, *rest) -> None:
        """Stretches of a joined text one by one: some of them are not what they decode to."""
        for i in own.tolist():
            name = names[i].as_py()
            (a, a_end), (b, b_end) = next(self.v.a_ends([name])), next(self.v.b_ends([name]))
            ok[i] = b"".join([self.v.b_bytes[j] for j in b.tolist()]) == name.encode()
            if ok[i]:
                self._align(a, a_end, b, b_end, np.array([i]), np.array([len(name.encode())]), ok, *rest)

    def _align(self, a, a_end, b, b_end, own, border, ok, totals, begin, count, written) -> None:
        shared = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        whose = np.searchsorted(border, shared)  # the stretch of each group
        if not np.isin(border, shared).all():
            raise ValueError("a token reaches over a cut")
        group, with_a, with_b, times = linked(a, a_group, b, b_group, len(shared))
        key, place = np.unique(whose[group] * (self.wide << 32) + with_a * self.wide + with_b, return_inverse=True)
        total = np.bincount(place, times, len(key)).astype(np.int64)
        stretch = key // (self.wide << 32)
        self.pair.extend(key % (self.wide << 32))
        self.times.extend(total.astype(np.int32))
        n = len(own)
        totals[0, own] = np.bincount(whose[a_group], minlength=n)
        totals[1, own] = np.bincount(whose[b_group], minlength=n)
        totals[2, own] = np.bincount(whose, minlength=n)
        totals[3, own] = np.bincount(stretch, total, n)
        count[own] = np.bincount(stretch, minlength=n)
        begin[own] = self.pair.size - len(key) + np.cumsum(count[own]) - count[own]
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        a_upto = np.searchsorted(a_group, np.arange(len(shared)), "right").tolist()
        b_upto = np.searchsorted(b_group, np.arange(len(shared)), "right").tolist()
        groups = [
            f"{a_text[i]}|{b_text[k]}" if j - i == 1 and m - k == 1 else f"{','.join(a_text[i:j])}|{','.join(b_text[k:m])}"
            for i, j, k, m in zip([0, *a_upto], a_upto, [0, *b_upto], b_upto)
        ]
        g_upto = np.cumsum(totals[2, own]).tolist()
        for i, low, high in zip(own.tolist(), [0, *g_upto], g_upto):
            written[i] = ";".join(groups[low:high])


def build_aligner(content: bytes) -> Aligner:
    return Aligner(Vocabularies(*pickle.loads(content)))


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of whole numbers over consecutive parts."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return upto[ends[1:]] - upto[ends[:-1]]


# -- blocks of documents --------------------------------------------------------

BINARIES = ("sizes", "stretches", "repeats", "pairs", "docs", "pair_sizes", "pair_places", "pair_times")
LISTS = ("n_a", "n_b", "n_groups", "n_links")


class Block:
    """Documents of one task, and the dictionary of their stretches and pairs."""

    def __init__(self, aligner: Aligner):
        aligner.numbers.trim()
        pa.default_memory_pool().release_unused()
        self.aligner, self.bytes = aligner, 0
        self.ids, self.lists, self.hashes = [], [], []
        self.sizes, self.stretches, self.repeats, self.pairs, self.docs = [], [], [], [], []

    def add(self, doc_ids: pa.Array, texts: pa.Array) -> None:
        al = self.aligner
        found = cut(texts, lead=True, apart=True)
        number = al.numbers.of(found.names)[found.index]
        n, sizes = len(texts), np.diff(found.ends)
        length = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        good = (length > 0) & (sums(~al.ok.data[number], sizes) == 0)
        number = number[np.repeat(good, sizes)]
        sizes = np.where(good, sizes, 0)
        self.lists.append(np.array([sums(pool.data[number], sizes) for pool in (al.n_a, al.n_b, al.n_groups, al.n_links)]))
        ends, texts_of = np.cumsum(sizes).tolist(), al.texts
        self.hashes += [
            hashlib.sha256(";".join([texts_of[i] for i in number[low:high].tolist()]).encode()).hexdigest() if high > low else ""
            for low, high in zip([0, *ends], ends)
        ]
        # Distinct stretches of each document, and its distinct pairs.
        key, repeats = np.unique(np.repeat(np.arange(n), sizes) << 32 | number, return_counts=True)
        doc, number = key >> 32, key & 0xFFFFFFFF
        self.sizes.append(np.bincount(doc, minlength=n))
        self.stretches.append(number)
        self.repeats.append(repeats)
        count = al.count.data[number]
        pair = al.pair.data[runs(al.begin.data[number], count)]
        pair = np.unique(np.repeat(doc, count) * (al.wide << 20) + pair) % (al.wide << 20)
        pair, docs = np.unique(pair, return_counts=True)
        self.pairs.append(pair)
        self.docs.append(docs)
        self.ids.append(doc_ids)
        self.bytes += int(length.sum())

    def row(self, block: int) -> pa.RecordBatch:
        al = self.aligner
        stretches = np.concatenate(self.stretches)
        used = np.unique(stretches)
        count = al.count.data[used]
        entries = runs(al.begin.data[used], count)
        all_pairs, docs = np.concatenate(self.pairs), np.concatenate(self.docs)
        pairs, place = np.unique(all_pairs, return_inverse=True)
        packed = {
            "sizes": np.concatenate(self.sizes), "stretches": np.searchsorted(used, stretches), "repeats": np.concatenate(self.repeats),
            "pairs": pairs, "docs": np.bincount(place, docs, len(pairs)),
            "pair_sizes": count, "pair_places": np.searchsorted(pairs, al.pair.data[entries]), "pair_times": al.times.data[entries],
        }
        ids = pa.concat_arrays(self.ids)
        ends = pa.array([0, len(ids)], pa.int32())
        lists = np.concatenate(self.lists, axis=1)
        columns = [pa.array([block]), pa.ListArray.from_arrays(ends, ids)]
        columns += [pa.ListArray.from_arrays(ends, pa.array(values)) for values in lists]
        columns += [pa.ListArray.from_arrays(ends, pa.array(self.hashes, pa.string()))]
        columns += [pa.array([values.astype(np.int64 if c == "pairs" else np.int32).tobytes()], pa.binary()) for c, values in packed.items()]
        return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", *LISTS, "hashes", *BINARIES])


def align_blocks(docs: DataFrame, content) -> DataFrame:
    """One row per block of documents: their columns, stretches, and the pairs of these."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = model_of(content, build_aligner)
        block = None
        for batch in batches:
            if not len(batch):
                continue
            if block is None:
                # Unique without a shuffle: the number of the first row.
                name, block = batch.column("row_no")[0].as_py(), Block(aligner)
            for part in byte_slices(batch, ["text"], SLICE):
                if block is None:
                    name, block = part.column("row_no")[0].as_py(), Block(aligner)
                block.add(part.column("doc_id"), part.column("text"))
                if block.bytes >= BLOCK:
                    yield block.row(name)
                    block = None
        if block is not None:
            yield block.row(name)

    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<bigint>" for c in LISTS)
    schema = f"block bigint, doc_ids array<{kind}>, {lists}, hashes array<string>, " + ", ".join(f"{c} binary" for c in BINARIES)
    return map_batches(docs.withColumn("row_no", F.monotonically_increasing_id()).select("row_no", "doc_id", "text"), run, schema)


# -- counts over all documents --------------------------------------------------


def _pair_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, place, pair, docs) of every pair of every block."""
    for batch in batches:
        for i in range(len(batch)):
            pairs = np.frombuffer(batch.column("pairs")[i].as_buffer(), dtype=np.int64)
            docs = np.frombuffer(batch.column("docs")[i].as_buffer(), dtype=np.int32)
            block = batch.column("block")[i].as_py()
            for low in range(0, len(pairs), 1 << 16):
                some = slice(low, low + (1 << 16))
                size = len(pairs[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, block)), pa.array(np.arange(low, low + size, dtype=np.int32)), pa.array(pairs[some]), pa.array(docs[some])],
                    names=["block", "place", "pair", "docs"],
                )


def pair_counts(rows: DataFrame, wide: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (no pair of its A id has more)."""
    counts = rows.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.expr(f"pair div {wide}"))
    # One row per id of A's vocabulary at most.
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _packed_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts sorted by (block, place), as one row per block."""
    current, parts = None, []

    def out():
        n, best = (np.concatenate(c) for c in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int64()), pa.array([n.tobytes()], pa.binary()), pa.array([np.packbits(best).tobytes()], pa.binary())],
            names=["block", "n", "best"],
        )

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = (np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, len(blocks)]):
            if low == high:
                continue
            if blocks[low] != current:
                if parts:
                    yield out()
                current, parts = int(blocks[low]), []
            best = batch.column("best")[low:high].to_numpy(zero_copy_only=False)
            parts.append((batch.column("n")[low:high].to_numpy(), best.astype(bool)))
    if parts:
        yield out()


def _score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds counts up: pairs of a stretch, stretches of a document."""
    for batch in batches:
        for i in range(len(batch)):
            get = {c: np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.int32) for c in BINARIES if c not in ("pairs", "docs")}
            ids = batch.column("doc_ids")[i].values
            if batch.column("n")[i].is_valid:
                n = np.frombuffer(batch.column("n")[i].as_buffer(), dtype=np.int64)
                best = np.unpackbits(np.frombuffer(batch.column("best")[i].as_buffer(), dtype=np.uint8), count=len(n))
            else:  # no document of the block has tokens
                n = best = np.zeros(0, dtype=np.int64)
            times, places = get["pair_times"].astype(np.int64), get["pair_places"]
            repeats = get["repeats"].astype(np.int64)
            of_stretch = (sums(times * best[places], get["pair_sizes"]), sums(times * n[places], get["pair_sizes"]))
            n_best, count_sum = (sums(repeats * values[get["stretches"]], get["sizes"]) for values in of_stretch)
            lists = [batch.column(c)[i].values for c in LISTS]
            yield pa.RecordBatch.from_arrays(
                [ids, *lists, pa.array(n_best), pa.array(count_sum), batch.column("hashes")[i].values],
                names=["doc_id", *LISTS, "n_best", "count_sum", "groups_sha256"],
            )


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    ``n_best`` are the links whose pair is in as many documents as any pair of its A id,
    ``count_sum`` the documents that hold each link's pair, added up.
    """
    spark = docs.sparkSession
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        content = spark.sparkContext.broadcast(pickle.dumps((a.read(), b.read())))
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    blocks = materialize(align_blocks(given, content), "alignment-blocks", compression="zstd", **SMALL_GROUPS)
    rows = map_batches(blocks.select("block", "pairs", "docs"), _pair_rows, "block bigint, place int, pair bigint, docs int")
    counts = pair_counts(rows, model_of(content, build_aligner).wide)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = rows.join(counts, "pair").select("block", "place", "n", "best")
    met = met.repartition(n, "block").sortWithinPartitions("block", "place")
    packed = map_batches(met, _packed_counts, "block bigint, n binary, best binary")
    whole = blocks.drop("pairs", "docs").join(packed, "block", "left")
    kind = given.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} bigint" for c in LISTS)
    return map_batches(whole, _score, f"doc_id {kind}, {lists}, n_best bigint, count_sum bigint, groups_sha256 string")


#: A row is a whole block, and readers hold a row group at a time.
SMALL_GROUPS = {"parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 1}
