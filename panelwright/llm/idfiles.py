"""Token ids in files: frequency-ranked, in byte-aligned variable-length code.

An id is written as its rank among all ids of the corpus, the commonest first, so
common ids take one byte. Lengths stand apart from the bytes: a control byte holds
one bit per rank (one or two bytes) for vocabularies up to 65,536, else two bits (one
to four bytes). A reader looks a control byte up in a table that says which of the
following bytes goes where, and takes them for all control bytes at once.

File format: ``ids`` are Parquet files in ascending order of documents, one row per
block of whole documents: part and block number, ids of the part before the block,
document ids and their numbers of ids, control bytes, data bytes. ``ranks`` holds the
id of every rank.

Rules: a null text is empty, and like every document ends with the end id. Documents
are ordered by id, nulls first; of rows that share an id, by a hash of the text; rows
alike in both are interchangeable. Every row is one document. An empty table gives no
blocks. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm.bpe import byte_letters, id_lists, model_of, read_vocabulary
from panelwright.llm.common import byte_slices, map_batches
from panelwright.llm.stretches import Numbers, Pool, cut, joined, runs
from panelwright.session import delete_folder, new_path

BLOCK = 1 << 20  # ids of a block, whole documents
ENCODED = 8_000_000  # bytes of texts that are cut together; they stay in Arrow
KNOWN = 2_000_000  # stretches that a worker remembers


# -- the code -----------------------------------------------------------------


class Codec:
    """Variable-length code of ranks below ``size``.

    ``per`` ranks share a control byte and decode to sixteen bytes: eight of two bytes
    or four of four.
    """

    def __init__(self, size: int):
        self.bits, self.kind = (1, np.dtype("<u2")) if size <= 1 << 16 else (2, np.dtype("<u4"))
        self.per = 8 // self.bits
        control = np.arange(256)[:, None] >> self.bits * np.arange(self.per) & (1 << self.bits) - 1
        length = control + 1
        self.total = length.sum(axis=1)
        begin = np.cumsum(length, axis=1) - length
        byte = np.arange(self.kind.itemsize)
        # Which of the bytes behind a control byte goes to each of its sixteen places; -1: none.
        self.source = np.where(byte < length[:, :, None], begin[:, :, None] + byte, -1).reshape(256, 16)

    def encode(self, ranks: np.ndarray) -> tuple[bytes, bytes]:
        """Control and data bytes. The last control byte is filled up with zero bits
        whose bytes are not written."""
        wide = ranks.astype(self.kind).view(np.uint8).reshape(len(ranks), self.kind.itemsize)
        length = np.ones(len(ranks), dtype=np.uint8)
        for i in range(1, self.kind.itemsize):
            length[wide[:, i:].any(axis=1)] = i + 1
        codes = np.zeros(-(-len(ranks) // self.per) * self.per, dtype=np.uint8)
        codes[: len(ranks)] = length - 1
        shifts = (self.bits * np.arange(self.per)).astype(np.uint8)
        control = np.bitwise_or.reduce(codes.reshape(-1, self.per) << shifts, axis=1, dtype=np.uint8)
        data = wide[np.arange(self.kind.itemsize, dtype=np.uint8) < length[:, None]]
        return control.tobytes(), data.tobytes()

    def decode(self, control: bytes, data: bytes, n: int) -> np.ndarray:
        """The ``n`` ranks, by table lookup."""
        controls = np.frombuffer(control, dtype=np.uint8)
        # Zeros at the end: for places without a byte, and behind the last control byte.
        padded = np.concatenate([np.frombuffer(data, dtype=np.uint8), np.zeros(17, dtype=np.uint8)])
        begin = np.cumsum(self.total[controls]) - self.total[controls]
        out = np.empty((len(controls), 16), dtype=np.uint8)
        for low in range(0, len(controls), 1 << 15):
            some = slice(low, low + (1 << 15))
            source = self.source[controls[some]]
            out[some] = padded[np.where(source < 0, len(padded) - 1, begin[some, None] + source)]
        return out.reshape(-1).view(self.kind)[:n]


# -- ids of texts -------------------------------------------------------------


class StretchEncoder:
    """Ids by the tokenizers library, which sees each distinct stretch once."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or " " in t.content for t in added.values()):
            raise ValueError("added tokens that reach over spaces are not supported")
        self.bytes_of = token_bytes(self.tokenizer)
        self.length = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.kind = np.dtype(np.uint16 if len(self.length) <= 1 << 16 else np.uint32)
        self.numbers = Numbers(self._learn, self._clear, KNOWN)
        self._clear()

    def _clear(self) -> None:
        self.ids, self.begin, self.count = Pool(self.kind), Pool(np.int64), Pool(np.int64)

    def _learn(self, names: pa.Array) -> None:
        order, texts, _ = joined(names)
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.int64, sum(map(len, found)))
        ends = np.concatenate([[0], np.cumsum(self.length[ids])])
        want = np.cumsum(pc.binary_length(names).to_numpy()[order])
        upto = np.searchsorted(ends, want, "right") - 1
        if not np.array_equal(ends[upto], want):
            raise ValueError("a token reaches over a cut")
        begin, count = np.empty(len(names), dtype=np.int64), np.empty(len(names), dtype=np.int64)
        count[order] = np.diff(upto, prepend=0)
        begin[order] = self.ids.size + upto - count[order]
        self.ids.extend(ids.astype(self.kind))
        self.begin.extend(begin)
        self.count.extend(count)

    def number(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of each stretch of all texts, and where each text ends."""
        found = cut(texts)
        self.numbers.trim()
        return self.numbers.of(found.names)[found.index], found.ends

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one behind the other, and how many each text has."""
        number, ends = self.number(texts)
        count = self.count.data[number]
        upto = np.concatenate([[0], np.cumsum(count)])
        return self.ids.data[runs(self.begin.data[number], count)], np.diff(upto[ends])


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; added tokens are their text."""
    to_byte = {c: b for b, c in enumerate(byte_letters())}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    for token, i in vocabulary.items():
        out[i] = token.encode() if token in added else bytes(to_byte[c] for c in token)
    return out


# -- writing ------------------------------------------------------------------


def packed(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ids of several documents as one binary value each, without an object per document."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * ids.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``packed`` and how many each document has."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return np.frombuffer(raw.tobytes(), dtype=kind), np.diff(ends) // kind.itemsize


def encode_rows(docs: DataFrame, content, end_id: int) -> DataFrame:
    """doc_id, tie, row_no and the ids of every document with ``end_id`` behind them."""
    given = docs.withColumn("tie", F.xxhash64("text")).withColumn("row_no", F.monotonically_increasing_id())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model_of(content, StretchEncoder)
        for batch in batches:
            for part in byte_slices(batch, ["text"], ENCODED):
                ids, counts = encoder.encode(part.column("text"))
                whole = np.insert(ids, np.cumsum(counts), end_id)
                columns = [part.column(c) for c in ("doc_id", "tie", "row_no")]
                yield pa.RecordBatch.from_arrays([*columns, packed(whole, counts + 1)], names=["doc_id", "tie", "row_no", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(given.select("doc_id", "tie", "row_no", "text"), run, f"doc_id {kind}, tie bigint, row_no bigint, ids binary")


def ids_by_rank(encoded: DataFrame, size: int, kind: np.dtype) -> np.ndarray:
    """The id of every rank: all ``size`` ids, the commonest in all documents first, ties
    by id. A task adds up and sends one row per id that it has met."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(unpacked(batch.column("ids"), kind)[0], minlength=size)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["id", "c"])

    counts = map_batches(encoded.select("ids"), run, "id bigint, c bigint").groupBy("id").agg(F.sum("c").alias("c"))
    found = counts.toArrow()  # one row per id of the vocabulary at most
    times = np.zeros(size, dtype=np.int64)
    times[found.column("id").to_numpy()] = found.column("c").to_numpy()
    return np.lexsort((np.arange(size), -times))


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every document, each with ``end_id`` behind it, to ``folder``.

    ``path`` is a vocabulary of the tokenizers library. Texts are encoded once, where
    they are read, and their ids written beside the tables of this application. Then
    ids are counted, and sorted by a range partitioning on (document id, hash of the
    text, row), so that neither a common id nor a common row fills one task.
    """
    spark = docs.sparkSession
    content = read_vocabulary(docs, path)
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    encoder = model_of(content, StretchEncoder)
    size, kind = len(encoder.length), encoder.kind
    if not 0 <= end_id < size:
        raise ValueError(f"end_id must be an id of the vocabulary; got {end_id}")
    scratch = new_path(spark, "id-rows")
    encoded = encode_rows(given, content, end_id)
    encoded.write.option("compression", "zstd").parquet(scratch)
    encoded = spark.read.schema(encoded.schema).parquet(scratch)
    ids = ids_by_rank(encoded, size, kind)
    ranks = np.empty(size, dtype=np.int64)
    ranks[ids] = np.arange(size)
    table = spark.createDataFrame(pa.table({"rank": pa.array(np.arange(size)), "id": pa.array(ids)}))
    table.coalesce(1).write.parquet(f"{folder}/ranks")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["doc_id", "tie", "row_no"]
    placed = encoded.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select(F.spark_partition_id().alias("part"), "doc_id", "ids")
    id_kind = given.schema["doc_id"].dataType
    blocks = map_batches(
        placed, _blocks(spark.sparkContext.broadcast(ranks), kind, id_kind),
        f"part int, block int, before bigint, n bigint, doc_ids array<{id_kind.simpleString()}>, sizes array<bigint>, control binary, data binary",
    )
    blocks.write.option("compression", "zstd").parquet(f"{folder}/ids")
    delete_folder(spark, scratch)


def _blocks(shared, kind: np.dtype, id_type):
    from pyspark.sql.pandas.types import to_arrow_type

    id_kind = to_arrow_type(id_type)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        codec = Codec(len(ranks))
        ranks = ranks.astype(codec.kind)
        held, held_ids, held_sizes, size, before, block = [], [], [], 0, 0, 0

        def out(part):
            control, data = codec.encode(np.concatenate(held))
            ids = pa.concat_arrays(held_ids).cast(id_kind)
            sizes = pa.array(np.concatenate(held_sizes).astype(np.int64))
            ends = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before]), pa.array([size]),
                 pa.ListArray.from_arrays(ends, ids), pa.ListArray.from_arrays(ends, sizes),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                names=["part", "block", "before", "n", "doc_ids", "sizes", "control", "data"],
            )

        part = 0
        for batch in batches:
            for some in byte_slices(batch, ["ids"]):
                part = some.column("part")[0].as_py()
                ids, counts = unpacked(some.column("ids"), kind)
                held.append(ranks[ids])
                held_ids.append(some.column("doc_id"))
                held_sizes.append(counts)
                size += len(ids)
                if size >= BLOCK:
                    yield out(part)
                    before, block = before + size, block + 1
                    held, held_ids, held_sizes, size = [], [], [], 0
        if held:
            yield out(part)

    return run


# -- reading ------------------------------------------------------------------


def _read(spark: SparkSession, folder: str, run, schema: str) -> DataFrame:
    """``run(ids of ranks, doc_ids, start, ids, sizes)`` on every block."""
    table = spark.read.parquet(f"{folder}/ranks").toArrow()  # as long as the vocabulary
    ids = np.empty(len(table), dtype=np.int64)
    ids[table.column("rank").to_numpy()] = table.column("id").to_numpy()
    shared = spark.sparkContext.broadcast(ids)
    blocks = spark.read.parquet(f"{folder}/ids")
    # One row per file part: as many as the writer had partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("parts_before"))
    placed = blocks.join(F.broadcast(parts), "part")

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_rank = shared.value
        codec = Codec(len(of_rank))
        for batch in batches:
            for i in range(len(batch)):
                one = {c: batch.column(c)[i] for c in batch.schema.names}
                found = codec.decode(one["control"].as_py(), one["data"].as_py(), one["n"].as_py())
                sizes = one["sizes"].values.to_numpy()
                start = one["parts_before"].as_py() + one["before"].as_py() + np.cumsum(sizes) - sizes
                yield run(one["doc_ids"].values, start, of_rank[found], sizes)

    return map_batches(placed.select("part", "before", "n", "doc_ids", "sizes", "control", "data", "parts_before"), decode, schema)


def _id_kind(spark: SparkSession, folder: str) -> str:
    return spark.read.parquet(f"{folder}/ids").schema["doc_ids"].dataType.elementType.simpleString()


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), token_ids of every document in ``folder``."""

    def run(doc_ids, start, ids, sizes):
        lists = id_lists(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(start), lists], names=["doc_id", "start", "token_ids"])

    return _read(spark, folder, run, f"doc_id {_id_kind(spark, folder)}, start bigint, token_ids array<int>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers) of
    every document in ``folder``."""

    def run(doc_ids, start, ids, sizes):
        raw = memoryview(ids.astype("<u4").tobytes())
        ends = (4 * np.cumsum(sizes)).tolist()
        sums = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends], ends)]
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(start), pa.array(sizes), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
        )

    return _read(spark, folder, run, f"doc_id {_id_kind(spark, folder)}, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(docs: DataFrame, path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write to a new folder beside the tables of this application, and read the digests back."""
    folder = new_path(docs.sparkSession, "id-files")
    write_ids(docs, path, folder, end_id, doc_id, text)
    return read_digests(docs.sparkSession, folder)
