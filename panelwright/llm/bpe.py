"""Byte-level BPE: encode with a priority queue over a linked list, decode by
concatenation.

Nulls encode as empty texts; empty texts give no tokens. The strings of added
tokens inside a text become those tokens, as the library does by default. Rows
may repeat and come in any order; every row gives one row.
"""

from __future__ import annotations

import hashlib
import json
import re
from heapq import heapify, heappop, heappush
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelwright.llm.common import append_columns, texts_of

#: The pre-token pattern for Latin-1 texts, with its letters, numbers and spaces written out.
LATIN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+".format(
        L="A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", N="0-9\xb2\xb3\xb9\xbc-\xbe", S="\x09-\x0d\x20\x85\xa0"
    )
).findall
#: White space of the pre-token pattern (Unicode White_Space).
SPACES = frozenset(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def merge_ranked(symbols: list[int], rank_of_pair, merged: list[int]) -> list[int]:
    """Merge adjacent symbols, lowest rank first, leftmost first among equals.

    ``rank_of_pair(a << 20 | b)`` is the rank of a pair or None, ``merged[rank]``
    the symbol that replaces it. The queue holds rank and position in one
    integer. An entry is stale, and is skipped, when the pair that begins at its
    position has another rank by now. Changes ``symbols``.
    """
    queue = []
    a = symbols[0]
    for i in range(1, len(symbols)):
        b = symbols[i]
        rank = rank_of_pair(a << 20 | b)
        if rank is not None:
            queue.append(rank << 32 | i - 1)
        a = b
    if not queue:
        return symbols
    heapify(queue)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    while queue:
        entry = heappop(queue)
        i = entry & 0xFFFFFFFF
        j = after[i]
        a = symbols[i]
        if j >= n or a < 0 or rank_of_pair(a << 20 | symbols[j]) != entry >> 32:
            continue
        symbols[i] = a = merged[entry >> 32]
        symbols[j] = -1
        after[i] = j = after[j]
        before[j] = i
        if j < n:
            rank = rank_of_pair(a << 20 | symbols[j])
            if rank is not None:
                heappush(queue, rank << 32 | i)
        i = before[i]
        if i >= 0:
            rank = rank_of_pair(symbols[i] << 20 | a)
            if rank is not None:
                heappush(queue, rank << 32 | i)
    return [s for s in symbols if s >= 0]


LONGEST = 256  # characters of what is remembered


class Recent:
    """A bounded memory of computed values: two generations of at most ``size``
    entries of at most ``LONGEST`` characters, so that what is used often survives."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def put(self, key, value):
        if len(key) > LONGEST:  # a text without spaces is one key
            return value
        if len(self.new) >= self.size:
            self.new, self.old = {}, self.new
        self.new[key] = value
        return value


class ByteBpe:
    """A byte-level BPE model, read from the JSON of the tokenizers library.

    ``cache_size`` bounds what is remembered of pre-tokens; of whole stretches
    between spaces, which are cheap to take apart, half as many are. What is
    remembered are ids as bytes, which take half the memory of tuples and are
    joined without a step per id.
    """

    def __init__(self, content: bytes, cache_size: int = 400_000):
        from tokenizers import pre_tokenizers

        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE model without a normalizer is needed")
        if spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a model that adds a leading space is not supported")
        self.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.vocab = model["vocab"]
        self.ranks, self.merged = {}, []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.vocab[a] << 20 | self.vocab[b]] = len(self.merged)
            self.merged.append(self.vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        found = sorted(self.added, key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, found)) + ")").split if found else None
        to_byte = {c: b for b, c in enumerate(byte_letters())}
        self.strings = [b""] * (max([*self.vocab.values(), *self.added.values()]) + 1)
        for token, i in self.vocab.items():
            self.strings[i] = bytes(to_byte[c] for c in token if c in to_byte)
        for token, i in self.added.items():
            self.strings[i] = token.encode()
        self.decimal = [str(i) for i in range(len(self.strings))]
        letters = byte_letters()
        self.byte_ids = [self.vocab[c] for c in letters]
        self.kind = np.dtype(np.uint16 if len(self.strings) <= 1 << 16 else np.uint32)
        self.stretches, self.pieces = Recent(max(1, cache_size // 2)), Recent(cache_size)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes() if len(ids) > 1 else ids[0].to_bytes(self.kind.itemsize, "little")

    def _piece(self, piece: str) -> bytes:
        """Token ids of one pre-token."""
        ids = [self.byte_ids[b] for b in piece.encode()]
        return self.pieces.put(piece, self._packed(merge_ranked(ids, self.ranks.get, self.merged) if len(ids) > 1 else ids))

    def _stretch(self, stretch: str) -> bytes:
        """Token ids of a text that begins where a pre-token does."""
        found = self.stretches.old.get(stretch)
        if found is None:
            if stretch.isascii() or max(stretch) < "\u0100":
                pieces = LATIN(stretch)
            else:
                pieces = [stretch[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(stretch)]
            new, old = self.pieces.new.get, self.pieces.old.get
            if len(pieces) == 1:
                p = pieces[0]
                return new(p) or old(p) or self._piece(p)
            found = b"".join([new(p) or old(p) or self._piece(p) for p in pieces])
        return self.stretches.put(stretch, found)

    def _plain(self, text: str) -> bytes:
        """A pre-token starts before each space that a non-space follows, and the
        pattern never looks back, so stretches cut there encode on their own."""
        first, *rest = text.split(" ")
        if any(not s or s[0] in SPACES for s in rest):
            glued = [first]
            for s in rest:
                if not s or s[0] in SPACES:
                    glued[-1] += " " + s
                else:
                    glued.append(" " + s)
            stretches = glued
        else:
            stretches = [first, *[" " + s for s in rest]]
        known, whole, cut = self.stretches.new.get, self.pieces.new.get, self._stretch
        return b"".join([known(s) or whole(s) or cut(s) for s in stretches if s])

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        parts = [text] if self.split_added is None else self.split_added(text)
        if len(parts) == 1:
            found = self._plain(text)
        else:
            found = b"".join([self._packed([self.added[p]]) if p in self.added else self._plain(p) for p in parts])
        return np.frombuffer(found, dtype=self.kind)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable
    Latin-1, else the next free code point from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


_models: dict = {}


def model_of(content, build):
    """One model per worker process and vocabulary; ``content`` is a broadcast."""
    key = (build.__name__, hashlib.blake2b(content.value).digest())
    if key not in _models:
        _models[key] = build(content.value)
    return _models[key]


def read_vocabulary(df: DataFrame, path: str):
    """Broadcast a vocabulary file, a few MB whatever the data, read where the driver runs."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    """Lists of ids as one Arrow array, without an object per id."""
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encode_texts(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``token_ids``: the ids of each whole text."""
    content = read_vocabulary(df, path)

    def run(column):
        model = model_of(content, ByteBpe)
        return [id_lists([model.encode(t) for t in texts_of(column)])]

    return append_columns(df, run, [("token_ids", "array<int>")], [text], keep)


def decode_ids(df: DataFrame, path: str, keep: list[str], ids: str = "token_ids") -> DataFrame:
    """``keep`` and ``decoded``: the text of each list of ids; null ids give an empty text."""
    content = read_vocabulary(df, path)

    def run(column):
        model = model_of(content, ByteBpe)
        return [[model.decode(i or []) for i in column.to_pylist()]]

    return append_columns(df, run, [("decoded", "string")], [ids], keep)


def round_trip_digests(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, number of tokens, SHA-256 of the ids and of the decoded text.

    Encodes and decodes in one pass, so ids never leave the task.
    """
    content = read_vocabulary(df, path)

    def run(column):
        model = model_of(content, ByteBpe)
        counts, of_ids, of_text = [], [], []
        for t in texts_of(column):
            ids = model.encode(t).tolist()
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(",".join(map(model.decimal.__getitem__, ids)).encode()).hexdigest())
            of_text.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
        return [counts, of_ids, of_text]

    fields = [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    return append_columns(df, run, fields, [text], keep)


def encode_and_check(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, token_ids, n_tokens, and round_trip: whether the ids decode to the text."""
    content = read_vocabulary(df, path)

    def run(column):
        model = model_of(content, ByteBpe)
        texts = texts_of(column)
        ids = [model.encode(t) for t in texts]
        same = [model.decode(i.tolist()) == t for i, t in zip(ids, texts)]
        return [id_lists(ids), [len(i) for i in ids], same]

    fields = [("token_ids", "array<int>"), ("n_tokens", "bigint"), ("round_trip", "boolean")]
    return append_columns(df, run, fields, [text], keep)
