"""Texts as stretches that tokenizers encode on their own.

A byte-level pre-token starts before each space that a non-space follows, and its
pattern never looks back, so ids of a text are those of its stretches, one after the
other. Words come back all the time: a batch of texts has far fewer distinct
stretches than stretches, and only those that are new go to a tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from panelwright.llm.bpe import SPACES

JOINED = 1 << 10  # characters that go to a tokenizer as one text
BLANKS = pa.array([*sorted(SPACES), ""], pa.string())


class Cut(NamedTuple):
    """``names[index[ends[i]:ends[i + 1]]]`` are the stretches of text ``i``."""

    names: pa.Array
    index: np.ndarray
    ends: np.ndarray


def flags(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(bool)


def cut(texts: pa.Array, lead: bool = False, apart: bool = False) -> Cut:
    """Cut texts before each space that a non-space follows; null is empty.

    ``lead`` puts a space before each text. With ``apart`` a cut also needs something
    else than a space in front of it, so that runs of spaces stay whole. Names are
    distinct, and nothing is done word by word in Python but for runs of spaces.
    """
    pieces = pc.split_pattern(pc.fill_null(texts, ""), " ")
    bounds = pieces.offsets.to_numpy().astype(np.int64)
    coded = pieces.flatten().dictionary_encode()
    piece, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    glued = flags(pc.is_in(pc.utf8_slice_codeunits(words, 0, 1), value_set=BLANKS))[piece]
    first = np.zeros(len(piece), dtype=bool)
    first[bounds[:-1]] = True
    if apart and len(piece):
        glued[1:] |= flags(pc.equal(words, ""))[piece[:-1]]
    glued[first] = False
    heads = np.flatnonzero(~glued)
    sizes = np.diff(np.append(heads, len(piece)))
    bare = first[heads] if not lead else np.zeros(len(heads), dtype=bool)
    single = sizes == 1
    # Words behind a space first, then those without one, then runs of spaces.
    code = piece[heads] + len(words) * bare
    used = np.flatnonzero(np.bincount(code[single], minlength=2 * len(words)))
    place = np.zeros(2 * len(words), dtype=np.int64)
    place[used] = np.arange(len(used))
    spaced = pc.binary_join_element_wise("", words.take(pa.array(used[used < len(words)])), " ")
    plain = words.take(pa.array(used[used >= len(words)] - len(words)))
    index = np.zeros(len(heads), dtype=np.int64)
    index[single] = place[code[single]]
    more: dict[str, int] = {}
    for h in np.flatnonzero(~single).tolist():
        a = heads[h]
        name = " ".join(words.take(pa.array(piece[a : a + sizes[h]])).to_pylist())
        name = name if bare[h] else " " + name
        index[h] = len(used) + more.setdefault(name, len(more))
    names = pa.concat_arrays([spaced, plain, pa.array(list(more), pa.string())])
    return Cut(names, index, np.searchsorted(heads, bounds))


def runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``begins[i]`` to ``begins[i] + sizes[i]`` of all i, one behind the other."""
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def joined(names: pa.Array, limit: int = JOINED) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Texts made of several names each, that are cut again at the same places.

    Returns the order of the names in the texts, the texts, and how many names each
    has. A name that does not begin with a space and a non-space, or ends with a
    space, stays alone.
    """
    alone = flags(pc.is_in(pc.utf8_slice_codeunits(names, 1, 2), value_set=BLANKS))
    alone |= ~flags(pc.starts_with(names, " ")) | flags(pc.ends_with(names, " "))
    together = np.flatnonzero(~alone)
    simple = names.take(pa.array(together))
    upto = np.cumsum(pc.binary_length(simple).to_numpy()) // limit
    starts = np.flatnonzero(np.diff(upto, prepend=-1)) if len(upto) else np.zeros(0, dtype=np.int64)
    bounds = np.append(starts, len(simple)) if len(starts) else np.zeros(1, dtype=np.int64)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), simple), "").to_pylist()
    lonely = np.flatnonzero(alone)
    order = np.concatenate([together, lonely])
    counts = np.concatenate([np.diff(bounds), np.ones(len(lonely), dtype=np.int64)])
    return order, texts + names.take(pa.array(lonely)).to_pylist(), counts


class Pool:
    """Arrays that grow at their end, kept in one buffer."""

    def __init__(self, kind):
        self.data, self.size = np.zeros(1 << 10, dtype=kind), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(max(need, 2 * len(self.data)) - self.size, self.data.dtype)])
        self.data[self.size : need] = values
        self.size = need


class Numbers:
    """Numbers of the stretches that a worker has met, with a bound on what it keeps.

    ``learn(names)`` is called with the new ones, in the order of their numbers.
    ``trim`` forgets all when there are more than ``most`` names, or more than 16 bytes
    for each of ``most``; it is called between batches, so a batch is always whole.
    """

    def __init__(self, learn: Callable[[pa.Array], None], clear: Callable[[], None], most: int = 1_000_000):
        self.learn, self.clear, self.most = learn, clear, most
        self.names = pa.array([], pa.string())

    def of(self, names: pa.Array) -> np.ndarray:
        found = pc.index_in(names, value_set=self.names)
        fresh = flags(found.is_null())
        number = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        if fresh.any():
            new = names.filter(pa.array(fresh))
            number[fresh] = len(self.names) + np.arange(len(new))
            self.learn(new)
            self.names = pa.concat_arrays([self.names, new])
        return number

    def trim(self) -> None:
        if len(self.names) > self.most or self.names.nbytes > 16 * self.most:
            self.names = pa.array([], pa.string())
            self.clear()
