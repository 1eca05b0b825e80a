"""Language-model scores: a word-count base and online logistic context mixing.

A text is predicted bit by bit; a byte is written in a prefix code that gives
frequent bytes few bits. Five predictors look up adaptive counts in hashed
tables: the last one, two, three and four bytes of the text, separators
included, and the word so far. Their log-odds are mixed by weights that a gate
chooses (how much two of the contexts have been seen, place in the word).
Weights are learned online, chunk by chunk: predict, move the weights along the
gradient, then count. A last stage refines the mixed probability with counts
per gate and probability. The sum over all bits is the length of the text.

Every training byte is predicted, moves weights and refinement, and is counted,
from the first chunk on. Texts are dealt to shards by a hash of id and text,
whose number follows from the size of the input, and a shard is learned in the
order of the hash, in chunks that double from ``LEARN`` to ``LEARN_MOST`` characters: the
model does not depend on partitions or batches. What a byte costs depends on the four
bytes before it and the word so far alone. Bytes of a chunk that share these are one
event: it is predicted once, and moves weights, refinement and counts as often as it
occurs. Events are told apart by a hash of 64 bits. Scoring remembers events likewise.

A shard predicts from tables of its own (``OWN`` slots) and gives out its events; those of
all shards are added up, weights are averaged by the number of chunks. Then the distinct
keys (context and bits so far) of each predictor are counted, and its table in the model
has ``SPARE`` slots for each; slots do not check keys, so a share of 1 - exp(-1 / SPARE) of
the keys meets another in its slot. A slot of the model is a byte: its log-odds, rounded
to the states of ``state_values``, and how much it has been seen. The model and its broadcast grow with the distinct
contexts of the input; what learns a shard grows with those of the shard.

Rules: A-Z in lower case; a null text is empty; the end of a text is its last
token and its last byte. Rows may repeat, each gives one row. Without training
rows no token is known and the mixer predicts without counts.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import map_batches, slices, texts_of
from panelwright.session import materialize, scratch

BEFORE, END = b"\xfe\xfe\xfe\xfe", b"\xff"  # bytes that are not in UTF-8
PREDICTORS = 5  # orders 1 to 4, word so far
BLOCK = 1 << 16  # slots that travel in one row
LEAST = (BLOCK,) * PREDICTORS  # slots of each predictor, for small inputs
SPARE = 2  # slots for each distinct key
SAMPLE_BITS = 6  # one key of 64 is counted to measure how many there are
INPUTS = PREDICTORS + 1  # and a constant
GATES = 64
APM_CELLS = 33
FINE = 1537  # cells of the final table of costs
REACH = 12.0  # largest log-odds
PRIOR = 0.2
STEP = 1 << 12  # distinct bits between two moves of the weights
MOST_RATE = 4.0  # how much further a move goes for bits that occur often, at most
CHUNK = 1 << 18  # characters whose contexts are found together
LEARN, LEARN_MOST = 1 << 16, 1 << 22  # characters that are learned together, at first and at most
BATCH = 1 << 16  # events that are predicted before they are counted
GATHERED = 1 << 18  # events that are turned into counts together
OWN = (BLOCK, 1 << 20, 1 << 22, 1 << 22, 1 << 22)  # slots of each predictor while a shard is learned
MEMO_BITS = 22  # a worker remembers the costs of 2^22 events
SHARD = 16_000_000  # bytes of training texts that are learned one after the other
WEIGHT_UNIT = float(1 << 20)
MIX = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
KNOWN_TOKENS = 300_000  # words that a worker remembers
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32, 0xFE])


# -- bytes and bits -------------------------------------------------------


def prefix_code(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and lengths of a Huffman code over the 256 bytes; none is without a code."""
    heap = [(int(c) + 1, b, (b,)) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    length = np.zeros(256, dtype=np.int64)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        members = a[2] + b[2]
        length[list(members)] += 1
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), members))
    code, at, last = np.zeros(256, dtype=np.int64), 0, 0
    for b in sorted(range(256), key=lambda b: (length[b], b)):
        at <<= int(length[b]) - last
        last = int(length[b])
        code[b] = at
        at += 1
    return code, length


_powers = [np.ones(0, dtype=np.uint64)] * 2


def powers(n: int) -> list[np.ndarray]:
    """The first powers of ``ODD`` and of its inverse, kept for the next call."""
    if len(_powers[0]) < n:
        _powers[:] = [np.cumprod(np.full(n + n // 8, base)) for base in (ODD, INVERSE)]
    return [p[:n] for p in _powers]


class Places:
    """The bytes of some texts in their order, and what stands before each: four bytes and the word so far."""

    COLUMNS = ("four", "byte", "so_far", "place")

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(BEFORE + BEFORE.join(texts), dtype=np.uint8)
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        # Four bytes stand before each text.
        at = np.arange(len(self.owner)) + 4 * (self.owner + 1)
        last = data.astype(np.uint32)
        four = last.copy()
        for back in (1, 2, 3):
            four[back:] |= last[:-back] << np.uint32(8 * back)
        self.four, self.byte = four[at - 1], data[at]
        first = np.maximum.accumulate(np.where(BLANK[data], np.arange(1, len(data) + 1), 0))[at - 1]
        # Hash of the word so far: a difference of running sums, moved to a common power.
        forward, backward = powers(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data + np.uint64(1)) * forward, out=sums[1:])
        self.so_far = (sums[at] - sums[first]) * backward[first]
        self.place = np.minimum(at - first, 3).astype(np.uint8)  # in the word

    def events(self) -> np.ndarray:
        """A hash of each byte and what stands before it."""
        h = self.four.astype(np.uint64)
        h <<= np.uint64(8)
        h |= self.byte
        h *= MIX
        h ^= self.so_far
        h *= ODD
        h ^= h >> np.uint64(29)
        h *= MIX
        return h

    @classmethod
    def of(cls, *columns: np.ndarray) -> Places:
        """Without the texts that they belong to."""
        out = object.__new__(cls)
        for name, column in zip(cls.COLUMNS, columns):
            setattr(out, name, column)
        return out

    def take(self, at) -> Places:
        return Places.of(*(getattr(self, name)[at] for name in self.COLUMNS))


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in an order in which equal values are neighbours, and where each group begins.

    High bits and position are sorted as one number; values that share the high bits alone
    may come as several groups.
    """
    low = np.uint64(max(1, len(values).bit_length()))
    key = values >> low << low
    key |= np.arange(len(values), dtype=np.uint64)
    key.sort()
    key &= (np.uint64(1) << low) - np.uint64(1)
    at = key.view(np.int64)
    ordered = values[at]
    new = np.ones(len(values), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return at, np.flatnonzero(new)


class Events:
    """Distinct bytes with what stands before them, their hashes, and how often each occurs."""

    def __init__(self, places: Places, hashes: np.ndarray, times: np.ndarray):
        self.places, self.hashes, self.times = places, hashes, times

    @classmethod
    def of(cls, texts: list[bytes]) -> Events:
        parts = []
        for a, b in slices(texts, CHUNK) if texts else [(0, 0)]:
            places = Places(texts[a:b])
            hashes = places.events()
            at, start = grouped(hashes)
            first = at[start]
            parts.append(cls(places.take(first), hashes[first], np.diff(np.append(start, len(at))).astype(np.int32)))
        return cls.merged(parts) if len(parts) > 1 else parts[0]

    @classmethod
    def joined(cls, parts: list[Events]) -> Events:
        places = Places.of(*(np.concatenate([getattr(p.places, name) for p in parts]) for name in Places.COLUMNS))
        return cls(places, *(np.concatenate([getattr(p, name) for p in parts]) for name in ("hashes", "times")))

    @classmethod
    def merged(cls, parts: list[Events]) -> Events:
        found = cls.joined(parts)
        at, start = grouped(found.hashes)
        if not len(at):
            return found
        sums = np.add.reduceat(found.times[at], start).astype(found.times.dtype)
        return cls(found.places.take(at[start]), found.hashes[at[start]], sums)

    def part(self, some) -> Events:
        return Events(self.places.take(some), self.hashes[some], self.times[some])

    def pack(self) -> bytes:
        """6 to 14 bytes an event, or 30: what the four bytes before do not show, and numbers above 255, apart."""
        p = self.places
        long, many = ~BLANK[p.four.view(np.uint8).reshape(-1, 4)].any(axis=1), self.times > 255
        columns = (
            np.array([len(p.four), long.sum(), many.sum()], dtype=np.int64), p.four, p.byte, self.times.astype(np.uint8),
            p.so_far[long], np.flatnonzero(many), (self.times[many] >> 8).astype(np.int64),
        )
        return b"".join(c.tobytes() for c in columns)

    @classmethod
    def unpack(cls, data: bytes) -> Events:
        at = 0

        def read(n: int, kind) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        n, n_long, n_many = read(3, np.int64)
        four, byte, times = read(n, np.uint32), read(n, np.uint8), read(n, np.uint8).astype(np.int64)
        blank = BLANK[four.view(np.uint8).reshape(-1, 4)]
        long = ~blank.any(axis=1)
        # The last byte before comes first; the word so far begins behind the last blank.
        size = np.where(long, 4, blank.argmax(axis=1))
        so_far = np.zeros(n, dtype=np.uint64)
        for back in range(3):
            inside = size > back
            value = (four[inside] >> np.uint32(8 * back) & np.uint32(255)).astype(np.uint64) + np.uint64(1)
            so_far[inside] += value * powers(5)[0][size[inside] - 1 - back] * INVERSE
        so_far[long] = read(n_long, np.uint64)
        many = read(n_many, np.int64)
        times[many] += read(n_many, np.int64) << 8
        places = Places.of(four, byte, so_far, np.minimum(size, 3).astype(np.uint8))
        return cls(places, places.events(), times)

    def batches(self, code: np.ndarray, length: np.ndarray, size: int = BATCH) -> Iterator[tuple[Bytes, np.ndarray]]:
        """Some events at a time, and how often each occurs."""
        for low in range(0, len(self.times), size):
            some = slice(low, low + size)
            data = Bytes(self.places.take(some), code, length)
            yield data, self.times[some][data.order]


class Bytes:
    """The bytes of some texts and a context per predictor and byte.

    Bytes are sorted by the length of their code, longest first, so those that
    have a bit of some depth are always in front.
    """

    def __init__(self, texts: list[bytes] | Places, code: np.ndarray, length: np.ndarray):
        places = texts if isinstance(texts, Places) else Places(texts)
        self.order = np.argsort(-length.astype(np.int8)[places.byte], kind="stable")
        places = places.take(self.order)
        self.place = places.place
        self.code, self.length = code[places.byte].astype(np.uint64), length[places.byte]
        four = places.four.astype(np.uint64)
        short = [four & np.uint64((1 << 8 * n) - 1) for n in (1, 2, 3)]
        self.contexts = [hashed(c, i) for i, c in enumerate((*short, four, places.so_far))]

    def take(self, at) -> Bytes:
        """Some bytes, in the order given, without their places."""
        out = object.__new__(Bytes)
        out.code, out.length, out.contexts = self.code[at], self.length[at], [c[at] for c in self.contexts]
        return out

    def keys(self, predictors: Iterable[int] = range(PREDICTORS)) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
        """Per depth: how many bytes have a bit there, a hash of context and prefix per predictor, and the bit."""
        for depth in range(int(self.length.max(initial=0))):
            n = int(np.searchsorted(-self.length, -depth, "left"))
            left = (self.length[:n] - depth).astype(np.uint64)
            prefix = (np.uint64(1 << depth) | self.code[:n] >> left) * np.uint64(0x9E3779B1)
            keys = [(self.contexts[i][:n] ^ prefix) * MIX for i in predictors]
            yield n, keys, (self.code[:n] >> (left - np.uint64(1)) & np.uint64(1)).view(np.int64)

    def bits(self, sizes: tuple[int, ...]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
        """As ``keys``, with the slots in tables of ``sizes`` one behind the other."""
        lows = [sum(sizes[:i]) for i in range(PREDICTORS)]
        for n, keys, y in self.keys():
            yield n, [slots_of(h, size) + low for h, size, low in zip(keys, sizes, lows)], y


def slots_of(keys: np.ndarray, size: int) -> np.ndarray:
    keys >>= np.uint64(32)
    keys *= np.uint64(size)
    keys >>= np.uint64(32)
    return keys.view(np.int64)


def hashed(context: np.ndarray, predictor: int) -> np.ndarray:
    h = (context + np.uint64(0x3C6EF372 + 0x5BE0CD19 * predictor)) * MIX
    return (h ^ (h >> np.uint64(29))) * ODD


def odds_of(counts: np.ndarray) -> np.ndarray:
    """Log-odds of a one per slot, in 256ths."""
    smooth = counts.astype(np.float32) + np.float32(PRIOR)
    return np.rint(256 * np.log(smooth[:, 1] / smooth[:, 0])).astype(np.int16)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """How much a slot has been seen: 0 never, 1 up to three times, 2 up to 31, 3 more."""
    n = counts[:, 0] + counts[:, 1]
    return ((n > 0).astype(np.uint8) + (n > 3) + (n > 31)).astype(np.uint8)


def state_values() -> tuple[np.ndarray, np.ndarray]:
    """Log-odds in 256ths, in order inside a level, and the level of each state of a slot.

    A slot that has been seen up to three times has a state of its own for each pair of
    counts; beyond, steps are a tenth to a sixth of a unit of log-odds.
    """
    few = [(a, n - a) for n in range(4) for a in range(n + 1)]
    odds = [odds_of(np.array([c])) for c in few]
    levels = [levels_of(np.array([c])) for c in few]
    for level, n, most in ((2, 96, 31.0), (3, 150, 1e5)):
        reach = 256 * np.log((most + PRIOR) / PRIOR)
        odds.append(np.rint(np.linspace(-reach, reach, n)).astype(np.int16))
        levels.append(np.full(n, level, dtype=np.uint8))
    odds, levels = np.concatenate(odds), np.concatenate(levels)
    order = np.lexsort((odds, levels))
    return odds[order], levels[order]


STATE_ODDS, STATE_LEVELS = state_values()


def states_of(odds: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The state of the same level with the nearest log-odds, one byte a slot."""
    out = np.zeros(len(odds), dtype=np.uint8)
    for level in range(1, 4):
        low, high = np.searchsorted(STATE_LEVELS, [level, level + 1])
        at = np.flatnonzero(levels == level)
        values = STATE_ODDS[low:high].astype(np.int32)
        out[at] = low + np.searchsorted((values[1:] + values[:-1]) // 2, odds[at])
    return out


def first_weights() -> np.ndarray:
    """Equal weights, for log-odds in 256ths."""
    return np.tile(np.array([0.3] * (INPUTS - 1) + [0.0], dtype=np.float32), (GATES, 1)) / np.float32(256)


def mix(x, word_level, four_level, weights, place):
    """Gate and mixed log-odds of some bit predictions with the inputs ``x``."""
    gate = (word_level * np.uint8(16) + four_level * np.uint8(4) + place).astype(np.intp)
    mixed = weights[:, INPUTS - 1][gate]
    for i, values in enumerate(x):
        mixed += weights[:, i][gate] * values
    return gate, np.clip(mixed, -REACH, REACH, out=mixed)


# -- learning -------------------------------------------------------------


class Learner:
    """Online state of one shard."""

    def __init__(self, code: np.ndarray, length: np.ndarray, sizes: tuple[int, ...] = LEAST):
        self.code, self.length, self.sizes = code, length, sizes
        self.counts = np.zeros((sum(sizes), 2), dtype=np.int32)  # zeros and ones
        self.weights = first_weights()
        self.speed = np.full((GATES, INPUTS), 1e-3, dtype=np.float64)
        self.apm = np.zeros((2, GATES * APM_CELLS), dtype=np.int64)
        self.chunks, self.seen = 0, []

    def learn(self, texts: list[bytes], rate: float = 0.02) -> None:
        found = Events.of([t + END for t in texts])
        for data, times in found.batches(self.code, self.length):
            seen = []
            for n, slots, y in data.bits(self.sizes):
                for low in range(0, n, STEP):
                    some = slice(low, low + STEP)
                    self._step([s[some] for s in slots], y[some], data.place[:n][some], times[:n][some], rate)
                seen.append((slots, y))
            for slots, y in seen:
                for slot in slots:
                    np.add.at(self.counts.reshape(-1), slot * 2 + y, times[: len(y)])  # of the table's type: numpy's fast way
        self.seen.append(found)
        self.chunks += 1

    def _step(self, slots: list[np.ndarray], y, place, times, rate: float) -> None:
        """Predict some bits, refine, and move the weights of each gate along the gradient."""
        table = self.counts.view(np.int64).ravel()  # both counts of a slot at once
        met = [table[s].view(np.int32).reshape(-1, 2) for s in slots]
        x = [odds_of(c) for c in met]
        gate, mixed = mix(x, levels_of(met[4]), levels_of(met[3]), self.weights, place)
        cell = gate * APM_CELLS + np.rint((mixed + REACH) * ((APM_CELLS - 1) / (2 * REACH))).astype(np.int64)
        cell += y * (GATES * APM_CELLS)
        self.apm += np.bincount(cell, times, 2 * GATES * APM_CELLS).astype(np.int64).reshape(2, -1)
        error = (y - 1.0 / (1.0 + np.exp(-mixed))) * times
        n = np.maximum(np.bincount(gate, times, GATES), 1)
        rate *= min(MOST_RATE, float(times.mean()))  # a step that stands for more bits moves further
        for i in range(INPUTS):
            # Log-odds come in 256ths, so their weights are 256 times smaller.
            unit = 256.0 if i < INPUTS - 1 else 1.0
            pull = np.bincount(gate, error * x[i] if i < INPUTS - 1 else error, GATES) / n / unit
            self.speed[:, i] += pull * pull
            self.weights[:, i] += (rate * pull / np.sqrt(self.speed[:, i]) / unit).astype(np.float32)

    def events(self) -> Events:
        """All that was learned."""
        if len(self.seen) != 1:
            self.seen = [Events.merged(self.seen) if self.seen else Events.of([])]
        return self.seen[0]

    def state(self) -> bytes:
        """The number of chunks, weights and refinement as whole numbers that can be added."""
        weights = self.weights.astype(np.float64)
        weights[:, : INPUTS - 1] *= 256
        weights = np.rint(weights * WEIGHT_UNIT).astype(np.int64) * self.chunks
        return np.concatenate([[self.chunks], weights.ravel(), self.apm.ravel()]).astype(np.int64).tobytes()

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """What the shard has learned, as blocks of whole numbers that can be added; block -1 is ``state``."""
        for block, parts in cells_of(self.events(), self.code, self.length, self.sizes):
            counts = np.zeros((BLOCK, 2), dtype=np.int32)
            for b, (place, count) in enumerate(parts):
                counts[place, b] = count
            yield block, counts.tobytes()
        yield -1, self.state()


def cells_of(found: Events, code, length, sizes: tuple[int, ...]) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(block, places and counts of zeros, and of ones) of some events; a block may come again."""
    for whole, often in found.batches(code, length, GATHERED):
        for i in reversed(range(PREDICTORS)):
            # Bytes that follow the same context of a predictor are added up first; each of the
            # orders goes on with the sums of the one above.
            at, start = grouped((whole.contexts[i] ^ (whole.code << np.uint64(4) | whole.length.astype(np.uint64)) * ODD) * MIX)
            times = np.add.reduceat(often[at], start)
            some = np.argsort(-whole.length.astype(np.int8)[at[start]], kind="stable")
            data, times = whole.take(at[start][some]), times[some]
            if i < PREDICTORS - 1:
                whole, often = data, times
            cells, counts = [], []
            for n, (keys,), y in data.keys([i]):
                cells.append(slots_of(keys, sizes[i]) * 2 + y)
                counts.append(times[:n])
            # Cells are moved to the high bits, where groups are told apart.
            high = np.uint64(63 - (2 * sizes[i]).bit_length())
            cell = np.concatenate(cells).view(np.uint64) << high
            at, start = grouped(cell)
            counts = np.add.reduceat(np.concatenate(counts)[at], start)
            cell = (cell[at[start]] >> high).view(np.int64)
            edges = np.searchsorted(cell, np.arange(0, 2 * sizes[i] + 1, 2 * BLOCK))
            for block, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if a < b:
                    one = (cell[a:b] & 1).astype(bool)
                    place = (cell[a:b] >> 1) % BLOCK
                    yield sum(sizes[:i]) // BLOCK + block, [(place[k], counts[a:b][k]) for k in (~one, one)]


def packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Places and counts of a block in three bytes each; what a count has above 255 follows."""
    out = []
    for place, count in parts:
        large = np.flatnonzero(count > 255)
        out += [
            np.array([len(place), len(large)], dtype=np.int32), place.astype(np.uint16), count.astype(np.uint8),
            place[large].astype(np.uint16), (count[large] >> 8).astype(np.int32),
        ]
    return b"".join(a.tobytes() for a in out)


def add_packed(data: bytes, total: np.ndarray) -> None:
    at = 0

    def read(n: int, kind) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, dtype=kind, count=n, offset=at)
        at += out.nbytes
        return out

    for b in (0, 1):
        n, large = read(2, np.int32)
        for count, kind, shift in ((n, np.uint8, 0), (large, np.int32, 8)):
            place = read(count, np.uint16)
            total[place, b] += read(count, kind).astype(np.int64) << shift


def events_of_texts(batch: pa.RecordBatch) -> Iterator[Events]:
    texts = texts_of(batch.column("text"))
    for a, b in slices(texts, LEARN_MOST):
        yield Events.of([t.encode().lower() + END for t in texts[a:b]])


def packed_events(batch: pa.RecordBatch) -> Iterator[Events]:
    return map(Events.unpack, batch.column("events").to_pylist())


def distinct_keys(
    rows: DataFrame, code: np.ndarray, length: np.ndarray, most: int = 1 << 20,
    read: Callable[[pa.RecordBatch], Iterable[Events]] = events_of_texts,
) -> list[int]:
    """How many distinct keys each predictor has in all ``rows``, from which ``read`` gets events.

    Keys are sampled by their hash, so each is counted once or not at all
    wherever it occurs, and what is counted is multiplied. A task holds about
    ``most`` sampled keys of a predictor.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=np.uint64) for _ in range(PREDICTORS)]

        def out(i):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held[i]), i, dtype=np.int32)), pa.array(held[i].view(np.int64))], names=["predictor", "key"]
            )

        for batch in batches:
            for events in read(batch):
                new = [[h] for h in held]
                for data, _ in events.batches(code, length):
                    for _, keys, _ in data.keys():
                        for i, h in enumerate(keys):
                            new[i].append(h[h >> np.uint64(64 - SAMPLE_BITS) == 0])
                held = [np.unique(np.concatenate(h)) for h in new]
                for i in range(PREDICTORS):
                    if len(held[i]) > most:
                        yield out(i)
                        held[i] = held[i][:0]
        for i in range(PREDICTORS):
            yield out(i)

    sampled = map_batches(rows, run, "predictor int, key bigint").distinct().groupBy("predictor").count()
    found = {r.predictor: r["count"] << SAMPLE_BITS for r in sampled.collect()}  # one row per predictor
    return [found.get(i, 0) for i in range(PREDICTORS)]


def table_sizes(keys: list[int]) -> tuple[int, ...]:
    """Slots of each predictor: ``SPARE`` for each distinct key, in whole blocks."""
    return tuple(BLOCK * max(1, -(-SPARE * n // BLOCK)) for n in keys)


def learn_events(texts: DataFrame, code: np.ndarray, length: np.ndarray, shards: int) -> DataFrame:
    """(part, events): the events of all ``shards`` added up, by a range of their hashes; part -1 has the
    weights and the refinement instead.

    A task learns a shard at a time, and adds up a part at a time.
    """
    parts = 4 * shards

    def rows(learner):
        learner.counts = None  # before the events take their memory
        found = learner.events()
        edges = np.searchsorted(found.hashes, [(k << 64) // parts for k in range(parts)] if len(found.times) else [])
        blocks = [(k, found.part(slice(a, b)).pack()) for k, (a, b) in enumerate(zip(edges, [*edges[1:], len(found.times)])) if a < b]
        for block, events in [*blocks, (-1, learner.state())]:
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([events], pa.binary())], names=["part", "events"])

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Reads texts sorted by shard; chunks go on from one batch to the next."""
        learner, current, chunk, size, wanted = None, None, [], 0, LEARN
        for batch in batches:
            for shard, text in zip(batch.column("shard").to_pylist(), texts_of(batch.column("text"))):
                if shard != current:
                    if learner:
                        if chunk:
                            learner.learn(chunk)
                        yield from rows(learner)
                    learner = None  # before the next takes its memory
                    learner, current, chunk, size, wanted = Learner(code, length, OWN), shard, [], 0, LEARN
                chunk.append(text.encode().lower())
                size += len(text)
                if size >= wanted:
                    learner.learn(chunk)
                    chunk, size, wanted = [], 0, min(2 * wanted, LEARN_MOST)
        if learner:
            if chunk:
                learner.learn(chunk)
            yield from rows(learner)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, n = None, [], 0

        def merged():
            return [np.sum(held, axis=0)] if current < 0 else [Events.merged(held)]

        def out():
            total = merged()[0]
            packed = total.tobytes() if current < 0 else total.pack()
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([packed], pa.binary())], names=["part", "events"])

        for batch in batches:
            for part, events in zip(batch.column("part").to_pylist(), batch.column("events")):
                if part != current:
                    if current is not None:
                        yield out()
                    current, held, n = part, [], 0
                held.append(np.frombuffer(events.as_buffer(), np.int64) if part < 0 else Events.unpack(events.as_py()))
                n += 1
                if n % 32 == 0:  # so many shards are held at a time
                    held = merged()
        if current is not None:
            yield out()

    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.withColumn("order", F.xxhash64("doc_id", "text")).withColumn("shard", F.pmod("order", F.lit(shards)))
    # Each shard is a partition of its own number, so none waits behind another by chance.
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "order")
    learned = map_batches(dealt.select("shard", "text"), learn, "part int, events binary")
    return map_batches(learned.repartition(n, "part").sortWithinPartitions("part"), add, "part int, events binary")


def tables(learned: DataFrame, code: np.ndarray, length: np.ndarray, sizes: tuple[int, ...]) -> DataFrame:
    """(block, states): the rows of ``learn_events`` turned into the tables of the model;
    block -1 has the weights and the refinement instead.

    Blocks are streamed in order, so a task holds one sum at a time.
    """
    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(block, counts):
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([counts], pa.binary())], names=["block", "counts"])

        def out(held):
            for block, parts in cells_of(Events.joined(held), code, length, sizes) if held else []:
                yield row(block, packed(parts))

        held, n = [], 0
        for batch in batches:
            for part, events in zip(batch.column("part").to_pylist(), batch.column("events")):
                if part < 0:
                    yield row(part, events.as_py())
                    continue
                held.append(Events.unpack(events.as_py()))
                n += len(held[-1].times)
                if n >= GATHERED:
                    yield from out(held)
                    held, n = [], 0
        yield from out(held)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None

        def out():
            states = total if current < 0 else states_of(odds_of(total), levels_of(total))
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([states.tobytes()], pa.binary())], names=["block", "states"])

        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                if block != current:
                    if current is not None:
                        yield out()
                    current, total = block, np.zeros(len(counts.as_buffer()) // 8 if block < 0 else (BLOCK, 2), dtype=np.int64)
                if block < 0:
                    total += np.frombuffer(counts.as_buffer(), dtype=np.int64)
                else:
                    add_packed(counts.as_py(), total)
        if current is not None:
            yield out()

    n = int(learned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = map_batches(learned, cells, "block int, counts binary")
    return map_batches(parts.repartition(n, "block").sortWithinPartitions("block"), add, "block int, states binary")


# -- scoring --------------------------------------------------------------


class Scorer:
    """The learned model: a state per slot of each predictor, weights, cost of each outcome."""

    def __init__(self, code, length, sizes, states, weights, cost):
        self.code, self.length, self.sizes = code, length, sizes
        self.states, self.weights, self.cost = states, weights, cost
        self.known = None  # hashes and costs of events, made where it scores

    def token_bits(self, tokens: list[bytes]) -> np.ndarray:
        """Bits that each of some texts or tokens costs on its own.

        An event that was met lately is not priced again; its place in the memory follows
        from its hash, which is compared.
        """
        if not tokens:
            return np.zeros(0)
        if self.known is None:
            self.known = np.zeros(1 << MEMO_BITS, dtype=np.uint64), np.zeros(1 << MEMO_BITS)
            self.known[0][0] = ~np.uint64(0)  # belongs to the last place, so the first is empty too
        hashes, costs = self.known
        places = Places(tokens)
        events = places.events()
        slot = (events >> np.uint64(64 - MEMO_BITS)).view(np.int64)
        bits = costs[slot]
        new = np.flatnonzero(hashes[slot] != events)
        if len(new):
            at, start = grouped(events[new])
            picked = new[at[start]]
            priced = self._price(places.take(picked))
            bits[new[at]] = np.repeat(priced, np.diff(np.append(start, len(at))))
            hashes[slot[picked]], costs[slot[picked]] = events[picked], priced
        return np.bincount(places.owner, bits, len(tokens))

    def _price(self, places: Places) -> np.ndarray:
        out = np.zeros(len(places.byte))
        for low in range(0, len(out), 2 * STEP):
            some = slice(low, low + 2 * STEP)
            data = Bytes(places.take(some), self.code, self.length)
            total = np.zeros(len(data.order))
            for n, keys, y in data.keys():
                slots = [slots_of(h, size) for h, size in zip(keys, self.sizes)]
                met = [states[s] for states, s in zip(self.states, slots)]
                x = [STATE_ODDS[m] for m in met]
                gate, mixed = mix(x, STATE_LEVELS[met[4]], STATE_LEVELS[met[3]], self.weights, data.place[:n])
                cell = ((mixed + np.float32(REACH)) * np.float32((FINE - 1) / (2 * REACH)) + np.float32(0.5)).astype(np.int32)
                total[:n] += self.cost[(gate * FINE + cell) * 2 + y]
            out[some][data.order] = total
        return out


class KnownWords:
    """Numbers, base scores and, with a scorer, costs on their own of the words that a worker has met lately.

    A word is looked up once per occurrence; all else is array work. Beyond
    ``KNOWN_TOKENS`` words it starts anew, so its size is bounded.
    """

    def __init__(self, scorer: Scorer | None, base: dict[bytes, float]):
        self.scorer, self.base_of = scorer, base
        self.end = float(scorer.token_bits([END])[0]) if scorer else 0.0
        self._clear()

    def _clear(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.words: list[bytes] = []  # by number
        self.bits = self.base = np.zeros(0)

    def numbers(self, texts: list[list[bytes]]) -> np.ndarray:
        """The number of each word of all texts; costs of new words are added."""
        if len(self.number) > KNOWN_TOKENS:
            self._clear()
        found = np.fromiter(map(self.number.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        # The newest words are the last of the dict.
        new = list(islice(reversed(self.number), len(self.number) - len(self.words)))[::-1]
        self.words += new
        for low in range(0, len(new), 1 << 15):
            some = new[low : low + (1 << 15)]
            own = self.scorer.token_bits([w + b" " for w in some]) if self.scorer else np.zeros(len(some))
            self.bits = np.concatenate([self.bits, own])
            self.base = np.concatenate([self.base, [self.base_of.get(w, np.nan) for w in some]])
        return found

    def score(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.ListArray, pa.ListArray]:
        """Per text: bits, how many words have a base score and its sum, the other words and how often."""
        n = len(texts)
        word = self.numbers(texts)
        owner = np.repeat(np.arange(n), [len(t) for t in texts])
        base = self.base[word]
        has = ~np.isnan(base)
        bits = np.bincount(owner, self.bits[word], n) + self.end
        total = np.bincount(owner, np.where(has, base, 0.0), n)
        pairs, times = np.unique(owner[~has] * len(self.bits) + word[~has], return_counts=True)
        size = max(1, len(self.bits))
        offsets = pa.array(np.searchsorted(pairs // size, np.arange(n + 1)), pa.int32())
        words = pa.array([self.words[i] for i in (pairs % size).tolist()], pa.binary())
        return (
            bits, np.bincount(owner, has, n).astype(np.int64), total,
            pa.ListArray.from_arrays(offsets, words), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
        )


def cost_table(apm: np.ndarray) -> np.ndarray:
    """Bits for a zero and a one, per gate and mixed log-odds: half the mixer's
    probability, half the refined one. A rarely met cell keeps the mixer's."""
    grid = np.linspace(-REACH, REACH, FINE)
    own = 1.0 / (1.0 + np.exp(-grid))
    centre = 1.0 / (1.0 + np.exp(-np.linspace(-REACH, REACH, APM_CELLS)))
    out = np.empty((GATES, FINE, 2))
    zeros, ones = apm.reshape(2, GATES, APM_CELLS)
    for g in range(GATES):
        met = (ones[g] + 8.0 * centre) / (zeros[g] + ones[g] + 8.0)
        p = 0.5 * own + 0.5 * np.interp(grid, np.linspace(-REACH, REACH, APM_CELLS), met)
        p = np.clip(p, 1e-6, 1 - 1e-6)
        out[g, :, 0], out[g, :, 1] = -np.log2(1 - p), -np.log2(p)
    return out.ravel()


def scorer_from(rows: Iterable[tuple[int, bytes, bytes | None]], code: np.ndarray, length: np.ndarray, sizes: tuple[int, ...] = LEAST) -> Scorer:
    """The model from (block, log-odds, levels), or from the rows of ``tables`` and None for levels."""
    states = [np.zeros(size, dtype=np.uint8) for size in sizes]
    starts = np.cumsum([0, *sizes[:-1]]) // BLOCK
    weights, apm = first_weights(), np.zeros((2, GATES * APM_CELLS), dtype=np.int64)
    for block, some_odds, some_levels in rows:
        if block >= 0:
            i = int(np.searchsorted(starts, block, "right")) - 1
            low = (block - int(starts[i])) * BLOCK
            known = some_levels is None
            states[i][low : low + BLOCK] = np.frombuffer(some_odds, np.uint8) if known else states_of(
                np.frombuffer(some_odds, np.int16), np.frombuffer(some_levels, np.uint8)
            )
            continue
        values = np.frombuffer(some_odds, dtype=np.int64)
        if values[0]:
            mean = values[1 : 1 + GATES * INPUTS].reshape(GATES, INPUTS) / (values[0] * WEIGHT_UNIT)
            weights = mean.astype(np.float32)
            weights[:, : INPUTS - 1] /= 256
        apm = values[1 + GATES * INPUTS :].reshape(2, -1)
    return Scorer(code, length, sizes, states, weights, cost_table(apm))


# -- the base -------------------------------------------------------------


def count_words(texts: DataFrame, flush: int = 200_000) -> tuple[DataFrame, np.ndarray]:
    """(word, c) over all texts, and how often each byte occurs.

    A task adds up before the shuffle and holds at most ``flush`` words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(times, kind):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(times), pa.binary()), pa.array(list(times.values()), pa.int64()), pa.array([kind] * len(times), pa.bool_())],
                names=["word", "c", "is_byte"],
            )

        times, raw = Counter(), np.zeros(256, dtype=np.int64)
        for batch in batches:
            for text in texts_of(batch.column("text")):
                low = text.encode().lower()
                times.update(low.split())
                raw += np.bincount(np.frombuffer(low + END, dtype=np.uint8), minlength=256)
                if len(times) > flush:
                    yield out(times, False)
                    times = Counter()
        yield out(times, False)
        yield out({bytes([b]): int(c) for b, c in enumerate(raw) if c}, True)

    parts = map_batches(texts, run, "word binary, c bigint, is_byte boolean")
    counts = materialize(parts.groupBy("is_byte", "word").agg(F.sum("c").alias("c")), "lm-words")
    raw = np.zeros(256, dtype=np.int64)
    for row in counts.where("is_byte").collect():  # 256 rows at most
        raw[row.word[0]] = row.c
    return counts.where("NOT is_byte").select("word", "c"), raw


def common_words(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The counts of the commonest words, at most ``most`` of them.

    A histogram of the counts on a scale of eighths of a doubling, some hundred
    rows, gives the count from which on they are few enough; nothing is sorted.
    """
    step = F.floor(F.log2("c") * 8).cast("int")
    found, lowest = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        found += row["count"]
        if found > most:
            break
        lowest = row.step
    if lowest is None:
        return {}
    rows = counts.where(step >= lowest).toArrow()
    return dict(zip(rows.column("word").to_pylist(), rows.column("c").to_pylist()))


def score_texts(docs: DataFrame, held_out: str, doc_id="doc_id", text="text", frequent: int = 120_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from the rows whose ``held_out`` is false. Counts of the
    ``frequent`` commonest words are broadcast (at most that many); all other
    words meet their counts in a join.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{held_out}`").alias("held_out"), F.col(f"`{text}`").alias("text"))
    training = given.where("NOT held_out").select("doc_id", "text")
    counts, raw = count_words(training)
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = int(raw[END[0]])  # one per training row
    n, v = (total.n or 0) + ends, total.v + (ends > 0)
    code, length = prefix_code(raw)
    with scratch(spark, "lm-model"):
        # Written, so that a lost executor does not repeat the learning; not needed once the model is made.
        events = materialize(learn_events(training, code, length, max(1, -(-int(raw.sum()) // SHARD))), "lm-events")
        sizes = table_sizes(distinct_keys(events.where("part >= 0"), code, length, read=packed_events))
        learned = materialize(tables(events, code, length, sizes), "lm-counts")
        scorer = scorer_from(((r.block, bytes(r.states), None) for r in learned.toLocalIterator()), code, length, sizes)
    model = spark.sparkContext.broadcast((scorer, common_words(counts, frequent)))
    size = n + (v + 1)  # add-one smoothing over the known tokens and one unknown

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, hot = model.value
        known = KnownWords(None, {w: log10((c + 1) / size) for w, c in hot.items()})
        at_end = log10((ends + 1) / size)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in slices(texts, CHUNK):
                low = [t.encode().lower() for t in texts[a:b]]
                split = [t.split() for t in low]
                _, found, base, rest, times = known.score(split)
                bits = scorer.token_bits([t + END for t in low])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in ("row_no", "doc_id", "held_out")],
                        pa.array([len(t) + 1 for t in split], pa.int64()), pa.array(found + (ends > 0)), pa.array(base + at_end),
                        rest, times, pa.array(bits * -log10(2)),
                    ],
                    names=["row_no", "doc_id", "held_out", "n_tokens", "n_known", "base", "rest", "times", "score"],
                )

    kind = given.schema["doc_id"].dataType.simpleString()
    numbered = given.withColumn("row_no", F.monotonically_increasing_id())
    scored = materialize(
        map_batches(
            numbered, run,
            f"row_no bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, "
            "rest array<binary>, times array<bigint>, score double",
        ),
        "lm-scored",
    )
    rare = scored.select("row_no", F.explode(F.arrays_zip("rest", "times")).alias("r")).select("row_no", F.col("r.rest").alias("word"), "r.times")
    c = F.coalesce("c", F.lit(0))
    added = (
        rare.join(counts, "word", "left")
        .groupBy("row_no")
        .agg(
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(size)))).alias("more_base"),
        )
    )
    return scored.join(added, "row_no", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score",
    )
