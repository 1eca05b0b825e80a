"""Periodic runs of words: stretches that repeat a pattern of q words four times or more.

An online sparse diagonal programme: word i meets its earlier occurrences; each, q
words before, makes the match of lag q one word longer, and a lag whose match ends
emits a run at once if that was long enough.

Which earlier occurrences can matter is decided exactly. A run of smallest period q,
2^k <= q < 2^(k+1), has 4q words or more, so behind its first q + m words, m = 2^(k+1),
word i ends the same m words as word i - q. No nearer word does: with a nearer one, at
lag d, the m + d words up to i would have the periods q and d, m + d >= q + d, so also
their common divisor (Fine and Wilf), and the whole run with them, against q being the
smallest. So for each k a word meets its nearest earlier occurrence at the end of the
same m words, if that is 2^k to m - 1 words before: at most one per doubling. Conversely
a match of that kind over words i to j covers the words i - m + 1 - q to j with smallest
period q, and extends no further, by the same argument.

Contexts of 2m words are named by pairs of names of m words; contexts that occur once
in their text drop out at every doubling, so ordinary texts end after a few.

Rules: a word is a run of anything but six ASCII blanks; words are compared as they
are. A null text has no words. A null id counts as any other. Rows may repeat, each
gives one row. An empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from panelwright.llm.common import append_columns, slices, texts_of

CHUNK = 4_000_000  # characters whose words are numbered together
LEAST, TIMES = 6, 4  # words and periods that a run has at least

Run = tuple[int, int, int]  # start, length, period


def meetings(word: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, lag, m) of every word that meets an earlier occurrence, by place.

    ``word`` numbers the words of several texts one behind the other, ``text`` says
    which text each is from, in order.
    """
    longest = int(np.bincount(text).max(initial=0))
    found = []
    # Names of the 2^k words from a place on, for the places that are still in question.
    place, name, width, k = np.arange(len(word)), word, 1, 0
    while TIMES * (1 << k) <= longest:
        # Names of m = 2^(k+1) words: a name and the one ``width`` words on, in one text.
        whole = np.full(len(word) + 1, -1, dtype=np.int64)
        whole[place] = name
        ahead = np.minimum(place + width, len(word))
        inside = (whole[ahead] >= 0) & (text[np.minimum(ahead, len(word) - 1)] == text[place])
        place, ahead = place[inside], ahead[inside]
        if not len(place):
            break
        size = int(whole.max()) + 1
        key = (text[place] - text[0]) * size * size if (int(text[-1] - text[0]) + 1) * size * size < 1 << 62 else None
        if key is None:  # too many names for one number: name the pairs first
            _, pair = np.unique(whole[place] * size + whole[ahead], return_inverse=True)
            key = (text[place] - text[0]) * (int(pair.max()) + 1) + pair
        else:
            key = key + whole[place] * size + whole[ahead]
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        same = sorted_key[1:] == sorted_key[:-1]
        number = np.concatenate([[0], np.cumsum(~same)])
        # The nearest earlier occurrence of the same m words.
        later, earlier = place[order[1:][same]], place[order[:-1][same]]
        lag, m = later - earlier, 1 << k + 1
        fits = (lag >= 1 << k) & (lag < m)
        found.append((later[fits] + m - 1, lag[fits], np.full(int(fits.sum()), m)))
        kept = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        place, name = place[order[kept]], number[kept]
        width, k = m, k + 1
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    at, lag, m = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(at, kind="stable")
    return at[order], lag[order], m[order]


def emit_runs(at: np.ndarray, lag: np.ndarray, m: np.ndarray) -> list[Run]:
    """The runs of one or several texts from their meetings, in the order of their ends."""
    active: dict[int, list[int]] = {}  # lag: first word of the run, last word so far
    out: list[Run] = []

    def ended(before: int) -> None:
        for q in [q for q, (_, last) in active.items() if last < before]:
            start, last = active.pop(q)
            length = last - start + 1
            if length >= max(LEAST, TIMES * q):
                out.append((start, length, q))

    word = -1
    for i, q, context in zip(at.tolist(), lag.tolist(), m.tolist()):
        if i != word:
            ended(i - 1)
            word = i
        open_run = active.get(q)
        if open_run is not None and open_run[1] == i - 1:
            open_run[1] = i
        else:
            if open_run is not None:
                ended(i)
            active[q] = [i - context - q + 1, i]
    ended(1 << 62)
    return out


def runs_of(words: list[np.ndarray]) -> list[list[Run]]:
    """The runs of each of some texts, given as numbers of words; by start, then period."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    ends = np.cumsum(sizes)
    out: list[list[Run]] = [[] for _ in words]
    if not int(sizes.sum()):
        return out
    text = np.repeat(np.arange(len(words)), sizes)
    at, lag, m = meetings(np.concatenate(words), text)
    # A text of its own for each sweep: lags of one do not go on in the next.
    bounds = np.searchsorted(at, ends)
    for i in np.unique(text[at]).tolist():
        low, base = (int(bounds[i - 1]) if i else 0), int(ends[i] - sizes[i])
        out[i] = sorted((s - base, n, q) for s, n, q in emit_runs(at[low : bounds[i]], lag[low : bounds[i]], m[low : bounds[i]]))
    return out


def best_run(found: list[Run]) -> Run | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for run in sorted(found, key=lambda r: (r[0], r[2])):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, found: list[Run]) -> np.ndarray:
    """Which of ``n`` words no run contains after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, q in found:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def periodic_copy(doc_id, n: int) -> np.ndarray | None:
    """Which original word stands at each of ``n`` places, for ids that a fixed rule
    chooses: from some word on, a tenth of the texts repeat a pattern. None: unchanged."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    return np.where(place < a, place, a + (place - a) % p)


def collapse_runs(
    docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text",
    respell: Callable[[object, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """``keep``; n_runs; start, length, period, exponent_milli of the run with the most
    periods; runs_sha256 and collapsed_sha256: of all runs, and of the text without the
    words that only repeat.

    ``respell(id, number of words)`` may put words in other places first. A narrow
    step: nothing is shuffled.
    """
    return _narrow(docs, keep, doc_id, text, respell, _digests, DIGESTS)


def find_runs(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep``, runs (start, length, period of each, by start, then period) and
    collapsed: the words that no run repeats, joined by one space; null for a null text."""
    return _narrow(docs, keep, doc_id, text, None, _plain, PLAIN)


DIGESTS = [
    ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"), ("exponent_milli", "bigint"),
    ("runs_sha256", "string"), ("collapsed_sha256", "string"),
]
PLAIN = [("runs", "array<struct<start:bigint,length:bigint,period:bigint>>"), ("collapsed", "string")]


def _digests(words: list[bytes], found: list[Run], _) -> tuple:
    best = best_run(found)
    best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    written = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = kept_words(len(words), found).tolist() if found else None
    collapsed = b" ".join(words if kept is None else [w for w, k in zip(words, kept) if k])
    return len(found), *best, hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()


def _plain(words: list[bytes], found: list[Run], is_null: bool) -> tuple:
    kept = kept_words(len(words), found).tolist()
    collapsed = None if is_null else b" ".join([w for w, k in zip(words, kept) if k]).decode()
    return [{"start": s, "length": n, "period": q} for s, n, q in found], collapsed


def _narrow(docs, keep, doc_id, text, respell, finish, fields) -> DataFrame:
    def run(ids, column):
        rows, texts = [], texts_of(column)
        nulls, ids = column.is_null().to_pylist(), ids.to_pylist()
        for low, high in slices(texts, CHUNK):
            words = [t.encode().split() for t in texts[low:high]]
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            numbers = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, sum(map(len, words)))
            found = np.split(numbers, np.cumsum([len(w) for w in words])[:-1])
            for i, own in enumerate(words):
                moved = respell(ids[low + i], len(own)) if respell else None
                if moved is not None:
                    found[i] = found[i][moved]
                    words[i] = [own[j] for j in moved.tolist()]
            for i, runs in enumerate(runs_of(found)):
                rows.append(finish(words[i], runs, nulls[low + i]))
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in fields]

    return append_columns(docs, run, fields, [doc_id, text], keep)
