"""Secrets in texts: fixed patterns, and values that would be hard to guess.

The base patterns find assignments to a known name, access keys and long hex
runs. Beyond them, every value that stands behind a credential-like name is
priced by dynamic programming: the cheapest way to write it as words, dates,
repeats, keyboard walks and brute-force spans, in decimal digits of guesses. A
value that costs ``min_digits`` or more is a secret; placeholders are cheap and
stay. Words are ranked by how often the corpus has them outside such values, so
ordinary words stay too. A quoted value goes up to its closing quote.

Nulls count as empty texts; an empty text has no spans. Positions are code
points, end exclusive. Every row gives one row; long texts are searched whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.llm.common import append_columns, fresh, map_batches, texts_of
from panelwright.llm.lm import common_words
from panelwright.session import materialize

KINDS = ("assign", "access", "hex", "guess")

_assign = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_access = re.compile(r"AKIA[A-Z0-9]+")
_hex = re.compile(r"[0-9a-f]{24,}")
#: Names of credentials in a wider sense.
_name = re.compile(
    r"""pass(?:word|wd|phrase|code)?|pwd|secret|token|credential|(?:api|access|private|auth)[_-]?key|bearer""", re.I | re.A
)
#: A whole name and a separator; the value is matched behind it.
_head = re.compile(
    r"""(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)(?:["']?[\x20\t]*+(?::=|=>|[:=])[\x20\t]*+|(?<=bearer)[\x20\t]++)""", re.I | re.A
)
#: A value with or without quotes.
_value = re.compile(
    r""""((?:[^"\\\r\n]|\\[^\r\n])+)"|'((?:[^'\\\r\n]|\\[^\r\n])+)'|["']?([^\s"',;]*[^\s"',;:.!?])""", re.A
)
_letters = re.compile(r"[^\W\d_]{3,24}")
#: One of these is in every text that a pattern with a name can match.
_hints = ("pass", "pwd", "secret", "token", "credential", "key", "bearer")

#: Frequent words of passwords and placeholders, most frequent first.
WORDS = (
    "password secret token key admin user test example changeme your here none null true false the my this that is "
    "placeholder insert value string default login welcome letmein master root guest access private public api auth "
    "dragon monkey football baseball sunshine princess shadow superman batman trustno iloveyou love hello world "
    "freedom whatever computer internet server service system data base code name email mail phone number word pass "
    "enter replace with todo dummy sample foo bar baz temp new old big small red blue green black white money secure "
    "security bearer basic env config var file path home summer winter spring autumn monday friday january june july "
    "august december london paris berlin madrid michael jennifer thomas jordan daniel andrew charlie robert"
).split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LONGEST = max(map(len, WORDS))
#: Rows of a keyboard and the two plain sequences.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0123456789")
NEXT = {pair for row in ROWS for line in (row, row[::-1]) for pair in zip(line, line[1:])}
LEET = str.maketrans("430157$@!", "aeoistsai")
_date = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")

SEGMENT = 0.3  # digits of guesses for where a segment that is no brute force begins


def brute_force(char: str) -> float:
    if char.isdigit():
        return 1.0
    if char.isalpha():
        return log10(26) if char.islower() else log10(52)
    return log10(33)


class Cheapest:
    """The cheapest start of a growing segment, at ``price(start) + log10(end - start)``.

    A start that an earlier one beats stays beaten, as the logarithm of the longer
    segment grows more slowly. What is kept are starts that none beats, each cheaper
    than the one before, and for each the end from which on the one before beats it.
    """

    def __init__(self):
        self.price, self.before, self.after = {}, {}, {}
        self.last = None
        self.events: list[tuple[float, int, int]] = []

    def _pair(self, early: int, late: int) -> None:
        self.before[late], self.after[early] = early, late
        ratio = 10.0 ** min(self.price[late] - self.price[early], 300.0)
        if ratio > 1.0:
            heappush(self.events, ((ratio * late - early) / (ratio - 1.0), late, early))

    def add(self, start: int, price: float, end: int) -> None:
        """A later start than all before."""
        if self.last is not None and price + log10(end - start) >= self.cost(end):
            return
        self.price[start] = price
        if self.last is not None:
            self._pair(self.last, start)
        self.last = start

    def cost(self, end: int) -> float:
        while self.events and self.events[0][0] <= end:
            _, late, early = heappop(self.events)
            if late not in self.price or self.before.get(late) != early:
                continue
            del self.price[late], self.before[late]
            after = self.after.pop(late, None)
            self.after.pop(early, None)
            if after is None:
                self.last = early
            else:
                self._pair(early, after)
        return self.price[self.last] + log10(end - self.last)


def words_ending(value: str, lower: str, plain: str, end: int, ranks: dict[str, int]) -> Iterator[tuple[int, float]]:
    """(start, digits of guesses) of words and dates up to ``end``."""
    for start in range(max(0, end - max(LONGEST, 24)), end - 1):
        rank = ranks.get(lower[start:end])
        leet = 0.0 if rank else 0.3
        rank = rank or ranks.get(plain[start:end])
        if rank:
            case = 0.0 if value[start:end] == lower[start:end] else 0.6
            yield start, SEGMENT + log10(rank + 1) + leet + case
    for size in (4, 8, 10):
        if end >= size and _date.fullmatch(value, end - size, end):
            yield end - size, SEGMENT + (log10(200) if size == 4 else log10(365 * 200))


def guess_digits(value: str, ranks: dict[str, int] = RANK) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs.

    Words, dates and single characters have few starts per end. Keyboard walks and
    repeats of a unit of one to four characters may be of any length; they go on from
    one end to the next, so a long one costs no more per character than a short one.
    """
    lower = value.lower() if len(value.lower()) == len(value) else value
    plain = lower.translate(LEET)
    best, char = [0.0], list(map(brute_force, value))
    walk, walk_from = None, 0
    run, repeats = [0] * 5, [None] * 5
    for end in range(1, len(value) + 1):
        least = best[end - 1] + char[end - 1]
        for start, cost in words_ending(value, lower, plain, end, ranks):
            least = min(least, best[start] + cost)
        if end < 2 or (lower[end - 2], lower[end - 1]) not in NEXT:
            walk, walk_from = None, end - 1
        elif end - walk_from >= 3:
            walk = walk or Cheapest()
            walk.add(end - 3, best[end - 3], end)
            least = min(least, SEGMENT + log10(94) + walk.cost(end))
        for unit in range(1, 5):
            if end <= unit or value[end - 1] != value[end - 1 - unit]:
                run[unit], repeats[unit] = 0, None
                continue
            run[unit] += 1
            times = 3 if unit == 1 else 2  # two characters are no repeat
            if run[unit] >= unit * (times - 1):
                if repeats[unit] is None:
                    repeats[unit] = [Cheapest() for _ in range(unit)]
                starts = repeats[unit][end % unit]
                starts.add(end - unit * times, best[end - unit * times], end)
                # Times are characters divided by the unit.
                least = min(least, SEGMENT + sum(char[end - unit : end]) + starts.cost(end) - log10(unit))
        best.append(least)
    return best[-1]


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, start and end of the secret itself), sorted."""
    spans = []
    lower = text.lower()
    if "password" in lower or "passwd" in lower or "secret" in lower or "token" in lower or "key" in lower:
        spans += [(m.start(), 0, m.end(), *m.span(2)) for m in _assign.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), *m.span()) for m in _access.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end(), *m.span()) for m in _hex.finditer(text)]
    return sorted(spans)


def values(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each value in a credential context."""
    lower = text.lower()
    if not any(h in lower for h in _hints):
        return
    for m in _head.finditer(text):
        if _name.search(m[1]) and (found := _value.match(text, m.end())):
            yield found.span(found.lastindex)


def guessed_spans(text: str, base: list, min_digits: float, min_length: int = 6, ranks: dict[str, int] = RANK) -> list:
    """Values in credential contexts that are hard to guess and not in a base span."""
    spans, last = [], -1
    for start, end in values(text):
        if end - start < min_length or end <= last or any(b[3] <= start and end <= b[4] for b in base):
            continue
        if guess_digits(text[start:end], ranks) >= min_digits:
            spans.append((start, 3, end, start, end))
            last = end
    return spans


def find_spans(text: str, min_digits: float, ranks: dict[str, int] = RANK) -> list:
    base = base_spans(text)
    return sorted(base + guessed_spans(text, base, min_digits, ranks=ranks))


def word_ranks(docs: DataFrame, text: str = "text", most: int = 200_000, flush: int = 200_000) -> dict[str, int]:
    """Ranks of ``WORDS`` and of the commonest words of all texts, at most ``most`` of them.

    Words in credential values do not count, and neither do those that occur once.
    A task adds up before the shuffle and holds about ``flush`` words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(times):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(times), pa.string()), pa.array(list(times.values()), pa.int64())], names=["word", "c"]
            )

        times: Counter = Counter()
        for batch in batches:
            for t in texts_of(batch.column("text")):
                at, parts = 0, []
                for start, end in values(t):
                    parts.append(t[at:start])
                    at = max(at, end)
                times.update(_letters.findall(" ".join([*parts, t[at:]]).lower()))
                if len(times) > flush:
                    yield out(times)
                    times = Counter()
        yield out(times)

    parts = map_batches(docs.select(F.col(f"`{text}`").alias("text")), run, "word string, c bigint")
    counts = materialize(parts.groupBy("word").agg(F.sum("c").alias("c")).where("c > 1"), "secret-words")
    found = sorted(common_words(counts, most).items(), key=lambda x: (-x[1], x[0]))
    ranks = {w: i + 1 for i, (w, _) in enumerate(found)}
    return ranks | {w: min(r, ranks.get(w, r)) for w, r in RANK.items()}


def written(spans: list) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _, _ in spans])


def scan(docs: DataFrame, keep: list[str], text: str = "text", min_digits: float = 8.0) -> DataFrame:
    """``keep``, n_assign, n_access, n_hex, base_sha256, spans, n_guess."""
    words = docs.sparkSession.sparkContext.broadcast(word_ranks(docs, text))

    def run(column):
        rows = []
        for t in texts_of(column):
            spans = find_spans(t, min_digits, words.value)
            base = [s for s in spans if s[1] < 3]
            counts = [sum(1 for s in spans if s[1] == k) for k in range(4)]
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            rows.append((*counts[:3], digest, written(spans), counts[3]))
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(6)]

    fields = [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"),
              ("spans", "string"), ("n_guess", "bigint")]
    return append_columns(docs, run, fields, [text], keep)


def redact_text(text: str, min_digits: float, mark: str, ranks: dict[str, int] = RANK) -> str:
    """``text`` with each secret replaced; overlapping ones become one mark."""
    out, at, last = [], 0, -1
    for start, end in sorted((s[3], s[4]) for s in find_spans(text, min_digits, ranks)):
        if start > last:
            out += (text[at:start], mark)
        at = last = max(last, end)
    return "".join([*out, text[max(at, 0):]]) if out else text


def redact(docs: DataFrame, text: str = "text", min_digits: float = 8.0, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs`` with the secrets in ``text`` replaced; null stays null."""
    clean = fresh(docs, "clean")
    words = docs.sparkSession.sparkContext.broadcast(word_ranks(docs, text))

    def run(column):
        return [[None if t is None else redact_text(t, min_digits, mark, words.value) for t in column.to_pylist()]]

    out = append_columns(docs, run, [(clean, "string")], [text], [c for c in docs.columns if c != text])
    kept = {f.name: f.dataType for f in docs.schema}
    assert isinstance(kept[text], T.StringType)
    return out.select(*[F.col(f"`{clean}`").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns])
