"""Quality rules: exact document statistics, and boosted trees over them.

Trees are fitted with a logistic loss on a bounded sample of labelled documents
(``fit_rows``, documented and chosen by a hash of the id), are complete binary
trees, and live in flat numpy arrays, so a batch is scored level by level
without branching. Chosen features are monotone: more symbols, repeats or
capitals never raise the quality.

Rules: a null text has no words; documents that fail a base rule are never
kept; without labels of both classes there is no model, and the base rules
decide alone. A repeated label counts as its lowest quality. Rows may repeat,
each gives one row. Column names other than those asked for do not matter.
"""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import append_columns, fresh, texts_of
from panelwright.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = string.ascii_uppercase.encode()
DIGITS = string.digits.encode()
PUNCTUATION = b"!?.,;:"
#: Name and direction of each feature: -1 never raises the quality, 0 is free.
FEATURES = [
    ("words", 0), ("mean_word", 0), ("longest_word", 0), ("symbols_per_word", -1), ("duplicate_lines", -1),
    ("repeated_words", -1), ("capitals", -1), ("digits", 0), ("punctuation", 0), ("distinct_words", 0),
    ("words_per_line", 0), ("shouts", -1), ("commonest_word", 0), ("lone_symbols", -1),
]


def rule_counts(text: str) -> tuple[int, int, int, int, int, list[bytes], list[str]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the words and lines."""
    words = text.encode().split()
    word_chars = len(text) - sum(map(text.count, BLANKS))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    n_dup_lines = len(lines) - len(set(lines))
    return len(words), word_chars, n_symbols, n_dup_lines, repeated_words(words), words, lines


def repeated_words(words: list[bytes]) -> int:
    """Words in a window of five that occurs at least twice."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    marked = bytearray(len(words))
    for i, window in enumerate(windows):
        if times[window] > 1:
            marked[i : i + 5] = b"\1\1\1\1\1"
    return sum(marked)


def features(text: str, counts: tuple) -> list[float]:
    n, chars, symbols, dup_lines, repeated, words, lines = counts
    if not n:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    times = Counter(words)
    return [
        np.log1p(n), chars / n, min(64, max(map(len, words))), symbols / n, dup_lines / len(lines), repeated / n,
        (len(raw) - len(raw.translate(None, UPPER))) / chars, (len(raw) - len(raw.translate(None, DIGITS))) / chars,
        (len(raw) - len(raw.translate(None, PUNCTUATION))) / n, len(times) / n, n / len(lines),
        text.count("!!") / n, max(times.values()) / n, sum(times.get(s.encode(), 0) for s in SYMBOLS) / n,
    ]


def base_fails(n_words: int, n_repeat: int) -> bool:
    return n_words < 10 or 100 * n_repeat > 20 * n_words


@dataclass
class Trees:
    """Complete trees in flat arrays: inner nodes by level, then leaves."""

    depth: int
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of ``x``."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**self.depth - 1)]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, signs: list[int], n_trees: int = 60, depth: int = 4, rate: float = 0.2,
    bins: int = 64, ridge: float = 2.0, least: float = 2.0,
) -> Trees:
    """Histogram boosting with monotone features.

    A split on a monotone feature is allowed only if its sides are in order;
    their middle then bounds all leaves below, so no later split undoes it.
    """
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(k)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    rate_of = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    base = float(np.log(rate_of / (1 - rate_of)))
    score = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    trees = Trees(depth, np.zeros((n_trees, inner), np.int64), np.full((n_trees, inner), np.inf), np.zeros((n_trees, leaves)), base)

    def value(g, h, low, high):
        return np.clip(-g / (h + ridge), low, high)

    for t in range(n_trees):
        p = 1.0 / (1.0 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for level in range(depth):
            width = 2**level
            at = node - (width - 1)
            sums = []
            for j in range(k):
                cell = at * bins + binned[:, j]
                sums.append([np.bincount(cell, w, width * bins).reshape(width, bins) for w in (grad, hess)])
            for i in range(width):
                own = width - 1 + i
                low, high = bounds[own]
                best = (1e-9, 0, np.inf, (low, high), (low, high))
                for j in range(k):
                    g, h = sums[j][0][i], sums[j][1][i]
                    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
                    gr, hr = g.sum() - gl, h.sum() - hl
                    wl, wr = value(gl, hl, low, high), value(gr, hr, low, high)
                    whole = value(g.sum(), h.sum(), low, high)
                    gain = lambda w, g, h: -(g * w + 0.5 * (h + ridge) * w * w)
                    won = gain(wl, gl, hl) + gain(wr, gr, hr) - gain(whole, g.sum(), h.sum())
                    fine = (hl >= least) & (hr >= least) & (np.arange(bins - 1) < len(edges[j]))
                    if signs[j]:
                        fine &= signs[j] * (wr - wl) >= 0
                    won = np.where(fine, won, -np.inf)
                    b = int(np.argmax(won))
                    if won[b] > best[0]:
                        left = right = (low, high)
                        if signs[j]:
                            middle = float((wl[b] + wr[b]) / 2)
                            left, right = ((low, middle), (middle, high)) if signs[j] > 0 else ((middle, high), (low, middle))
                        best = (float(won[b]), j, float(edges[j][b]), left, right)
                _, trees.feature[t, own], trees.threshold[t, own], bounds[2 * own + 1], bounds[2 * own + 2] = best
            node = 2 * node + 1 + (x[np.arange(n), trees.feature[t, node]] > trees.threshold[t, node])
        at = node - inner
        g, h = np.bincount(at, grad, leaves), np.bincount(at, hess, leaves)
        for i in range(leaves):
            trees.leaf[t, i] = rate * value(g[i], h[i], *bounds[inner + i])
        score += trees.leaf[t, at]
    return trees


def fit_quality(
    docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", fit_rows: int = 20_000
) -> Trees | None:
    """Trees from at most ``fit_rows`` labelled documents, the first by a hash of their id."""
    one = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").alias("label")).dropna()
    one = one.groupBy("doc_id").agg(F.min("label").alias("label"))
    sample = one.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(fit_rows)
    sample = materialize(sample, "quality-sample")
    chosen = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(sample), "doc_id"  # fit_rows bounds its size
    )

    def run(texts):
        return [[features(t, rule_counts(t)) for t in texts_of(texts)]]

    # A repeated id may bring more rows than were chosen; the mean over its rows keeps the bound.
    found = append_columns(chosen, run, [("x", "array<double>")], ["text"], ["doc_id", "label"])
    means = [F.avg(F.col("x")[j]).alias(f"x{j}") for j in range(len(FEATURES))]
    rows = found.groupBy("doc_id").agg(F.min("label").alias("label"), *means).orderBy("doc_id").toPandas()
    y = rows["label"].to_numpy(dtype=np.float64)
    if len(rows) == 0 or y.min() == y.max():
        return None
    x = rows[[f"x{j}" for j in range(len(FEATURES))]].to_numpy(dtype=np.float64)
    return fit_trees(x, (y > 0).astype(np.float64), [s for _, s in FEATURES])


def judge(
    docs: DataFrame, trees: Trees | None, keep: list[str], text: str = "text", cut: float = 0.5
) -> DataFrame:
    """``keep``, the five counts, base_failed, quality (probability, 1 without a model) and kept."""
    model = docs.sparkSession.sparkContext.broadcast(trees)  # some thousand numbers

    def run(column):
        texts = texts_of(column)
        counts, x = [], []
        for t in texts:
            c = rule_counts(t)
            counts.append(c[:5])
            x.append(features(t, c) if model.value is not None else [])
        failed = np.array([base_fails(c[0], c[4]) for c in counts], dtype=bool)
        score = np.ones(len(texts))
        if model.value is not None and texts:
            score = model.value.score(np.array(x))
        columns = [list(c) for c in zip(*counts)] if counts else [[] for _ in range(5)]
        return [*columns, pa.array(failed), pa.array(score), pa.array(~failed & (score >= cut))]

    fields = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
              ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("quality", "double"), ("kept", "boolean")]
    return append_columns(docs, run, fields, [text], keep)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    trees = fit_quality(docs, labels, doc_id, text)
    model = docs.sparkSession.sparkContext.broadcast(trees)
    kept = fresh(docs, "kept")

    def run(column):
        texts = texts_of(column)
        out = np.zeros(len(texts), dtype=bool)
        x = np.zeros((len(texts), len(FEATURES)))
        for i, t in enumerate(texts):
            c = rule_counts(t)
            out[i] = not base_fails(c[0], c[4])
            if out[i] and model.value is not None:
                x[i] = features(t, c)
        if model.value is not None and texts:
            out &= model.value.score(x) >= 0.5
        return [pa.array(out)]

    return append_columns(docs, run, [(kept, "boolean")], [text], list(docs.columns)).where(F.col(f"`{kept}`")).drop(kept)
