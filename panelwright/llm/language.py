"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from a seed and its code
point. A trigram binds three of them, the first permuted twice, the second
once. A text bundles (adds) the trigrams of its words, word borders included;
a language bundles the texts it is learned from. A text gets the language
whose prototype has the largest cosine with it.

Rules: only the text is an input of a prediction; texts that are null or have
no letter (``str.isalpha``) are ``und`` with score 0, as are all texts if no
language was learned; equal cosines give the smaller name; a negative cosine
scores 0. Rows may repeat, each gives one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import append_columns, map_batches, slices, texts_of

BORDER = 0
CHUNK = 1 << 21  # characters that are turned into trigrams at once
CELLS = 1 << 22  # of the count matrix of some documents at once
TRIGRAMS = 1 << 13  # trigram vectors that are multiplied at once

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or the border."""
    global _letters
    if _letters is None:
        found = np.zeros(0x110000, dtype=np.uint32)
        for c in map(chr, range(0x110000)):
            if c.isalpha():
                found[ord(c)] = ord(c.lower()[0])
        _letters = found
    return _letters


class Space:
    """Vectors of letters and trigrams, the same in every process."""

    def __init__(self, size: int = 1024, seed: int = 7):
        self.size, self.seed = size, seed
        self.shuffle = np.random.default_rng(seed).permutation(size)
        self.known: dict[int, np.ndarray] = {}

    def letters(self, codes: np.ndarray) -> np.ndarray:
        for c in codes.tolist():
            if c not in self.known:
                self.known[c] = np.random.default_rng((self.seed, c)).integers(0, 2, self.size, dtype=np.int8) * 2 - 1
        return np.stack([self.known[c] for c in codes.tolist()])

    def trigrams(self, alphabet: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Vectors of trigrams, given as numbers to the base of the alphabet's size."""
        third = self.letters(alphabet)
        second = third[:, self.shuffle]
        first = second[:, self.shuffle]
        k = len(alphabet)
        return (first[codes // (k * k)] * second[codes // k % k] * third[codes % k]).astype(np.float32)


def trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, trigram) of every letter, and the alphabet that the numbers refer to.

    A trigram is a letter with its neighbours; a run of other characters, and
    the start and end of a text, count as one border.
    """
    joined = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = letter_table()[joined]
    ends = np.cumsum([len(t) + 1 for t in texts]) + 1
    alphabet, small = np.unique(letters, return_inverse=True)
    if alphabet[0] != BORDER:
        raise AssertionError("line feeds are borders")
    at = np.flatnonzero(small)
    k = len(alphabet)
    codes = (small[at - 1].astype(np.int64) * k + small[at]) * k + small[at + 1]
    return np.searchsorted(ends, at, "right"), codes, alphabet


def text_vectors(space: Space, groups: np.ndarray, codes: np.ndarray, alphabet: np.ndarray, n: int) -> np.ndarray:
    """Bundles of the trigrams of each of ``n`` groups; ``groups`` is sorted."""
    out = np.zeros((n, space.size), dtype=np.float64)
    if not len(codes):
        return out
    distinct, column = np.unique(codes, return_inverse=True)
    rows = max(1, CELLS // len(distinct))
    for first in range(0, len(distinct), TRIGRAMS):
        vectors = space.trigrams(alphabet, distinct[first : first + TRIGRAMS])
        width = len(vectors)
        for low in range(0, n, rows):
            high = min(n, low + rows)
            a, b = np.searchsorted(groups, (low, high))
            own = column[a:b] - first
            inside = (own >= 0) & (own < width)
            cell = (groups[a:b][inside] - low) * width + own[inside]
            counts = np.bincount(cell, minlength=(high - low) * width).reshape(high - low, width)
            out[low:high] += counts.astype(np.float32) @ vectors
    return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = 1024) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes, from all rows with a text and a language.

    Each task adds up one vector per language; the sums are exact whole
    numbers, so order and partitions do not matter. Languages are few, so
    prototypes fit the driver.
    """
    given = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")).dropna()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(size), {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for a, b in slices(texts, CHUNK):
                names = sorted(set(langs[a:b]))
                number = {name: i for i, name in enumerate(names)}
                owner, codes, alphabet = trigram_codes(texts[a:b])
                group = np.array([number[x] for x in langs[a:b]])[owner]
                order = np.argsort(group, kind="stable")
                found = text_vectors(space, group[order], codes[order], alphabet, len(names))
                for name, vector in zip(names, found):
                    sums[name] = sums.get(name, 0) + np.rint(vector).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                names=["lang", "vector"],
            )

    parts = map_batches(given, run, "lang string, vector array<bigint>")
    cells = parts.select("lang", F.posexplode("vector").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    found = cells.toPandas()
    names = sorted(found["lang"].unique())
    prototypes = np.zeros((len(names), size))
    row = {name: i for i, name in enumerate(names)}
    prototypes[found["lang"].map(row).to_numpy(dtype=np.int64), found["at"].to_numpy(dtype=np.int64)] = found["value"].to_numpy()
    return names, prototypes


def predict(
    docs: DataFrame, names: list[str], prototypes: np.ndarray, keep: list[str], text: str = "text"
) -> DataFrame:
    """``keep``, lang_pred and score (cosine) of each whole text."""
    length = np.linalg.norm(prototypes, axis=1, keepdims=True) if len(names) else prototypes
    units = prototypes / np.where(length == 0, 1, length) if len(names) else prototypes
    model = docs.sparkSession.sparkContext.broadcast((names, units))

    def run(column):
        names, units = model.value
        space = Space(units.shape[1])
        texts = texts_of(column)
        found, scores = [], []
        for a, b in slices(texts, CHUNK):
            owner, codes, alphabet = trigram_codes(texts[a:b])
            vectors = text_vectors(space, owner, codes, alphabet, b - a)
            size = np.linalg.norm(vectors, axis=1)
            has_letter = np.bincount(owner, minlength=b - a) > 0
            if not names:
                found += ["und"] * (b - a)
                scores += [0.0] * (b - a)
                continue
            cosine = vectors @ units.T / np.where(size == 0, 1, size)[:, None]
            best = np.argmax(cosine, axis=1)
            top = np.clip(cosine[np.arange(b - a), best], 0.0, 1.0)
            found += [names[i] if ok else "und" for i, ok in zip(best.tolist(), has_letter.tolist())]
            scores += np.where(has_letter, top, 0.0).tolist()
        return [found, scores]

    return append_columns(docs, run, [("lang_pred", "string"), ("score", "double")], [text], keep)
