"""Periodic runs against a search over all lags, and whole queries against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from edge_cases import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from panelwright.llm import periodic
from panelwright.llm.queries import QUERIES


def slow_runs(words):
    """Every stretch with smallest period q, length >= max(6, 4q), that cannot be extended."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i : i + length]
            smallest = next(p for p in range(1, q + 1) if part[p:] == part[: length - p])
            if length >= max(6, 4 * q) and smallest == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out)


def fast_runs(texts):
    number = {}
    return periodic.runs_of([np.array([number.setdefault(w, len(number)) for w in t], dtype=np.int64) for t in texts])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aab"), max_size=60), max_size=4))
def test_runs_of_small_alphabets(texts):
    assert fast_runs(texts) == [slow_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=9), st.integers(1, 70)), max_size=5))
def test_runs_of_repeated_patterns(parts):
    text = [w for pattern, size in parts for w in (pattern * size)[:size]]
    assert fast_runs([text, [], text[::-1], ["z"]]) == [slow_runs(text), [], slow_runs(text[::-1]), []]


@pytest.mark.parametrize("word", ["aa", "ab", "aab", "abaababaab", "abaabb" * 3 + "c"])
def test_runs_of_fibonacci_like_texts(word):
    text = list(word)
    for _ in range(7):
        text = (text + text[: max(1, len(text) * 5 // 8)])[:700]
    assert fast_runs([text]) == [slow_runs(text)]


def test_a_very_long_repeat_is_quick():
    text = ["a"] * 400_000 + ["b", "c"] * 200_000 + list(range(3)) * 100_000
    assert fast_runs([text])[0] == [(0, 400_000, 1), (400_000, 400_000, 2), (800_000, 300_000, 3)]


def slow_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def slow_row(doc_id, text):
    words = slow_words(text)
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), *digest)


def key(row):
    return tuple((v is not None, v) for v in row)


def test_runs_of_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["x", "y", "Y", "é"], k=rng.randint(0, 80))), "en", "a", 0) for i in range(100, 400)]
    rows += [(1, "a b " * 40, None, None, None), (2, "go " * 5, "en", "a", 1), (3, "go " * 6, "en", "a", 1), (4, "A a " * 3 + "a a a a a a", "en", "a", 1)]
    rows += [(None, "p q r " * 9, None, None, None), (None, None, None, None, None), (3, "go " * 6, "en", "a", 1), (-7, "", "en", "a", 1), (30, "\x85 \xa0 " * 9, "en", "a", 1)]
    docs = documents(spark, rows)
    found = periodic.collapse_runs(docs, ["doc_id"], respell=periodic.periodic_copy)
    assert sorted(map(tuple, found.collect()), key=key) == sorted([slow_row(i, t) for i, t, *_ in rows], key=key)
    assert periodic.collapse_runs(docs.limit(0), ["doc_id"]).count() == 0
    odd = documents(spark)  # very long, empty and null texts
    assert periodic.collapse_runs(odd, ["doc_id"], respell=periodic.periodic_copy).count() == odd.count()


def test_collapsed_texts(spark):
    docs = spark.createDataFrame([(1, "so it goes on and on and on and on and on it goes"), (2, None), (3, "x")], "key int, body string")
    found = {r.key: r for r in periodic.find_runs(docs, ["key"], "key", "body").collect()}
    assert [tuple(r) for r in found[1].runs] == [(3, 9, 2)] and found[1].collapsed == "so it goes on and it goes"
    assert found[2].runs == [] and found[2].collapsed is None and found[3].collapsed == "x"


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    short = [r for r in rows if len(slow_words(r[1])) < 1200]
    assert len(short) > 180
    found = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, folder).collect()}
    assert len(found) == len(rows)
    for i, t in short:
        assert found[i] == slow_row(i, t)
