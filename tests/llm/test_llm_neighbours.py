"""SimHash components, nearest neighbours and the pipeline, against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from edge_cases import GOOD, ROWS, documents
from pyspark.sql import functions as F

import corpus_pipeline
from panelwright.llm import ann, credentials, mixing, quality, simhash
from panelwright.session import materialize

# -- fingerprints and components -------------------------------------------


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance=4):
    prints = sorted(prints)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if ((p ^ q) & (2**64 - 1)).bit_count() <= distance:
                a, b = sorted((find(p), find(q)))
                root[b] = a
    return {p: find(p) for p in prints}


def signed(p):
    return p - (1 << 64) if p >> 63 else p


@pytest.mark.parametrize("text", ["", "one", "a b c d", "A b\x0bc d e f", GOOD, "é ü " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("limit", [2048, 20, 3])
def test_components_of_clusters_and_chains(spark, limit):
    rng = np.random.default_rng(limit)
    prints = {int(x) for x in rng.integers(0, 2**63, 60)}
    for base in list(prints)[:12]:
        for _ in range(int(rng.integers(1, 60))):
            p = base
            for b in rng.integers(0, 64, int(rng.integers(1, 6))):
                p ^= 1 << int(b)
            prints.add(p)
    chain = 0
    for step in range(12):  # a path whose ends are far apart
        chain ^= 0xF << 4 * step
        prints.add(chain)
    prints = {signed(p) for p in prints} | {0, -1}
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    found = {r.fp: r.root for r in simhash.components(simhash.near_pairs(df, 4, limit)).collect()}
    assert {p: found.get(p, p) for p in prints} == slow_components(prints)


def test_near_pairs_are_not_emitted_for_all_of_a_large_list(spark):
    prints = [(int(p),) for p in {1 << a | 1 << b for a in range(64) for b in range(64)} if p < 2**63]
    links = simhash.near_pairs(spark.createDataFrame(prints, "fp bigint"), 4, list_limit=64)
    assert len({r.root for r in simhash.components(links).collect()}) == 1


@pytest.mark.parametrize("size", [5, 20, 200])
def test_lists_of_every_size_retain_a_pair_in_its_first_list(size):
    masks = simhash.position_masks(4)
    fp = np.uint64(0x0123456789ABCD00) + np.arange(size, dtype=np.uint64)  # share all bytes but the first
    first = next(i for i, m in enumerate(masks) if not m & 0xFF)
    for at in (first, len(masks) - 1):
        batch = simhash.pa.RecordBatch.from_arrays([simhash.pa.array(np.full(size, at)), simhash.pa.array(fp.view(np.int64))], names=["mask", "fp"])
        links = [(r["a"], r["b"]) for b in simhash._links_in_lists(masks, 4, 2048)([batch]) for r in b.to_pylist()]
        assert len({x for pair in links for x in pair}) == (size if at == first else 0)


def test_near_duplicates_of_odd_rows(spark):
    near = GOOD * 30
    rows = [*ROWS, (30, near, "en", "a", 1), (31, near + " tail", "en", "a", 1), (32, near.upper(), "en", "b", 1), (None, None, None, None, None)]
    docs = documents(spark, rows)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    roots = slow_components({signed(slow_fingerprint(t)) for _, t, *_ in rows})
    least = {}
    for i, t, *_ in rows:
        r = roots[signed(slow_fingerprint(t))]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = Counter((i, signed(slow_fingerprint(t)), least[roots[signed(slow_fingerprint(t))]]) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.fp, r.component_id) for r in found) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.one_of_each(docs.limit(0)).count() == 0


# -- nearest neighbours ----------------------------------------------------


def slow_search(rows, k=10):
    good = [(i, np.array(x, dtype=np.float64)) for i, x in rows if x and None not in x and np.isfinite(x).all() and any(x)]
    usual = Counter(len(x) for _, x in good).most_common(1)[0][0]
    good = [(i, x) for i, x in good if len(x) == usual]
    out = []
    for n, (i, x) in enumerate(good):
        if i is not None and i % 100 == 0:
            d = sorted((float(np.sqrt(((y - x) ** 2).sum())), j is None, j or 0) for m, (j, y) in enumerate(good) if m != n)
            out.append((i, [(s, None if null else j) for s, null, j in d[:k]]))
    return out


def hundredth(column):
    return F.pmod(column, F.lit(100)) == 0


def test_recall_against_brute_force(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = {}
    for r in ann.search(vectors, hundredth, block_rows=700).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    want = slow_search([(r.vec_id, r.embedding) for r in vectors.collect()])
    assert set(found) == {q for q, _ in want}
    hits = sum(len({i for _, i in near} & {i for _, i in found[q].values()}) for q, near in want)
    assert hits / (10 * len(want)) >= 0.9
    for q, near in want:
        got = [found[q][r] for r in range(1, 11)]
        assert got == sorted(got)
        scores = {i: s for s, i in near}
        assert all(scores.get(i, s) == pytest.approx(s, abs=1e-12) for s, i in got)


@pytest.mark.parametrize("n", [0, 1, 4, 40])
def test_neighbours_of_odd_rows(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i * 50, rng.normal(size=8).tolist()) for i in range(n)]
    odd = [(500, None), (600, [0.0] * 8), (700, [1.0, None] * 4), (800, [float("nan")] * 8), (900, [float("inf")] * 8), (1000, [1.0, 2.0])]
    if n > 10:
        odd += [(0, rows[0][1]), (0, rows[0][1]), (None, rows[3][1]), (7, rows[3][1])]  # repeats and ties
    rows += odd
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS row_no", "2 AS x", "3 AS score")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = ann.search(df, hundredth, share=1.0).collect()  # the radius holds all neighbours of the sample
    if n < 1:
        assert all(r.query_id in (1000,) for r in found)
        return
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    want = {}
    for q, near in slow_search(rows):
        want.setdefault(q, []).append(near)
    for q, lists in want.items():
        got = sorted(by_query.get(q, []), key=lambda x: x[0])
        assert Counter(r for r, _, _ in got) == Counter(r for near in lists for r in range(1, len(near) + 1))
        assert sorted(s for _, s, _ in got) == pytest.approx(sorted(s for near in lists for s, _ in near))
        if len(lists) == 1:
            assert [i for _, _, i in got] == [i for _, i in lists[0]]


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (500, 8)).astype(np.uint8)
    index = ann.Index(codes)
    for radius in (0, 5, 20, 27, 40, 64):
        for q in codes[:5]:
            bits = np.unpackbits(codes ^ q, axis=1).sum(axis=1)
            assert (index.within(q, radius) == np.flatnonzero(bits <= radius)).all()


# -- pipeline --------------------------------------------------------------


def test_stages_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "secret_scan", "source_mix", "encode"]
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, before, folder), f"test-{name}")
        rows[name] = (before.collect(), docs.collect())
        if name != "encode":
            assert docs.columns == before.columns
    before, after = rows["quality_rules"]
    kept = {r.doc_id for r in after}
    assert not any(quality.base_fails(*quality.rule_counts(r.text)[0:5:4]) for r in after)
    assert 0 < len(kept) < len(before)
    before, after = rows["near_dedup"]
    roots = slow_components({signed(slow_fingerprint(r.text)) for r in before})
    least = {}
    for r in before:
        root = roots[signed(slow_fingerprint(r.text))]
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(least.values())
    before, after = rows["secret_scan"]
    clean = {r.doc_id: credentials.redact_text(r.text, 8.0, "[SECRET]") for r in before}
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == {i: (t, len(t)) for i, t in clean.items()}
    before, after = rows["source_mix"]
    taken = mixing.mix(spark.createDataFrame(before)).collect()
    want = Counter({r.doc_id: int(r.taken / r.size + 0.5) for r in taken if r.size})
    assert Counter(r.doc_id for r in after) == +want
    before, after = rows["encode"]
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    assert all(r.round_trip and len(r.token_ids) == r.n_tokens for r in after)


def test_stages_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (ROWS, []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, docs, str(tmp_path)), f"odd-{name}")
            assert name == "encode" or out.columns == docs.columns
            assert out.count() <= 3 * max(1, len(rows))


def test_run_is_the_stages_in_order(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.round_trip for r in rows)
    digest = hashlib.sha256(str(sorted((r.doc_id, r.n_tokens) for r in rows)).encode()).hexdigest()
    again = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert digest == hashlib.sha256(str(sorted((r.doc_id, r.n_tokens) for r in again)).encode()).hexdigest()


def test_one_of_each_keeps_unlike_rows_that_share_an_id(spark):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcde"]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (7, texts[4]), (3, texts[4]), (None, texts[4]), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()]
    assert sorted(kept, key=lambda r: r[1]) == [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (3, texts[4])]
