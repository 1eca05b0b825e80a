"""Ids in files: the code itself, and whole tables against the library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from edge_cases import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelwright.llm import idfiles
from panelwright.llm.queries import QUERIES
from panelwright.llm.stretches import cut
from panelwright.session import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a", " a", "a  b", "a \n b", "\n", "a　b 　 c", "x <|endoftext|> y<|endoftext|>z", "é 日本 😀 ", "a" * 5000, "tail  ", "  head\t\t x", "don't  we'll"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def scalar_decode(codec, control, data, n):
    """One id at a time."""
    out, at = [], 0
    for i in range(n):
        length = (control[i // codec.per] >> codec.bits * (i % codec.per) & (1 << codec.bits) - 1) + 1
        out.append(int.from_bytes(data[at : at + length], "little"))
        at += length
    assert at == len(data)
    return out


@pytest.mark.parametrize("size", [1, 300, 1 << 16, (1 << 16) + 1, 1 << 31])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, 300_000])
def test_code_round_trip(size, n):
    rng = np.random.default_rng(n)
    ranks = np.minimum((size * rng.uniform(size=n) ** 6).astype(np.int64), size - 1)
    codec = idfiles.Codec(size)
    control, data = codec.encode(ranks)
    assert len(control) == -(-n // codec.per)
    assert np.array_equal(codec.decode(control, data, n), ranks)
    if n <= 1000:
        assert scalar_decode(codec, control, data, n) == ranks.tolist()


def slow_cut(text, lead, apart):
    text = " " + text if lead else text
    spaces = set(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
    cuts = [i for i in range(1, len(text) - 1) if text[i] == " " and text[i + 1] not in spaces and not (apart and text[i - 1] == " ")]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]


@pytest.mark.parametrize("lead,apart", [(False, False), (True, True)])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet=" ab\n\t　é'1", max_size=14), max_size=6))
def test_cuts(lead, apart, texts):
    found = cut(pa.array([*texts, None], pa.string()), lead, apart)
    names = found.names.to_pylist()
    got = [[names[j] for j in found.index[a:b]] for a, b in zip(found.ends, found.ends[1:])]
    # An empty stretch may stand before a leading space.
    assert [[n for n in g if n] for g in got] == [[n for n in slow_cut(t, lead, apart) if n] for t in [*texts, ""]]
    assert len(set(found.names)) == len(found.names)


def test_encoder_equals_the_library(library):
    rng = random.Random(5)
    mixed = ["".join(rng.choices(["the", "Word", " ", " ", "\n", "é", "'s", "123", "日", "<|endoftext|>", "!?", "　"], k=rng.randint(0, 40))) for _ in range(300)]
    with open(PATH, "rb") as f:
        encoder = idfiles.StretchEncoder(f.read())
    encoder.numbers.most = 100  # forgets between batches
    for low in range(0, 300, 50):
        texts = [*ODD, None, *mixed[low : low + 50]]
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        want = [library(t) for t in texts]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
        packed = idfiles.packed(ids, counts)[1:]
        got, sizes = idfiles.unpacked(packed, encoder.kind)
        assert got.tolist() == ids[counts[0] :].tolist() and sizes.tolist() == counts[1:].tolist()


def expected(rows, library):
    """(doc_id, n_tokens, crc) and the starts in order of id."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*library(text), 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def test_files_of_odd_rows(spark, library, monkeypatch):
    monkeypatch.setattr(idfiles, "BLOCK", 500)
    docs = documents(spark)
    found = [tuple(r) for r in idfiles.write_and_read(docs, PATH).collect()]
    rows = sorted([(r.doc_id, r.text) for r in docs.collect()], key=lambda r: (r[0] is not None, r[0] or 0))
    want = expected(rows, library)  # only equal rows share an id here
    assert sorted(found, key=key) == sorted(want, key=key)
    assert idfiles.write_and_read(docs.limit(0), PATH).count() == 0


def test_files_hold_the_ids(spark, library):
    docs = spark.createDataFrame([(3, "b c"), (1, "a " * 300), (2, None), (2, "tie"), (2, "tie")], "key bigint, body string")
    folder = new_path(spark, "test-ids")
    idfiles.write_ids(docs, PATH, folder, end_id=50256, doc_id="key", text="body")
    found = sorted([(r.start, r.doc_id, r.token_ids) for r in idfiles.read_ids(spark, folder).collect()])
    assert [d for _, d, _ in found] == [1, 2, 2, 2, 3]
    at = 0
    for start, doc_id, ids in found:
        assert start == at and ids[-1] == 50256
        at += len(ids)
    assert found[0][2][:-1] == library("a " * 300)
    assert sorted(map(len, (f[2] for f in found[1:4]))) == sorted([1, len(library("tie")) + 1, len(library("tie")) + 1])
    # The commonest id has the smallest rank and so one byte.
    ranks = {r.id: r.rank for r in spark.read.parquet(f"{folder}/ranks").collect()}
    assert ranks[library("a a")[1]] == 0 and len(ranks) == 50257


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = expected(sorted((r.doc_id, r.text) for r in docs), library)
    assert sorted(map(tuple, QUERIES["op11_id_files"](spark, folder).collect())) == want
