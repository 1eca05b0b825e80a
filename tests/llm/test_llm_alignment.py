"""Aligned tokens against a slow version that works token by token over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from edge_cases import documents
from tokenizers import Tokenizer

from panelwright.llm import alignment
from panelwright.llm.bpe import byte_letters
from panelwright.llm.queries import QUERIES

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def slow_groups(text, libraries):
    """[(a ids, b ids)] of one text; [] if it has no tokens."""
    if not text:
        return []
    a, b = libraries
    letter = {c: i for i, c in enumerate(byte_letters())}
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    a_bytes = [bytes(letter[c] for c in a.id_to_token(i)) for i in a_ids]
    b_ids = b.encode(text)
    b_bytes = []
    for i in b_ids:
        piece = b.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    raw = (" " + text).encode()
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return []
    groups, i, j = [], 0, 0
    while i < len(a_ids):
        first_i, first_j, x, y = i, j, len(a_bytes[i]), len(b_bytes[j])
        i, j = i + 1, j + 1
        while x != y:
            if x < y:
                x += len(a_bytes[i])
                i += 1
            else:
                y += len(b_bytes[j])
                j += 1
        groups.append((a_ids[first_i:i], b_ids[first_j:j]))
    return groups


def slow_align(rows, libraries):
    found = [(i, slow_groups(t, libraries)) for i, t in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in found]
    count = Counter(pair for of_doc in links for pair in of_doc)
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for (i, groups), of_doc in zip(found, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(of_doc.values()),
            sum(t for p, t in of_doc.items() if count[p] == highest[p[0]]), sum(t * count[p] for p, t in of_doc.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


ODD = [
    "a", " a", "a ", "  two  spaces ", "line\nbreaks \n\n here", "tab\tand\r\n", "Grüße 日本語 😀😀 é", "​zero", "a▁b", "▁", "<0x41> <s> </s> <|endoftext|>",
    "1234567890" * 30, "😀" * 50, "日本" * 200, "x" * 3000, "\x00\x01 \x7f", "don't stop", " nbsp here", "ﬁ ligature Å", "한국어 텍스트", "٣ ४ ৫", " ",
]


def test_spans_end_where_decoded_bytes_do(libraries):
    with open(A_PATH, "rb") as a, open(B_PATH, "rb") as b:
        v = alignment.Vocabularies(a.read(), b.read())
    texts = [" " + t for t in ODD if "▁" not in t]
    for (a, a_end), (b, b_end), t in zip(v.a_ends(texts), v.b_ends(texts), texts):
        assert a_end.tolist() == v.a_length[a].cumsum().tolist()
        assert b_end.tolist() == v.b_length[b].cumsum().tolist()
        assert a_end[-1] == b_end[-1] == len(t.encode())


def test_odd_texts(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 2000)
    monkeypatch.setattr(alignment, "BLOCK", 5000)
    rng = random.Random(3)
    bits = ["the", "Word", " ", " ", " ", "\n", "é", "'s", "123", "日", "<|endoftext|>", "!?", "　", "😀", "ing"]
    rows = [(i, t) for i, t in enumerate([*ODD, None, "", *["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(200)]])]
    docs = spark.createDataFrame(pa.table({"key": [i for i, _ in rows], "body": [t for _, t in rows], "block": ["x"] * len(rows)}))
    found = alignment.align(docs.coalesce(2), A_PATH, B_PATH, doc_id="key", text="body")
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == sorted(slow_align(rows, libraries))


def test_odd_rows(spark, libraries):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = [tuple(r) for r in alignment.align(docs, A_PATH, B_PATH).collect()]
    assert sorted(found, key=key) == sorted(slow_align(rows, libraries), key=key)
    assert alignment.align(docs.limit(0), A_PATH, B_PATH).count() == 0
    nothing = alignment.align(docs.where("text IS NULL"), A_PATH, B_PATH).collect()
    assert [tuple(r)[1:] for r in nothing] == [(0,) * 6 + ("",)]


def test_query_equals_the_slow_version(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = [tuple(r) for r in QUERIES["op13_tokenizer_alignment"](spark, folder).collect()]
    assert sorted(found) == sorted(slow_align(rows, libraries))
