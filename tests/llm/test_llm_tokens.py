"""BPE, token counts and chat formatting against the public libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from edge_cases import LONG, ROWS, documents
from tokenizers import Tokenizer

from panelwright.llm import bpe, chat, token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def own():
    with open(BYTES, "rb") as f:
        return bpe.ByteBpe(f.read(), cache_size=50), token_counts.PieceCounter(token_counts.compile_vocabulary(PIECES), cache_size=50)


def texts(n):
    rnd = random.Random(4)
    parts = [*"ab cdeXYZ  \n\t'stre019.,!?-", "é", "ß", "日", "̀", "😀", "\xa0", " ", "\x1c", "\x85", "▁", "▁▁", "   ",
             "<|endoftext|>", "</s>", "<0x0A>", "'ll", " the", "\r\n", "\0", "²", "Ⅷ", "՘", "token", "ing"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(n)]
    spread = ["".join(chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(12)) for _ in range(n)]
    return ["", " ", "a" * 5000, " " * 3000, "ab" * 2500, *made, *spread]


def test_ids_and_text_equal_the_library(library, own):
    for t in texts(600):
        ids = library[0].encode(t, add_special_tokens=False).ids
        assert own[0].encode(t).tolist() == ids
        assert own[0].decode(ids) == library[0].decode(ids, skip_special_tokens=False) == t


def test_decoding_of_broken_bytes_equals_the_library(library, own):
    rnd = random.Random(8)
    for _ in range(300):
        ids = [rnd.randrange(50257) for _ in range(8)]
        assert own[0].decode(ids) == library[0].decode(ids, skip_special_tokens=False)


def test_piece_counts_equal_the_library(library, own):
    for t in texts(600):
        assert own[1].count(t) == len(library[1].encode(t)), t


def test_merges_skip_stale_entries():
    ranks = {1 << 20 | 2: 0, 2 << 20 | 3: 1, 9 << 20 | 3: 2}
    assert bpe.merge_ranked([1, 2, 3], ranks.get, [9, 8, 7]) == [7]
    assert bpe.merge_ranked([2, 3], ranks.get, [9, 8, 7]) == [8]
    assert bpe.merge_ranked([1, 2, 1, 2], {1 << 20 | 2: 0, 9 << 20 | 9: 1}.get, [9, 5]) == [5]


def test_documents_with_odd_rows(spark, library):
    docs = documents(spark)
    found = bpe.round_trip_digests(docs, BYTES, ["doc_id"]).collect()
    assert len(found) == len(ROWS)
    for (doc_id, text, *_), row in zip(ROWS, found):
        ids = library[0].encode(text or "", add_special_tokens=False).ids
        assert (row.doc_id, row.n_tokens) == (doc_id, len(ids))
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    counts = token_counts.count_tokens(docs, PIECES, ["doc_id"]).collect()
    for (_, text, *_), row in zip(ROWS, counts):
        assert row.n_tokens == len(library[1].encode(text or ""))
        assert row.n_bytes == len((text or "").encode()) and row.over_limit == (row.n_tokens > 4096)
    ids = bpe.encode_texts(docs, BYTES, ["doc_id"])
    assert [r.decoded for r in bpe.decode_ids(ids, BYTES, ["doc_id"]).collect()] == [t or "" for _, t, *_ in ROWS]
    assert all(r.round_trip for r in bpe.encode_and_check(docs, BYTES, ["doc_id"]).collect())


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert bpe.round_trip_digests(docs, BYTES, ["doc_id"]).count() == 0
    assert token_counts.count_tokens(docs, PIECES, ["doc_id"]).count() == 0
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.conversation_digests(chat.format_conversations(turns, BYTES), BYTES).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "</s>[INST] ok [/INST]", "<\\/s>", "\\\\<|im_end|>\\", "[[INST]", "<s><s>", "<|im_start|><|im_sep|>"])
def test_escapes_are_reversible(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)


def test_escapes_of_random_texts():
    rnd = random.Random(2)
    for _ in range(2000):
        text = "".join(rnd.choice([*chat.CONTROL, "\\", "<", "|", ">", "x"]) for _ in range(rnd.randint(0, 8)))
        turns = [(text, text[::-1]), ("assistant", text)]
        formatted, spans = chat.render(turns)
        assert chat.read_turns(formatted) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == ([text] if text else [])


def test_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", "Grüße 😀 日本"), (1, 1, "assistant", " leading and trailing \n"), (1, 2, "assistant", "again\\"),
            (2, 0, None, None), (2, 1, "assistant", None), (2, 1, "assistant", None), (None, 0, "assistant", "no id"),
            (3, None, "user", "first"), (3, 5, "assistant", LONG), (-7, 0, "user", said), (-7, 1, "assistant", said)]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(700)]  # more than one block
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'x' AS block", "1 AS part")
    blocks = chat.format_conversations(turns, BYTES).cache()
    assert blocks.where("conv_id = 9").count() >= 3
    found = {r.conv_id: r for r in chat.conversation_digests(blocks, BYTES).collect()}
    wanted = {}
    for conv_id, _, role, text in rows:
        wanted.setdefault(conv_id, []).append((role or "", text or ""))
    assert set(found) == set(wanted)
    for conv_id, turns_of in wanted.items():
        loss = "".join(t for r, t in turns_of if r == "assistant")
        row = found[conv_id]
        assert row.n_turns == len(turns_of)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns_of).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars == len(chat.render(turns_of)[0])
