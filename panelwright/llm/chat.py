"""Chat formatting with loss masks that are aligned to tokens.

A conversation is rendered as ``<|im_start|>role<|im_sep|>text<|im_end|>`` per
turn. The three markers are added tokens, so a token never crosses from a
marker into a text. Control strings inside roles and texts are escaped with a
backslash behind their first character, and backslashes are doubled; reading
back undoes both.

Rules: a null role or text counts as empty; turns are ordered by turn (null
first), ties by role and then by a hash of the text, repeated rows are all
kept; rows with a null conversation id form one conversation. An empty table
gives an empty result.

Any conversation may hold a large share of all rows. Turns are
range-partitioned on (conversation, turn), so a long conversation spreads over
partitions, and is rendered and encoded in blocks of a bounded size. Only the
digest of a conversation runs over its blocks in one go; it streams them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.bpe import model_of, read_vocabulary
from panelwright.llm.common import map_batches

START, BODY, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = [START, BODY, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

_control = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)
_escaped = re.compile(r"\\(\\?)")
_turn = re.compile(f"{re.escape(START)}(.*?){re.escape(BODY)}(.*?){re.escape(END)}", re.S)


def escape(text: str) -> str:
    return _control.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the sorted spans of assistant texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + BODY, escape(text)
        if role == "assistant" and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that a formatted text was made of."""
    return [(unescape(role), unescape(text)) for role, text in _turn.findall(formatted)]


def mask_tokens(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Token ranges under sorted character spans, found by binary search."""
    if not spans:
        return []
    tokens = np.array(offsets, dtype=np.int64).reshape(-1, 2)
    wanted = np.array(spans, dtype=np.int64)
    first = np.searchsorted(tokens[:, 0], wanted[:, 0], "left")
    last = np.searchsorted(tokens[:, 1], wanted[:, 1], "right")
    if not (np.array_equal(tokens[first, 0], wanted[:, 0]) and np.array_equal(tokens[last - 1, 1], wanted[:, 1])):
        raise ValueError("a token crosses the border of a turn")
    return list(zip(first.tolist(), last.tolist()))


def chat_tokenizer(content: bytes):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (START, BODY, END)])
    return tokenizer


def format_conversations(
    turns: DataFrame, path: str, conversation="conv_id", turn="turn", role="role", text="text",
    block_turns: int = 256, block_chars: int = 1 << 19,
) -> DataFrame:
    """Blocks of formatted conversations.

    Columns: conv_id, part and block (their order inside the conversation),
    formatted, token_ids, loss_from and loss_to (token ranges under the loss
    mask, end exclusive). A block holds at most ``block_turns`` turns, and no
    further turn once it has ``block_chars`` characters; the blocks of a
    conversation joined in order are its whole rendering.
    """
    spark = turns.sparkSession
    content = read_vocabulary(turns, path)
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = turns.select(
        F.col(f"`{conversation}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    order = ["conv_id", "turn", "role", "tie"]
    sorted_turns = given.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    kind = given.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = model_of(content, chat_tokenizer)
        part, number = TaskContext.get().partitionId(), 0

        def encoded(blocks, schema):
            rows = []
            for conv_id, number, turns in blocks:
                formatted, spans = render(turns)
                found = tokenizer.encode(formatted, add_special_tokens=False)
                ranges = mask_tokens(found.offsets, spans)
                rows.append((conv_id, part, number, formatted, found.ids, [a for a, _ in ranges], [b for _, b in ranges]))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        schema, current, held, chars = None, None, [], 0
        for batch in batches:
            if schema is None:
                names = ["conv_id", "part", "block", "formatted", "token_ids", "loss_from", "loss_to"]
                ints = pa.list_(pa.int32())
                kinds = [batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.string(), ints, ints, ints]
                schema = pa.schema(list(zip(names, kinds)))
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            ready, size = [], 0
            for conv_id, a, b in zip(*columns):
                if held and (conv_id != current or len(held) >= block_turns or chars >= block_chars):
                    ready.append((current, number, held))
                    number, size = number + 1, size + chars
                    held, chars = [], 0
                    if size >= block_chars:
                        yield encoded(ready, schema)
                        ready, size = [], 0
                current = conv_id
                held.append((a, b))
                chars += len(a) + len(b)
            if ready:
                yield encoded(ready, schema)
        if held:
            yield encoded([(current, number, held)], schema)

    return map_batches(
        sorted_turns, run,
        f"conv_id {kind}, part int, block int, formatted string, token_ids array<int>, "
        "loss_from array<int>, loss_to array<int>",
    )


def conversation_digests(blocks: DataFrame, path: str) -> DataFrame:
    """One row per conversation, read back from its blocks: conv_id, n_turns,
    turns_sha256 (role, line feed, text, line feed per turn), loss_chars,
    loss_sha256 (all text under the loss mask), formatted_chars, n_tokens.

    Blocks are streamed in order; a task holds one block and two hash states.
    """
    content = read_vocabulary(blocks, path)
    slices = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = blocks.schema["conv_id"].dataType.simpleString()
    ordered = blocks.repartition(slices, "conv_id").sortWithinPartitions("conv_id", "part", "block")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = model_of(content, chat_tokenizer)
        state, names, kinds = None, None, None

        def row(s):
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6])

        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
            done = []
            for i in range(batch.num_rows):
                conv_id = batch.column("conv_id")[i].as_py()
                if state is None or state[0] != conv_id:
                    if state is not None:
                        done.append(row(state))
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                formatted = batch.column("formatted")[i].as_py()
                turns = read_turns(formatted)
                state[1] += len(turns)
                for a, b in turns:
                    state[2].update(f"{a}\n{b}\n".encode())
                ids = batch.column("token_ids")[i].as_py()
                ranges = zip(batch.column("loss_from")[i].as_py(), batch.column("loss_to")[i].as_py())
                for text in tokenizer.decode_batch([ids[x:y] for x, y in ranges], skip_special_tokens=False):
                    under_mask = unescape(text)
                    state[3] += len(under_mask)
                    state[4].update(under_mask.encode())
                state[5] += len(formatted)
                state[6] += len(ids)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row(state), kinds)], names=names)

    return map_batches(
        ordered, run,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, n_tokens bigint",
    )
