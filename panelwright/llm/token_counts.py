"""Token counts of a sentencepiece BPE vocabulary without encoding every word.

Offline, each vocabulary string is merged once: those that end as one token are
whole tokens. A text is cut where no merge can reach across; a cut piece that
is a whole token counts as one, only the others are merged.

Nulls and empty texts have no tokens. Strings of control tokens inside a text
are ordinary text. Every row gives one row.
"""

from __future__ import annotations

import pickle

from pyspark.sql import DataFrame

from panelwright.llm.bpe import Recent, merge_ranked, model_of
from panelwright.llm.common import append_columns, texts_of

MARK = "▁"  # stands for a space
UNKNOWN = (1 << 20) - 1  # a character without a token; in no pair
NORMAL, USER_DEFINED = 1, 4  # kinds of pieces in the model file


class PieceCounter:
    """Counts tokens with the tables of ``compile_vocabulary``."""

    def __init__(self, content: bytes, cache_size: int = 400_000):
        self.ids, self.ranks, self.merged, self.whole, self.break_lines = pickle.loads(content)
        self.recent = Recent(cache_size)

    def merge(self, piece: str) -> int:
        """Tokens of ``piece``; a character without a token costs its bytes."""
        symbols = [self.ids.get(c, UNKNOWN) for c in piece]
        extra = 0
        if UNKNOWN in symbols:
            extra = sum(len(c.encode()) - 1 for c in piece if c not in self.ids)
        if len(symbols) > 1:
            symbols = merge_ranked(symbols, self.ranks.get, self.merged)
        return len(symbols) + extra

    def _miss(self, piece: str) -> int:
        n = self.recent.old.get(piece) or self.merge(piece)
        return self.recent.put(piece, n)

    def _line(self, line: str) -> int:
        """``line`` has marks for spaces; a token has marks only at its start,
        so a cut before each mark that follows another character is safe."""
        first, *rest = line.split(MARK)
        if "" in rest:
            pieces, marks = [first], 0
            for s in rest:
                marks += 1
                if s:
                    pieces.append(MARK * marks + s)
                    marks = 0
            if marks:
                pieces.append(MARK * marks)
        else:
            pieces = [first, *[MARK + s for s in rest]]
        whole = self.whole
        others = [p for p in pieces if p not in whole]
        known, miss = self.recent.new.get, self._miss
        return len(pieces) - len(others) + sum([known(p) or miss(p) for p in others if p])

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        if not self.break_lines:
            return self._line(marked)
        lines = marked.split("\n")
        return len(lines) - 1 + sum([self._line(line) for line in lines])


def compile_vocabulary(path: str) -> bytes:
    """Read a sentencepiece model and prove, on the driver, once:

    - no piece has a mark behind another character (else cutting is unsafe);
    - whether a line feed is in no piece but its own byte, so lines can be cut;
    - which pieces come out of the merges as one token.
    """
    from sentencepiece import sentencepiece_model_pb2 as spec

    model = spec.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
        raise ValueError("only models that leave texts as they are and add one space in front are supported")
    if not model.trainer_spec.byte_fallback or any(p.type == USER_DEFINED for p in model.pieces):
        raise ValueError("byte fallback and no user-defined pieces are needed")
    normal = [p for p in model.pieces if p.type == NORMAL]
    if any(MARK in p.piece.lstrip(MARK) for p in normal):
        raise ValueError("a piece has a space inside")
    # The best score merges first; equal strings share a rank, others never do.
    ordered = sorted(normal, key=lambda p: (-p.score, p.piece))
    ids = {p.piece: i for i, p in enumerate(ordered)}
    if any(ch not in ids for p in ids for ch in p):
        raise ValueError("a character of a piece is no piece itself")
    # The rank of a pair is the id of the piece that it makes.
    ranks = {
        ids[p[:k]] << 20 | ids[p[k:]]: i
        for p, i in ids.items()
        for k in range(1, len(p))
        if p[:k] in ids and p[k:] in ids
    }
    break_lines = not any("\n" in p for p in ids)
    tables = (ids, ranks, range(len(ids)))
    counter = PieceCounter(pickle.dumps((*tables, frozenset(), break_lines)))
    whole = frozenset(p for p in ids if counter.merge(p) == 1)
    return pickle.dumps((*tables, whole, break_lines))


def count_tokens(df: DataFrame, path: str, keep: list[str], text: str = "text", limit: int = 4096) -> DataFrame:
    """``keep``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` of each whole text."""
    content = df.sparkSession.sparkContext.broadcast(compile_vocabulary(path))

    def run(column):
        counter = model_of(content, PieceCounter)
        texts = texts_of(column)
        counts = [counter.count(t) for t in texts]
        return [[len(t.encode()) for t in texts], counts, [n > limit for n in counts]]

    fields = [("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    return append_columns(df, run, fields, [text], keep)
