"""Byte-level BPE: encoding by longest matches with backtracking, and decoding.

A rank file gives a byte string per token id. Two neighbouring tokens are
compatible if merging their joined bytes gives just these two again. A text's
encoding is the one sequence of tokens whose neighbours are all compatible, so
it can be found without merging the text: take the longest token at a
position (Aho-Corasick over the bytes as Latin-1 characters), go to shorter
ones where it does not fit the token before, step back where none fits, and
never enter a position again that was given up. That is linear in the text,
also for one very long word.

Texts are cut by the rank file's pattern first. The pattern never joins a
non-space character with a following space or line feed, so a text may be cut
there without changing its pieces; the ids of such a stretch are remembered,
within a bound, as words repeat.
"""

from __future__ import annotations

import base64
import functools
import re
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import REMEMBERED, arrow_rows, forget, sole_memory, utf8, values

#: Longer stretches are not remembered.
REMEMBERED_LENGTH = 64

_STRETCH = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")


class ByteBpe:
    """Encoder and decoder of one rank file and one pattern."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.texts = [t.decode("latin-1") for t in tokens]
        self.ranks = {t: i for i, t in enumerate(self.texts)}
        self.pieces = regex.compile(pattern).findall
        self.lengths = [len(t) for t in tokens]
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ranks.items():
            self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The plain merges of a short Latin-1 text: the lowest rank first, the leftmost of equals."""
        parts, worst, rank = list(text), len(self.tokens), self.ranks.get
        ranks = [rank(a + b, worst) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < worst:
            at = ranks.index(low)
            joined = parts[at] = parts[at] + parts.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank(joined + parts[at + 1], worst)
            if at:
                ranks[at - 1] = rank(parts[at - 1] + joined, worst)
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether b may follow a; remembered."""
        pair = a * len(self.tokens) + b
        found = self.pairs.get(pair)
        if found is None:
            forget(self.pairs, REMEMBERED // 2)
            x, y = self.texts[a], self.texts[b]
            found = self.pairs[pair] = self.merged(x + y) == [x, y]
        return found

    def next_shorter(self, i: int) -> int:
        """The longest token that is a proper prefix of token i; -1 if none is."""
        found = self.shorter.get(i)
        if found is None:
            text = self.texts[i]
            found = self.shorter[i] = next((self.ranks[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.ranks), -1)
        return found

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one piece, its bytes given as Latin-1."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        n, n_tokens, lengths = len(piece), len(self.tokens), self.lengths
        shorter, fits, pairs = self.next_shorter, self.fits, self.pairs.get
        ids: list[int] = []
        at, last = 0, -1
        for end, (i, length) in self.automaton.iter_long(piece):  # mostly, the longest tokens follow and fit each other
            if end - length + 1 != at or last >= 0 and not (fits(last, i) if (known := pairs(last * n_tokens + i)) is None else known):
                break
            ids.append(i)
            at, last = end + 1, i
        if at == n:
            return ids
        longest = [-1] * n
        for end, (i, length) in self.automaton.iter(piece):
            longest[end - length + 1] = i  # ends ascend, so the last one is the longest
        ids, at, i = [], 0, longest[0]
        open_at = bytearray(b"\x01") * (n + 1)
        while at < n:
            last = ids[-1] if ids else -1
            while i >= 0 and not (open_at[at + lengths[i]] and (last < 0 or (fits(last, i) if (known := pairs(last * n_tokens + i)) is None else known))):
                i = shorter(i)
            if i >= 0:
                ids.append(i)
                at += lengths[i]
                i = longest[at] if at < n else -1
            elif ids:
                open_at[at] = 0
                i = ids.pop()
                at -= lengths[i]
                i = shorter(i)
            else:
                raise ValueError("the rank file lacks a byte of the text")
        return ids

    def _packed(self, text: str) -> bytes:
        pieces = self.pieces(text)
        if not text.isascii():
            pieces = [p.encode("utf-8").decode("latin-1") for p in pieces]
        ids: list[int] = []
        for piece in pieces:
            ids += self.encode_piece(piece)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if _OTHER_SPACE.search(text):
            return self._packed(text)  # other white space may join runs: no cuts
        known, stretches = self.known, _STRETCH.findall(text)
        forget(known, REMEMBERED // 2)
        long = []
        for s in set(stretches).difference(known):
            known[s] = self._packed(s)
            if len(s) > REMEMBERED_LENGTH:
                long.append(s)
        out = b"".join(map(known.__getitem__, stretches))
        for s in long:
            del known[s]
        return out

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 and rank on each line) in the order of their ranks."""
    fs, where = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    with fs.open_input_stream(where) as f:
        pairs = [line.split() for line in f.read().splitlines() if line]
    by_rank = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [by_rank[i] for i in range(len(by_rank))]


@functools.lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """A worker's own encoder, made once."""
    return ByteBpe(read_ranks(path), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's token ids: id_col and token_ids (binary, little-endian unsigned 32-bit integers).

    One row for each input row, also for repeated ones; a null or empty text
    has no ids; a null id stays null. Other columns are not read. Bytes that
    are not UTF-8 become U+FFFD.
    """
    schema = pa.schema([(id_col, pa.int64()), ("token_ids", pa.binary())])

    def rows(batch):
        bpe = coder(ranks_path, pattern)
        sole_memory("byte_bpe", bpe.known, bpe.pairs)
        for i, text in zip(values(batch, id_col), values(batch, text_col)):
            yield i, bpe.encode(text.decode("utf-8", "replace"))

    picked = docs.select(F.col(id_col).cast("long").alias(id_col), utf8(text_col).alias(text_col))
    return picked.mapInArrow(arrow_rows(schema, rows, lambda r: len(r[1]) + 16), f"`{id_col}` long, token_ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Adds decoded (binary: the bytes that token_ids stand for) to the result of encode; null ids give no bytes."""
    schema = pa.schema([(id_col, pa.int64()), ("token_ids", pa.binary()), ("decoded", pa.binary())])

    def rows(batch):
        bpe = coder(ranks_path, pattern)
        for i, ids in zip(values(batch, id_col), values(batch, "token_ids")):
            yield i, ids, bpe.decode(ids or b"")

    picked = encoded.select(id_col, "token_ids")
    return picked.mapInArrow(arrow_rows(schema, rows, lambda r: len(r[1] or b"") + len(r[2]) + 16), f"`{id_col}` long, token_ids binary, decoded binary")



def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of decode(encode(docs)), encoded and decoded by one worker.

    Chained, the two run in two workers a task, which take turns, so that each of
    them comes to hold an encoder's memory, and the ids pass between them.
    """
    schema = pa.schema([(id_col, pa.int64()), ("token_ids", pa.binary()), ("decoded", pa.binary())])

    def rows(batch):
        bpe = coder(ranks_path, pattern)
        sole_memory("byte_bpe", bpe.known, bpe.pairs)
        for i, text in zip(values(batch, id_col), values(batch, text_col)):
            ids = bpe.encode(text.decode("utf-8", "replace"))
            yield i, ids, bpe.decode(ids)

    picked = docs.select(F.col(id_col).cast("long").alias(id_col), utf8(text_col).alias(text_col))
    return picked.mapInArrow(arrow_rows(schema, rows, lambda r: len(r[1]) + len(r[2]) + 16), f"`{id_col}` long, token_ids binary, decoded binary")
