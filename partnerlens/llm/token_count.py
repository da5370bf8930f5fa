"""Token counts by merging many words at once.

The distinct words of a batch lie one after another in one array of symbols.
In each step every word finds its lowest-ranked pair of neighbours, and all
words merge theirs at the same time (in a run of overlapping equal pairs, from
the left); words without a ranked pair leave with their number of symbols. A
merge's result never takes part in a pair of lower rank, so that equals
merging one pair after another.

The tokenizer file names the rest: the special strings that are cut out first,
the normalizer (NFC, white space, lower case), the pattern, and the word end.
No piece holds white space, so a text may be cut at spaces and line feeds and
the counts of such stretches remembered, within a bound.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import arrow_rows, forget, sole_memory, utf8, values


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if visible in Latin-1, else from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in visible)}
    return [hidden.get(b, chr(b)) for b in range(256)]


class WordBpe:
    """Counts the tokens of texts under one tokenizer file: BPE over bytes with a mark at the word's end."""

    def __init__(self, spec: dict):
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        if model["type"] != "BPE" or not end:
            raise ValueError("a BPE file with word ends is needed")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or not split["invert"]:
            raise ValueError("unknown normalizer or splitter")
        vocab = model["vocab"]
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces = regex.compile(split["pattern"]["Regex"]).findall
        self.inner = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.last = np.array([vocab[c + end] for c in byte_symbols()], np.int64)
        self.size = len(vocab)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)  # by rank
        self.words: dict[str, int] = {}
        self.known: dict[str, int] = {}

    def count_words(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word, all merged rank by rank in one ragged array."""
        raw = [w.encode("utf-8") for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[data[ends - 1]]
        out = np.zeros(len(words), np.int64)
        row = np.repeat(np.arange(len(words)), lengths)
        none = len(self.made)
        while len(symbols):
            rank = np.full(len(symbols), none, np.int64)  # of a symbol and its right neighbour in the word
            pair = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            hit = (self.keys[at] == pair) & (row[:-1] == row[1:])
            rank[:-1][hit] = self.ranks[at[hit]]
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            sizes = np.diff(np.r_[starts, len(row)])
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == none
            out[row[starts[done]]] = sizes[done]
            merge = (rank == np.repeat(lowest, sizes)) & (rank < none)
            where = np.flatnonzero(merge)
            if len(where):  # in a run of overlapping pairs, the first, third, ... merge
                first = np.r_[True, np.diff(where) != 1]
                since = np.arange(len(where)) - np.maximum.accumulate(np.where(first, np.arange(len(where)), 0))
                where = where[since % 2 == 0]
                symbols[where] = self.made[rank[where]]
            keep = np.repeat(~done, sizes)
            keep[where + 1] = False
            symbols, row = symbols[keep], row[keep]
        return out

    def stretch_words(self, stretch: str) -> tuple[list[str], int]:
        """The words of a stretch of text, and the special strings in it."""
        parts = self.special.split(stretch) if self.special and "<" in stretch else [stretch]
        words = []
        for part in parts:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # each character is lowered by itself
            words += self.pieces(part.lower())
        return words, len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        known, words = self.known, self.words
        forget(known)
        forget(words)
        fresh = {s: self.stretch_words(s) for s in set().union(*cut).difference(known)} if cut else {}
        new = list({w for ws, _ in fresh.values() for w in ws}.difference(words))
        if new:
            words.update(zip(new, self.count_words(new).tolist()))
        known.update((s, n + sum(map(words.__getitem__, ws))) for s, (ws, n) in fresh.items())
        out = [sum(map(known.__getitem__, c)) for c in cut]
        for memory in (known, words):
            for s in [s for s in (fresh if memory is known else new) if len(s) > 64]:
                del memory[s]
        return out


@functools.lru_cache(maxsize=2)
def counter(path: str) -> WordBpe:
    """A worker's own counter, made once."""
    fs, where = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    with fs.open_input_stream(where) as f:
        return WordBpe(json.loads(f.read()))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes, n_tokens and over_limit (more tokens than limit) for every row of docs.

    A null text counts as empty: no bytes, no tokens. Repeated rows are counted
    each; a null id stays null. Other columns are not read.
    """
    schema = pa.schema([(id_col, pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def rows(batch):
        bpe = counter(tokenizer_path)
        sole_memory("token_count", bpe.known, bpe.words)
        ids, texts, held = [], [], 0
        for i, raw in zip(values(batch, id_col), values(batch, text_col)):
            ids.append((i, len(raw)))
            texts.append(raw.decode("utf-8", "replace"))
            held += len(raw)
            if held > 2 << 20:
                yield from ((*x, n, n > limit) for x, n in zip(ids, bpe.count(texts)))
                ids, texts, held = [], [], 0
        yield from ((*x, n, n > limit) for x, n in zip(ids, bpe.count(texts)))

    picked = docs.select(F.col(id_col).cast("long").alias(id_col), utf8(text_col).alias(text_col))
    return picked.mapInArrow(arrow_rows(schema, rows), f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean")
