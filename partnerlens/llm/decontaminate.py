"""Benchmark decontamination by a bit table of word windows and a join.

Words of both sides are runs of digits, letters and non-ASCII characters with
A-Z lower-cased. Each benchmark item gives its windows of consecutive words (a
shorter item is one window), which are written as a table. The broadcast hash
set of windows is a bit table of their hashes: tasks hold it and slide over the
words of each text, and count them; windows that it lets pass are joined with
the table of windows word by word, which verifies them. The spans of covered
words and the items that were found go back to the texts by 128 bits of hash.

The bit table has a fixed size, and nothing else is broadcast or collected: a
larger benchmark fills it more, and more windows go to the join. Windows that
the same items hold name that set of items, so that a passage which very many
items share is not copied with each hit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import arrow_rows, drop_path, others, small_batches, utf8, values, written
from partnerlens.llm.shingles import word_hashes

#: Bytes of the bit table that is broadcast, whatever the number of windows (rounded down to a power of two).
BLOCK_BYTES = 32 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Each window sets a bit for each of these.
_PROBES = np.array([0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD], np.uint64)

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(raw: bytes) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z; in UTF-8 a byte from 128 on is part of a word."""
    return raw.translate(_LOWER).split()


def window_hashes(hashes: np.ndarray, lengths: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of these lengths a 64-bit hash of the window from each place on; hashes are those of the words."""
    h = np.zeros(len(hashes), np.uint64)
    for n in range(1, min(max(lengths, default=0), len(hashes)) + 1):
        h = (h[: len(hashes) - n + 1] ^ hashes[n - 1 :]) * _MIX
        h ^= h >> np.uint64(31)
        if n in lengths:
            yield n, h


def slots(h: np.ndarray, factor: np.uint64, size: int) -> np.ndarray:
    """Places of hashes in a table of `size` bits, a power of two."""
    return (h * factor) >> np.uint64(65 - size.bit_length())


def passes(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes of which all bits are set; among them all of the table's windows."""
    at = np.arange(len(h))
    for factor in _PROBES:
        found = slots(h[at], factor, 64 * len(table))
        at = at[(table[found >> np.uint64(6)] >> (found & np.uint64(63))) & np.uint64(1) == 1]
    return at


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, overlapping or touching ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """The distinct windows (words joined by a space) of all items, with their length and hash and the ids that hold them."""
    schema = pa.schema([("item", pa.string()), ("words", pa.binary()), ("n", pa.int64()), ("hash", pa.int64())])

    def rows(batch):
        for item, raw in zip(values(batch, "item"), values(batch, "raw")):
            parts = words(raw)
            for n, h in window_hashes(word_hashes(b" ".join(parts)), {min(window, len(parts))}):
                for k, x in enumerate(h.view(np.int64).tolist()):
                    yield item, b" ".join(parts[k : k + n]), n, x

    picked = items.select(F.col(id_col).cast("string").alias("item"), utf8(text_col).alias("raw")).filter(F.col("item").isNotNull())
    found = picked.mapInArrow(arrow_rows(schema, rows, lambda r: len(r[1]) + 64), "item string, words binary, n long, hash long")
    return found.groupBy("words").agg(F.min("n").alias("n"), F.min("hash").alias("hash"), F.array_sort(F.collect_set("item")).alias("items"))


def bit_table(windows: DataFrame, n_bytes: int) -> np.ndarray:
    """A table of at most n_bytes (8 at least) in which the bits of all windows are set, as 64-bit words."""
    size = 1 << (max(n_bytes, 8) * 8).bit_length() - 1

    def bits(batches):
        for batch in batches:
            h = np.array(batch.column(0)).view(np.uint64)
            found = np.concatenate([slots(h, factor, size) for factor in _PROBES])
            at, mask = found >> np.uint64(6), np.uint64(1) << (found & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array(mask.view(np.int64))], names=["at", "mask"])

    found = windows.select("hash").mapInArrow(bits, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(size >> 6, np.uint64)
    table[found["at"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return table


KEY = ["_key1", "_key2"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Rows by id and text: rows of one key have the same text. The id only deals copies out."""
    parts = [utf8(text_col), *([utf8(F.col(id_col).cast("string"))] if id_col in docs.columns else [])]
    return [F.xxhash64(*parts).alias(KEY[0]), F.xxhash64(F.lit(1), *parts).alias(KEY[1])]


def likely(texts: DataFrame, windows: DataFrame, n_bytes: int, every: bool) -> tuple[DataFrame, str]:
    """Key, at, n and words of all windows of texts (key, raw) that the bit table lets pass, and the path they are written to.

    A row at -1 has the number of a text's words as n; there is one for each
    text with a passed window, or for ``every`` text.
    """
    lengths = {r["n"] for r in windows.select("n").distinct().collect()}  # at most as many as a window has words
    held = texts.sparkSession.sparkContext.broadcast(bit_table(windows, n_bytes))
    schema = pa.schema([(KEY[0], pa.int64()), (KEY[1], pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("words", pa.binary())])

    def rows(batch):
        for one, two, raw in zip(*(values(batch, c) for c in (*KEY, "raw"))):
            plain, parts = raw.translate(_LOWER), None
            hashes = word_hashes(plain)
            for n, h in window_hashes(hashes, lengths):
                for k in passes(held.value, h).tolist():
                    parts = parts or plain.split()
                    yield one, two, k, n, b" ".join(parts[k : k + n])
            if every or parts:
                yield one, two, -1, len(hashes), None

    found = written(texts.mapInArrow(arrow_rows(schema, rows, lambda r: len(r[4] or b"") + 128),
                                     f"{KEY[0]} long, {KEY[1]} long, at long, n long, words binary"), "windows-likely")
    held.destroy()
    return found


def found_in(docs: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str, item_id: str, item_text: str, block_bytes: int, every: bool) -> DataFrame:
    """Key, n_words, spans and items for every text, or for those with an occurring window."""
    spark = docs.sparkSession
    small_batches(spark)
    windows, windows_path = written(item_windows(items, window, item_id, item_text).withColumn("owners", F.xxhash64("items")), "windows")
    texts = docs.select(*_keyed(docs, id_col, text_col), utf8(text_col).alias("raw"))
    passed, passed_path = likely(texts, windows, block_bytes, every)
    hits, hits_path = written(passed.filter("at >= 0").join(windows.select("words", "owners"), "words").groupBy(*KEY).agg(
        F.collect_set(F.struct("at", "n")).alias("places"), F.collect_set("owners").alias("owners")), "windows-hit")
    sets = windows.groupBy("owners").agg(F.first("items").alias("items"))
    named = hits.select(*KEY, F.explode("owners").alias("owners")).join(sets, "owners").groupBy(*KEY).agg(F.collect_list("items").alias("sets"))
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    schema = pa.schema([(KEY[0], pa.int64()), (KEY[1], pa.int64()), ("spans", span), ("items", pa.list_(pa.string()))])

    def rows(batch):
        for one, two, places, sets in zip(*(values(batch, c) for c in (*KEY, "places", "sets"))):
            spans = joined([(p["at"], p["at"] + p["n"]) for p in places])
            yield one, two, [{"from": a, "to": b} for a, b in spans], sorted(set().union(*sets))

    merged = arrow_rows(schema, rows, lambda r: 16 * len(r[2]) + sum(map(len, r[3])) + 128)
    spans = hits.drop("owners").join(named, KEY).mapInArrow(
        merged, f"{KEY[0]} long, {KEY[1]} long, spans array<struct<from: bigint, to: bigint>>, items array<string>")
    counts = passed.filter("at < 0").groupBy(*KEY).agg(F.max("n").alias("n_words"))
    found, _ = written(counts.join(spans, KEY, "left" if every else "inner"), "contamination")
    for path in (windows_path, passed_path, hits_path):
        drop_path(spark, path)
    return found


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with three more columns: n_words, spans (array of struct from, to: covered words), items (sorted ids as strings).

    A null text has no words; items without words or with a null id give no
    window; without items nothing is covered. Every row of docs is judged by
    itself. Input columns with these three names are replaced. docs is read
    twice and must give the same rows.
    """
    found = found_in(docs, items, window, id_col, text_col, item_id, item_text, block_bytes, every=True)
    kept = others(docs, "n_words", "spans", "items")
    out = docs.select(F.struct(*kept).alias("row"), *_keyed(docs, id_col, text_col)).join(found, KEY, "left")
    return out.select("row.*", "n_words", *(F.coalesce(c, F.expr(f"cast(array() as {found.schema[c].dataType.simpleString()})")).alias(c) for c in ("spans", "items")))


def clean(docs: DataFrame, items: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that are not contaminated, as they are, whatever their columns are named.

    Rows without an occurring window are never moved. docs is read twice and
    must give the same rows.
    """
    found = found_in(docs, items, window, id_col, text_col, item_id, item_text, block_bytes, every=False)
    gone = found.filter(contaminated()).select(*KEY)
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_keyed(docs, id_col, text_col))
    return rows.join(gone, KEY, "left_anti").select("row.*")


def n_hit() -> F.Column:
    """Words that spans cover."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])


def contaminated() -> F.Column:
    """Whether a row counts as contaminated: some words are covered, and at least one of twenty."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))
