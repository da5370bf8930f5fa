"""Removes byte strings of a given length that also start earlier, found by suffix order.

1. Anchors. Every string of LENGTH bytes has one anchor: the leftmost least
   hash of its GRAM-byte strings. Neighbouring strings share anchors, so a
   text is cut into stretches of at most LENGTH - GRAM + 1 strings of one
   anchor. Equal strings have equal anchors at equal places, so only
   stretches whose anchor occurs again can hold a repeat; the others go.
2. Copies. Of stretches with equal bytes only the first one stays open; all
   strings of the others start earlier too. Copied documents, lines and
   passages end here, whatever the number of copies.
3. Suffix groups. The different stretches of one anchor come together. Parts
   whose bytes are not found again at their place in another stretch are cut
   off; the rest, each different string once, is one text whose suffixes are
   put in order by linear grouping. Suffixes with LENGTH equal bytes are
   neighbours in that order; all but the earliest of them are repeats.
4. An anchor with very many different stretches would be too much for one
   task. Its strings are compared by 128-bit digests that Spark groups.

The repeats of each document are joined as byte ranges and taken out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import arrow_rows, drop_path, let_go, own_ids, small_batches, sole_memory, utf8, values, written
from partnerlens.llm.suffixes import suffix_order

GRAM = 40
#: Different stretches of one anchor that a task takes.
MOST = 16_384
#: Stretches that a task works on together (more only within one anchor).
TOGETHER = 16_384
#: The table of anchors that occur again has 2**25 bits, 4 MB, whatever their number.
TABLE_BITS = 25

_FACTOR = 0x9E3779B97F4A7C15
_random = np.random.default_rng(20240301)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _FACTOR and of its inverse modulo 2**64."""
    out = []
    for x in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
        a = np.full(n, x, np.uint64)
        a[0] = 1
        out.append(np.multiply.accumulate(a))
    return out[0], out[1]


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` bytes from each place on; texts are taken in parts of a million bytes."""
    parts, step = [], 1 << 20
    up, down = _powers(step + 256)
    for k in range(0, len(raw) - size + 1, step):
        part = raw[k : k + step + size - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        h = (sums[size:] - sums[:-size]) * down[: len(part) - size + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        parts.append(h ^ (h >> np.uint64(29)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least value in each window of `width` values."""
    at, size = np.arange(len(h)), 1
    while size < width:
        step = min(size, width - size)
        a, b = at[:-step], at[step:]
        at = np.where(h[a] <= h[b], a, b)
        size += step
    return at


def stretches(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor, first string's start, and number of strings."""
    b = np.frombuffer(raw, np.uint8)
    if len(b) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    h = gram_hashes(b, gram)
    anchor = least_in_windows(h, length - gram + 1)
    start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return h[anchor[start]], anchor[start], start, np.diff(np.r_[start, len(anchor)])


# A stretch's place in one number: 16 bits that tell rows of one id apart, 40 bits of start, 7 bits of strings less 1.
def _place(text_print: int, start: np.ndarray, many: np.ndarray) -> np.ndarray:
    return (np.int64(text_print) << 47) | (start.astype(np.int64) << 7) | (many - 1)


def _print(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) & 0xFFFF


def _start(place):
    return (place >> 7) & ((1 << 40) - 1)


def _many(place):
    return (place & 127) + 1


def count_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """anchor (hash) and n of all stretches, counted in part by tasks; further counts of an anchor may follow."""
    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int64())])

    def run(batches):
        sole_memory("suffix_dedup")
        held: list[np.ndarray] = []
        n = 0

        def out() -> pa.RecordBatch:
            anchors, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(n)], schema=schema)

        for batch in batches:
            for raw in values(batch, "text"):
                held.append(stretches(raw, length, gram)[0].astype(np.uint64))
                n += len(held[-1])
                if n >= 1_000_000:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    return texts.select("text").mapInArrow(run, "anchor long, n long")


def anchor_bits(anchors: DataFrame, bits: int) -> np.ndarray:
    """A table of 2**bits bits, those of the anchors set: its size does not depend on their number.

    The low bits are taken: anchors are least hashes, so their high bits are mostly zero.
    """
    place = F.col("anchor").bitwiseAND(F.lit((1 << bits) - 1))
    words = anchors.select(place.alias("place")).select(F.shiftrightunsigned("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table


def find_stretches(texts: DataFrame, table: np.ndarray, length: int, gram: int) -> DataFrame:
    """anchor (hash), content (digest of the bytes), id and place of every stretch of texts (id, text) whose anchor's bit is set."""
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "content", "id", "place")])
    held_table = texts.sparkSession.sparkContext.broadcast(table)
    mask = np.uint64(len(table) * 64 - 1)

    def run(batches):
        held: list[list[np.ndarray]] = []
        n, bits = 0, held_table.value

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)

        for batch in batches:
            for i, raw in zip(values(batch, "id"), values(batch, "text")):
                anchor, _, start, many = stretches(raw, length, gram)
                bit = anchor & mask
                kept = np.flatnonzero((bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1))
                if not len(kept):
                    continue
                anchor, start, many = anchor[kept], start[kept], many[kept]
                ends = (start + many + (length - 1)).tolist()
                content = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), ends)], np.uint64)
                held.append([anchor.view(np.int64), content.view(np.int64), np.full(len(start), i, np.int64), _place(_print(raw), start, many)])
                n += len(start)
                if n >= 200_000:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    return texts.mapInArrow(run, "anchor long, content long, id long, place long")


def repeated_parts(keys: np.ndarray, rows: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Which strings (row, column of the start) may be found in another row of the same key.

    rows holds bytes by column, the anchors in one column. A string stays if
    each of four 16-byte pieces of it stands at its column in another row.
    """
    piece = 16
    n = rows.shape[1] - piece + 1
    h = np.zeros((len(rows), n), np.uint64)
    for k in range(piece):
        h = h * np.uint64(0x100000001B3) + rows[:, k : k + n] + np.uint64(1)
    h = (h ^ (keys[:, None].view(np.uint64) * np.uint64(_FACTOR))) * np.uint64(0xD6E8FEB86659FD93)
    again = np.zeros(h.shape, bool)
    for c in range(n):
        order = np.argsort(h[:, c])
        same = h[order[1:], c] == h[order[:-1], c]
        again[order[1:][same], c] = True
        again[order[:-1][same], c] = True
    columns = np.arange(rows.shape[1] - length + 1)
    ok = (columns >= first[:, None]) & (columns <= last[:, None])
    for offset in sorted({0, (length - piece) // 3, 2 * (length - piece) // 3, length - piece}):
        ok &= again[:, offset : offset + len(columns)]
    return ok


def suffix_repeats(texts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """Strings of `length` bytes that several texts hold: text, start, and the number of their group."""
    joined: list[int] = []
    starts = []
    for t in texts:
        starts.append(len(joined))
        joined += t
        joined.append(-1)  # below all bytes
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts]).tolist()
    out, number, last, before = [], 0, None, None
    for s in suffix_order(joined):
        k = owner[s]
        at = s - starts[k]
        if at + length > len(texts[k]):
            continue
        string = texts[k][at : at + length]
        if string == last:
            if before is not None:
                out.append((*before, number))
                before = None
            out.append((k, at, number))
        else:
            last, before = string, (k, at)
            number += 1
    return out


def bucket_repeats(keys: np.ndarray, ids: np.ndarray, places: np.ndarray, texts: list[bytes], anchors: np.ndarray, length: int, gram: int):
    """Byte ranges (row, from, to) of strings that stand earlier in another row of the same key.

    Rows are different stretches, in the order of key, id and place; anchors
    are the anchors' places in them.
    """
    reach = length - gram  # columns before the anchor's
    rows = np.zeros((len(texts), reach + length), np.uint8)
    first = reach - anchors
    for k, t in enumerate(texts):
        rows[k, first[k] : first[k] + len(t)] = np.frombuffer(t, np.uint8)
    sizes = np.array([len(t) for t in texts])
    ok = np.zeros((len(texts), rows.shape[1] - length + 3), bool)
    ok[:, 1:-1] = repeated_parts(keys, rows, first, first + sizes - length, length)
    row, a = np.nonzero(ok[:, 1:-1] & ~ok[:, :-2])
    _, z = np.nonzero(ok[:, 1:-1] & ~ok[:, 2:])
    # Each different part once, owned by the earliest row; where it stands again, all its strings are repeats.
    parts: dict[int, dict[tuple, int]] = {}
    for r, x, y in zip(row.tolist(), a.tolist(), z.tolist()):
        own = parts.setdefault(int(keys[r]), {})
        name = (x, y, rows[r, x : y + length].tobytes())
        if name in own:
            yield r, x - int(first[r]), y - int(first[r]) + length
        else:
            own[name] = r
    for own in parts.values():
        if len(own) < 2:
            continue
        names = list(own)
        order: dict[int, list[tuple]] = {}
        for k, at, number in suffix_repeats([t for _, _, t in names], length):
            r = own[names[k]]
            order.setdefault(number, []).append((int(ids[r]), int(places[r]), r, names[k][0] + at - int(first[r])))
        gone: dict[int, list[int]] = {}
        for same in order.values():
            for *_, r, at in sorted(same)[1:]:
                gone.setdefault(r, []).append(at)
        for r, starts in gone.items():
            s = np.unique(starts)
            cut = np.flatnonzero(np.diff(s) != 1)
            for x, y in zip(s[np.r_[0, cut + 1]].tolist(), s[np.r_[cut, len(s) - 1]].tolist()):
                yield r, x, y + length


def group_repeats(length: int, gram: int, together: int):
    """For mapInArrow over rows sorted by anchor, id and place: the ranges of bucket_repeats, by id and place."""
    schema = pa.schema([("id", pa.int64()), ("place", pa.int64()), ("from", pa.int32()), ("to", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            keys, ids, places, texts, anchors = zip(*rows)
            found = bucket_repeats(np.array(keys, np.int64), np.array(ids, np.int64), np.array(places, np.int64), texts, np.array(anchors), length, gram)
            ranges = [(ids[r], places[r], x, y) for r, x, y in found]
            columns = zip(*ranges) if ranges else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for row in zip(*(values(batch, c) for c in ("anchor", "id", "place", "bytes", "at"))):
                if held and row[:3] == held[-1][:3]:
                    continue  # of a repeated row
                if len(held) >= together and row[0] != held[-1][0]:
                    yield out(held)
                    held = []
                held.append(row)
        if held:
            yield out(held)

    return run


def removal_ranges(texts: DataFrame, length: int, gram: int, most: int, together: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """What to remove from texts (id, text): whole stretches (id, place), and ranges (id, place, from and to within the stretch)."""
    spark = texts.sparkSession
    again = count_anchors(texts, length, gram).groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")
    again, again_path = written(again.select("anchor"), "anchors")
    let_go(spark)
    table = anchor_bits(again, bits)
    every, found_path = written(find_stretches(texts, table, length, gram), "stretches")
    drop_path(spark, again_path)

    # Copies: all strings of a stretch start earlier, but for the first of equal ones.
    contents = every.groupBy("anchor", "content").agg(F.min(F.struct("id", "place")).alias("first"), F.count("*").alias("n"))
    contents, contents_path = written(contents.select("anchor", "content", F.col("first.id").alias("first_id"), F.col("first.place").alias("first_place"), "n"), "contents")
    let_go(spark)
    copies = every.join(contents.filter("n > 1").drop("n"), ["anchor", "content"]).filter("id != first_id or place != first_place")
    copies, _ = written(copies.select("id", "place"), "copies")
    drop_path(spark, found_path)
    let_go(spark)

    # First ones whose anchor has several contents: their bytes come from the texts.
    size = contents.groupBy("anchor").agg(F.count("*").alias("contents")).filter("contents > 1")
    shared = contents.join(size, "anchor").select("anchor", F.col("first_id").alias("id"), F.col("first_place").alias("place"), "contents")
    few = with_bytes(texts, shared.filter(F.col("contents") <= most), length, gram)
    few = few.repartition("anchor").sortWithinPartitions("anchor", "id", "place")
    ranges, _ = written(few.mapInArrow(group_repeats(length, gram, together), "id long, place long, from int, to int"), "ranges")
    out = ranges
    large = shared.filter(F.col("contents") > most)
    if large.isEmpty():
        drop_path(spark, contents_path)
    else:
        digests, _ = written(string_digests(texts, large, length, gram), "strings")
        least = digests.groupBy("d1", "d2").agg(F.min(F.struct("id", "start")).alias("least"), F.count("*").alias("n")).filter("n > 1")
        later = digests.join(least.drop("n"), ["d1", "d2"]).filter(F.struct("id", "start") != F.col("least"))
        out = out.union(later.select("id", F.col("start").alias("place"), F.lit(0).alias("from"), F.lit(length).alias("to")))
    let_go(spark)
    return copies, out


def _by_text(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of texts with the list of wanted (anchor, place) of each: bounded by the text's own length."""
    lists = wanted.groupBy("id").agg(F.collect_list(F.struct("anchor", "place")).alias("wanted"))
    return texts.join(lists, "id").select("id", "text", "wanted")


def with_bytes(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """anchor, id, place, bytes and at (the anchor's place in the bytes) of the wanted stretches."""
    schema = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("place", pa.int64()), ("bytes", pa.binary()), ("at", pa.int64())])

    def rows(batch):
        for i, raw, wanted in zip(*(values(batch, c) for c in ("id", "text", "wanted"))):
            mine = _print(raw)
            for w in wanted:
                if w["place"] >> 47 == mine:
                    start, many = _start(w["place"]), _many(w["place"])
                    part = raw[start : start + many + length - 1]
                    # The anchor is the leftmost least of the last string's grams, and of the first one's.
                    h = gram_hashes(np.frombuffer(part, np.uint8), gram)[many - 1 : length - gram + 1]
                    yield w["anchor"], i, w["place"], part, many - 1 + int(h.argmin())

    texts = _by_text(texts, wanted)
    return texts.mapInArrow(arrow_rows(schema, rows, lambda r: len(r[3]) + 32), "anchor long, id long, place long, bytes binary, at long")


def string_digests(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """A 128-bit digest (d1, d2) of every string of the wanted stretches, with id and start (a place of one string)."""
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("id", pa.int64()), ("start", pa.int64())])

    def rows(batch):
        for i, raw, wanted in zip(*(values(batch, c) for c in ("id", "text", "wanted"))):
            mine = _print(raw)
            for w in wanted:
                if w["place"] >> 47 == mine:
                    start = _start(w["place"])
                    for at in range(start, start + _many(w["place"])):
                        d = np.frombuffer(xxhash.xxh3_128_digest(raw[at : at + length]), "<i8")
                        yield int(d[0]), int(d[1]), i, (mine << 47) | (at << 7)

    return _by_text(texts, wanted).mapInArrow(arrow_rows(schema, rows), "d1 long, d2 long, id long, start long").distinct()


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                   most: int = MOST, together: int = TOGETHER, bits: int = TABLE_BITS) -> DataFrame:
    """id_col, n_bytes, spans (array of struct from, to: removed bytes, maximal) and kept (binary: the other bytes) of every row.

    A byte goes if a string of `length` bytes that covers it also starts
    earlier: in a row of smaller id, or earlier in the same row. All strings
    are judged on the texts as they are; none crosses rows. A null text is
    empty. A null id comes before all others. Rows that repeat id and text are
    one document, and each is returned; other rows of one id, or of none, are
    documents of their own, in the order of a 64-bit hash of their texts. length
    is gram + 31 to gram + 127.
    """
    if not gram + 31 <= length < gram + 128:
        raise ValueError("length must be from gram + 31 to gram + 127")
    small_batches(docs.sparkSession)
    null = -(1 << 63)
    own = F.col(id_col).cast("long")
    texts, _ = own_ids(docs.select(F.coalesce(own, F.lit(null)).alias("id"), utf8(text_col).alias("text"), own.alias("own")))
    copies, ranges = removal_ranges(texts, length, gram, most, together, bits)
    copies = copies.groupBy("id").agg(F.collect_list("place").alias("copies"))
    ranges = ranges.groupBy("id").agg(F.collect_list(F.struct("place", "from", "to")).alias("ranges"))
    lists = copies.join(ranges, "id", "full")
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    schema = pa.schema([(id_col, pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            copies, ranges = (batch.column(batch.schema.get_field_index(c)) for c in ("copies", "ranges"))
            out, held = [], 0
            for k, (i, raw) in enumerate(zip(values(batch, "own"), values(batch, "text"))):
                spans, kept = taken_out(raw, copies[k], ranges[k], length)
                out.append((i, len(raw), [{"from": a, "to": b} for a, b in spans], kept))
                held += len(kept)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    both = texts.join(lists, "id", "left").select("own", "text", "copies", "ranges")
    return both.mapInArrow(run, f"`{id_col}` long, n_bytes long, spans array<struct<from: bigint, to: bigint>>, kept binary")


def taken_out(raw: bytes, copies: pa.Scalar, ranges: pa.Scalar, length: int) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal ranges to remove from a text, and what is left of it."""
    firsts, lasts, mine = [], [], _print(raw)
    if copies.is_valid:
        place = np.array(copies.values)
        place = place[place >> 47 == mine]
        firsts.append(_start(place))
        lasts.append(_start(place) + _many(place) + length - 1)
    if ranges.is_valid:
        place, x, y = (np.array(ranges.values.field(c)) for c in ("place", "from", "to"))
        own = place >> 47 == mine
        firsts.append(_start(place[own]) + x[own])
        lasts.append(_start(place[own]) + y[own])
    a, b = (np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (firsts, lasts))
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    if not len(a):
        return [], raw
    new = np.r_[True, a[1:] > b[:-1]]
    firsts = np.flatnonzero(new)
    spans = list(zip(a[firsts].tolist(), b[np.r_[firsts[1:] - 1, len(a) - 1]].tolist()))
    kept, at = [], 0
    for x, y in spans:
        kept.append(raw[at:x])
        at = y
    return spans, b"".join([*kept, raw[at:]])


def n_removed() -> Column:
    """Bytes that spans cover."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
