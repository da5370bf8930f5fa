"""Token-id files: patched frame-of-reference blocks, written and read by Spark tasks.

A shard file holds the ids of consecutive documents:

    magic "PFORIDS1"
    blocks: minimum (uint32), values (uint16), width in bits (uint8), 0, exceptions (uint16), 0, 0;
            each value less the minimum, its low `width` bits packed from bit 0 of 64-bit words;
            for each exception its place (uint16), then for each its whole difference (uint32)
    index:  block starts, document ids, null flags, tokens of each document (all int64)
    footer: number of blocks, documents and ids, and the start of the index (int64), magic

All integers are little-endian. A block has BLOCK values, the last of a shard
may have fewer. The width is what a given percentile of a block's differences
needs; larger ones are exceptions.

Documents are range-partitioned and sorted by id, each task writes shards of
bounded length under names of its own, and the returned manifest lists the
shards of successful tasks only: what a lost or repeated attempt wrote is
never read.
"""

from __future__ import annotations

import functools
import os
import re
import string
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partnerlens.llm.common import REMEMBERED, arrow_rows, forget, new_path, small_batches, sole_memory, utf8, values, written

MAGIC = b"PFORIDS1"
_UPPER = string.ascii_uppercase + "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)
BLOCK = 512
#: Ids that are encoded or decoded at once, a multiple of BLOCK.
CHUNK = BLOCK * 1024
_HEAD = 12


def encode_blocks(ids: np.ndarray, percentile: float = 0.9) -> tuple[bytes, np.ndarray]:
    """The blocks of some ids, and the length of each in bytes."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return b"", np.zeros(0, np.int64)
    counts = np.full(n, BLOCK)
    counts[-1] = len(ids) - BLOCK * (n - 1)
    grid = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1])]).astype(np.uint32).reshape(n, BLOCK)
    low = grid.min(axis=1)
    grid -= low[:, None]
    at = min(BLOCK - 1, int(percentile * BLOCK))
    widths = np.array([int(x).bit_length() for x in np.partition(grid, at, axis=1)[:, at]])
    over = grid > ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    over.reshape(-1)[len(ids):] = False
    exceptions = over.sum(axis=1)
    sizes = _HEAD + BLOCK // 8 * widths + 6 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    head = np.zeros((n, _HEAD), np.uint8)
    head[:, 0:4] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    head[:, 4:6] = counts.astype("<u2").view(np.uint8).reshape(n, 2)
    head[:, 6] = widths
    head[:, 8:10] = exceptions.astype("<u2").view(np.uint8).reshape(n, 2)
    out[starts[:, None] + np.arange(_HEAD)] = head
    for width in np.unique(widths[widths > 0]).tolist():
        rows = np.flatnonzero(widths == width)
        cells = (grid[rows] & np.uint32((1 << width) - 1)).astype(np.uint64).reshape(len(rows), BLOCK // 64, 64)
        packed = np.zeros((len(rows), BLOCK // 64, width + 1), np.uint64)
        for j in range(64):
            word, shift = divmod(j * width, 64)
            packed[:, :, word] |= cells[:, :, j] << np.uint64(shift)
            if shift + width > 64:
                packed[:, :, word + 1] |= cells[:, :, j] >> np.uint64(64 - shift)
        data = np.ascontiguousarray(packed[:, :, :width]).astype("<u8").view(np.uint8).reshape(len(rows), -1)
        out[starts[rows][:, None] + _HEAD + np.arange(data.shape[1])] = data
    block, place = np.nonzero(over)
    if len(block):
        order = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
        base = starts[block] + _HEAD + BLOCK // 8 * widths[block]
        out[(base + 2 * order)[:, None] + np.arange(2)] = place.astype("<u2").view(np.uint8).reshape(-1, 2)
        whole = grid[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(base + 2 * exceptions[block] + 4 * order)[:, None] + np.arange(4)] = whole
    return out.tobytes(), sizes


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks, which begin at starts in data."""
    raw = np.frombuffer(data, np.uint8)
    n = len(starts)
    if not n:
        return np.zeros(0, "<u4")
    head = raw[starts[:, None] + np.arange(_HEAD)]
    low = np.ascontiguousarray(head[:, 0:4]).view("<u4")[:, 0].astype(np.uint64)
    counts = np.ascontiguousarray(head[:, 4:6]).view("<u2")[:, 0]
    widths = head[:, 6].astype(np.int64)
    exceptions = np.ascontiguousarray(head[:, 8:10]).view("<u2")[:, 0].astype(np.int64)
    grid = np.zeros((n, BLOCK), np.uint64)
    for width in np.unique(widths[widths > 0]).tolist():
        rows = np.flatnonzero(widths == width)
        packed = raw[starts[rows][:, None] + _HEAD + np.arange(BLOCK // 8 * width)].view("<u8").reshape(len(rows), BLOCK // 64, width)
        cells = np.empty((len(rows), BLOCK // 64, 64), np.uint64)
        for j in range(64):
            word, shift = divmod(j * width, 64)
            cells[:, :, j] = packed[:, :, word] >> np.uint64(shift)
            if shift + width > 64:
                cells[:, :, j] |= packed[:, :, word + 1] << np.uint64(64 - shift)
        grid[rows] = (cells & np.uint64((1 << width) - 1)).reshape(len(rows), BLOCK)
    if total := int(exceptions.sum()):
        block = np.repeat(np.arange(n), exceptions)
        order = np.arange(total) - (np.cumsum(exceptions) - exceptions)[block]
        base = starts[block] + _HEAD + BLOCK // 8 * widths[block]
        place = np.ascontiguousarray(raw[(base + 2 * order)[:, None] + np.arange(2)]).view("<u2")[:, 0]
        whole = np.ascontiguousarray(raw[(base + 2 * exceptions[block] + 4 * order)[:, None] + np.arange(4)]).view("<u4")[:, 0]
        grid[block, place] = whole
    ids = (grid + low[:, None]).astype("<u4")
    return ids.reshape(-1)[(np.arange(BLOCK) < counts[:, None]).reshape(-1)]


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A file system and path of a URI or local path, by Arrow (local, HDFS and object stores)."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))  # Hadoop's names of the scheme
    return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)


class Shard:
    """A shard file while it is written."""

    def __init__(self, folder: str, percentile: float):
        self.path, self.percentile = f"{folder}/{uuid.uuid4().hex}.pfor", percentile
        fs, where = _open(self.path)
        fs.create_dir(where.rpartition("/")[0], recursive=True)
        self.file = fs.open_output_stream(where)
        self.file.write(MAGIC)
        self.at, self.sizes, self.docs, self.held, self.n_held, self.n_ids = len(MAGIC), [], [], [], 0, 0

    def add(self, doc_id: int | None, packed: bytes) -> None:
        n = len(packed) // 4
        self.docs.append((doc_id or 0, int(doc_id is None), n))
        self.held.append(packed)
        self.n_held += n
        self.n_ids += n
        if self.n_held >= CHUNK:
            self.flush(False)

    def flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        full = len(ids) if last else len(ids) // BLOCK * BLOCK
        for k in range(0, full, CHUNK):
            data, sizes = encode_blocks(ids[k : min(k + CHUNK, full)], self.percentile)
            self.file.write(data)
            self.sizes.append(sizes)
        self.held, self.n_held = [ids[full:].tobytes()], len(ids) - full

    def close(self) -> tuple[str, int, int]:
        self.flush(True)
        sizes = np.concatenate([np.zeros(0, np.int64), *self.sizes])
        starts = len(MAGIC) + np.cumsum(sizes) - sizes
        docs = np.array(self.docs, np.int64).reshape(-1, 3)
        self.file.write(starts.astype("<i8").tobytes() + np.ascontiguousarray(docs.T).astype("<i8").tobytes())
        self.file.write(struct.pack("<4q", len(starts), len(docs), self.n_ids, len(MAGIC) + int(sizes.sum())) + MAGIC)
        self.file.close()
        return self.path, len(docs), self.n_ids


def read_shard(path: str) -> Iterator[tuple[int | None, int, bytes]]:
    """The documents of a shard in their order: id, start within the shard, and packed ids."""
    fs, where = _open(path)
    with fs.open_input_file(where) as f:
        size = f.size()
        f.seek(size - 40)
        n_blocks, n_docs, n_ids, index, magic = struct.unpack("<4q8s", f.read(40))
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard file")
        f.seek(index)
        starts = np.frombuffer(f.read(8 * n_blocks), "<i8")
        docs = np.frombuffer(f.read(24 * n_docs), "<i8").reshape(3, n_docs)
        ends = np.r_[starts[1:], index]
        held, first, block, step = b"", 0, 0, CHUNK // BLOCK
        at = 0
        for doc_id, null, n in zip(*docs.tolist()):
            while first + len(held) // 4 < at + n:
                some = starts[block : block + step]
                f.seek(int(some[0]))
                more = decode_blocks(f.read(int(ends[block + len(some) - 1] - some[0])), some - some[0])
                held, first = held[4 * (at - first):] + more.tobytes(), at
                block += step
            yield None if null else doc_id, at, held[4 * (at - first) : 4 * (at + n - first)]
            at += n


class Stretches(dict):
    """Packed ids of stretches of text; one that is missing gets an empty place, which is noted and filled later."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, stretch: str) -> bytearray:
        self.new.append(stretch)
        place = self[stretch] = bytearray()
        return place


class Encoder:
    """Ids of texts by the tokenizers library, without special tokens, and an end id."""

    #: A word of its own that stands between stretches which the library encodes in one text.
    BETWEEN = "~"
    #: A word and ASCII marks after it, which the library splits off too. (İ gets a mark when it is lower-cased.)
    _MARKED = re.compile(r"([^\W\d_İ]+)([!-&(-/:-@\[-`{-~]+)")

    def __init__(self, path: str, end_id: int, cut: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library, self.cut = Tokenizer.from_file(path), cut
        self.end = struct.pack("<I", end_id)
        self.known = Stretches()
        between = self.library.encode(self.BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        rule = self.library.normalizer
        self.lowers = rule is not None and rule.normalize_str(_UPPER) == _UPPER.lower()
        self.special = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]

    def packed(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def packed_words(self, words: list[str]) -> list[bytes]:
        """The ids of each of some stretches: about a thousand go in one text, cut where the word between them stands."""
        out = []
        for k in range(0, len(words), 1000):
            group = words[k : k + 1000]
            ids = self.packed([f" {self.BETWEEN} ".join(group)])[0] if self.between is not None else b""
            at = (4 * np.flatnonzero(np.frombuffer(ids, "<u4") == self.between)).tolist()
            if len(at) == len(group) - 1 and not any(self.BETWEEN in w for w in group):
                out += map(ids.__getitem__, map(slice, [0, *(x + 4 for x in at)], [*at, len(ids)]))
            else:
                out += self.packed(group)
        return out

    def fill(self, new: list[str]) -> None:
        """Encodes new stretches and fills their places; a word and the marks after it are encoded each for itself."""
        known, split = self.known, self._MARKED.fullmatch
        marked, plain = [], []
        for s in new:
            if m := split(s):
                word, marks = m.groups()
                marked.append((known[s], known[word], known[marks]))  # places, of which some may be new
            else:
                plain.append(s)
        plain += known.new
        known.new = []
        odd = [s for s in plain if self.BETWEEN in s]
        if odd:
            plain = [s for s in plain if self.BETWEEN not in s]
        for s, ids in zip(plain + odd, self.packed_words(plain) + self.packed(odd)):
            known[s].extend(ids)
        for place, word, marks in marked:
            place += word
            place += marks

    def lowered(self, text: str) -> str:
        """A Latin-1 text in lower case, where the library makes it so and no special string could arise."""
        if not self.lowers:
            return text
        try:
            text.isascii() or text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        low = text.lower()
        return text if any(s in low for s in self.special) else low

    def cuts(self, text: str) -> list[str]:
        """The stretches of a text."""
        text = self.lowered(text)
        if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return text.split()  # at all that is white space to the library too
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cut:
            return [ids + self.end for ids in self.packed(texts)]
        known = self.known
        forget(known, 5 * REMEMBERED // 2)
        get = known.__getitem__
        found = [list(map(get, self.cuts(t))) for t in texts]
        new, known.new = known.new, []
        self.fill(new)
        out = [b"".join(f) + self.end for f in found]
        known.update(zip(new, map(bytes, map(get, new))))  # smaller than the places
        for s in [s for s in new if len(s) > 64]:
            del known[s]
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str, end_id: int, cut: bool) -> Encoder:
    """A worker's own encoder, made once."""
    return Encoder(path, end_id, cut)


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, cut_at_spaces: bool = False, id_col: str = "doc_id",
              text_col: str = "text", percentile: float = 0.9, shard_ids: int = 1 << 24) -> DataFrame:
    """Encodes every row's text, appends end_id, and writes all ids in ascending order of id_col.

    Returns the manifest: path, n_docs, n_ids, and start (ids of all shards
    before), one row for each shard. A null text counts as empty and has the
    end id alone; null ids come first; rows that share an id are all written,
    in the order of their texts. shard_ids bounds a file (one document more).

    cut_at_spaces: for tokenizers that drop all white space, so that no token
    holds any; texts are then encoded in the stretches between, whose ids are
    remembered.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches):
        code, part, shard, number = encoder(tokenizer_path, end_id, cut_at_spaces), TaskContext.get().partitionId(), None, 0
        sole_memory("id_store", code.known)

        def row(shard, number):
            path, n_docs, n_ids = shard.close()
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "path": path, "n_docs": n_docs, "n_ids": n_ids}], schema)

        for batch in batches:
            rows = zip(values(batch, "id"), values(batch, "text"))
            while some := _take(rows, 1 << 20):
                for (doc_id, _), packed in zip(some, code.encode([t for _, t in some])):
                    shard = shard or Shard(folder, percentile)
                    shard.add(doc_id, packed)
                    if shard.n_ids >= shard_ids:
                        yield row(shard, number)
                        shard, number = None, number + 1
        if shard:
            yield row(shard, number)

    picked = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    ordered = picked.repartitionByRange("id").sortWithinPartitions("id", "text")
    manifest, _ = written(ordered.mapInArrow(run, "part long, number long, path string, n_docs long, n_ids long"), "manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    return manifest.select("path", "n_docs", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))


def _take(rows: Iterator[tuple], size: int) -> list[tuple]:
    """The next rows, with texts of about size bytes."""
    out, held = [], 0
    for doc_id, raw in rows:
        out.append((doc_id, raw.decode("utf-8", "replace")))
        held += len(raw) + 64
        if held >= size:
            break
    return out


def read_ids(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every document of the shards: id_col, start (ids before it) and token_ids (binary, little-endian unsigned 32-bit integers)."""
    schema = pa.schema([(id_col, pa.int64()), ("start", pa.int64()), ("token_ids", pa.binary())])

    def rows(batch):
        for path, start in zip(values(batch, "path"), values(batch, "start")):
            for doc_id, at, packed in read_shard(path):
                yield doc_id, start + at, packed

    spread = manifest.select("path", "start").repartition(max(1, manifest.count()), "path")  # a task for about each file
    return spread.mapInArrow(arrow_rows(schema, rows, lambda r: len(r[2]) + 24), f"`{id_col}` long, start long, token_ids binary")


def new_folder(spark: SparkSession) -> str:
    """A folder for shards in the shared folder."""
    return new_path(spark, "ids")
