"""Approximate nearest neighbours by shifted space-filling curves.

Each curve turns vectors by its own random rotation, keeps DIMENSIONS of the
coordinates, shifts them and orders all vectors by their Hilbert index. Spark
range-partitions and sorts the keys; places along each curve are cut into
blocks, and a query is compared with all vectors of its block and of both
neighbouring blocks on every curve, by cosine in double precision on the
original vectors. The nearest of all curves are merged.

Vectors that are equal are indexed once, with their smallest ids; so a vector
that a third of all rows share takes one place. A block's length is not
guessed: for a bounded sample of queries the exact neighbours are found, and
the block is made as long as their distance along the best curve asks for
TARGET of them. Long blocks are compared in parts, each a group of its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerlens.llm.common import arrow_rows, values, written

CURVES = 16
DIMENSIONS = 16
BITS = 3
#: Queries whose exact neighbours set the block's length.
SAMPLE = 256
TARGET = 0.92
LEAST_BLOCK = 64
#: Vectors, and queries, of a block that a task compares at once, on the average; longer blocks are dealt out by hash.
PART = 16_384


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (integers below 2**bits) along the Hilbert curve; up to 63 bits in all.

    From the top bit down, each axis mirrors or swaps the lower bits of the
    first one; a Gray code over all axes gives the place's bits, axis by axis.
    """
    x = [c.astype(np.uint64) for c in cells.T]
    for b in range(bits - 1, 0, -1):
        low = np.uint64((1 << b) - 1)
        for i in range(len(x)):
            is_set = (x[i] >> np.uint64(b)) & np.uint64(1) == 1
            swap = np.where(is_set, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> np.uint64(b)) & np.uint64(1) == 1, turn ^ np.uint64((1 << b) - 1), turn)
    place = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            place = (place << np.uint64(1)) | (((axis ^ turn) >> np.uint64(b)) & np.uint64(1))
    return place.astype(np.int64)


def curve_keys(vectors: np.ndarray, curve: int, dimensions: int, bits: int) -> np.ndarray:
    """Places of unit vectors along one curve; the curve's number sets its rotation and shift."""
    random, d = np.random.default_rng(1000 + curve), vectors.shape[1]
    used = min(dimensions, d)
    turned = vectors @ np.linalg.qr(random.normal(size=(d, d)))[0][:, :used] * np.sqrt(d)
    turned += random.uniform(-0.5, 0.5, used)
    share = 1 / (1 + np.exp(-1.702 * turned))  # about evenly spread over 0 to 1
    return hilbert_index(np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def pack(vector: list[float], kind: str) -> bytes:
    """A vector's components, with -0.0 as 0.0; kind as the table has them, `<f4` or `<f8`."""
    return (np.array(vector, kind) + np.zeros(1, kind)).tobytes()


def unpack(raw, kind: str) -> np.ndarray:
    """Several packed vectors as doubles, one to a row."""
    return np.stack([np.frombuffer(x, kind) for x in raw]).astype(np.float64)


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to 0.5 to 1: exact, and squares neither overflow nor vanish."""
    _, power = np.frexp(np.abs(v).max(axis=1, initial=0.0))
    return np.ldexp(v, -power[:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, each summed alike wherever it stands."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def nearest(queries: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """For each query the k nearest rows: query's number, row's id and cosine; ties to smaller ids."""
    queries, rows = scaled(queries), scaled(rows)
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    out = []
    for first in range(0, len(queries), 256):
        some = queries[first : first + 256]
        near = some / np.linalg.norm(some, axis=1)[:, None] @ unit.T
        m = min(k, len(rows))
        edge = np.partition(near, -m, axis=1)[:, -m] - 1e-9
        for i, j in enumerate(near >= edge[:, None]):
            at = np.flatnonzero(j)  # a few more where scores are almost equal
            exact = cosines(np.broadcast_to(some[i], (len(at), some.shape[1])), rows[at])
            best = np.lexsort((row_ids[at], -exact))[:k]
            out += [(first + i, int(row_ids[at[b]]), float(exact[b])) for b in best]
    return out


def distinct_vectors(rows: DataFrame, id_col: str, vec_col: str, keep: int, kind: str) -> DataFrame:
    """Each different valid vector once: class_id (its smallest id), ids (its `keep` smallest), vector (packed).

    Null vectors, empty ones, zeros, and those with a null or non-finite
    component or of another dimension than most have take no part; nor do null ids.
    """
    valid = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    valid = valid.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    valid = valid.filter(F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    usual = valid.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    valid = valid.filter(F.size("v") == (usual["d"] if usual else 0)).distinct()
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))  # keeps few ids of each vector before it shuffles
    few = valid.withColumn("place", place).filter(F.col("place") <= keep)
    classes = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))

    schema = pa.schema([("class_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("vector", pa.binary())])

    def packed(batch):
        for ids, v in zip(values(batch, "ids"), values(batch, "v")):
            yield ids[0], ids, pack(v, kind)

    return classes.mapInArrow(arrow_rows(schema, packed, lambda r: len(r[2]) + 64), "class_id long, ids array<long>, vector binary")


def places(classes: DataFrame, kind: str, curves: int, dimensions: int, bits: int) -> DataFrame:
    """class_id and place (from 0) of every vector on every curve."""
    schema = pa.schema([("curve", pa.int32()), ("key", pa.int64()), ("class_id", pa.int64())])

    def keys(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, v = batch.column(0), unpack((x.as_py() for x in batch.column(1)), kind)
            v = scaled(v)
            v /= np.linalg.norm(v, axis=1)[:, None]
            for c in range(curves):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), c, np.int32)), pa.array(curve_keys(v, c, dimensions, bits)), ids], schema=schema)

    dealt = classes.select("class_id", "vector").mapInArrow(keys, "curve int, key long, class_id long")
    dealt = dealt.repartitionByRange("curve", "key", "class_id").sortWithinPartitions("curve", "key", "class_id")
    numbered, _ = written(dealt.select("curve", "class_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "curve-keys")
    starts = numbered.groupBy("curve", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))  # a row for each task and curve
    starts = starts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return numbered.join(starts.select("curve", "part", "first", "before"), ["curve", "part"]).select(
        "curve", "class_id", (F.col("before") + F.col("at") - F.col("first")).alias("place"))


def exact_neighbours(classes: DataFrame, kind: str, queries: list[tuple[int, bytes]], k: int) -> list[tuple[int, int]]:
    """The k nearest other classes of a bounded list of queries, by one scan over all classes."""
    if not queries:
        return []
    held = classes.sparkSession.sparkContext.broadcast(queries)
    schema = pa.schema([("query", pa.int64()), ("class_id", pa.int64()), ("score", pa.float64())])

    def scan(batch):
        ids, v = np.array(batch.column(0)), unpack(values(batch, "vector"), kind)
        own = [q for q, _ in held.value]
        for q, c, s in nearest(unpack((x for _, x in held.value), kind), v, ids, k + 1):
            if own[q] != c:
                yield own[q], c, s

    found = classes.select("class_id", "vector").mapInArrow(arrow_rows(schema, lambda b: scan(b) if b.num_rows else iter(())), "query long, class_id long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "class_id")
    return [(r["query"], r["class_id"]) for r in found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).collect()]


def block_length(classes: DataFrame, asked: DataFrame, placed: DataFrame, kind: str, k: int, sample: int, target: float, least: int) -> int:
    """Length of a block in which the target share of a sample's exact neighbours lies within one block on some curve."""
    some = asked.orderBy(F.xxhash64("class_id"), "class_id").limit(sample).collect()
    pairs = exact_neighbours(classes, kind, [(r["class_id"], bytes(r["vector"])) for r in some], k)
    if not pairs:
        return least
    spark = classes.sparkSession
    pairs = spark.createDataFrame(pairs, "query long, near long")  # sample times k rows at most
    ours = placed.join(F.broadcast(pairs), placed["class_id"] == pairs["query"]).select("query", "near", "curve", "place")
    both = ours.join(placed.select(F.col("class_id").alias("near"), "curve", F.col("place").alias("other")), ["near", "curve"])
    apart = both.groupBy("query", "near").agg(F.min(F.abs(F.col("place") - F.col("other"))).alias("apart"))
    far = sorted(r["apart"] for r in apart.collect())
    return max(least, far[min(len(far) - 1, int(target * len(far)))] + 1)


def search(rows: DataFrame, query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", curves: int = CURVES,
           dimensions: int = DIMENSIONS, bits: int = BITS, sample: int = SAMPLE, target: float = TARGET, least_block: int = LEAST_BLOCK,
           part: int = PART) -> DataFrame:
    """The k nearest rows found for each row whose id fits query (a condition on the column `id`): query_id, rank, id, score.

    Nearness is the cosine in double precision; ties go to smaller ids; a row
    is no neighbour of its own, but rows of equal vectors are. All others, if
    fewer than k. Rows that repeat id and vector count once.
    """
    kind = "<f4" if rows.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    classes, _ = written(distinct_vectors(rows, id_col, vec_col, k + 1, kind), "vectors")
    asked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(query).distinct()
    packed = classes.select(F.col("class_id").alias("query_class"), "ids", "vector")
    placed, _ = written(places(classes, kind, curves, dimensions, bits), "places")

    # The class of each query: its own vector's. Few ids of a class are kept, so queries are found by vector.
    schema = pa.schema([("id", pa.int64()), ("vector", pa.binary())])

    def by_vector(batch):
        for i, v in zip(values(batch, "id"), values(batch, "v")):
            yield i, pack(v, kind)

    finite = asked.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()))
    asked = finite.mapInArrow(arrow_rows(schema, by_vector, lambda r: len(r[1]) + 16), "id long, vector binary")
    asked = asked.join(packed, "vector").select(F.col("id").alias("query_id"), "query_class")
    asked, _ = written(asked, "queries")
    asked_classes = asked.select(F.col("query_class").alias("class_id")).distinct()

    marked = classes.join(asked_classes, "class_id", "left_semi")
    length = block_length(classes, marked, placed, kind, k, sample, target, least_block)

    block = placed.withColumn("block", F.floor(F.col("place") / length))
    indexed = block.join(classes.select("class_id", "vector"), "class_id").select("curve", "block", "class_id", "vector")
    wide = block.join(marked.select("class_id", "vector"), "class_id")
    wide = wide.select(F.col("curve").alias("q_curve"), F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("q_block"),
                       F.col("class_id").alias("q_class"), F.col("vector").alias("q_vector"))

    # Every part of a block's vectors meets every part of its queries, so that a group's size does not grow with the table.
    crowd = wide.groupBy("q_curve", "q_block").count().agg(F.max("count")).first()[0] or 0
    parts, sets = -(-length // part), max(1, -(-crowd // part))
    dealt = lambda c, n: F.pmod(F.xxhash64(F.col(c), F.lit("part")), F.lit(n))
    indexed = indexed.withColumn("part", dealt("class_id", parts)).withColumn("set", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sets - 1).cast("long"))))
    wide = wide.withColumn("q_set", dealt("q_class", sets)).withColumn("q_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def compare(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_class": [], "class_id": [], "score": []})
        found = nearest(unpack(left["q_vector"], kind), unpack(right["vector"], kind), right["class_id"].to_numpy(), k + 1)
        own = left["q_class"].to_numpy()
        return pd.DataFrame([(own[q], c, s) for q, c, s in found], columns=["query_class", "class_id", "score"])

    near = wide.groupBy("q_curve", "q_block", "q_part", "q_set").cogroup(indexed.groupBy("curve", "block", "part", "set"))
    near = near.applyInPandas(compare, "query_class long, class_id long, score double")
    near = near.groupBy("query_class", "class_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    near = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")

    found = asked.join(near, "query_class").join(classes.select("class_id", "ids"), "class_id")
    found = found.select("query_id", "score", F.explode("ids").alias("id")).filter(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
