"""Near-duplicate groups by b-bit MinHash, confirmed on full shingle sets.

Every document gives the set of its distinct word shingles. Documents with
equal sets are one class from then on, so a group of copies is never expanded.
A class keeps the low BITS bits of HASHES minima, packed, and a key for each
of BANDS bands of ROWS full minima.

Links are searched so that no bucket is paired with itself as a whole:
1. In each bucket the smallest class is compared with every other one. Each
   class gets the label of the smallest one that confirmed links lead to in
   two steps; equal labels mean that classes are connected.
2. In buckets that still hold several labels, classes of different labels are
   compared, where the bucket has at most SMALL classes.
3. For the classes in larger ones of these buckets, prefixes are joined: two
   sets as similar as asked share one of their rarest shingles, of which
   1 - similarity of each set suffices, and for one of the two sets
   (1 - similarity) / (1 + similarity). What stands after the first shared
   one bounds what two sets have in common. Prefixes lose no link, and what very
   many classes share (a passage) is in few of them.
Pairs first pass the similarity that the packed bits estimate, corrected for
chance collisions, with a margin of about five standard deviations; those that
pass are confirmed exactly on the full sets. All three searches have this filter,
prefixes too, so none is strictly exact: by the binomial sum a pair at the bound
itself is lost here with a probability of 6e-7, and shares none of the bands with
one of 3e-7. More similar pairs are lost less often.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import arrow_rows, drop_path, let_go, own_ids, utf8, values, written
from partnerlens.llm.graph import components
from partnerlens.llm.shingles import shingles

BANDS, ROWS, BITS = 40, 4, 4
#: The first BANDS * ROWS of them make bands; all of them make the estimate.
HASHES = 480
#: Classes in a bucket that are still compared with each other.
SMALL = 256
#: Size of the table of shingle counts by which prefixes are ordered.
SLOTS = 1 << 21
#: What an estimate may lack of the similarity asked for; a standard deviation is 0.021.
MARGIN = 0.105

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set that is not empty, 32 bits each."""
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for k in range(0, len(hashes), 1024):
        least = np.minimum(least, (hashes[k : k + 1024][None, :] * _FACTORS[:, None]).min(axis=1))
    return least >> np.uint64(32)


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The low BITS bits of all minima in 64-bit words."""
    low = (least & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band; different bands have different keys."""
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def estimate(a: str, b: str) -> Column:
    """Similarity of two packed signatures (array<long> columns): share of equal cells, less what chance makes equal."""
    words = HASHES * BITS // 64
    other = None
    for k in range(words):
        d = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x1111111111111111))
        other = F.bit_count(d) if other is None else other + F.bit_count(d)
    chance = 1 / (1 << BITS)
    return (1 - other / HASHES - chance) / (1 - chance)


def signatures(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, set_key (digest of the set), bits and bands of every row; the last three null for an empty set."""
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bits", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])

    def rows(batch):
        for i, raw in zip(values(batch, "id"), values(batch, "text")):
            found = shingles(raw, size)
            if len(found):
                least = minima(found)
                yield i, len(found), xxhash.xxh3_128_digest(found.tobytes()), packed_bits(least), band_keys(least)
            else:
                yield i, 0, None, None, None

    picked = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    return picked.mapInArrow(arrow_rows(schema, rows, lambda _: 600), "id long, n_shingles long, set_key binary, bits array<long>, bands array<long>")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Those of pairs (a, b) of ids with 100 * intersection >= percent * union of their full sets."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    texts = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    needed = texts.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id"])

    def rows(batch):
        last, ours = None, None
        for a, b, x, y in zip(*(values(batch, c) for c in ("a", "b", "x", "y"))):
            if a != last:
                last, ours = a, shingles(x, size)
            theirs = shingles(y, size)
            common = len(np.intersect1d(ours, theirs, assume_unique=True))
            if common and 100 * common >= percent * (len(ours) + len(theirs) - common):
                yield a, b

    both = pairs.join(needed.select(F.col("id").alias("b"), F.col("text").alias("y")), "b")
    both = both.join(needed.select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(arrow_rows(schema, rows), "a long, b long")


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose sizes and packed bits allow the similarity."""
    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    both = pairs.filter("a != b").join(left, "a").join(right, "b")
    return both.filter(fitting("na", "nb", percent) & (estimate("bits_a", "bits_b") >= percent / 100 - MARGIN)).select("a", "b").distinct()


def fitting(na: str, nb: str, percent: int) -> Column:
    """Whether sets of such sizes can be similar enough."""
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def by_prefix(classes: DataFrame, docs: DataFrame, size: int, percent: int, id_col: str, text_col: str, slots: int = SLOTS) -> DataFrame:
    """Pairs (a, b) of classes of different labels that share one of the rarest shingles of their sets.

    Any order of shingles that is the same for all sets loses no link; only the
    estimate can, which pairs have to pass here too (see above). Here it
    is by counts in a table of fixed size, which tasks can hold: a shingle's
    slot may count others too, so it is only about its frequency.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), utf8(text_col).alias("text")).dropDuplicates(["rep"])
    texts, path = written(texts.join(classes.select("rep", "label", "bits"), "rep"), "texts")

    def tally(batches):
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            for raw in values(batch, "text"):
                np.add.at(counts, shingles(raw, size) % np.uint64(slots), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])

    found = texts.select("text").mapInArrow(tally, "slot long, n long").groupBy("slot").agg(F.least(F.sum("n"), F.lit(255)).alias("n")).toPandas()
    table = np.zeros(slots, np.uint8)
    table[found["slot"].to_numpy()] = found["n"].to_numpy()
    held = spark.sparkContext.broadcast(table)
    schema = pa.schema([("rep", pa.int64()), ("label", pa.int64()), ("n", pa.int64()), ("place", pa.int64()), ("shingle", pa.int64()), ("bits", pa.list_(pa.int64()))])

    def rows(batch):
        counts = held.value
        for rep, label, raw, bits in zip(*(values(batch, c) for c in ("rep", "label", "text", "bits"))):
            own = shingles(raw, size)
            often = counts[own % np.uint64(slots)]
            order = np.lexsort((own, often))
            last = (100 - percent) * len(own) // 100 + 1
            for place in range(int((often == 1).sum()), min(last, len(own))):  # those counted once are in no other set
                yield rep, label, len(own), place + 1, int(own[order[place]].view(np.int64)), bits

    found, _ = written(texts.mapInArrow(arrow_rows(schema, rows, lambda _: 160), "rep long, label long, n long, place long, shingle long, bits array<long>"), "prefixes")
    drop_path(spark, path)
    short = found.filter((100 + percent) * F.col("place") <= (100 - percent) * F.col("n") + 100 + percent)
    left, right = short.alias("l"), found.alias("r")
    # If it is the first one that both share, they share no more than what is left of either set.
    most = F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place")) + 1
    near = (F.col("l.label") != F.col("r.label")) & fitting("l.n", "r.n", percent) & ((100 + percent) * most >= percent * (F.col("l.n") + F.col("r.n")))
    near = near & (estimate("l.bits", "r.bits") >= percent / 100 - MARGIN)
    pairs = left.join(right, (F.col("l.shingle") == F.col("r.shingle")) & near)
    return pairs.select(F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """id_col, n_shingles, component_id and kept for every row of docs.

    Rows are linked if 100 * intersection >= percent * union of their sets of
    distinct shingles of `size` words; component_id is the smallest id that
    links reach, kept says that it is the row's own. A null text or one without
    words has an empty set and is linked with nothing. Rows that share an id
    share a component, whatever their texts, and each is returned; a row with a
    null id has no component and is kept. Other columns are not read.
    """
    texts, names = own_ids(docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text")))
    found = _components(texts, size, percent, small)
    if names is not None:
        # Rows of one id are linked; numbers ascend with the ids, so the smallest number is that of the smallest id.
        found, _ = written(found.join(names.withColumnRenamed("node", "id"), "id", "left"), "named")
        least = found.filter("true_id is not null").groupBy("true_id").agg(F.min("component").alias("least"))
        edges = found.join(least, "true_id").filter("component <> least").select(F.col("component").alias("a"), F.col("least").alias("b")).distinct()
        merged = components(edges).select(F.col("node").alias("component"), F.col("component").alias("whole"))
        found = found.join(merged, "component", "left").withColumn("component", F.coalesce("whole", "component"))
        roots = names.select(F.col("node").alias("component"), F.col("true_id").alias("root"))
        found = found.join(roots, "component", "left").select(F.col("true_id").alias("id"), "n_shingles", F.col("root").alias("component"))
    return found.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """docs with one row of each group of linked texts, that of the smallest id; rows without an id stay, all columns as they are.

    Here rows that share an id but not a text are documents of their own:
    none goes but for a near copy of its own text that stays.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"), F.struct("*").alias("row"))
    named, _ = own_ids(rows.filter("id is not null"))
    found = _components(named.select("id", "text"), size, percent, small)
    gone = found.filter("id <> component").select("id").distinct()
    stay = named.select("id", "row").join(gone, "id", "left_anti").dropDuplicates(["id"])
    return stay.select("row.*").union(rows.filter("id is null").select("row.*"))


def _components(docs: DataFrame, size: int, percent: int, small: int) -> DataFrame:
    """id, n_shingles and component (smallest id that links reach) for docs (id, text); rows of one id have one text."""
    id_col, text_col = "id", "text"
    spark = docs.sparkSession
    signed, signed_path = written(signatures(docs, size, id_col, text_col), "signatures")
    known = signed.filter(F.col("id").isNotNull() & F.col("set_key").isNotNull())
    first = known.groupBy("set_key").agg(F.min("id").alias("rep"))
    firsts = known.join(first.withColumnRenamed("set_key", "key"), (F.col("set_key") == F.col("key")) & (F.col("id") == F.col("rep")), "left_semi")
    classes, classes_path = written(firsts.select(F.col("id").alias("rep"), F.col("n_shingles").alias("n"), "bits", "bands").dropDuplicates(["rep"]), "classes")

    ids, _ = written(signed.select("id", "n_shingles", "set_key"), "ids")
    first, _ = written(first, "firsts")
    drop_path(spark, signed_path)
    let_go(spark)

    # 1. Each bucket's smallest class with every other one.
    entries = classes.select("rep", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.min("rep").alias("least"), F.count("*").alias("members")).filter("members > 1")
    shared, shared_path = written(entries.join(buckets, "bucket").select("bucket", "rep", "least", "members"), "buckets")
    slim, slim_path = written(classes.select("rep", "n", "bits"), "classes")
    drop_path(spark, classes_path)
    classes, classes_path = slim, slim_path
    let_go(spark)
    # Written before texts are shuffled: the confirmation reads pairs twice, and bits and texts are not on disk at once.
    stars, stars_path = written(likely(shared.select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct(), classes, percent), "pairs")
    let_go(spark)
    links, links_path = written(confirmed(stars, docs, size, percent, id_col, text_col), "links")
    drop_path(spark, stars_path)
    let_go(spark)

    # 2. What is left in buckets of several labels.
    up = links.groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("label"))
    up = up.join(up.select(F.col("rep").alias("label"), F.col("label").alias("higher")), "label", "left")
    up = up.select("rep", F.coalesce("higher", "label").alias("label"))
    here = shared.join(up, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    here, here_path = written(here.select("bucket", "rep", "least", "members", "label"), "labelled")
    drop_path(spark, shared_path)
    mixed = here.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("bucket")
    here, mixed_path = written(here.join(mixed, "bucket"), "mixed")
    drop_path(spark, here_path)
    let_go(spark)
    few = here.filter((F.col("members") <= small) & (F.col("rep") != F.col("least")))  # the smallest one has been compared
    few = few.join(classes.select("rep", "n", "bits"), "rep")
    left, right = few.alias("l"), few.alias("r")
    unlike = (F.col("l.rep") < F.col("r.rep")) & (F.col("l.label") != F.col("r.label")) & fitting("l.n", "r.n", percent)
    pairs = left.join(right, (F.col("l.bucket") == F.col("r.bucket")) & unlike & (estimate("l.bits", "r.bits") >= percent / 100 - MARGIN))
    pairs, pairs_path = written(pairs.select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")).distinct(), "pairs")

    # 3. Larger ones of them.
    many = here.filter(F.col("members") > small).select("rep", "label").distinct().join(classes.select("rep", "bits"), "rep")
    more, more_path = written(by_prefix(many, docs, size, percent, id_col, text_col), "pairs")
    let_go(spark)
    rest, rest_path = written(pairs.union(more).distinct(), "pairs")
    more, found_path = written(confirmed(rest, docs, size, percent, id_col, text_col), "links")

    found = components(links.union(more))
    for path in (classes_path, links_path, mixed_path, pairs_path, more_path, rest_path, found_path):
        drop_path(spark, path)

    let_go(spark)
    ids = ids.join(first, "set_key", "left")
    ids = ids.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "id")
    return ids.select("id", "n_shingles", F.when(F.col("id").isNotNull(), component).alias("component"))
