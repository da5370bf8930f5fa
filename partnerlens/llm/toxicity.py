"""Toxicity: a counterfactual-regularised classifier.

Texts are lower-cased, everything but letters becomes one space. A text's
features are the distinct character 4- to 6-grams inside its words (with the
space before and after), so that presence counts, whatever the length; those
that occur once in every DENSE words or more often are a further feature each.
A logistic regression is fitted on a bounded sample of labelled rows. Each of
them has a counterfactual: its identity terms ("muslim", "Frauen") swapped for
others of their kind, or, where it names none, one put in. Besides the loss on labels
and an L2 penalty, the fit minimises the squared change of the score between a
row and its counterfactual. So a group whose mention goes with toxic labels in
the sample gets no weight, and neutral texts about it stay clean, while the
words that make either text toxic keep theirs.

Labels and ids are joined without texts; only the sample's texts are moved.
Scoring reads every whole text.
"""

from __future__ import annotations

import dataclasses
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerlens.llm.common import arrow_rows, others, small_batches, sole_memory, utf8, values, written
from partnerlens.llm.langid import letters

#: Sample of labelled rows for the fit: at most so many of each label.
ROWS_PER_CLASS = 6000
#: Lengths of n-grams, spaces around a word included.
SIZES = (4, 5, 6)
#: An n-gram is dense in a text that has it once in so many words or more often.
DENSE = 100
#: Features are looked for in buckets of this many bits first, then by their 64-bit hashes.
BUCKET_BITS = 20
#: Association with the label, in standard deviations, from which a bucket or a feature counts, and rows that must have it.
BUCKET_Z, FEATURE_Z, LEAST_ROWS = 2.5, 4.0, 3
#: Weight of the squared change of a score (as a logit) between a row and its counterfactual.
PULL = 4.0
#: Code points whose n-grams are hashed at once.
STEP = 1 << 20

#: Identity terms, each line one kind; a term is swapped for another of its line.
IDENTITIES = """
christian muslim jewish hindu buddhist atheist catholic protestant
christians muslims jews hindus buddhists atheists catholics protestants
black white asian african european latino arab
american mexican chinese indian german french spanish russian turkish polish
gay lesbian straight bisexual transgender queer
women men
woman man
girls boys
immigrants refugees foreigners natives
disabled blind deaf autistic
old young elderly teenage
christen muslime juden hindus buddhisten atheisten
frauen männer
frau mann
schwule lesben heterosexuelle
ausländer flüchtlinge einheimische migranten
türken polen franzosen russen amerikaner
chrétiens musulmans juifs bouddhistes athées
femmes hommes
femme homme
étrangers réfugiés immigrés
arabes africains européens asiatiques
cristianos musulmanes judíos budistas ateos
mujeres hombres
mujer hombre
extranjeros refugiados inmigrantes
negros blancos asiáticos árabes
gitanos mexicanos chinos rusos
"""


def grams(text: str) -> np.ndarray:
    """64-bit hashes of a text's distinct n-grams, and others of the dense ones; none without a word of enough letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    is_letter = letters()[points]
    c = np.r_[np.uint64(32), np.where(is_letter, points, 32).astype(np.uint64), np.uint64(32)]
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]
    mix, found = np.uint64(0x9E3779B97F4A7C15), []
    for at in range(0, len(c), STEP):
        part = c[at : at + STEP + max(SIZES) - 1]
        inner = np.cumsum(part == 32)
        h = part * mix
        for n in range(2, max(SIZES) + 1):
            if len(part) < n:
                break
            h = h[:-1] ^ (part[n - 1 :] + np.uint64(n << 32))
            h = h * mix
            h ^= h >> np.uint64(29)
            if n in SIZES:  # no space but at both ends
                found.append(h[:STEP][(inner[n - 2 : len(inner) - 1] == inner[: len(inner) - n + 1])[:STEP]])
    if not found:
        return np.zeros(0, np.uint64)
    h, n = np.unique(np.concatenate(found), return_counts=True)
    dense = h[DENSE * n >= np.count_nonzero(c == 32) - 1]
    dense = (dense ^ np.uint64(0xD1B54A32D192ED03)) * mix
    return np.r_[h, dense ^ (dense >> np.uint64(31))]


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def kinds(lines: str = IDENTITIES) -> dict[str, list[str]]:
    """Each identity term's kind: all terms of its line."""
    return {term: line.split() for line in lines.strip().splitlines() for term in line.split()}


def counterfactual(text: str, terms: dict[str, list[str]], key: int) -> str:
    """The text with each identity term swapped for another of its kind, the same one everywhere; without any, one is put after a word.

    key chooses the terms and the place.
    """
    if not terms:
        return text
    swapped = {}

    def other(m):
        term = m[0].lower()
        if term not in swapped:
            rest = [t for t in terms[term] if t != term]
            swapped[term] = rest[zlib.crc32(f"{key}:{term}".encode()) % len(rest)] if rest else term
        return swapped[term]

    out = re.sub(r"[^\W\d_]+", lambda m: other(m) if m[0].lower() in terms else m[0], text)
    if swapped:
        return out
    all_terms, ends = sorted(terms), [m.end() for m in re.finditer(r"[^\W\d_]+", text)]
    at = ends[key % len(ends)] if ends else 0
    return f"{text[:at]} {all_terms[(key // 7) % len(all_terms)]} {text[at:]}"


@dataclasses.dataclass
class Model:
    """Weights of features, by their 64-bit hashes in ascending order."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    seen: np.ndarray = None  # which buckets have a feature

    def __post_init__(self):
        self.seen = np.zeros(1 << BUCKET_BITS, bool)
        self.seen[buckets(self.features)] = True

    def present(self, text: str) -> np.ndarray:
        """Places, among the features, of those that a text has."""
        h = grams(text)
        h = h[self.seen[buckets(h)]]
        at = np.searchsorted(self.features, h)
        at[at == len(self.features)] = 0
        return at[self.features[at] == h] if len(self.features) else at[:0]

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[self.present(text)].sum(), -30, 30))))


def fit(rows: list[tuple[bool, np.ndarray, np.ndarray]], totals: tuple[float, float], size: int, pull: float = PULL, l2: float = 1e-4,
        steps: int = 500, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias for rows (label, its features, its counterfactual's features), by whole-sample gradient steps (Adam).

    totals are all labelled rows of label 0 and 1: rows are weighted so that
    the sample's labels are as frequent as theirs.
    """
    y = np.array([r[0] for r in rows], float)
    weight = np.where(y == 1, totals[1] / max(y.sum(), 1), totals[0] / max((1 - y).sum(), 1))
    weight /= weight.sum()

    def sparse(lists):
        n = np.array([len(x) for x in lists])
        return np.repeat(np.arange(len(lists)), n), np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)

    row, col = sparse([r[1] for r in rows])
    row_gone, gone = sparse([np.setdiff1d(r[1], r[2], True) for r in rows])
    row_come, come = sparse([np.setdiff1d(r[2], r[1], True) for r in rows])
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)  # the last is the bias
    total = lambda at, which: np.bincount(at, w[which], len(rows))
    for t in range(1, steps + 1):
        z = np.clip(total(row, col) + w[-1], -30, 30)
        g = weight * (1 / (1 + np.exp(-z)) - y)
        change = pull * weight * (total(row_gone, gone) - total(row_come, come))
        slope = np.bincount(col, g[row], size + 1) + np.bincount(gone, change[row_gone], size + 1) - np.bincount(come, change[row_come], size + 1)
        slope = slope + l2 * np.r_[w[:-1], 0.0]
        slope[-1] = g.sum()
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w[:-1], float(w[-1])


def _z(toxic: str, clean: str, totals: tuple[float, float]) -> Column:
    """How far apart a feature's shares of toxic and clean rows are, in standard deviations."""
    n1, n0 = float(totals[1]), float(totals[0])
    share = (F.col(toxic) + F.col(clean)) / (n1 + n0)
    return (F.col(toxic) / n1 - F.col(clean) / n0) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / n1 + 1 / n0))


def train(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          rows_per_class: int = ROWS_PER_CLASS, pull: float = PULL, identities: str = IDENTITIES) -> Model:
    """Learns from docs whose id labels mark with 0 or 1 and for which learnable (a condition on the id) holds.

    An id that is labelled more than once is toxic if any of its rows says so; a
    null label or id teaches nothing, nor does a text without words. The fit
    sees rows_per_class rows of each label at most (those with the smallest
    hashes of their ids), and the driver gets their chosen features only. With
    rows of one label or none, every score is that label.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marked = labels.filter(F.coalesce(learnable, F.lit(False)) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).alias("id")).agg((F.max(F.col(label_col).cast("double")) > 0).alias("label"))
    marked, _ = written(marked.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi"), "labelled")
    number = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    totals = (float(number.get(False, 0)), float(number.get(True, 0)))
    if not all(totals):
        return Model(np.zeros(0, np.uint64), np.zeros(0), 30.0 if totals[1] else -30.0)
    share = F.when(F.col("label"), 2 * rows_per_class / totals[1]).otherwise(2 * rows_per_class / totals[0])
    order = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    near = marked.filter(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 30)) / (1 << 30) <= share)
    chosen = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows_per_class).select("id", "label")
    texts = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")).filter(F.octet_length("text") > 0)
    # At most 2 * rows_per_class ids and labels.
    sample, _ = written(texts.join(F.broadcast(chosen), "id").select(F.xxhash64("id", "text").alias("key"), "label", "text"), "toxicity-sample")

    def counted(pick, name):
        """How many rows of the sample of either label have each bucket or feature."""
        def count(batches):
            sole_memory("toxicity")
            for batch in batches:
                found: tuple[list, list] = ([], [])
                for label, raw in zip(values(batch, "label"), values(batch, "text")):
                    found[label].append(pick(grams(raw.decode("utf-8", "replace"))))
                for label, of in enumerate(found):
                    at, n = np.unique(np.concatenate([*of, np.zeros(0, np.int64)]).astype(np.int64), return_counts=True)
                    none = np.zeros(len(at), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n if label else none), pa.array(none if label else n)], names=[name, "toxic", "clean"])

        rows = sample.select("label", "text").mapInArrow(count, f"{name} long, toxic long, clean long")
        return rows.groupBy(name).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))

    in_sample = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = (max(in_sample.get(False, 0), 1), max(in_sample.get(True, 0), 1))
    wide = counted(lambda h: np.unique(buckets(h)), "bucket").filter(F.abs(_z("toxic", "clean", n)) >= BUCKET_Z)
    mask = np.zeros(1 << BUCKET_BITS, bool)
    mask[wide.select("bucket").toPandas()["bucket"].to_numpy()] = True
    mask = spark.sparkContext.broadcast(mask)
    exact = counted(lambda h: h[mask.value[buckets(h)]].view(np.int64), "feature").filter(
        (F.abs(_z("toxic", "clean", n)) >= FEATURE_Z) & (F.col("toxic") + F.col("clean") >= LEAST_ROWS))
    features = np.sort(exact.select("feature").toPandas()["feature"].to_numpy(np.int64).view(np.uint64))

    model = spark.sparkContext.broadcast(Model(features, np.zeros(len(features)), 0.0))
    terms = kinds(identities)
    schema = pa.schema([("key", pa.int64()), ("label", pa.bool_()), ("own", pa.binary()), ("other", pa.binary())])

    def sparse(batch):
        for key, label, raw in zip(values(batch, "key"), values(batch, "label"), values(batch, "text")):
            text = raw.decode("utf-8", "replace")
            own, other = model.value.present(text), model.value.present(counterfactual(text, terms, key % (1 << 31)))
            yield key, label, own.astype("<i4").tobytes(), other.astype("<i4").tobytes()

    rows = sample.mapInArrow(arrow_rows(schema, sparse, lambda r: len(r[2]) + len(r[3])), "key long, label boolean, own binary, other binary").collect()
    rows = sorted((r["key"], r["label"], bytes(r["own"]), bytes(r["other"])) for r in rows)
    weights, bias = fit([(y, np.frombuffer(own, "<i4"), np.frombuffer(other, "<i4")) for _, y, own, other in rows], totals, len(features), pull)
    return Model(features, weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with the probability that a row is toxic (0 to 1), from its whole text alone; a null text is an empty one.

    An input column of that name is replaced.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = others(docs, name.lower())
    picked = docs.select(F.struct(*kept).alias("row"), F.lit(0.0).alias("score"))

    def run(batches):
        sole_memory("toxicity")
        for batch in batches:
            row = batch.column(batch.schema.get_field_index("row"))
            text = row.field(row.type.get_field_index(text_col))
            yield pa.RecordBatch.from_arrays([row, pa.array([held.value.score(x.as_py() or "") for x in text], pa.float64())], names=["row", "score"])

    return picked.mapInArrow(run, picked.schema).select("row.*", F.col("score").alias(name))
