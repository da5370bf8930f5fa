"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and all 1- to
3-grams of the whole text are counted in hashed buckets. Document frequencies
are counted over all rows that may be learned from. The classifier is fitted
on a bounded sample of labelled rows (ROWS_PER_LANG of each language, those
with the smallest hashes of their ids) by follow-the-regularised-leader with
L1 and L2 penalties, one row after another; a part of the sample is set aside
to choose the temperature of its probabilities. Prediction reads every whole
text, in tasks that hold the weights: buckets times languages, 4 bytes each.
"""

from __future__ import annotations

import dataclasses
import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerlens.llm.common import arrow_rows, others, small_batches, sole_memory, utf8, values, written

BUCKETS = 1 << 16
#: Sample of labelled rows for the fit: at most so many of each language.
ROWS_PER_LANG = 600
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's character n-grams, ascending, and how often each occurs; none without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    is_letter = letters()[points]
    if not is_letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.r_[np.uint64(32), np.where(is_letter, points, 32).astype(np.uint64), np.uint64(32)]
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]
    mix = np.uint64(0x9E3779B97F4A7C15)
    one = c * mix
    two = (one[:-1] ^ (c[1:] + np.uint64(0x51ED27))) * mix
    three = (two[:-1] ^ (c[2:] + np.uint64(0xA3F1))) * mix
    hashed = np.concatenate([one, two, three]) >> np.uint64(48)
    found = np.bincount(hashed.astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(found)
    return at, found[at]


@dataclasses.dataclass
class Model:
    """Weights by bucket and language, with what turns counts into features and scores into probabilities."""

    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = (1 + np.log(n)) * self.idf[at]
        return x / max(np.sqrt(x @ x), 1e-12)

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.features(at, n) @ self.weights[at] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        """The likeliest language and its probability; UNKNOWN and 0 for a text without a letter or where nothing was learned."""
        at, n = counts(text)
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(at, n) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, bool, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.01, seed: int = 7) -> Model:
    """Fits rows (language, whether set aside for the temperature, buckets, counts).

    Per-coordinate follow-the-regularised-leader: each weight is the minimum of
    its gathered gradients, squared distances to its former values and both
    penalties; it stays 0 while its gradients stay within l1.
    """
    langs = sorted({lang for lang, *_ in rows})
    model = Model(langs, idf, np.zeros((BUCKETS, len(langs))), np.zeros(len(langs)))
    if not langs:
        return model
    learn = [r for r in rows if not r[1]] or rows
    z, n = np.zeros((BUCKETS + 1, len(langs))), np.zeros((BUCKETS + 1, len(langs)))  # the last row is the bias

    def weights(at):
        w = (np.sign(z[at]) * l1 - z[at]) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    data = [(np.r_[at, BUCKETS], np.r_[model.features(at, c), 0.2], langs.index(lang)) for lang, _, at, c in learn]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(data)):
            at, x, y = data[k]
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            n_new = n[at] + g * g
            z[at] += g - (np.sqrt(n_new) - np.sqrt(n[at])) / alpha * w
            n[at] = n_new
    w = weights(np.arange(BUCKETS + 1))
    model.weights, model.bias = w[:-1].astype(np.float32), 0.2 * w[-1]

    aside = [r for r in rows if r[1]] or rows
    logits, y = np.array([model.logits(at, c) for _, _, at, c in aside]), np.array([langs.index(lang) for lang, *_ in aside])
    loss = lambda t: -np.mean(np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12))
    model.temperature = float(min(np.geomspace(0.02, 20, 200), key=loss))
    return model


def train(docs: DataFrame, learnable: Column, aside: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_per_lang: int = ROWS_PER_LANG) -> Model:
    """Learns from the text and non-null language of the rows where learnable holds; aside picks those that set the temperature.

    Rows without a letter teach nothing. The driver gets rows_per_lang rows of
    each language at most, as bucket counts, and one number for each bucket.
    """
    ours = docs.filter(F.coalesce(learnable, F.lit(False)) & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), utf8(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(aside, F.lit(False)).alias("aside"))

    small_batches(docs.sparkSession)

    # Document frequencies over all these rows: each task sums its own, then Spark sums by bucket.
    def frequencies(batches):
        sole_memory("langid")
        n, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for raw in values(batch, "text"):
                at, _ = counts(raw.decode("utf-8", "replace"))
                n[at] += 1
                total += len(at) > 0
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, BUCKETS]), pa.array(np.r_[n[at], total])], names=["bucket", "n"])

    found = ours.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS + 1)
    df[found["bucket"].to_numpy()] = found["n"].to_numpy()
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1

    schema = pa.schema([("lang", pa.string()), ("aside", pa.bool_()), ("at", pa.binary()), ("n", pa.binary())])

    def counted(batch):
        for lang, a, raw in zip(values(batch, "lang"), values(batch, "aside"), values(batch, "text")):
            at, n = counts(raw.decode("utf-8", "replace"))
            if len(at):
                yield lang, a, at.astype("<u2").tobytes(), n.astype("<u4").tobytes()

    # Texts of twice the rows asked for are shuffled, by their ids' hashes; rows without an id have one hash.
    # The list of languages is written, so that its size is known before the texts are moved.
    number, _ = written(ours.groupBy(F.col("lang").alias("l")).agg(F.count("*").alias("total")), "languages")
    near = ours.join(number, F.col("lang") == F.col("l")).filter(
        F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) / (1 << 30) * F.col("total") <= 2 * rows_per_lang)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    sample = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows_per_lang).select("lang", "aside", "text")
    rows = sample.mapInArrow(arrow_rows(schema, counted, lambda r: len(r[2]) + len(r[3])), "lang string, aside boolean, at binary, n binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"])))
    return fit([(r["lang"], r["aside"], np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["n"], "<u4").astype(np.float64)) for r in rows], idf)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred (a learned language, or `und` for a null text or one without a letter) and score (0 to 1).

    Only the text is an input. Every row is predicted; input columns with the
    two names are replaced.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = others(docs, "lang_pred", "score")
    picked = docs.select(F.struct(*kept).alias("row"), F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches):
        sole_memory("langid")
        for batch in batches:
            row = batch.column(batch.schema.get_field_index("row"))
            text = row.field(row.type.get_field_index(text_col))
            found = [held.value.predict(x.as_py() or "") for x in text]
            yield pa.RecordBatch.from_arrays([row, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             names=["row", "lang_pred", "score"])

    return picked.mapInArrow(run, picked.schema).select("row.*", "lang_pred", "score")
