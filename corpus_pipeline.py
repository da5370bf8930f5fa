"""The corpus pipeline: stages over the documents table, each written and read by the next.

A stage takes (spark, docs, sf_dir), with docs as its predecessor left them,
and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partnerlens.llm import byte_bpe, decontaminate, langid, line_dedup, minhash
from partnerlens.llm.common import drop_path, table, written
from partnerlens.llm.queries import fold

#: A text whose likeliest language is less probable than this is in none of the known languages.
LEAST_SCORE = 0.5


def _apart(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns of these names (in any case of letters) under others, and how to name them back: a stage's own columns replace none."""
    other = {c: f"_own_{k}_{c}" for k, c in enumerate(docs.columns) if c.lower() in names}
    return docs.withColumnsRenamed(other), {new: old for old, new in other.items()}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rows without a letter, or without a language of at least LEAST_SCORE, go.

    Learns from the labelled rows that are not held out. Where none is
    labelled, nothing can be rejected but what has no letter.
    """
    model = langid.train(docs, learnable=fold() != 2, aside=fold() == 3)
    rows, back = _apart(docs, "lang_pred", "score")
    found = langid.predict(rows, model)
    known = F.col("lang_pred") != langid.UNKNOWN if model.langs else F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.filter(known & (F.col("score") >= (LEAST_SCORE if model.langs else 0))) \
        .drop("lang_pred", "score").withColumnsRenamed(back).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: every row loses its lines that at least 5 documents hold; n_chars follows the text."""
    rows, back = _apart(docs, "n_lines", "n_dropped")
    kept = line_dedup.drop_repeated_lines(rows, min_chars=40, min_docs=5).drop("n_lines", "n_dropped").withColumnsRenamed(back)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of near copies the row of the smallest id stays, once; rows without an id stay.

    Rows that share an id but not a text are documents of their own here.
    """
    return minhash.one_of_each(docs, size=5, percent=75)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows of which windows of 13 benchmark words cover one word in twenty or more go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=13)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: each row's token ids, packed, their number, and digests of the ids and of the bytes they decode to."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = byte_bpe.round_trip(docs, ranks, pattern)
    return both.select("doc_id", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"), "token_ids",
                       F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash", near_duplicates),
    ("decontaminate", benchmark),
    ("byte_bpe", tokens),
]

#: SQL expresses neither the trained classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet in the shared folder and read again."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, new = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if path:
            drop_path(spark, path)
        path = new
    return docs
