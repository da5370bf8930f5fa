import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session")
def docs(spark):
    """A function that makes a documents table of (doc_id, text) rows, with further columns whose names operators use themselves."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t) for i, t in rows], DOC).repartition(3)
        clash = ("id", "row", "key", "token_ids", "n_tokens", "n_lines", "spans", "items", "score", "print", "bits", "Host", "rep", "start")
        return df.withColumns({c: F.lit("clash") for c in clash}) if extra else df

    return make


#: Texts that every operator must take: null, empty, blanks, no letters, one long word, repeated rows and a null id.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "12 34 !!"), (5, "x" * 30000), (6, "one two three four five six"), (6, "one two three four five six"),
       (None, "a text without an id, which is some words long"), (7, "Ünïcode ß 中文 😀 é İ\r\nline\x00two\x1c"), (8, "one two three four five six"), (9, "word " * 9000)]


@pytest.fixture
def odd():
    return list(ODD)
