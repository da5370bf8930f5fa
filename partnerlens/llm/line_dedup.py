"""Line dedup with DataFrame functions only.

Lines are exploded, normalised and hashed; the distinct documents of each hash
are counted; lines whose key many documents hold go, except in the largest
document id that holds it; the others are put together again by position.

A very frequent line is no hot spot: (key, document) pairs are spread by both
before keys are counted, and counts are summed before they are shuffled. The keys to
drop are written, so that their size is known: a small list is broadcast by
Spark itself, and for a large one both sides of the join are shuffled anew,
where adaptive execution splits the rows of one frequent key.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import others, written

#: What the ends of a line lose.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased (other letters stay)."""
    bare = F.trim(line, F.lit(BLANKS))
    ascii_only = F.char_length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def drop_repeated_lines(docs: DataFrame, min_chars: int, min_docs: int, id_col: str = "doc_id", text_col: str = "text",
                        n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """docs with text_col without its repeated lines, and two more columns: its lines before, and how many went.

    A key counts if it has min_chars code points or more and min_docs or more
    distinct ids hold it; the lines stay in the largest such id. A null or
    empty text is one empty line. Rows that share an id count as one document,
    but each row keeps its own text; a null id counts as no document, and its
    lines go where the others' do. Input columns named n_lines or n_dropped
    are replaced.
    """
    spread = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spread = spread.withColumn("print", F.xxhash64("text"))

    # Long enough lines, by row (id and fingerprint of its text) and position.
    lines = spread.select("id", "print", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.filter(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    lines = lines.filter(F.char_length("key") >= min_chars)
    lines = lines.select("id", "print", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))

    hot = lines.groupBy("k1", "k2").agg(F.count_distinct("id").alias("n"), F.max("id").alias("last"))
    hot, _ = written(hot.filter(F.col("n") >= min_docs).select("k1", "k2", "last"), "hot-lines")

    gone = lines.join(hot, ["k1", "k2"]).filter(~F.col("id").eqNullSafe(F.col("last")))
    gone = gone.groupBy("id", "print").agg(F.collect_set("pos").alias("gone"))
    gone = gone.select(F.col("id").alias("gone_id"), F.col("print").alias("gone_print"), "gone")

    both = spread.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("print") == F.col("gone_print")), "left")
    both = both.withColumn("lines", F.split("text", "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda p: F.col("lines")[p]), "\n"))
    new = {text_col: text, n_lines: F.size("lines").cast("long"), n_dropped: F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")}
    old = others(docs, n_lines.lower(), n_dropped.lower())
    return both.select(*[new[c].alias(c) if c == text_col else F.col("row")[c].alias(c) for c in old],
                       new[n_lines].alias(n_lines), new[n_dropped].alias(n_dropped))
