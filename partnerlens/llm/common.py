"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import itertools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Batches between Spark and Python have at most about so many bytes (or one row), and so many rows.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000

#: Entries that a worker's memory of words or pairs holds at most (and one text's more).
REMEMBERED = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder, read by Spark (any store that Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local master gets a folder of its own; any other
    master is refused, as a machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is unused; it goes when the application ends."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(where)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a path made by new_path, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes df as Parquet in the shared folder and reads it again: cuts lineage; survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def let_go(spark: SparkSession) -> None:
    """Lets the driver drop shuffle files that nothing refers to any more, rather than whenever it collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def utf8(col: str | Column) -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("binary"), F.lit(b""))


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows and BATCH_BYTES, so that few long texts are in memory at once."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(re.sub(r"\D", "", spark.conf.get(name))) <= most:
            spark.conf.set(name, str(most))


def arrow_rows(schema: pa.Schema, rows: Callable[[pa.RecordBatch], Iterator[tuple]], size: Callable[[tuple], int] = lambda _: 64):
    """A function for mapInArrow: each batch gives row tuples, which leave in batches of bounded size."""
    small_batches(SparkSession.active())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # a worker that is used again gives back what earlier batches took
        kept: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            columns = zip(*kept) if kept else [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for row in rows(batch):
                kept.append(row)
                held += size(row)
                if held >= BATCH_BYTES or len(kept) >= 10_000:
                    yield out()
                    kept, held = [], 0
        if kept:
            yield out()

    return run


def values(batch: pa.RecordBatch, name: str) -> Iterator:
    """The values of a column one after another; a long text is not copied before its turn."""
    return (v.as_py() for v in batch.column(batch.schema.get_field_index(name)))


_memory: list = [None, ()]


def sole_memory(owner: str, *memories: dict) -> None:
    """Lets a worker keep the memories of one operator at a time: those of another one are emptied."""
    if _memory[0] != owner:
        for m in _memory[1]:
            m.clear()
        _memory[:] = owner, memories


def forget(known: dict, most: int = REMEMBERED) -> None:
    """Drops the newer half of a full memory: what came early is what is frequent."""
    if len(known) >= most:
        for k in list(itertools.islice(reversed(known), len(known) // 2)):
            del known[k]


def others(df: DataFrame, *names: str) -> list[str]:
    """The columns of df but those of these names, in any case of letters."""
    return [c for c in df.columns if c.lower() not in names]


def own_ids(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """rows (id, text, ...) with an id that stands for one text, and what it stands for (node, true_id).

    Where no id has several texts (by 64-bit hash), rows stay as they are and
    the second is None. Else each distinct id and text (by 128 bits) gets a
    number; numbers ascend with the ids. Repeated rows share theirs. A null id
    stays null.
    """
    prints = [F.xxhash64("text").alias("print1"), F.xxhash64(F.lit(1), "text").alias("print2")]
    known = rows.filter("id is not null").select("id", *prints)
    if known.groupBy("id").agg(F.min("print1").alias("low"), F.max("print1").alias("high")).filter("low <> high").isEmpty():
        return rows, None
    order = ["true_id", "print1", "print2"]
    ranged = known.withColumnRenamed("id", "true_id").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    nodes, _ = written(ranged.withColumn("node", F.monotonically_increasing_id()), "own-ids")
    keyed = rows.select("*", *prints)
    same = (F.col("id") == F.col("true_id")) & (keyed["print1"] == nodes["print1"]) & (keyed["print2"] == nodes["print2"])
    return keyed.join(nodes, same, "left").select(F.col("node").alias("id"), *[c for c in rows.columns if c != "id"]), nodes.select("node", "true_id")
