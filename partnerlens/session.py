"""Session setup shared by the library, the tests and the bench."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine's results depend on; applied to any session it is handed.
_RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Form values: the last duplicate name wins, as in the landing loader.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Execution settings that only change speed, never results.
_EXEC_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Sizes that the session's settings are lowered to, where they are higher. Spark judges both by compressed bytes. By its
# own threshold of 10 MB some 700,000 keys were broadcast as a hash table of 150 MB, several at once in the driver; and
# partitions of its 64 MB took a task 1 GB to sort. Bounded so, a driver and a task need the same for any input.
BROADCAST_BYTES = 256 << 10
PARTITION_BYTES = 16 << 20
_AT_MOST = {
    "spark.sql.autoBroadcastJoinThreshold": BROADCAST_BYTES,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_BYTES,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": PARTITION_BYTES,
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; fill in a checkpoint dir if unset."""
    for k, v in {**_RESULT_CONF, **_EXEC_CONF}.items():
        spark.conf.set(k, v)
    bound_sizes(spark)
    ensure_checkpoint_dir(spark)
    return spark


def bound_sizes(spark: SparkSession) -> None:
    """Lowers broadcasts and shuffle partitions to _AT_MOST; what is lower, or off (-1), or falls back on another setting, stays."""
    for name, most in _AT_MOST.items():
        given = spark.conf.get(name, None) or (None if name.endswith("adaptive.autoBroadcastJoinThreshold") else spark.conf.get(name))
        if given is not None and _bytes(given) > most:
            spark.conf.set(name, str(most))


def _bytes(size: str) -> int:
    """A size of Spark's settings, as 64m or 10485760b."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a folder of its own; any other
    master is refused, as executors could not see a machine-local folder.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="partnerlens-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder; it goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/partnerlens-{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a path made by new_path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def let_go(spark: SparkSession) -> None:
    """Lets the driver give back what nothing refers to any more (plans, broadcasts, shuffle files), rather than when its heap is full.

    A full collection also returns the heap's free pages, so the driver does not
    grow with the number of queries it has planned or their tasks. Spark's event
    queues hold the last query that ended until another one does: a small one.
    """
    spark.sql("select 1").collect()
    gc.collect()
    spark._jvm.System.gc()


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "partnerlens") -> SparkSession:
    master = master or os.environ.get("PARTNERLENS_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PARTNERLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions or master.startswith("local"):  # a cluster's own setting stays
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    for k, v in {**_RESULT_CONF, **_EXEC_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)
