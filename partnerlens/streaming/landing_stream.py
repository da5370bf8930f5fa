"""Streaming front for landing (A4 + L1-L12 + A8) with Structured Streaming.

Files that arrive in dump folders are read with ``readStream``; each
micro-batch is landed with the functions of the landing run and merged into
the raw tables, which are the same as the landing run's. A stream reads a group
of dump kinds, all those that feed its tables, so that each table has one
writer: the five engagement kinds go into one table, and contacts and
submissions are one group, as a contact that lands fills in the submissions
that came before it. Merging is by key and version, so a micro-batch that runs
again after a failure changes nothing. The raw tables hold the state; the
stream's progress is in the checkpoint location that the caller names, and a
stream started there again goes on where the last one ended.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from partnerlens.plans.landing_run import land, store, store_submissions
from partnerlens.sources import landing as L

# Groups of dump kinds, and the raw tables that each group feeds.
GROUPS = {
    "owners": (("owners",), ("owner",)),
    "contacts": (("contacts", "submissions"), ("contact", "contact_form")),
    "deals": (("deals",), ("deal", "deal_stage_history", "deal_contact")),
    "engagements": (tuple(L.ENGAGEMENT_TYPES), ("engagement", "engagement_contact")),
    "forms": (("forms",), ("form",)),
}


def _shape(kind: str) -> str:
    return L.KINDS.get(kind, "object")


def land_batch(spark: SparkSession, batch: DataFrame, group: str, root: str, at: dt.datetime) -> None:
    """Lands one micro-batch (kind, and one struct for each shape of object) into the raw tables of its group under root."""
    objects = lambda kind: batch.filter(F.col("kind") == kind).select(f"{_shape(kind)}.*")
    for table in GROUPS[group][1]:
        rows = land(table, objects, at)
        if table == "contact_form":
            store_submissions(spark, root, rows)
        else:
            store(spark, root, table, rows)


def arriving(spark: SparkSession, dump_root: str, group: str) -> DataFrame:
    """The objects of a group as one stream. A kind's folder that is not there yet is made: a stream's sources cannot change later."""
    shapes = sorted({_shape(kind) for kind in GROUPS[group][0]})
    streams = []
    for kind in GROUPS[group][0]:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{dump_root}/{kind}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
        schema = L.DUMP_SCHEMAS[_shape(kind)]
        objects = spark.readStream.schema(schema).json(f"{dump_root}/{kind}")
        streams.append(objects.select(F.lit(kind).alias("kind"), *[
            (F.struct("*") if s == _shape(kind) else F.lit(None).cast(L.DUMP_SCHEMAS[s])).alias(s) for s in shapes]))
    return reduce(DataFrame.unionByName, streams)


def start_landing_stream(spark: SparkSession, dump_root: str, target_root: str, checkpoint: str, group: str = "contacts",
                         available_now: bool = False, processing_time: str = "30 minutes", loaded_at: dt.datetime | None = None) -> StreamingQuery:
    """Starts the stream of one group of dump kinds; ``checkpoint`` is its stable progress folder, in a store that all executors share.

    ``available_now`` processes what is there and stops (a scheduled refresh);
    otherwise it triggers every ``processing_time`` (the pipeline's 30-minute cadence).
    """
    def each(batch: DataFrame, _: int) -> None:
        at = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        batch.persist()  # several tables come from it; what is lost with an executor is read again
        land_batch(batch.sparkSession, batch, group, target_root, at)
        batch.unpersist()

    writer = arriving(spark, dump_root, group).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
