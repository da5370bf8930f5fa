"""Keyed merges: A8 upsert, A9 archived pass, A11 incremental mart merge, C2
keyed delete, and stored tables that they change in place.

A stored table is a Parquet folder, partitioned by a column of its own (a
month) or by hash buckets of its key. Each key stands in it once, so that
reading is a plain scan. A merge or delete finds the partitions that hold or
will hold one of its keys, reads those, and writes them anew with Spark's
dynamic partition overwrite, which replaces a partition only when the whole
job has succeeded. The same changes merged again give the same table. One
writer at a time may change a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerlens.session import drop_path, new_path


#: What rows of one key and version are ordered by, where it was worked out before columns were dropped.
TIE = "_tie"


def _hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(c).cast("string") for c in columns])


def latest_per_key(rows: DataFrame, keys: list[str], seq: Column | str | None = None) -> DataFrame:
    """Last write wins among duplicate keys: the row with the greatest ``seq``.

    A null ``seq`` comes before all others; rows of one key and ``seq`` are
    ordered by a hash of all their columns (or by ``TIE``, which rows may carry),
    so the same rows always give the same row. The aggregation is partial before the shuffle: a key that is
    repeated many times never gathers its rows in one task.
    """
    others = [c for c in rows.columns if c not in (*keys, TIE)]
    if not others:
        return rows.distinct()
    seq_col = F.lit(None) if seq is None else F.col(seq) if isinstance(seq, str) else seq
    order = [seq_col.isNotNull(), seq_col] if seq is not None else []
    order.append(F.col(TIE) if TIE in rows.columns else _hash(others))
    packed = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return packed.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def complete(changes: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Changes with the columns that only the target has: as the target's row of that key has them, null for a new key."""
    more = [c for c in target.columns if c not in changes.columns]
    if not more:
        return changes
    return changes.join(target.select(*keys, *more), keys, "left")


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], seq: Column | str | None = None, once: bool = False) -> DataFrame:
    """Keyed upsert; new keys are inserted, of existing keys the given columns are replaced, last write wins.

    Columns that only the target has keep their values; columns that only the
    changes have are null in the target's other rows (A7). ``once``: the changes
    have each key once.
    """
    changes = complete(rows if once else latest_per_key(rows, keys, seq), target, keys)
    kept = target.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def with_archived(live: DataFrame, archived: DataFrame) -> DataFrame:
    """The archived pass lands the same shape with ``_archived = true`` after the live pass."""
    return live.withColumn("_archived", F.lit(False)).unionByName(archived.withColumn("_archived", F.lit(True)))


def merge_mart(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Merge the look-back slice of a mart into the stored mart on its unique key.

    Rows that no longer qualify are not deleted (as in the original incremental
    models); run a full refresh to drop them.
    """
    return upsert(target, new, [key])


def delete_keys(target: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    """Remove rows by key (anti-join)."""
    return target.join(keys_df.select(*keys).distinct(), keys, "left_anti")


# ------------------------------------------------------------- stored tables

BUCKET = "_bucket_of_"
#: The version of a stored row, where changes are given with one; readers do not see it.
SEQ = "_seq"
#: Buckets of a table that has no partition column of its own; a stored table keeps the number it was made with.
BUCKETS = 16
#: Stored bytes that a task of a merge sorts, about; the shuffle has some five times as many.
TASK_BYTES = 4 << 20


def _scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """All columns of a stored table, also hidden ones; None where there is none yet. With ``schema`` its files' own are not read."""
    try:
        if schema is not None:
            return spark.read.schema(schema).parquet(path)
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _partition(columns: list[str], by: str | None) -> str:
    return by or next(c for c in columns if c.startswith(BUCKET))


def _placed(rows: DataFrame, keys: list[str], part: str) -> DataFrame:
    """rows with the partition column, which is one of their own or a bucket."""
    if not part.startswith(BUCKET):
        return rows
    return rows.withColumn(part, F.pmod(_hash(keys), F.lit(int(part[len(BUCKET):]))).cast("int"))


def _settled(old: DataFrame | None, new: DataFrame, keys: list[str], part: str, versioned: bool, once: bool) -> DataFrame:
    """old and new rows of buckets as a merge leaves them, each task with rows of one bucket; they are dealt and sorted once.

    New rows of a key may be several where not ``once``, but few: the latest
    counts, as in :func:`latest_per_key`, and then as in :func:`merge_into`. A
    key with a null is none that is known already.
    """
    buckets = int(part[len(BUCKET):])
    size = sum(int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for rows in (old, new) if rows is not None)
    tasks = min(max(size // (buckets * TASK_BYTES) + 1, 1), 512)  # of a bucket
    others = [c for c in new.columns if c not in (*keys, part)]
    rows = new.withColumns({"_new": F.lit(True), TIE: F.lit(0) if once or not others else _hash(others)})
    if old is not None:
        rows = rows.unionByName(old.withColumns({"_new": F.lit(False), TIE: F.lit(0)}))
    rows = rows.withColumn("_task", (F.col(part) * tasks + F.pmod(F.shiftright(_hash(keys), 8), F.lit(tasks))).cast("int")).repartitionById(buckets * tasks, F.col("_task"))
    order = [F.col("_new").desc(), *([F.col(SEQ).desc_nulls_last()] if versioned else []), F.col(TIE).desc()]
    each = Window.partitionBy(part, "_task", *keys).orderBy(*order)
    rows = rows.withColumn("_nth", F.row_number().over(each))
    if old is None:
        return rows.filter("_nth = 1").select(*new.columns)
    group = each.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wins = F.first("_new").over(group)
    if versioned:
        given, known = F.first(SEQ).over(group), F.max(F.when(~F.col("_new"), F.col(SEQ))).over(group)
        wins = wins & (given.isNull() | known.isNull() | (given >= known))
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(k).isNull()
    rows = rows.withColumn("_wins", wins)
    kept = F.when(F.col("_new"), (F.col("_nth") == 1) & (unknown | F.col("_wins"))).otherwise(unknown | ~F.col("_wins"))
    return rows.filter(kept).select(*old.columns)


def _write(rows: DataFrame, path: str, part: str, mode: str, dealt: bool = False) -> None:
    """Writes partitions whole; rows are dealt by partition into files of a good size, however many tasks and partitions there are.

    A small table is written by as many tasks as the cluster has, too, as it
    is the number of files that takes the time there. ``dealt``: a task has
    rows of few partitions already.
    """
    if dealt:
        return rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(part).parquet(path)
    spark, least = rows.sparkSession, "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(least, None)
    spark.conf.set(least, "16k")
    try:
        rows.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(part).parquet(path)
    finally:
        spark.conf.unset(least) if before is None else spark.conf.set(least, before)


def visible(rows: DataFrame) -> DataFrame:
    return rows.drop(*[c for c in rows.columns if c == SEQ or c.startswith(BUCKET)])


def write_keyed(rows: DataFrame, path: str, keys: list[str], by: str | None = None, buckets: int = BUCKETS, seq: Column | None = None) -> None:
    """Writes a stored table anew, partitioned by the column ``by`` or by buckets of the key; rows have each key once."""
    part = by or f"{BUCKET}{buckets}"
    _write(_placed(rows if seq is None else rows.withColumn(SEQ, seq), keys, part), path, part, "static")


def read_keyed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A stored table as it stands: a scan; with ``schema``, which spares reading the files' own, of these columns. None where there is no table."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    rows = _scan(spark, path)
    return None if rows is None else visible(rows)


def _same(part: str, values: list) -> Column:
    """Whether a row is in one of these partitions."""
    known = [v for v in values if v is not None]
    found = F.col(part).isin(known) if known else F.lit(False)
    return found | F.col(part).isNull() if len(known) < len(values) else found


def _replace(spark: SparkSession, path: str, rows: DataFrame, part: str, lose: list, stored: DataFrame) -> None:
    """Writes the partitions of rows anew; of those that may ``lose`` their last row, the ones that did (and so were not written) go."""
    before = set(stored.inputFiles()) if lose else set()
    _write(rows, path, part, "dynamic")
    same = before & set(spark.read.schema("_ int").parquet(path).inputFiles()) if lose else set()
    for value in lose:
        folder = f"{part}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
        if any(f"/{folder}/" in f for f in same):
            drop_path(spark, f"{path}/{folder}")


def merge_into(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], seq: Column | None = None, by: str | None = None,
               buckets: int = BUCKETS, ready: bool = False, schema: T.StructType | None = None, once: bool = False, few: bool = False,
               cheap: bool = False) -> DataFrame:
    """A8 and A11 against a stored table: new keys are inserted, of known ones the given columns replaced; returns the table.

    With ``seq``, a version that is older than the stored one changes nothing; of
    equal ones the given one wins, as it does where a version is not known.
    Only partitions that hold a changed key, or will, are read and written.
    ``ready`` says that rows have each key once and are a stored table
    themselves, so that they need not be sorted out and staged; ``once`` only
    that they have each key once, ``few`` that no key comes many times, and
    ``cheap`` that they need not be staged; ``schema`` is the stored table's,
    where that is known.
    """
    changes = rows if seq is None else rows.withColumn(SEQ, seq)
    stored = _scan(spark, path, schema)
    part = f"{BUCKET}{buckets}" if stored is None and not by else _partition(stored.columns if stored is not None else [], by)
    settles = not by and (stored is None or {*stored.columns} == {*changes.columns, part})
    few = few and settles
    if not once and not few and not (ready and seq is None):
        changes = latest_per_key(changes, keys, None if seq is None else SEQ)
    changes = _placed(changes, keys, part)
    if stored is None:
        _write(_settled(None, changes, keys, part, seq is not None, once) if few else changes, path, part, "static", few)
        return read_keyed(spark, path, schema)
    held, drop = (changes, lambda: None) if ready or cheap and settles else staged(spark, changes)
    touched = held.select(part)
    if by:  # the stored row of a key can be in another partition
        touched = touched.union(stored.join(held.select(*keys), keys, "left_semi").select(part))
    touched = [r[0] for r in touched.distinct().collect()]
    if touched:
        old = stored.filter(_same(part, touched))
        new = held
        if settles:
            _write(_settled(old, new, keys, part, seq is not None, once or not few), path, part, "dynamic", True)
        else:
            if seq is not None and SEQ in stored.columns:
                before = old.select(*keys, F.col(SEQ).alias("_before"))
                new = held.join(before, keys, "left").filter("_before is null or _seq is null or _seq >= _before").drop("_before")
            _replace(spark, path, upsert(old, new, keys, once=True), part, touched if by else [], stored)
    drop()
    return read_keyed(spark, path, schema)


def delete_from(spark: SparkSession, path: str, keys_df: DataFrame, keys: list[str], by: str | None = None) -> DataFrame | None:
    """C2 against a stored table: removes the rows of these keys; returns the table. Only partitions that hold one are written."""
    stored = _scan(spark, path)
    if stored is None:
        return None
    part = _partition(stored.columns, by)
    gone, drop = staged(spark, _placed(keys_df.select(*keys).distinct(), keys, part))
    touched = [r[0] for r in (stored.join(gone.select(*keys), keys, "left_semi") if by else gone).select(part).distinct().collect()]
    if touched:
        _replace(spark, path, stored.filter(_same(part, touched)).join(gone.select(*keys), keys, "left_anti"), part, touched, stored)
    drop()
    return read_keyed(spark, path)


def staged(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """Changes as a table in the shared folder, as they are read more than once, and what deletes it."""
    path = new_path(spark, "changes")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), lambda: drop_path(spark, path)
