"""Publish job P1-P5 and customer-count maintenance C1-C2.

Publishing works out, as DataFrames, which mart rows to create or update in
an outside document database: targets (P1) -> rows (P2) -> shaped
properties (P3) -> create/update plan against the existing pages (P4)
-> a status log (P5). Sending the requests is left to the caller.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerlens.functions import columns as X
from partnerlens.operators.merge import delete_from, delete_keys, merge_into, upsert

# Fixed values of the publish job: the sources, their title, filter keys and default filters.
SOURCES = {
    "partner_rankings": {"title": "partner_name", "filters": (), "defaults": {}},
    "partner_summary": {"title": "partner_name", "filters": ("period_type",), "defaults": {"period_type": "all_time"}},
    "partner_penetration": {"title": "partner_name", "filters": (), "defaults": {}},
}
# Limits of the target service, on what is sent.
TEXT_LIMIT = 2000
SELECT_LIMIT = 100
LOG_MESSAGE_LIMIT = 500


@dataclass(frozen=True)
class Target:
    """One row of the target table. ``kinds`` is the target database's own list of properties."""

    id: str
    source_table: str
    database_id: str
    column_map: dict[str, str] = field(default_factory=dict)     # mart column -> target property
    kinds: dict[str, str] = field(default_factory=dict)          # target property -> kind
    filters: dict[str, object] = field(default_factory=dict)
    key_columns: tuple[str, ...] = ()                            # V23: with the title, what identifies a page
    enabled: bool = True

    @property
    def title_column(self) -> str:
        return SOURCES[self.source_table]["title"]

    @property
    def title_property(self) -> str:
        found = [p for p, kind in self.kinds.items() if kind == "title"]
        if not found:
            raise ValueError(f"target {self.id}: its database has no title property")
        return found[0]


TARGET_SCHEMA = ("id string, source_table string, notion_database_id string, filter_json string, "
                 "column_map_json string, kinds_json string, key_columns array<string>, enabled boolean")


def target_from_row(row) -> Target:
    return Target(id=row["id"], source_table=row["source_table"], database_id=row["notion_database_id"],
                  column_map=json.loads(row["column_map_json"] or "{}"), kinds=json.loads(row["kinds_json"] or "{}"),
                  filters=json.loads(row["filter_json"] or "{}"), key_columns=tuple(row["key_columns"] or ()),
                  enabled=bool(row["enabled"]))


def publish_targets(targets: DataFrame) -> DataFrame:
    """Enabled targets, each with whether its source can be published."""
    return targets.filter(F.col("enabled")).withColumn("known_source", F.col("source_table").isin(*SOURCES))


def publish_filters(t: Target) -> dict[str, object]:
    """The target's filters over the source's defaults; a blank one (null, empty text or list) replaces a default by no filter."""
    spec = SOURCES.get(t.source_table)
    if spec is None:
        raise ValueError(f"unknown source table: {t.source_table}")
    both = {**spec["defaults"], **t.filters}
    return {k: v for k, v in both.items() if k in spec["filters"] and v not in (None, "", [])}


def publish_rows(mart: DataFrame, t: Target) -> DataFrame:
    """The mart's rows under the filters: title, mapped columns and key columns."""
    filters = publish_filters(t)
    names = list(dict.fromkeys([t.title_column, *t.column_map, *t.key_columns]))
    if bad := [c for c in names if c not in mart.columns]:
        raise ValueError(f"bad column name: {bad[0]}")
    for k, v in filters.items():
        mart = mart.filter(F.col(k) == F.lit(v))
    return mart.select(*names)


def text_of(c: Column, kind: T.DataType) -> Column:
    """A value as text: decimals as floating numbers, booleans capitalised."""
    if isinstance(kind, T.DecimalType):
        return c.cast("double").cast("string")
    if isinstance(kind, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    return c.cast("string")


def coerce(c: Column, target_kind: str, kind: T.DataType = T.StringType()) -> Column:
    """A value of type ``kind`` as the target property asks; what does not fit a number is null."""
    if target_kind in ("title", "rich_text"):
        return X.text_cut(text_of(c, kind), TEXT_LIMIT)
    if target_kind == "number":
        return c.try_cast("double") if isinstance(kind, (T.StringType, T.NumericType, T.BooleanType)) else F.lit(None).cast("double")
    if target_kind == "checkbox":
        if isinstance(kind, T.BooleanType):
            return c
        return c != 0 if isinstance(kind, T.NumericType) else F.when(c.isNotNull(), c.cast("string") != "")
    if target_kind == "date":
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
            return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(F.concat(whole, F.lit("."), F.date_format(c, "SSSSSS")))
        return c.cast("string")
    if target_kind == "select":
        return X.text_cut(text_of(c, kind), SELECT_LIMIT)
    return X.text_cut(text_of(c, kind), TEXT_LIMIT)


def bare(c: Column) -> Column:
    """A title as pages are matched: the whole text without blanks around it."""
    return F.trim(c.cast("string"), F.lit(" \t\n\r\x0b\x0c"))


def publish_shape(rows: DataFrame, t: Target) -> DataFrame:
    """The target's properties by name (those its database lacks are left out) and, under ``_``, what identifies a page."""
    kind = {f.name: f.dataType for f in rows.schema.fields}
    wanted = {t.title_column: t.title_property, **t.column_map}
    out = [coerce(F.col(c), t.kinds[p], kind[c]).alias(p) for c, p in wanted.items()
           if p in t.kinds and (c != t.title_column or t.kinds[p] == "title")]
    keys = [F.col(k).alias(f"_key_{k}") for k in t.key_columns]
    return rows.filter(F.col(t.title_column).isNotNull()).select(bare(F.col(t.title_column)).alias("_title"), *keys, *out)


def publish_diff(shaped: DataFrame, existing: DataFrame, t: Target) -> DataFrame:
    """Every shaped row as a create or an update of the page that has its whole title and key columns.

    ``existing``: page_id, title and the key columns of the pages there are. Of
    several pages that match, the one with the greatest page_id is updated.
    """
    keys = ["_title", *[f"_key_{k}" for k in t.key_columns]]
    pages = existing.select(bare(F.col("title")).alias("_title"), *[F.col(k).alias(f"_key_{k}") for k in t.key_columns], "page_id")
    pages = pages.filter(F.col("_title") != "").groupBy(*[F.col(k).alias(f"p{k}") for k in keys]).agg(F.max("page_id").alias("page_id"))
    same = [F.col(k).eqNullSafe(F.col(f"p{k}")) for k in keys]
    joined = shaped.join(pages, same, "left")
    action = F.when(F.col("page_id").isNull(), F.lit("create")).otherwise(F.lit("update"))
    return joined.select(F.lit(t.id).alias("target_id"), action.alias("action"), "page_id", *[c for c in shaped.columns if not c.startswith("_")])


def publish_plan(mart: DataFrame, existing: DataFrame, t: Target) -> DataFrame:
    """P2-P4 of one target."""
    return publish_diff(publish_shape(publish_rows(mart, t), t), existing, t)


LOG_SCHEMA = "target_id string, status string, message string, synced_at timestamp_ntz"


def publish_log(spark: SparkSession, results: list[tuple[str, str, str | None]], at: dt.datetime) -> DataFrame:
    """P5: one status row per target: ok / error with the message cut to 500 characters."""
    rows = [(tid, status, (msg or "")[:LOG_MESSAGE_LIMIT] or None, at) for tid, status, msg in results]
    return spark.createDataFrame(rows, LOG_SCHEMA)


STATUS_COLS = {"status": "last_sync_status", "message": "last_sync_message", "synced_at": "last_synced_at"}


def store_status(spark: SparkSession, path: str, log: DataFrame) -> DataFrame:
    """P5: the status of each target merged into the stored targets (key ``id``), whose other columns stay; returns them."""
    status = log.select(F.col("target_id").alias("id"), *[F.col(c).alias(name) for c, name in STATUS_COLS.items()])
    return merge_into(spark, path, status, ["id"])


def run_publish(spark: SparkSession, marts: dict[str, DataFrame], targets: list[Target], existing: dict[str, DataFrame],
                send: Callable[[Target, DataFrame], None], at: dt.datetime) -> DataFrame:
    """Plans each enabled target and hands its plan to ``send``, which runs it (writes it, or sends the requests).

    What fails while a target is planned or its plan runs is that target's
    status; the others go on. Returns the log, one row per enabled target.
    """
    results = []
    for t in sorted((t for t in targets if t.enabled), key=lambda t: (t.source_table, t.id)):
        try:
            if t.source_table not in SOURCES:
                raise ValueError(f"unknown source table: {t.source_table}")
            plan = publish_plan(marts[t.source_table], existing[t.id], t)
            send(t, plan)
            n = {r["action"]: r["count"] for r in plan.groupBy("action").count().collect()}
            created, updated = n.get("create", 0), n.get("update", 0)
            results.append((t.id, "ok", f"{created + updated} rows: {created} created, {updated} updated"))
        except Exception as e:  # noqa: BLE001 - recorded in the log, other targets continue
            results.append((t.id, "error", str(e)))
    return publish_log(spark, results, at)


# ------------------------------------------------------- customer counts

COUNT_KEYS = ["partner_id", "as_of_date"]


def checked_counts(rows: DataFrame) -> DataFrame:
    """C1 validation: rows with the trimmed id and ``reason``, null where a row is accepted."""
    pid, count = F.trim("partner_id"), F.col("total_customer_count")
    reason = (F.when(F.coalesce(F.length(pid), F.lit(0)) == 0, "partner_id is missing").when(F.length(pid) > 64, "partner_id is over 64 characters")
              .when(F.col("as_of_date").isNull(), "as_of_date is missing").when(count.isNull(), "total_customer_count is missing")
              .when(count < 0, "total_customer_count is negative").when(F.length("notes") > 500, "notes are over 500 characters"))
    return rows.withColumn("partner_id", pid).withColumn("reason", reason)


def valid_counts(rows: DataFrame) -> DataFrame:
    """The accepted rows."""
    return checked_counts(rows).filter(F.col("reason").isNull()).drop("reason")


def rejected_counts(rows: DataFrame) -> DataFrame:
    """The rows that are sent back, each with its reason."""
    return checked_counts(rows).filter(F.col("reason").isNotNull())


def upsert_counts(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Accepted rows upserted on (partner_id, as_of_date); see rejected_counts for the others."""
    return upsert(target, valid_counts(rows), COUNT_KEYS)


def store_counts(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """C1 against the stored counts: accepted rows are merged in; returns the counts."""
    return merge_into(spark, path, valid_counts(rows), COUNT_KEYS)


def unstore_counts(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame | None:
    """C2 against the stored counts: rows of these keys are removed; returns the counts."""
    return delete_from(spark, path, keys, COUNT_KEYS)


def delete_counts(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Delete count rows by (partner_id, as_of_date)."""
    return delete_keys(target, keys, COUNT_KEYS)
