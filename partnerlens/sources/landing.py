"""Landing transforms L1-L12 and the object scans A4-A6.

CRM objects arrive as nested records (one JSON object per record, as the
CRM's API returns them): ``{id, properties: map, propertiesWithHistory:
{dealstage: [{value, timestamp}]}, associations: {contacts: {results:
[{id}]}}}`` and form submissions ``{conversionId, submittedAt, pageUrl,
values: [{name, value}]}``. These functions flatten them to the raw tables
with column expressions, ``explode`` / ``posexplode`` and windows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerlens.functions import columns as X
from partnerlens.operators.merge import SEQ, TIE, latest_per_key
from partnerlens.sources.tables import CONTACT_PROPERTIES, DEAL_PROPERTIES

S = T.StringType()
HISTORY_ENTRY = T.StructType([T.StructField("value", S), T.StructField("timestamp", S)])
ASSOC = T.StructType([T.StructField("contacts", T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([T.StructField("id", S)])))]))])

OBJECT_SCHEMA = T.StructType([
    T.StructField("id", S),
    T.StructField("properties", T.MapType(S, S)),
    T.StructField("propertiesWithHistory", T.StructType([T.StructField("dealstage", T.ArrayType(HISTORY_ENTRY))])),
    T.StructField("associations", ASSOC),
    T.StructField("archived", T.BooleanType()),
    T.StructField("updatedAt", S),
])
SUBMISSION_SCHEMA = T.StructType([
    T.StructField("conversionId", S),
    T.StructField("formId", S),
    T.StructField("submittedAt", S),
    T.StructField("pageUrl", S),
    T.StructField("values", T.ArrayType(T.StructType([T.StructField("name", S), T.StructField("value", S)]))),
])

OWNER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("email", S), T.StructField("firstName", S), T.StructField("lastName", S),
    T.StructField("teams", T.ArrayType(T.StructType([T.StructField("id", T.LongType())]))), T.StructField("createdAt", S),
    T.StructField("archived", T.BooleanType()),
])
FORM_SCHEMA = T.StructType([T.StructField("id", S), T.StructField("guid", S), T.StructField("name", S)])
DUMP_SCHEMAS = {"object": OBJECT_SCHEMA, "submission": SUBMISSION_SCHEMA, "owner": OWNER_SCHEMA, "form": FORM_SCHEMA}
# Dump folders that hold something else than CRM objects.
KINDS = {"owners": "owner", "forms": "form", "submissions": "submission"}

# Engagement object types and the type label each one lands with.
ENGAGEMENT_TYPES = {"emails": "EMAIL", "calls": "CALL", "meetings": "MEETING", "notes": "NOTE", "tasks": "TASK"}
# The properties that are landed, by dump folder; the modified time may be one.
ENGAGEMENT_PROPERTIES = ["hs_timestamp", "hs_createdate", "hubspot_owner_id", "hs_email_direction", "hs_email_from_email", "hs_email_subject"]
MODIFIED = "hs_lastmodifieddate"
PROPERTIES = {"contacts": CONTACT_PROPERTIES, "deals": DEAL_PROPERTIES, **{kind: ENGAGEMENT_PROPERTIES for kind in ENGAGEMENT_TYPES}}


def objects(spark: SparkSession, path: str, kind: str = "object") -> DataFrame:
    """A4: scan nested object dumps (JSON lines) with a declared schema."""
    return spark.read.schema(DUMP_SCHEMAS[kind]).json(path)


def modified_at(objs: DataFrame) -> Column:
    """When an object was modified: ``updatedAt``, else the property that the CRM searches by; null if neither can be read."""
    known = [parse_ts(F.col("updatedAt"))] if "updatedAt" in objs.columns else []
    if "properties" in objs.columns:
        known.append(parse_ts(F.col("properties")[MODIFIED]))
    return F.coalesce(*known) if known else F.lit(None).cast("timestamp_ntz")


def objects_since(objs: DataFrame, watermark: dt.datetime | None, modified: Column | None = None) -> DataFrame:
    """A5: modified-since filter; a full scan when there is no watermark. An object of unknown time counts as modified."""
    if watermark is None:
        return objs
    m = modified if modified is not None else modified_at(objs)
    return objs.filter(m.isNull() | (m >= F.lit(watermark).cast("timestamp_ntz")))


def version(objs: DataFrame, read_at: dt.datetime) -> Column:
    """The version of an object's rows: its modified time, or that of the run that read it, where it is unknown."""
    return F.coalesce(modified_at(objs), F.lit(read_at).cast("timestamp_ntz")).alias(SEQ)


def sync_state(spark: SparkSession, object_type: str, run_started_at: dt.datetime) -> DataFrame:
    """One state row per object type; the watermark is the run start, not the max seen."""
    at = F.lit(run_started_at.isoformat(" ")).cast("timestamp_ntz")
    return spark.range(1).select(F.lit(object_type).alias("object_name"), at.alias("last_sync_at"))  # no Python worker for one row


def latest_objects(objs: DataFrame) -> DataFrame:
    """Each object once: as it was modified last; versions of unknown time come before all others."""
    return latest_per_key(objs, ["id"], modified_at(objs))


def known(objs: DataFrame, kind: str) -> DataFrame:
    """Objects with their landed properties alone, as a struct: what is shuffled and staged. Versions of one time stay in the order of whole objects."""
    others = [c for c in objs.columns if c != "id"]
    tie = F.xxhash64(*[F.col(c).cast("string") for c in others]).alias(TIE)
    properties = F.struct(*[F.col("properties")[p].alias(p) for p in [*PROPERTIES[kind], MODIFIED]]).alias("properties")
    return objs.select("id", *[properties if c == "properties" else c for c in others], tie)


def parse_ts(c: Column) -> Column:
    """Epoch milliseconds (number or digit text) or ISO text (with or without Z); else null."""
    return X.parse_loose_timestamp(c)


def _props(names: list[str]) -> list[Column]:
    return [F.col("properties")[p].alias(f"property_{p}") for p in names]


def _load_cols(loaded_at: dt.datetime, archived: Column | None = None) -> list[Column]:
    arch = archived if archived is not None else F.coalesce(F.col("archived"), F.lit(False))
    return [F.lit(loaded_at).cast("timestamp_ntz").alias("_fivetran_synced"), arch.alias("_archived")]


def land_contacts(objs: DataFrame, loaded_at: dt.datetime, *more: Column) -> DataFrame:
    """L1: contact objects -> ``contact`` rows (property_* text columns, load time, archived) and more columns of the objects."""
    return objs.select(F.col("id"), *_props(CONTACT_PROPERTIES), *_load_cols(loaded_at), *more)


def land_deals(objs: DataFrame, loaded_at: dt.datetime, *more: Column) -> DataFrame:
    """L2: deal objects -> ``deal`` rows."""
    return objs.select(F.col("id").alias("deal_id"), *_props(DEAL_PROPERTIES), *_load_cols(loaded_at), *more)


def land_stage_history(objs: DataFrame, *more: Column, once: bool = False) -> DataFrame:
    """L3: stage history entries; incomplete entries dropped; exit = the next entry's time.

    An object that a batch holds twice counts once, as it was updated last. ``once``: the batch holds each once.
    """
    # All entries of a deal are in its object, so they are put in order there, without a shuffle.
    entries = F.transform("propertiesWithHistory.dealstage", lambda h: F.struct(parse_ts(h["timestamp"]).alias("entered_at"), h["value"].alias("stage_id")))
    entries = F.sort_array(F.filter(entries, lambda e: e["entered_at"].isNotNull() & (F.coalesce(e["stage_id"], F.lit("")) != "")))
    e = (objs if once else latest_objects(objs)).select(F.col("id").alias("deal_id"), entries.alias("_all"), *more)
    after = F.get("_all", F.col("_pos") + 1)
    # The outer form, as else Spark works out the entries once more, to leave out what has none. Equal entries count once.
    e = e.select("deal_id", "_all", *e.columns[2:], F.posexplode_outer("_all").alias("_pos", "_e")).filter(F.col("_e").isNotNull() & (after.isNull() | (F.col("_e") != after)))
    return e.select("deal_id", "_e.stage_id", "_e.entered_at", *e.columns[2:-2], after["entered_at"].alias("exited_at"))


def land_deal_contacts(objs: DataFrame, *more: Column) -> DataFrame:
    """L4: deal-contact edges; the first association is the primary one."""
    e = objs.select(F.col("id").alias("deal_id"), F.posexplode("associations.contacts.results").alias("pos", "r"), *more)
    return e.select("deal_id", F.col("r.id").alias("contact_id"), (F.col("pos") == 0).alias("is_primary"), *e.columns[3:])


def land_engagements(by_type: dict[str, DataFrame], loaded_at: dt.datetime, more: Callable[[DataFrame], list[Column]] = lambda _: []) -> DataFrame:
    """Union of the engagement object types; time = hs_timestamp else hs_createdate; email fields for emails only."""
    out = None
    for kind, objs in by_type.items():
        p = F.col("properties")
        is_email = kind == "emails"
        df = objs.select(
            F.col("id").alias("engagement_id"),
            F.lit(ENGAGEMENT_TYPES[kind]).alias("engagement_type"),
            F.coalesce(parse_ts(p["hs_timestamp"]), parse_ts(p["hs_createdate"])).alias("engagement_timestamp"),
            p["hubspot_owner_id"].alias("owner_id"),
            F.lit(kind).alias("engagement_source"),
            (p["hs_email_direction"] if is_email else F.lit(None).cast("string")).alias("email_metadata_direction"),
            (p["hs_email_from_email"] if is_email else F.lit(None).cast("string")).alias("email_metadata_from_email"),
            (p["hs_email_subject"] if is_email else F.lit(None).cast("string")).alias("email_metadata_subject"),
            *_load_cols(loaded_at, F.lit(False)), *more(objs),
        )
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def land_engagement_contacts(objs: DataFrame) -> DataFrame:
    """Engagement-contact edges."""
    return objs.select(F.col("id").alias("engagement_id"), F.explode("associations.contacts.results").alias("r")) \
        .select("engagement_id", F.col("r.id").alias("contact_id"))


def land_owners(owners: DataFrame) -> DataFrame:
    """Owner id as text, team id or null, archived default false."""
    return owners.select(
        F.col("id").cast("string").alias("owner_id"), "email", F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"), F.get(F.col("teams"), 0)["id"].cast("string").alias("team_id"),
        parse_ts(F.col("createdAt")).alias("created_at"), F.coalesce(F.col("archived"), F.lit(False)).alias("archived"))


def land_forms(forms: DataFrame) -> DataFrame:
    """Form id (id else guid); forms with neither are skipped."""
    return forms.select(F.coalesce("id", "guid").alias("form_id"), "name").filter(F.col("form_id").isNotNull())


def submission_values(values: Column) -> Column:
    """``[{name, value}]`` -> one JSON object; nameless entries dropped, the last duplicate wins.

    Relies on ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (set by ``prepare_session``).
    """
    named = F.filter(values, lambda v: F.coalesce(v["name"], F.lit("")) != "")
    entries = F.transform(named, lambda v: F.struct(v["name"].alias("key"), v["value"].alias("value")))
    return F.to_json(F.map_from_entries(entries))


def submission_key(form_id: Column, submitted_at: Column, email: Column) -> Column:
    """``form:epoch_seconds:email`` (0 and '' for missing parts)."""
    secs = F.coalesce(F.floor(F.unix_micros(submitted_at.cast("timestamp")) / F.lit(1_000_000)), F.lit(0))
    return F.concat_ws(":", F.coalesce(form_id, F.lit("")), secs.cast("string"), F.coalesce(email, F.lit("")))


def land_submissions(subs: DataFrame, form_id: Column | None = None) -> DataFrame:
    """L9 + L10: submissions -> ``contact_form`` rows (contact resolved later by L11)."""
    fid = form_id if form_id is not None else F.col("formId")
    flat = subs.select(fid.alias("form_id"), "conversionId", parse_ts(F.col("submittedAt")).alias("submitted_at"),
                       F.col("pageUrl").alias("page_url"), submission_values(F.col("values")).alias("submission_values"))
    email = F.get_json_object("submission_values", "$.email")
    return flat.select(
        F.coalesce(F.col("conversionId"), submission_key(F.col("form_id"), F.col("submitted_at"), email)).alias("conversion_id"),
        F.lit(None).cast("string").alias("contact_id"), "form_id", "submitted_at", "page_url", "submission_values")


def resolve_contacts(subs: DataFrame, contacts: DataFrame) -> DataFrame:
    """Fill ``contact_id`` by case-folded email; blank emails never match.

    An address shared by several contacts resolves to the smallest contact id
    (the original matches an arbitrary one). The email index is aggregated
    first, so the join is 1:1 per address.
    """
    index = contacts.filter(F.col("property_email").isNotNull() & (F.col("property_email") != "")).groupBy(
        F.lower("property_email").alias("_email")).agg(F.min("id").alias("_resolved"))
    email = F.get_json_object("submission_values", "$.email")
    keyed = subs.withColumn("_email", F.when(F.coalesce(email, F.lit("")) != "", F.lower(email)))
    j = keyed.join(index, "_email", "left")
    return j.withColumn("contact_id", F.coalesce(F.col("contact_id"), F.col("_resolved"))).drop("_email", "_resolved")
