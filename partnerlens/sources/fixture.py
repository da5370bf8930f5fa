"""Driver test tables -> raw CRM tables.

The test data is a TPC-H-like star schema plus an ``events`` stream. This
module derives the raw CRM tables (contact, deal, deal_contact,
deal_stage_history, engagement, engagement_contact, owner, form, contact_form,
partner_customer_counts) and the two seeds from them with DataFrame
operations only, so every downstream model grows with the input tables.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partnerlens.config import EngineConfig
from partnerlens.sources.tables import RawTables

# Fixed values of the fixture mapping (they must agree with the oracle SQL).
CONTACT_EPOCH = "1994-07-01 00:00:00"
LIFECYCLE_BY_MOD6 = ["lead", "MarketingQualifiedLead", "salesqualifiedlead", "opportunity", "customer", "other"]
STAGE_BY_LINENUMBER = {1: "Discovery", 2: "demo", 3: "proposal", 4: "negotiation", 5: "closed_won", 6: "closed_lost", 7: "demo"}
ENGAGEMENT_TYPE_BY_EVENT = {"click": "EMAIL", "view": "call", "purchase": "meeting", "error": "note", "signup": "task"}
DEAL_SOURCE_BY_MOD4 = ["Partner Referral", " partner referral ", "Inbound", ""]
FORM_ROWS = [("f0", "Partner Referral - A"), ("f1", "partner introduction"), ("f2", "Contact us"), ("f3", None)]
SCALE_FROM = "2024-01-01 00:00:00"
SCALE_TO = "1995-01-01 00:00:00"
SCALE_FACTOR = 80
PARTNER_START = "1995-01-01"
APP_COUNT_DATES = ("2000-12-31", "2001-12-31")
SEED_COUNT_DATES = ("1999-12-31", "2000-12-31")


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _s(c: Column) -> Column:
    return c.cast("string")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _days(ts: Column, n: Column) -> Column:
    return ts.cast("timestamp_ntz") + F.make_dt_interval(n.cast("int"))


def _scale(ts: Column) -> Column:
    base = F.unix_micros(F.lit(SCALE_TO).cast("timestamp"))
    shift = (F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.lit(SCALE_FROM).cast("timestamp"))) * SCALE_FACTOR
    return F.timestamp_micros(base + shift).cast("timestamp_ntz")


def _case(key: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def _blank() -> Column:
    return F.lit(None).cast("string")


def ref_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = _read(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    k = F.col("n_nationkey")
    return (
        n.join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.concat(F.lit("p"), _s(k)).alias("partner_id"),
            F.col("n_name").alias("partner_name"),
            F.when(k % 5 == 4, _blank()).otherwise(F.concat(F.lit("Nation"), _s(k), F.lit(".example"))).alias("partner_domain"),
            F.col("r_name").alias("partner_tier"),
            F.lit(PARTNER_START).cast("date").alias("partner_start_date"),
        )
    )


def contacts(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = F.col("c_custkey")
    created = _days(F.lit(CONTACT_EPOCH), (k * 37) % 2000)
    mql_at = _days(F.lit(CONTACT_EPOCH), (k * 37) % 2000 + k % 30)
    lifecycle = F.element_at(F.array(*[F.lit(v) for v in LIFECYCLE_BY_MOD6]), (k % 6 + 1).cast("int"))
    cols = {
        "id": _s(k),
        "property_email": F.when(k % 97 == 0, F.lit("")).otherwise(
            F.concat(F.lit("User"), _s(k), F.lit("@Corp"), _s(k % 50), F.lit(".Example"))),
        "property_firstname": F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("First"), _s(k))),
        "property_lastname": F.when(k % 6 != 0, F.concat(F.lit("Last"), _s(k % 100))),
        "property_company": F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Company "), _s(k % 50))),
        "property_jobtitle": F.when(k % 3 == 0, F.lit("CTO")).when(k % 3 == 1, F.lit("Buyer")),
        "property_industry": F.concat(F.lit("ind"), _s(k % 7)),
        "property_numberofemployees": F.when(k % 13 == 0, F.lit("")).when(k % 21 == 7, F.lit("many")).otherwise(_s(k % 1000)),
        "property_annualrevenue": F.when(k % 23 == 5, F.lit("n/a")).otherwise(_s(F.col("c_acctbal").cast("decimal(18,2)"))),
        "property_lifecyclestage": lifecycle,
        "property_hs_lead_status": F.when(k % 17 == 0, F.lit("UNQUALIFIED")).when(k % 19 == 0, F.lit("bad_fit")).otherwise(F.lit("OPEN")),
        "property_createdate": F.when(k % 47 == 3, F.lit("soon")).when(k % 49 == 4, F.lit("")).otherwise(_iso(created)),
        "property_hs_lifecyclestage_lead_date": F.when(k % 2 == 0, _iso(created)).otherwise(F.lit("")),
        "property_hs_lifecyclestage_marketingqualifiedlead_date": F.when(k % 31 == 8, F.lit("not a date")).when(
            (k % 6).isin(2, 3, 4) & (k % 4 != 0), _iso(mql_at)).otherwise(F.lit("")),
        "property_hs_lifecyclestage_salesqualifiedlead_date": F.when(k % 12 == 3, _iso(mql_at)),
        "property_hs_lifecyclestage_opportunity_date": F.when(k % 6 == 3, _iso(mql_at)).otherwise(F.lit("")),
        "property_hs_lifecyclestage_customer_date": F.when(k % 6 == 4, _iso(mql_at)).otherwise(F.lit("")),
        "property_hs_analytics_source": F.when(k % 8 == 3, F.lit("REFERRALS")).otherwise(F.lit("ORGANIC_SEARCH")),
        "property_hs_analytics_source_data_1": F.when(k % 8 == 3, F.concat(F.lit(" "), F.lower("n_name"))),
        "property_hs_analytics_source_data_2": F.when(k % 16 == 3, F.concat(F.lit("NATION_"), _s(k % 20))),
        "property_hs_latest_source": F.when(k % 3 == 0, F.lit("DIRECT_TRAFFIC")),
        "property_hs_latest_source_data_1": F.concat(F.lit("d"), _s(k % 5)),
        "property_hs_latest_source_data_2": _blank(),
        "property_hubspot_owner_id": _s(k % 10),
        "property_referring_partner": F.when(k % 10 == 0, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
        .when(k % 40 == 5, F.lit("Unlisted Partner")).otherwise(F.lit("")),
        "property_lead_origin": F.when(k % 9 == 0, F.lit(" Partner Referral (Partner) ")).otherwise(F.lit("")),
        "property_lead_source": F.when(k % 9 == 1, F.lit("PARTNER")),
        "property_partner_source": F.when(k % 9 == 2, F.lit(" met at a fair ")),
        "_fivetran_synced": _days(F.lit(as_of), -(k % 30)),
        "_archived": k % 101 == 0,
    }
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(*[v.alias(name) for name, v in cols.items()])


def _deal_stage(status: Column, prio: Column) -> Column:
    return (
        F.when(status == "F", F.lit("Closed_Won"))
        .when((status == "P") & prio.isin("4", "5"), F.lit("closed_lost"))
        .when(prio == "1", F.lit("negotiation"))
        .when(prio == "2", F.lit("proposal"))
        .when(prio == "3", F.lit("demo"))
        .otherwise(F.lit("discovery"))
    )


def _deal_columns(as_of: str) -> list[Column]:
    """The columns of raw deals, from those of orders and the customer's nation name."""
    k = F.col("o_orderkey")
    stage = _deal_stage(F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1))
    closed = stage.isin("Closed_Won", "closed_lost")
    won = F.col("o_orderstatus") == "F"
    close_shift = F.when(k % 97 == 0, F.lit(-3)).otherwise(k % 90)
    cols = {
        "deal_id": _s(k),
        "property_dealname": F.concat(F.lit("Company "), _s(F.col("o_custkey") % 300),
                                      F.when(k % 5 == 0, F.lit(" expansion")).otherwise(F.lit(""))),
        "property_pipeline": F.concat(F.lit("pipe"), _s(k % 2)),
        "property_dealstage": F.when(k % 29 != 9, stage),
        "property_hs_deal_stage_probability": F.when(k % 5 == 0, F.lit("")).when(k % 21 == 3, F.lit("high")).otherwise(F.concat(F.lit("0."), _s(k % 10))),
        "property_amount": F.when(k % 53 == 0, F.lit("")).otherwise(_s(F.col("o_totalprice").cast("decimal(18,2)"))),
        "property_amount_in_home_currency": F.when(k % 2 == 0, _s(F.col("o_totalprice").cast("decimal(18,2)"))).otherwise(F.lit("")),
        "property_createdate": F.when(k % 33 == 6, F.lit("unknown")).otherwise(_iso(F.col("o_orderdate"))),
        "property_closedate": F.when(closed, _iso(_days(F.col("o_orderdate"), close_shift))).otherwise(F.lit("")),
        "property_hs_closed_won_date": F.when(won & (k % 4 != 0), _iso(_days(F.col("o_orderdate"), k % 90))).otherwise(F.lit("")),
        "property_hs_is_closed_won": F.when(k % 31 == 0, F.lit("")).when(won, F.lit("true")).otherwise(F.lit("false")),
        "property_hs_is_closed": F.when(k % 3 == 0, F.lit("")).when(closed, F.lit("true")).otherwise(F.lit("false")),
        "property_dealtype": F.when(k % 2 == 0, F.lit("existingbusiness")).otherwise(F.lit("newbusiness")),
        "property_hubspot_owner_id": _s(k % 11),
        "property_deal_source": F.element_at(F.array(*[F.lit(v) for v in DEAL_SOURCE_BY_MOD4]), (k % 4 + 1).cast("int")),
        "property_referring_partner": F.when((k % 6).isin(0, 1), F.col("n_name"))
        .when((k % 24).isin(2, 8), F.lit("Unlisted Partner")).otherwise(F.lit("")),
        "property_deal_source_detail": F.when(k % 3 == 0, F.lit(" by phone ")),
        "_fivetran_synced": _days(F.lit(as_of), -(k % 30)) - F.expr("INTERVAL 10 HOURS"),
        "_archived": k % 103 == 0,
    }
    return [v.alias(name) for name, v in cols.items()]


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def deals(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ORDER_COLUMNS)
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (
        o.join(c, o.o_custkey == c.c_custkey, "left")
        .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
        .select(*_deal_columns(as_of))
    )


def deal_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    c = _read(spark, sf_dir, "customer", ["c_custkey"])
    k = F.col("o_orderkey")
    primary = o.filter(k % 50 != 7).select(
        _s(k).alias("deal_id"), _s(F.col("o_custkey")).alias("contact_id"), (k % 3 != 0).alias("is_primary"))
    extra = (
        o.filter(k % 5 == 0)
        .join(c, (F.col("o_custkey") + 1) == c.c_custkey, "left_semi")
        .select(_s(k).alias("deal_id"), _s(F.col("o_custkey") + 1).alias("contact_id"), F.lit(False).alias("is_primary"))
    )
    return primary.unionByName(extra)


def deal_stage_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    entries = li.select(
        _s(F.col("l_orderkey")).alias("deal_id"),
        _case(F.col("l_linenumber"), STAGE_BY_LINENUMBER).alias("stage_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("entered_at"),
    ).distinct()
    w = Window.partitionBy("deal_id").orderBy("entered_at", "stage_id")
    return entries.withColumn("exited_at", F.lead("entered_at").over(w))


def engagements(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    e, u = F.col("event_id"), F.col("user_id")
    click = F.col("event_type") == "click"
    return ev.select(
        _s(e).alias("engagement_id"),
        _case(F.col("event_type"), ENGAGEMENT_TYPE_BY_EVENT).alias("engagement_type"),
        _scale(F.col("ts")).alias("engagement_timestamp"),
        _s(u % 10).alias("owner_id"),
        _blank().alias("engagement_source"),
        F.when(click, F.when(e % 2 == 0, F.lit("INCOMING")).otherwise(F.lit("outgoing"))).alias("email_metadata_direction"),
        F.when(click, F.concat(F.lit("Rep@Nation"), _s(u % 25), F.lit(".Example"))).alias("email_metadata_from_email"),
        _blank().alias("email_metadata_subject"),
        (F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 30 HOURS")).alias("_fivetran_synced"),
        F.lit(False).alias("_archived"),
    )


def engagement_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events", ["event_id", "user_id"])
    return ev.select(_s(F.col("event_id")).alias("engagement_id"), _s(F.col("user_id")).alias("contact_id"))


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = F.col("s_suppkey")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        _s(k).alias("owner_id"),
        F.concat(F.lit("rep"), _s(k), F.lit("@vendor.example")).alias("email"),
        F.col("s_name").alias("first_name"),
        F.when(k % 4 == 0, _blank()).otherwise(F.col("n_name")).alias("last_name"),
        _s(F.col("s_nationkey")).alias("team_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        (k % 7 == 0).alias("archived"),
    )


def forms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FORM_ROWS, "form_id string, name string")


def contact_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"]).filter(F.col("event_type") == "signup")
    e, u = F.col("event_id"), F.col("user_id")
    base = [
        F.lit("email"), F.concat(F.lit("user"), _s(u), F.lit("@corp"), _s(u % 50), F.lit(".example")),
        F.lit("company_size"), _s(e % 4),
        F.lit("industry"), F.concat(F.lit("ind"), _s(e % 6)),
    ]
    values = (
        F.when(e % 7 == 0, F.create_map(*base, F.lit("partner_name"), F.concat(F.lit(" nation_"), _s(u % 25), F.lit(" "))))
        .when(e % 7 == 1, F.create_map(*base, F.lit("partner_name"), F.lit(""), F.lit("referring_partner"), F.lit("NATION_3")))
        .otherwise(F.create_map(*base))
    )
    return ev.select(
        F.concat(F.lit("s"), _s(e)).alias("conversion_id"),
        F.when(u % 23 == 0, _blank()).otherwise(_s(u)).alias("contact_id"),
        F.concat(F.lit("f"), _s(e % 5)).alias("form_id"),
        _scale(F.col("ts")).alias("submitted_at"),
        _blank().alias("page_url"),
        F.to_json(values).alias("submission_values"),
    )


def partner_customer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation", ["n_nationkey"])
    k = F.col("n_nationkey")
    return n.select(
        F.concat(F.lit("p"), _s(k)).alias("partner_id"),
        F.explode(F.array(*[F.lit(d).cast("date") for d in APP_COUNT_DATES])).alias("as_of_date"),
        (F.lit(100) + k * 10).cast("int").alias("total_customer_count"),
        _blank().alias("notes"),
    )


def partner_total_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = F.col("n_nationkey")
    return n.select(
        F.concat(F.lit("p"), _s(k)).alias("partner_id"),
        F.col("n_name").alias("partner_name"),
        F.explode(F.array(*[F.lit(d).cast("date") for d in SEED_COUNT_DATES])).alias("as_of_date"),
        (k * 5).cast("int").alias("total_customer_count"),
    )


def load_fixture(spark: SparkSession, sf_dir: str, cfg: EngineConfig | None = None) -> RawTables:
    """All raw tables and seeds, derived from the driver tables under ``sf_dir``."""
    cfg = cfg or EngineConfig()
    as_of = cfg.as_of_literal
    return RawTables(
        contact=contacts(spark, sf_dir, as_of),
        deal=deals(spark, sf_dir, as_of),
        deal_contact=deal_contacts(spark, sf_dir),
        deal_stage_history=deal_stage_history(spark, sf_dir),
        engagement=engagements(spark, sf_dir, as_of),
        engagement_contact=engagement_contacts(spark, sf_dir),
        owner=owners(spark, sf_dir),
        form=forms(spark),
        contact_form=contact_forms(spark, sf_dir),
        partner_customer_counts=partner_customer_counts(spark, sf_dir),
        ref_partners=ref_partners(spark, sf_dir),
        partner_total_customers=partner_total_customers(spark, sf_dir),
    )


# ------------------------------------------------ nested objects for landing

def contact_objects(raw_contacts: DataFrame) -> DataFrame:
    """Nested contact objects (``properties`` map) built from raw contact rows."""
    from partnerlens.sources.tables import CONTACT_PROPERTIES

    props = F.create_map(*[x for p in CONTACT_PROPERTIES for x in (F.lit(p), F.col(f"property_{p}"))])
    return raw_contacts.select("id", props.alias("properties"), F.col("_archived").alias("archived"))


def deal_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested deal objects: stage history (epoch-millis or ISO text) and contact associations.

    Entries are gathered per deal; one deal has at most a handful of stage
    changes and contacts, so each gathered list is small.
    """
    hist = deal_stage_history(spark, sf_dir).select(
        "deal_id",
        F.struct(F.col("stage_id").alias("value"),
                 F.when(F.dayofmonth("entered_at") % 2 == 0, F.unix_millis(F.col("entered_at").cast("timestamp")).cast("string"))
                 .otherwise(_iso(F.col("entered_at"))).alias("timestamp")).alias("h"))
    hist = hist.groupBy("deal_id").agg(F.collect_list("h").alias("dealstage"))
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    c = _read(spark, sf_dir, "customer", ["c_custkey"])
    k = F.col("o_orderkey")
    first = o.select(_s(k).alias("deal_id"), F.lit(0).alias("pos"), _s(F.col("o_custkey")).alias("id"))
    second = o.filter(k % 5 == 0).join(c, (F.col("o_custkey") + 1) == c.c_custkey, "left_semi").select(
        _s(k).alias("deal_id"), F.lit(1).alias("pos"), _s(F.col("o_custkey") + 1).alias("id"))
    assoc = first.unionByName(second).groupBy("deal_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("_r"))
    assoc = assoc.select("deal_id", F.transform("_r", lambda r: F.struct(r["id"].alias("id"))).alias("results"))
    return hist.join(assoc, "deal_id", "full").select(
        F.col("deal_id").alias("id"),
        F.struct(F.coalesce("dealstage", F.array().cast("array<struct<value:string,timestamp:string>>")).alias("dealstage"))
        .alias("propertiesWithHistory"),
        F.struct(F.struct(F.coalesce("results", F.array().cast("array<struct<id:string>>")).alias("results"))
                 .alias("contacts")).alias("associations"),
    )


def submission_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form submissions as the CRM returns them: a value list with duplicate and nameless entries."""
    ev = _read(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"]).filter(F.col("event_type") == "signup")
    e, u = F.col("event_id"), F.col("user_id")
    nv = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    base = F.array(
        nv("email", F.concat(F.lit("user"), _s(u), F.lit("@corp"), _s(u % 50), F.lit(".example"))),
        nv("company_size", _s(e % 4)),
        nv("industry", F.concat(F.lit("ind"), _s(e % 6))),
    )
    dup = F.when(e % 2 == 0, F.array(nv("industry", F.concat(F.lit("ind"), _s((e + 1) % 6))))).otherwise(
        F.array().cast("array<struct<name:string,value:string>>"))
    junk = F.when(e % 4 == 0, F.array(nv("", F.lit("junk")))).otherwise(
        F.array().cast("array<struct<name:string,value:string>>"))
    return ev.select(
        F.when(e % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("s"), _s(e))).alias("conversionId"),
        F.concat(F.lit("f"), _s(e % 5)).alias("formId"),
        F.unix_millis(_scale(F.col("ts")).cast("timestamp")).cast("string").alias("submittedAt"),
        F.lit(None).cast("string").alias("pageUrl"),
        F.concat(base, dup, junk).alias("values"),
    )


def deal_property_objects(raw_deals: DataFrame) -> DataFrame:
    """Nested deal objects with a ``properties`` map and ``updatedAt`` (ISO load time)."""
    from partnerlens.sources.tables import DEAL_PROPERTIES

    props = F.create_map(*[x for p in DEAL_PROPERTIES for x in (F.lit(p), F.col(f"property_{p}"))])
    return raw_deals.select(F.col("deal_id").alias("id"), props.alias("properties"),
                            F.col("_archived").alias("archived"), _iso(F.col("_fivetran_synced")).alias("updatedAt"))


ENGAGEMENT_KIND_BY_EVENT = {"click": "emails", "view": "calls", "purchase": "meetings", "error": "notes", "signup": "tasks"}


def engagement_objects(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Engagement objects per type (emails, calls, meetings, notes, tasks) built from ``events``.

    ``hs_timestamp`` is epoch-millis text except for every third event, which
    only has ``hs_createdate`` (ISO text, whole seconds). The modified time is
    ``updatedAt``, or the property, or cannot be read, by the event's number.
    """
    ev = _read(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    e, u = F.col("event_id"), F.col("user_id")
    at = _scale(F.col("ts"))
    props = F.create_map(
        F.lit("hs_timestamp"), F.when(e % 3 != 0, F.unix_millis(at.cast("timestamp")).cast("string")),
        F.lit("hs_createdate"), _iso(at),
        F.lit("hubspot_owner_id"), _s(u % 10),
        F.lit("hs_email_direction"), F.when(e % 2 == 0, F.lit("INCOMING")).otherwise(F.lit("outgoing")),
        F.lit("hs_email_from_email"), F.concat(F.lit("Rep@Nation"), _s(u % 25), F.lit(".Example")),
        F.lit("hs_lastmodifieddate"), F.when(e % 4 == 1, F.unix_millis(at.cast("timestamp")).cast("string")),
    )
    updated = F.when(e % 4 == 0, _iso(at)).when(e % 4 == 2, F.lit("junk"))
    objs = ev.select("event_type", _s(e).alias("id"), props.alias("properties"), updated.alias("updatedAt"),
                     F.struct(F.struct(F.array(F.struct(_s(u).alias("id"))).alias("results")).alias("contacts"))
                     .alias("associations"))
    return {kind: objs.filter(F.col("event_type") == ev_type).drop("event_type")
            for ev_type, kind in ENGAGEMENT_KIND_BY_EVENT.items()}


def changed_engagement_objects(spark: SparkSession, sf_dir: str, at: dt.datetime) -> dict[str, DataFrame]:
    """What changed after a first landing run: every seventh engagement has another owner, modified at that time."""
    owner = F.col("properties")["hubspot_owner_id"].cast("int") + 100
    props = F.map_concat(F.map_filter("properties", lambda k, _: k != "hubspot_owner_id"), F.create_map(F.lit("hubspot_owner_id"), owner.cast("string")))
    return {kind: objs.filter(F.col("id").cast("bigint") % 7 == 0).withColumns({"properties": props, "updatedAt": _iso(F.lit(at).cast("timestamp_ntz"))})
            for kind, objs in engagement_objects(spark, sf_dir).items()}


def owner_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner objects as the CRM returns them (numeric id, team list, created time, optional archived flag)."""
    s = _read(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    k = F.col("s_suppkey")
    return s.select(
        k.alias("id"), F.concat(F.lit("rep"), _s(k), F.lit("@vendor.example")).alias("email"),
        F.col("s_name").alias("firstName"), F.lit(None).cast("string").alias("lastName"),
        F.when(k % 3 == 0, F.array().cast("array<struct<id:bigint>>"))
        .otherwise(F.array(F.struct(F.col("s_nationkey").cast("bigint").alias("id")))).alias("teams"),
        F.when(k % 2 == 0, _iso(F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")))
        .otherwise(F.lit("946684800000")).alias("createdAt"),
        F.when(k % 5 == 0, F.lit(None).cast("boolean")).otherwise(k % 7 == 0).alias("archived"),
    )


def form_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form objects: one per form that submissions name; some have only a guid, one has neither id nor guid."""
    ev = _read(spark, sf_dir, "events", ["event_id", "event_type"]).filter(F.col("event_type") == "signup")
    k = F.col("event_id") % 6
    form = ev.select(k.alias("k")).distinct().select(F.col("k"), F.concat(F.lit("f"), _s(F.col("k"))).alias("form"))
    return form.select(
        F.when(~F.col("k").isin(1, 5), F.col("form")).alias("id"), F.when(F.col("k") != 5, F.concat(F.col("form"), F.lit("-guid"))).alias("guid"),
        F.concat(F.lit("Form "), _s(F.col("k"))).alias("name"))


def _twice(rows: DataFrame, key: Column) -> DataFrame:
    """rows, and every 11th once more, with ``_older`` set."""
    return rows.withColumn("_older", F.explode(F.when(key % 11 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))


def _with_older(objs: DataFrame, prop: str) -> DataFrame:
    """objs of :func:`_twice`, the older versions with another value of the property, and an earlier time."""
    older = F.map_concat(F.map_filter("properties", lambda k, _: k != prop), F.create_map(F.lit(prop), F.lit("older")))
    before = _iso(_days(F.to_timestamp("updatedAt").cast("timestamp_ntz"), F.lit(-400)))
    pick = lambda was, now: F.when(F.col("_older"), was).otherwise(F.col(now))
    return objs.withColumns({"properties": pick(older, "properties"), "updatedAt": pick(before, "updatedAt")}).drop("_older")


def whole_deal_objects(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    """The deals' dump: :func:`deal_property_objects` joined with :func:`deal_objects`, and older versions.

    Orders are dealt by customer, then by key, as lineitem is; what the objects
    hold besides (maps, texts) is made from them afterwards.
    """
    from partnerlens.sources.tables import DEAL_PROPERTIES

    o = _read(spark, sf_dir, "orders", ORDER_COLUMNS)
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    li = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    k = F.col("o_orderkey")
    # One row a customer, so that an order stays one row until its contacts are gathered; a nation that is not known counts too.
    nations = c.groupBy(F.col("c_custkey").alias("o_custkey")).agg(F.collect_list(F.struct("c_nationkey")).alias("_nations"))
    ahead = c.select((F.col("c_custkey") - 1).alias("o_custkey")).distinct().withColumn("_ahead", F.lit(True))
    o = o.join(nations, "o_custkey", "left").join(ahead, "o_custkey", "left")
    contact = lambda pos, key: F.struct(F.lit(pos).alias("pos"), _s(key).alias("id"))
    first, second = contact(0, F.col("o_custkey")), contact(1, F.col("o_custkey") + 1)
    o = o.withColumn("_contacts", F.when((k % 5 == 0) & F.col("_ahead"), F.array(first, second)).otherwise(F.array(first))).drop("_ahead")
    # As the objects of an unknown deal are found by no key, they have neither contacts nor stages.
    all_of = F.sort_array(F.flatten(F.collect_list(F.when(k.isNotNull(), F.col("_contacts"))).over(Window.partitionBy("o_orderkey"))))
    o = o.withColumn("_contacts", F.when(k.isNotNull(), all_of))
    entry = F.struct(_case(F.col("l_linenumber"), STAGE_BY_LINENUMBER).alias("stage_id"), F.col("l_shipdate").cast("timestamp_ntz").alias("entered_at"))
    # Dealt before entries are gathered, as those of a key are few and seldom beside each other.
    hist = li.select(F.col("l_orderkey").alias("o_orderkey"), entry.alias("h")).repartition("o_orderkey").groupBy("o_orderkey").agg(F.collect_set("h").alias("_stages"))
    text = lambda at: F.when(F.dayofmonth(at) % 2 == 0, F.unix_millis(at.cast("timestamp")).cast("string")).otherwise(_iso(at))
    stages = F.transform("_stages", lambda h: F.struct(h["stage_id"].alias("value"), text(h["entered_at"]).alias("timestamp")))
    none = F.array().cast("array<struct<value:string,timestamp:string>>")
    o = o.join(hist, "o_orderkey", "left").withColumn("_nation", F.explode_outer("_nations")).drop("_nations")
    o = _twice(o.join(n, F.col("_nation.c_nationkey") == n.n_nationkey, "left"), k)
    rows = o.select(*_deal_columns(as_of), "_contacts", "_stages", "_older")
    props = F.create_map(*[x for p in DEAL_PROPERTIES for x in (F.lit(p), F.col(f"property_{p}"))])
    linked = F.struct(F.struct(F.transform("_contacts", lambda r: F.struct(r["id"].alias("id"))).alias("results")).alias("contacts"))
    return _with_older(rows.select(
        F.col("deal_id").alias("id"), props.alias("properties"), F.col("_archived").alias("archived"), _iso(F.col("_fivetran_synced")).alias("updatedAt"),
        F.when(F.col("_contacts").isNotNull(), F.struct(F.coalesce(stages, none).alias("dealstage"))).alias("propertiesWithHistory"),
        F.when(F.col("_contacts").isNotNull(), linked).alias("associations"), "_older"), "dealstage")


def dump_objects(spark: SparkSession, sf_dir: str, raw: RawTables, as_of: str) -> dict[str, DataFrame]:
    """All object dumps by kind. Every 11th contact and deal is in the dump twice, the older version with other values."""
    contacts = contact_objects(raw.contact).join(raw.contact.select("id", _iso(F.col("_fivetran_synced")).alias("updatedAt")), "id")
    return {
        "contacts": _with_older(_twice(contacts, F.col("id").cast("bigint")), "lifecyclestage"),
        "deals": whole_deal_objects(spark, sf_dir, as_of),
        **engagement_objects(spark, sf_dir), "owners": owner_objects(spark, sf_dir), "forms": form_objects(spark, sf_dir),
        "submissions": submission_objects(spark, sf_dir),
    }


# ------------------------------------------------------ publishing and counts

# Properties of the target databases, by their kind.
_KINDS = {"Name": "title", "Leads": "number", "Revenue": "number", "Top": "checkbox", "Quadrant": "select", "When": "date", "Period": "rich_text",
          "Rate": "number"}
# Target rows by region: source, filters, column map, key columns.
_TARGETS = [
    ("rankings", "partner_rankings", {}, {"partner_name": "Name", "total_leads": "Leads", "revenue_closed_won": "Revenue", "is_top_performer": "Top",
                                          "volume_efficiency_quadrant": "Quadrant", "mql_rate": "Not there"}, []),
    ("summary-month", "partner_summary", {"period_type": "month", "partner_id": "p1"}, {"period_start_date": "When", "total_leads": "Leads"}, ["period_start_date"]),
    ("penetration", "partner_penetration", {}, {"as_of_date": "When", "penetration_rate": "Rate"}, ["as_of_date"]),
    ("summary-any", "partner_summary", {"period_type": ""}, {"period_type": "Period", "period_start_date": "When", "total_leads": "Leads"},
     ["period_type", "period_start_date"]),
    ("unknown", "partner_leads", {}, {}, []),
]


def publish_target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publish targets: one for each region, enabled, and the same once more, disabled."""
    r = _read(spark, sf_dir, "region", ["r_regionkey"])
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("r_regionkey") + 1).cast("int"))
    keys = F.element_at(F.array(*[F.array(*[F.lit(k) for k in t[4]]).cast("array<string>") for t in _TARGETS]), (F.col("r_regionkey") + 1).cast("int"))
    on = r.select(
        pick([t[0] for t in _TARGETS]).alias("id"), pick([t[1] for t in _TARGETS]).alias("source_table"),
        F.concat(F.lit("db-"), _s(F.col("r_regionkey"))).alias("notion_database_id"), pick([json.dumps(t[2]) for t in _TARGETS]).alias("filter_json"),
        pick([json.dumps(t[3]) for t in _TARGETS]).alias("column_map_json"), F.lit(json.dumps(_KINDS)).alias("kinds_json"), keys.alias("key_columns"),
        F.lit(True).alias("enabled"))
    return on.unionByName(on.withColumn("enabled", F.lit(False)))


def published_pages(mart: DataFrame, target) -> DataFrame:
    """Pages that are there already: for the partners with an even number, with blanks around the title; some titles twice."""
    number = F.regexp_extract("partner_id", "([0-9]+)$", 1).try_cast("int")
    some = mart.filter(number % 2 == 0)
    page = F.concat_ws("/", F.lit("page"), "partner_id", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in target.key_columns])
    pages = some.select(page.alias("page_id"), F.concat(F.lit(" "), F.col(target.title_column), F.lit("\n")).alias("title"), *target.key_columns)
    return pages.unionByName(pages.filter(F.col("page_id").contains("4")).withColumn("page_id", F.concat("page_id", F.lit("-again"))))


def entered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-entered counts, four of five with one fault."""
    n = _read(spark, sf_dir, "nation", ["n_nationkey"])
    k = F.col("n_nationkey")
    return n.select(
        F.when(k % 5 == 1, F.concat(F.lit("p"), _s(k), F.lit("x" * 64))).when(k % 10 == 4, F.lit("  ")).otherwise(F.concat(F.lit(" p"), _s(k))).alias("partner_id"),
        F.when(k % 5 != 2, F.lit("2001-06-30")).cast("date").alias("as_of_date"),
        F.when(k % 5 == 3, -k).otherwise(k).cast("int").alias("total_customer_count"),
        F.when(k % 10 == 9, F.lit("n" * 501)).alias("notes"))
