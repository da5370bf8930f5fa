"""Registered queries: one callable per operator of the inventory.

Each entry takes ``(spark, sf_dir)``, derives the raw CRM tables from the
driver tables under ``sf_dir`` and returns the result in canonical shape
(see :mod:`partnerlens.plans.compare`). All of them read whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partnerlens.plans.compare import canonical
from partnerlens.plans.models import Models

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
MODEL_FNS: dict[str, Callable[[Models], DataFrame]] = {}

# Shared models (attribution, stage durations, partner leads and deals, summary)
# are written as Parquet in the shared folder; later plans read what they need.
MATERIALIZE = "parquet"


_RUNS: dict[str, tuple[tuple, Models]] = {}


def _inputs(spark: SparkSession, sf_dir: str) -> tuple:
    """What tells one state of the input folder from another: application, and each file's path, length and time."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return spark.sparkContext.applicationId, *sorted(found)


def models_for(spark: SparkSession, sf_dir: str) -> Models:
    """The model graph of one run over a folder as it is now.

    Queries of one application over the same files share the written models,
    as the marts of one refresh do. When a file has changed, the old run's
    models are deleted and a new run starts.
    """
    inputs = _inputs(spark, sf_dir)
    known, m = _RUNS.get(sf_dir, (None, None))
    if known != inputs:
        if m is not None and known[0] == inputs[0]:
            m.release()
        m = Models.from_fixture(spark, sf_dir, materialize=MATERIALIZE)
        _RUNS[sf_dir] = inputs, m
    return m


def register(name: str):
    def deco(fn: Callable[[Models], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return canonical(fn(models_for(spark, sf_dir)))

        MODEL_FNS[name] = fn

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run

    return deco


def _model(name: str, attr: str, doc: str) -> None:
    def fn(m: Models) -> DataFrame:
        return getattr(m, attr)

    fn.__doc__ = doc
    register(name)(fn)


for _name, _attr, _doc in [
    ("stg_contacts", "contacts", "S1"),
    ("stg_deals", "deals", "S2"),
    ("stg_stage_history", "stage_history", "S3"),
    ("stg_engagements", "engagements", "S4"),
    ("stg_form_submissions", "form_submissions", "S5"),
    ("stg_deal_contacts", "deal_contacts", "S6"),
    ("stg_engagement_contacts", "engagement_contacts", "S7"),
    ("stg_owners", "owners", "S8"),
    ("stg_partners", "partners", "S9"),
    ("stg_partner_totals", "partner_totals", "S10"),
    ("int_contact_first_touch", "first_touch", "I1"),
    ("int_deal_primary_contact", "primary_contact", "I2"),
    ("int_deal_sales_touches", "sales_touches", "I3 interval join"),
    ("int_deal_stage_durations", "stage_durations", "I4"),
    ("int_partner_contact_attribution", "attribution", "I5 attribution"),
    ("partner_leads", "partner_leads", "K1"),
    ("partner_deals", "partner_deals", "K2"),
    ("partner_deal_stage_durations", "deal_stage_durations", "K3"),
    ("partner_funnel_stage_conversion", "funnel", "K4"),
    ("partner_lead_cohorts", "lead_cohorts", "K5"),
    ("partner_penetration", "penetration", "K6"),
    ("partner_rep_performance", "rep_performance", "K7"),
    ("partner_rep_performance_all", "rep_performance_all", "K7b"),
    ("partner_summary", "summary", "K8"),
    ("partner_rankings", "rankings", "K9"),
]:
    _model(_name, _attr, _doc)


# ------------------------------------------------------------ reports (Q, D)
from pyspark.sql import functions as F  # noqa: E402

from partnerlens.operators import merge as M  # noqa: E402
from partnerlens.operators import quality as T  # noqa: E402
from partnerlens.plans import forecast as FC  # noqa: E402
from partnerlens.plans import publish as P  # noqa: E402
from partnerlens.plans import reports as R  # noqa: E402
from partnerlens.sources import fixture as FX  # noqa: E402
from partnerlens.sources import landing as L  # noqa: E402


@register("q_rankings")
def _q_rankings(m: Models) -> DataFrame:
    """Q1"""
    return R.q_rankings(m.rankings)


@register("q_totals")
def _q_totals(m: Models) -> DataFrame:
    """Q2-Q4: totals for every report period."""
    return R.q_totals_all_periods(m.summary, m.cfg.as_of)


@register("q_kpis")
def _q_kpis(m: Models) -> DataFrame:
    """Q3b"""
    return R.q_kpis(R.q_totals_all_periods(m.summary, m.cfg.as_of))


@register("q_monthly_all")
def _q_monthly_all(m: Models) -> DataFrame:
    """Q5 (all partners summed)"""
    return R.q_monthly(m.summary)


@register("q_monthly_by_partner")
def _q_monthly_by_partner(m: Models) -> DataFrame:
    """Q5 (per partner)"""
    return R.q_monthly(m.summary, by_partner=True)


@register("q_partner_all_time")
def _q_partner_all_time(m: Models) -> DataFrame:
    """Q6 for every partner"""
    return R.q_partner_all_time(m.summary)


@register("q_funnel")
def _q_funnel(m: Models) -> DataFrame:
    """Q7"""
    return R.q_funnel(m.funnel)


@register("q_reps")
def _q_reps(m: Models) -> DataFrame:
    """Q8"""
    return R.q_reps(m.rep_performance)


@register("q_deals")
def _q_deals(m: Models) -> DataFrame:
    """Q9 / O3"""
    return R.q_deals(m.partner_deals)


@register("q_deals_closed")
def _q_deals_closed(m: Models) -> DataFrame:
    """Q9b (closed list)"""
    return R.q_deals(m.partner_deals, closed=True)


@register("q_deals_open")
def _q_deals_open(m: Models) -> DataFrame:
    """Q9b (open list)"""
    return R.q_deals(m.partner_deals, closed=False)


def _form_subs(m: Models) -> DataFrame:
    return R.q_form_submissions(m.form_submissions, m.contacts, m.contact_engagements, m.partner_deals, m.partner_leads)


@register("q_form_submissions")
def _q_form_submissions(m: Models) -> DataFrame:
    """Q10 / W3"""
    return _form_subs(m)


@register("q_form_velocity")
def _q_form_velocity(m: Models) -> DataFrame:
    """Q10b / X15"""
    return R.q_form_velocity(_form_subs(m))


@register("q_partner_list")
def _q_partner_list(m: Models) -> DataFrame:
    """Q11"""
    return R.q_partner_list(m.summary)


@register("q_partner_counts")
def _q_partner_counts(m: Models) -> DataFrame:
    """Q12"""
    return R.q_partner_counts(m.partners, m.raw.partner_customer_counts)


@register("q_count_history")
def _q_count_history(m: Models) -> DataFrame:
    """Q13 for every partner"""
    return R.q_count_history(m.raw.partner_customer_counts)


@register("q_top_revenue")
def _q_top_revenue(m: Models) -> DataFrame:
    """Top 10 by revenue"""
    return R.q_top_revenue(m.rankings, 10)


@register("q_quadrant")
def _q_quadrant(m: Models) -> DataFrame:
    """Q15"""
    return R.q_quadrant(m.rankings)


@register("d_leads_by_month_source")
def _d1(m: Models) -> DataFrame:
    """D1"""
    return R.d_leads_by_month_source(m.partner_leads)


@register("d_drop_off_callout")
def _d2(m: Models) -> DataFrame:
    """D2 / G14"""
    return R.d_drop_off_callout(m.funnel)


@register("d_source_split")
def _d3(m: Models) -> DataFrame:
    """D3"""
    return R.d_source_split(m.partner_leads)


@register("d_form_breakdown")
def _d4(m: Models) -> DataFrame:
    """D4"""
    return R.d_form_breakdown(m.partner_leads)


@register("d_time_to_touch")
def _d5(m: Models) -> DataFrame:
    """D5 / G10"""
    return R.d_time_to_touch(m.partner_leads)


@register("d_rep_partner_matrix")
def _d6(m: Models) -> DataFrame:
    """D6"""
    return R.d_rep_partner_matrix(m.rep_performance)


@register("d_leads_by_owner")
def _d7(m: Models) -> DataFrame:
    """D7"""
    return R.d_leads_by_owner(m.partner_leads, m.owners)


@register("d_penetration_latest")
def _d8(m: Models) -> DataFrame:
    """D8 / W2"""
    return R.d_penetration_latest(m.penetration)


@register("d_velocity_tiles")
def _d10b(m: Models) -> DataFrame:
    """velocity"""
    return R.d_velocity_tiles(m.summary)


# O4 and the single-partner forms of Q5-Q9, Q13
ONE = "p3"


@register("q_monthly_one")
def _q5_one(m: Models) -> DataFrame:
    """Q5 of one partner"""
    return R.q_monthly(m.summary, ONE)


@register("q_partner_one")
def _q6_one(m: Models) -> DataFrame:
    """Q6 / O4 of one partner: its one all_time row"""
    return R.q_partner_all_time(m.summary, ONE)


@register("q_funnel_one")
def _q7_one(m: Models) -> DataFrame:
    """Q7 of one partner"""
    return R.q_funnel(m.funnel, ONE)


@register("q_reps_one")
def _q8_one(m: Models) -> DataFrame:
    """Q8 of one partner"""
    return R.q_reps(m.rep_performance, ONE)


@register("q_deals_one")
def _q9_one(m: Models) -> DataFrame:
    """Q9 of one partner"""
    return R.q_deals(m.partner_deals, ONE)


@register("q_count_history_one")
def _q13_one(m: Models) -> DataFrame:
    """Q13 of one partner"""
    return R.q_count_history(m.raw.partner_customer_counts, ONE)


@register("d_deals_filtered")
def _d9b(m: Models) -> DataFrame:
    """Filters by date, partner and owner together"""
    return R.d_global_filter(m.partner_deals, "deal_created_at", "1996-01-01", None, ["p1", ONE], ["2", "5", "7"]).select(
        "deal_id", "partner_id", "deal_owner_id", "deal_created_at")


@register("d_deals_in_range")
def _d9(m: Models) -> DataFrame:
    """Global date-range filter on partner deals (created in 1997)"""
    return R.d_global_filter(m.partner_deals, "deal_created_at", "1997-01-01", "1998-01-01").select(
        "deal_id", "partner_id", "deal_created_at", "amount")


@register("d_funnel_tiles")
def _d10(m: Models) -> DataFrame:
    """D10"""
    return R.d_funnel_tiles(m.summary)


@register("d_quality_rates")
def _d11(m: Models) -> DataFrame:
    """D11"""
    return R.d_quality_rates(m.summary)


# ----------------------------------------------------------------- forecast
@register("forecast_defaults")
def _f1(m: Models) -> DataFrame:
    """F1"""
    return FC.forecast_defaults(FC.history(m.summary))


@register("forecast")
def _f2(m: Models) -> DataFrame:
    """Every partner at once"""
    return FC.forecast(FC.history(m.summary))


@register("forecast_totals")
def _f3(m: Models) -> DataFrame:
    """F3"""
    return FC.forecast_totals(FC.forecast(FC.history(m.summary)))


@register("forecast_all")
def _f2_all(m: Models) -> DataFrame:
    """all partners as one series"""
    return FC.forecast(FC.history_all(m.summary))


@register("forecast_all_totals")
def _f3_all(m: Models) -> DataFrame:
    """all partners as one series"""
    return FC.forecast_totals(FC.forecast(FC.history_all(m.summary)))


# ------------------------------------------------------------------ publish
def _target(m: Models, name: str) -> P.Target:
    """One enabled row of the target table."""
    return P.target_from_row(FX.publish_target_rows(m.spark, m.sf_dir).filter((F.col("id") == name) & F.col("enabled")).first())


def _marts(m: Models) -> dict[str, DataFrame]:
    return {"partner_rankings": m.rankings, "partner_summary": m.summary, "partner_penetration": m.penetration}


def _published(m: Models, name: str) -> DataFrame:
    t = _target(m, name)
    mart = _marts(m)[t.source_table]
    return P.publish_plan(mart, FX.published_pages(mart, t), t)


@register("publish_targets")
def _p1(m: Models) -> DataFrame:
    """P1"""
    return P.publish_targets(FX.publish_target_rows(m.spark, m.sf_dir)).select("id", "source_table", "known_source")


@register("publish_rankings")
def _p4(m: Models) -> DataFrame:
    """Rankings matched by title"""
    return _published(m, "rankings")


@register("publish_penetration")
def _p4_penetration(m: Models) -> DataFrame:
    """Penetration, several dates per partner, matched by title and date"""
    return _published(m, "penetration")


@register("publish_summary_month")
def _p4_month(m: Models) -> DataFrame:
    """The months of the summary, each row to its own page"""
    return _published(m, "summary-month")


@register("publish_summary_unfiltered")
def _p4_unfiltered(m: Models) -> DataFrame:
    """A blank filter takes the default away"""
    return _published(m, "summary-any")


@register("publish_long_titles")
def _p4_long(m: Models) -> DataFrame:
    """Titles that differ after the 2,000 characters that are sent, and one title twice"""
    t = _target(m, "rankings")
    mart = m.rankings.withColumn("partner_name", F.concat(F.lit("t" * 2000), F.when(F.col("partner_id") == "p1", "NATION_2").otherwise(F.col("partner_name"))))
    return P.publish_plan(mart, FX.published_pages(mart, t), t).drop("Name")


def _statuses(m: Models, log: DataFrame) -> DataFrame:
    """The log as it stands in the stored targets after two runs of which the first failed: one row for each target."""
    path = m.new_path("targets")
    M.write_keyed(FX.publish_target_rows(m.spark, m.sf_dir).filter("enabled").select("id", "source_table", "notion_database_id"), path, ["id"])
    failed = [(r["target_id"], "error", "first run") for r in log.select("target_id").collect()]  # one row for each target
    P.store_status(m.spark, path, P.publish_log(m.spark, failed, m.cfg.as_of - dt.timedelta(hours=1)))
    stored = P.store_status(m.spark, path, log)
    return stored.select(F.col("id").alias("target_id"), *[F.col(name).alias(c) for c, name in P.STATUS_COLS.items()])


@register("publish_log")
def _p5(m: Models) -> DataFrame:
    """P5: every target run; an unknown source and a plan that fails while it runs do not stop the others"""
    targets = [P.target_from_row(r) for r in FX.publish_target_rows(m.spark, m.sf_dir).collect()]  # the configuration
    marts = _marts(m)
    existing = {t.id: FX.published_pages(marts[t.source_table], t) for t in targets if t.source_table in marts}
    marts["partner_penetration"] = m.penetration.withColumn("penetration_rate", F.when(F.lit(True), F.raise_error(F.lit("broken mart")).cast("double")))

    def send(t: P.Target, plan: DataFrame) -> None:
        plan.write.format("noop").mode("overwrite").save()

    log = P.run_publish(m.spark, marts, targets, existing, send, m.cfg.as_of)
    log = _statuses(m, log)
    return log.withColumn("message", F.when(F.col("message").contains("broken mart"), "broken mart").otherwise(F.col("message")))


def _stored_counts(m: Models) -> str:
    """The hand-entered counts as a stored table of their own."""
    path = m.new_path("counts")
    M.write_keyed(m.raw.partner_customer_counts, path, P.COUNT_KEYS)
    return path


@register("upsert_counts")
def _c1(m: Models) -> DataFrame:
    """Seed totals merged into the stored hand-entered counts, read back"""
    rows = m.raw.partner_total_customers.select("partner_id", "as_of_date", "total_customer_count",
                                                F.lit(None).cast("string").alias("notes"))
    return P.store_counts(m.spark, _stored_counts(m), rows)


@register("rejected_counts")
def _c1_rejected(m: Models) -> DataFrame:
    """Rows that are sent back, with the reason"""
    return P.rejected_counts(FX.entered_counts(m.spark, m.sf_dir)).select(
        F.col("partner_id").substr(1, 8).alias("partner_id"), "as_of_date", "total_customer_count", "reason")


@register("delete_counts")
def _c2(m: Models) -> DataFrame:
    """The count rows that the seed also has removed from the stored ones, read back"""
    return P.unstore_counts(m.spark, _stored_counts(m), m.raw.partner_total_customers)


# ------------------------------------------------------------------ quality
def _mart_tables(m: Models) -> dict[str, DataFrame]:
    return {
        **{name: getattr(m.raw, name) for name in ("contact", "deal", "engagement", "ref_partners", "partner_total_customers", "partner_customer_counts")},
        "stg_contacts": m.contacts, "stg_deals": m.deals, "stg_deal_contacts": m.deal_contacts, "stg_stage_history": m.stage_history,
        "stg_engagements": m.engagements, "stg_form_submissions": m.form_submissions, "stg_owners": m.owners, "stg_partners": m.partners,
        "stg_engagement_contacts": m.engagement_contacts, "stg_partner_totals": m.partner_totals,
        "int_partner_contact_attribution": m.attribution, "int_deal_primary_contact": m.primary_contact,
        "int_contact_first_touch": m.first_touch, "int_deal_sales_touches": m.sales_touches, "int_deal_stage_durations": m.stage_durations, "partner_leads": m.partner_leads, "partner_deals": m.partner_deals,
        "partner_deal_stage_durations": m.deal_stage_durations, "partner_funnel_stage_conversion": m.funnel,
        "partner_summary": m.summary, "partner_rep_performance": m.rep_performance, "partner_penetration": m.penetration,
        "partner_rankings": m.rankings, "partner_lead_cohorts": m.lead_cohorts,
    }


@register("quality_checks")
def _t8(m: Models) -> DataFrame:
    """Schema tests of all models as one result table"""
    return T.run_checks(_mart_tables(m), T.standard_checks())


@register("quality_failures")
def _t8_failures(m: Models) -> DataFrame:
    """Keys of the rows that fail, the smallest five of each check; checks with declared faults, as the declared ones all pass"""
    c = T.Check
    checks = [c("not_null", "contact", ("property_jobtitle",)), c("unique", "contact", ("property_company",)),
              c("unique", "contact", ("property_industry", "property_lifecyclestage")), c("accepted_values", "contact", ("property_lifecyclestage",), values=("lead", "customer")),
              c("unique", "deal_contact", ("deal_id",)), c("not_null", "deal_contact", ("contact_id",))]
    return T.failing_keys({"contact": m.raw.contact, "deal_contact": m.raw.deal_contact}, checks, {"contact": ["id"], "deal_contact": ["deal_id", "contact_id"]}, 5)


@register("check_close_before_create")
def _t6(m: Models) -> DataFrame:
    """T6 (warn)"""
    return T.run_checks({"partner_deals": m.partner_deals}, [T.close_before_create(m.partner_deals)])


@register("check_unlisted_lead_partners")
def _t7(m: Models) -> DataFrame:
    """T7 / J7 (warn)"""
    return T.unlisted_lead_partners(m.partner_leads, m.partners)


@register("check_lost_by_cast")
def _t9(m: Models) -> DataFrame:
    """Non-blank raw text that a cast of S1-S5 turned into null, for every declared cast"""
    return T.lost_by_declared_casts({"contact": m.raw.contact, "deal": m.raw.deal, "engagement": m.raw.engagement, "contact_form": m.raw.contact_form})


@register("source_freshness")
def _a12(m: Models) -> DataFrame:
    """Contact, deal and engagement load times against as_of"""
    out = None
    for name, df in (("contact", m.raw.contact), ("deal", m.raw.deal), ("engagement", m.raw.engagement)):
        f = T.freshness(df, name, "_fivetran_synced", m.cfg.as_of)
        out = f if out is None else out.unionByName(f)
    return out


# ------------------------------------------------------------------- merges
@register("upsert_contacts")
def _a8(m: Models) -> DataFrame:
    """Keyed upsert, last write wins among duplicates (every 7th contact changes twice)"""
    c = m.raw.contact
    k = F.col("id").cast("bigint")
    synced = F.col("_fivetran_synced")
    changed = c.filter(k % 7 == 0)
    newer = changed.withColumn("property_lifecyclestage", F.lit("customer")).withColumn(
        "_fivetran_synced", synced + F.expr("INTERVAL 2 HOURS"))
    older = changed.withColumn("property_lifecyclestage", F.lit("lead")).withColumn(
        "_fivetran_synced", synced + F.expr("INTERVAL 1 HOURS"))
    merged = M.upsert(c, older.unionByName(newer), ["id"], "_fivetran_synced")
    return merged.select("id", "property_lifecyclestage", "property_email", "_fivetran_synced", "_archived")


def _merged(m: Models, name: str, full: DataFrame, key: str, stale: dict) -> DataFrame:
    """The stored mart, with old values inside the look-back and a column of its own, after the slice was merged into it."""
    from partnerlens.plans.refresh import INCREMENTAL

    lower = F.lit(m.cfg.as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(m.cfg.incremental_lookback_days))
    stored = full.withColumns({c: F.when(F.col("_synced_at") >= lower, v).otherwise(F.col(c)).cast(full.schema[c].dataType) for c, v in stale.items()})
    path = m.new_path(name)
    month = INCREMENTAL[name][1]
    M.write_keyed(stored.withColumn("stored_note", F.concat(F.lit("note "), F.col(key))), path, [key], by=month)
    return M.merge_into(m.spark, path, getattr(m.incremental_copy(), name), [key], by=month)


@register("partner_leads_incremental_merge")
def _a11_leads(m: Models) -> DataFrame:
    """Stored leads, stale inside the look-back, + incremental slice, merged on contact_id"""
    return _merged(m, "partner_leads", m.partner_leads, "contact_id", {"lead_status": F.lit("stale"), "reached_mql": ~F.col("reached_mql")})


@register("partner_deals_incremental_merge")
def _a11_deals(m: Models) -> DataFrame:
    """Same for partner deals on deal_id"""
    return _merged(m, "partner_deals", m.partner_deals, "deal_id", {"deal_stage": F.lit("stale"), "amount": F.lit(-1)})


# ------------------------------------------------------------------ landing
def _raw_table(name: str) -> None:
    def fn(m: Models) -> DataFrame:
        from partnerlens.sources.tables import raw

        return raw(m.spark, m.landed_root, name)

    fn.__doc__ = "A1/A2, A4-A8, L1-L12: the raw table after two landing runs"
    register(f"raw_{name}")(fn)


for _name in ("contact", "deal", "deal_stage_history", "deal_contact", "engagement", "engagement_contact", "owner", "form", "contact_form",
              "partner_customer_counts"):
    _raw_table(_name)


@register("sync_state")
def _a6(m: Models) -> DataFrame:
    """The state after both runs"""
    return M.read_keyed(m.spark, f"{m.landed_root}/_sync_state")


@register("seed_ref_partners")
def _a3(m: Models) -> DataFrame:
    """A3"""
    from partnerlens.sources.tables import seed

    return seed(m.spark, f"{m.landed_root}/ref_partners.csv", "ref_partners")


@register("seed_partner_total_customers")
def _a3_totals(m: Models) -> DataFrame:
    """A3"""
    from partnerlens.sources.tables import seed

    return seed(m.spark, f"{m.landed_root}/partner_total_customers.csv", "partner_total_customers")


@register("upsert_keeps_columns")
def _a8_columns(m: Models) -> DataFrame:
    """Changes of few columns; a null load time comes before all others; target-only columns stay"""
    c = m.raw.contact.select("id", "property_email", "property_lifecyclestage", "_fivetran_synced")
    k = F.col("id").cast("bigint")
    late = c.filter(k % 5 == 0).select("id", F.lit("late").alias("property_lifecyclestage"), "_fivetran_synced")
    unknown = c.filter(k % 5 == 0).select("id", F.lit("unknown").alias("property_lifecyclestage"), F.lit(None).cast("timestamp_ntz").alias("_fivetran_synced"))
    new = c.filter(k % 9 == 0).select(F.concat(F.lit("new-"), "id").alias("id"), F.lit("new").alias("property_lifecyclestage"), "_fivetran_synced")
    return M.upsert(c, late.unionByName(unknown).unionByName(new), ["id"], "_fivetran_synced")


@register("land_contacts")
def _l1(m: Models) -> DataFrame:
    """L1: nested contact objects -> contact rows"""
    return L.land_contacts(FX.contact_objects(m.raw.contact), m.cfg.as_of)


@register("land_stage_history")
def _l3(m: Models) -> DataFrame:
    """Stage history from nested deals (epoch-millis and ISO timestamps)"""
    return L.land_stage_history(FX.deal_objects(m.spark, m.sf_dir))


@register("land_deal_contacts")
def _l4(m: Models) -> DataFrame:
    """L4: first association is primary"""
    return L.land_deal_contacts(FX.deal_objects(m.spark, m.sf_dir))


@register("land_submissions")
def _l9(m: Models) -> DataFrame:
    """Value lists -> JSON, synthetic keys, contact resolved by email"""
    subs = L.resolve_contacts(L.land_submissions(FX.submission_objects(m.spark, m.sf_dir)), m.raw.contact)
    v = F.col("submission_values")
    return subs.select("conversion_id", "contact_id", "form_id", "submitted_at",
                       F.get_json_object(v, "$.email").alias("email"),
                       F.get_json_object(v, "$.company_size").alias("company_size"),
                       F.get_json_object(v, "$.industry").alias("industry"),
                       F.get_json_object(v, "$['']").alias("nameless"))


@register("land_deals")
def _l2(m: Models) -> DataFrame:
    """L2: nested deal objects -> deal rows"""
    return L.land_deals(FX.deal_property_objects(m.raw.deal), m.cfg.as_of)


@register("land_engagements")
def _l5(m: Models) -> DataFrame:
    """Union of five engagement object types"""
    return L.land_engagements(FX.engagement_objects(m.spark, m.sf_dir), m.cfg.as_of)


@register("land_engagement_contacts")
def _l6(m: Models) -> DataFrame:
    """L6"""
    out = None
    for objs in FX.engagement_objects(m.spark, m.sf_dir).values():
        e = L.land_engagement_contacts(objs)
        out = e if out is None else out.unionByName(e)
    return out


@register("land_owners")
def _l7(m: Models) -> DataFrame:
    """L7"""
    return L.land_owners(FX.owner_objects(m.spark, m.sf_dir))


@register("objects_modified_since")
def _a5(m: Models) -> DataFrame:
    """A5: deal objects modified in the 7 days before as_of"""
    import datetime as dt

    objs = FX.deal_property_objects(m.raw.deal)
    return L.objects_since(objs, m.cfg.as_of - dt.timedelta(days=7)).select("id", "updatedAt")


@register("land_with_archived")
def _a9(m: Models) -> DataFrame:
    """Live pass then archived pass, flagged"""
    d = m.raw.deal.select("deal_id", "property_dealstage", "_archived")
    live = d.filter(~F.col("_archived")).drop("_archived")
    archived = d.filter(F.col("_archived")).drop("_archived")
    return M.with_archived(live, archived)


@register("scalar_functions")
def _x(m: Models) -> DataFrame:
    """The scalar helpers over whole raw contacts"""
    from partnerlens.functions import columns as X

    c = m.raw.contact
    created = X.safe_cast("property_createdate", "timestamp")
    mql = X.safe_cast("property_hs_lifecyclestage_marketingqualifiedlead_date", "timestamp")
    emp = X.safe_cast("property_numberofemployees", "int")
    return c.select(
        "id",
        emp.alias("employees"),
        X.safe_cast("property_annualrevenue", "numeric").alias("revenue"),
        X.safe_cast("_archived", "bool").alias("archived"),
        X.safe_divide(X.safe_cast("property_annualrevenue", "numeric"), emp).alias("revenue_per_employee"),
        X.seconds_between(mql, created).alias("seconds_to_mql"),
        X.seconds_to_hours(X.seconds_between(mql, created)).alias("hours_to_mql"),
        X.email_domain(F.col("property_email")).alias("email_domain"),
        X.name_key(F.col("property_referring_partner")).alias("partner_key"),
        X.trimmed_or_null(F.col("property_referring_partner")).alias("partner_declared"),
        X.month_start(created).alias("created_month"),
        X.quarter_start(created).alias("created_quarter"),
        F.add_months(X.month_start(created), -11).alias("created_month_minus_11"),
        (created - F.make_dt_interval(F.lit(14))).alias("created_minus_14d"),
        X.json_value(F.to_json(F.create_map(F.lit("e"), F.col("property_email"))), "e").alias("json_roundtrip"),
    )


@register("int_attribution_evidence")
def _i5_evidence(m: Models) -> DataFrame:
    """I5a-I5e: all evidence rows before the pick"""
    from partnerlens.operators import intermediate as I

    return I.attribution_evidence(m.contacts, m.partners, m.deals, m.deal_contacts, m.form_submissions,
                                  m.contact_engagements, m.cfg)
