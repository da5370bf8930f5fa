"""Marts K1-K9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerlens.config import EngineConfig
from partnerlens.functions import columns as X
from partnerlens.operators.joins import asc_nulls_last, first_per_key
from partnerlens.operators.ranges import exact_quantile, join_null_safe, ranks_desc

FORM_META_COLS = ["form_id", "form_name", "submitted_at", "form_company_name", "form_company_size",
                  "form_num_employees", "form_industry", "form_country", "form_use_case"]


def lookback_filter(df: DataFrame, cfg: EngineConfig, ts_col: str = "_synced_at") -> DataFrame:
    """Rows loaded within the look-back window before ``as_of``."""
    lower = X.ts_literal(cfg.as_of_literal) - F.make_dt_interval(F.lit(cfg.incremental_lookback_days))
    return df.filter(F.col(ts_col) >= lower)


def form_meta_first(forms: DataFrame) -> DataFrame:
    """Earliest partner-form submission per contact, with its metadata."""
    return first_per_key(
        forms.filter(F.col("is_partner_referral_form")), ["contact_id"],
        [*asc_nulls_last(F.col("submitted_at")), F.col("submission_id")], FORM_META_COLS)


def lifecycle_flags(cfg: EngineConfig) -> dict[str, Column]:
    """MQL / SQL / disqualified flags from lifecycle stage, dates and lead status."""
    stage = F.lower("lifecycle_stage")
    t = lambda c: F.when(c, F.lit(True)).otherwise(F.lit(False))
    return {
        "reached_mql": t(stage.isin(*cfg.mql_lifecycle_values) | F.col("became_mql_at").isNotNull()),
        "reached_sql": t(stage.isin(*cfg.sql_lifecycle_values) | F.col("became_sql_at").isNotNull()),
        "is_disqualified": t(stage.isin(*cfg.disqualified_lifecycle_values)
                             | F.lower("lead_status").isin(*cfg.disqualified_lead_status_values)),
    }


def partner_leads(contacts: DataFrame, attribution: DataFrame, first_touch: DataFrame, forms: DataFrame,
                  cfg: EngineConfig, incremental: bool = False) -> DataFrame:
    """K1: one row per attributed contact."""
    c = lookback_filter(contacts, cfg) if incremental else contacts
    flags = lifecycle_flags(cfg)
    fm = form_meta_first(forms).withColumnRenamed("submitted_at", "form_submitted_at")
    created = F.col("contact_created_at")
    j = c.join(attribution, "contact_id").join(first_touch, "contact_id", "left").join(fm, "contact_id", "left")
    return j.select(
        "contact_id", "partner_id", "partner_name", "source_type", "attribution_method", "attribution_evidence_at",
        "email", "email_domain", "first_name", "last_name", "company_name", "job_title", "industry",
        "company_size_employees", "company_annual_revenue", "contact_owner_id",
        created.alias("lead_created_at"), created.cast("date").alias("lead_created_date"),
        X.month_start(created).alias("lead_created_month"), X.quarter_start(created).alias("lead_created_quarter"),
        "first_touch_at", "first_sales_touch_at",
        X.seconds_to_hours(X.seconds_between(F.col("first_sales_touch_at"), created)).alias("hours_to_first_sales_touch"),
        "lifecycle_stage", "lead_status", "became_lead_at", "became_mql_at", "became_sql_at",
        "became_opportunity_at", "became_customer_at",
        (flags["reached_mql"] | F.col("form_id").isNotNull()).alias("reached_mql"),
        flags["reached_sql"].alias("reached_sql"), flags["is_disqualified"].alias("is_disqualified"),
        "form_id", "form_name", "form_submitted_at", "form_company_name", "form_company_size",
        "form_num_employees", "form_industry", "form_country", "form_use_case",
        "original_source", "original_source_drill_down_1", "original_source_drill_down_2", "_synced_at",
    )


def deal_partner(deals: DataFrame, primary: DataFrame, attribution: DataFrame, partners: DataFrame,
                 cfg: EngineConfig) -> DataFrame:
    """The deal's partner: the deal tag first, else the primary contact's attribution."""
    pd_ = partners.select(F.col("partner_id").alias("_tag_id"), F.col("partner_name").alias("_tag_name"),
                              F.col("partner_name_key").alias("_tag_key"))
    a = attribution.select(F.col("contact_id").alias("primary_contact_id"), F.col("partner_id").alias("_a_id"),
                           F.col("partner_name").alias("_a_name"), F.col("source_type").alias("_a_type"))
    j = (
        deals.join(primary, "deal_id", "left")
        .join(a, "primary_contact_id", "left")
        .join(pd_, X.name_key(F.col("referring_partner_deal")) == F.col("_tag_key"), "left")
    )
    sourced = F.col("is_partner_sourced_deal")
    return j.select(
        "*",
        F.coalesce("_tag_id", "_a_id").alias("partner_id"),
        F.coalesce("_tag_name", "referring_partner_deal", "_a_name").alias("partner_name"),
        F.coalesce(F.when(sourced, F.lit("partner_email")), F.col("_a_type")).alias("source_type"),
        F.when(sourced & F.col("referring_partner_deal").isNotNull(), F.lit("deal_referring_partner"))
        .when(F.col("_a_name").isNotNull(), F.lit("contact_attribution")).alias("partner_attribution_origin"),
    ).drop("_tag_id", "_tag_name", "_tag_key", "_a_id", "_a_name", "_a_type")


def partner_deals(deals: DataFrame, primary: DataFrame, attribution: DataFrame, partners: DataFrame,
                  contacts: DataFrame, owners: DataFrame, touches_fn, cfg: EngineConfig,
                  incremental: bool = False) -> DataFrame:
    """K2: one row per deal with a resolved partner.

    ``touches_fn(deals)`` computes I3 for the given deals; it is handed the
    partner deals only, so the touch counting never runs for other deals.
    """
    as_of = X.ts_literal(cfg.as_of_literal)
    d = lookback_filter(deals, cfg) if incremental else deals
    dp = deal_partner(d, primary, attribution, partners, cfg).filter(F.col("partner_name").isNotNull())
    touches = touches_fn(dp.select("deal_id", "deal_created_at", "deal_close_date"))
    o = owners.select(F.col("owner_id").alias("deal_owner_id"), F.col("owner_name").alias("deal_owner_name"),
                          F.col("owner_email").alias("deal_owner_email"), F.col("owner_team_id").alias("deal_owner_team_id"))
    c = contacts.select(F.col("contact_id").alias("primary_contact_id"), "contact_created_at")
    j = dp.join(c, "primary_contact_id", "left").join(touches, "deal_id", "left").join(o, "deal_owner_id", "left")
    created, close = F.col("deal_created_at"), F.col("deal_close_date")
    return j.select(
        "deal_id", F.col("primary_contact_id").alias("contact_id"), "partner_id", "partner_name", "source_type",
        "partner_attribution_origin", "deal_name", "pipeline_id", "deal_stage", "deal_stage_probability", "deal_type",
        "amount", "amount_home_currency",
        created.alias("deal_created_at"), created.cast("date").alias("deal_created_date"),
        X.month_start(created).alias("deal_created_month"), X.quarter_start(created).alias("deal_created_quarter"),
        close.alias("deal_close_date"), close.cast("date").alias("deal_close_date_d"),
        X.month_start(close).alias("deal_close_month"), X.quarter_start(close).alias("deal_close_quarter"),
        "deal_closed_won_at", "contact_created_at", "is_closed_won", "is_closed", "deal_status",
        X.safe_divide(X.seconds_between(created, F.col("contact_created_at")), F.lit(86400.0)).alias("days_contact_to_deal"),
        X.safe_divide(X.seconds_between(F.coalesce("deal_closed_won_at", "deal_close_date", as_of), created),
                      F.lit(86400.0)).alias("time_to_close_days"),
        F.col("total_touches").alias("sales_touches_total"), F.col("outbound_emails").alias("sales_outbound_emails"),
        F.col("calls").alias("sales_calls"), F.col("meetings").alias("sales_meetings"),
        "deal_owner_id", "deal_owner_name", "deal_owner_email", "deal_owner_team_id", "_synced_at",
    )


def canonical_partner_names(df: DataFrame, partners: DataFrame, cfg: EngineConfig) -> DataFrame:
    """V7 fix before aggregating: a known partner id always carries its listed name."""
    p = partners.select("partner_id", F.col("partner_name").alias("_listed_name"))
    return (df.join(p, "partner_id", "left")
            .withColumn("partner_name", F.coalesce("_listed_name", "partner_name")).drop("_listed_name"))


def deal_stage_durations(pdeals: DataFrame, durations: DataFrame) -> DataFrame:
    """K3: stage durations of partner deals."""
    return pdeals.select("partner_id", "partner_name", "deal_id", "deal_status", "is_closed_won", "amount").join(
        durations, "deal_id").select(
        "partner_id", "partner_name", "deal_id", "deal_stage", "times_entered", "total_seconds_in_stage",
        "total_days_in_stage", "first_entered_at", "last_exited_at", "deal_status", "is_closed_won", "amount")


def funnel(pdeals_canon: DataFrame, durations: DataFrame, cfg: EngineConfig, spark=None) -> DataFrame:
    """K4: per partner x ordered stage: entered, advanced, won, next stage, rates.

    Per-stage rows of one deal are unique (I4's grain), so the reference's
    distinct counts are plain conditional counts; the deal's furthest stage is a window max on the
    (partner, deal) partition, which the following aggregation reuses.
    """
    spark = spark or pdeals_canon.sparkSession
    # The stage order is configuration (a handful of rows), so broadcasting it is bounded.
    order = F.broadcast(spark.createDataFrame(
        [(s, i + 1) for i, s in enumerate(cfg.deal_stage_order)], "stage_name string, stage_order int"))
    entries = (
        pdeals_canon.filter(F.col("partner_id").isNotNull()).select("partner_id", "partner_name", "deal_id", "is_closed_won")
        .join(durations.select("deal_id", F.lower("deal_stage").alias("deal_stage")), "deal_id")
        .join(order, F.col("deal_stage") == F.col("stage_name"))
        .withColumn("max_stage_order", F.max("stage_order").over(Window.partitionBy("partner_id", "deal_id")))
    )
    g = entries.groupBy("partner_id", "partner_name", "deal_stage", "stage_order").agg(
        F.count("deal_id").alias("deals_entered"),
        F.count_if(F.col("max_stage_order") > F.col("stage_order")).alias("deals_advanced"),
        F.count_if(F.col("is_closed_won")).alias("deals_closed_won"),
        F.count_if(F.col("max_stage_order") >= F.col("stage_order") + 1).alias("deals_entered_next_stage"),
    )
    next_rate = X.safe_divide(F.col("deals_entered_next_stage"), F.col("deals_entered"))
    return g.select(
        "partner_id", "partner_name", "deal_stage", "stage_order", "deals_entered", "deals_advanced", "deals_closed_won",
        X.safe_divide(F.col("deals_advanced"), F.col("deals_entered")).alias("stage_conversion_rate"),
        X.safe_divide(F.col("deals_closed_won"), F.col("deals_entered")).alias("stage_to_won_rate"),
        "deals_entered_next_stage", next_rate.alias("next_stage_conversion_rate"), (F.lit(1.0) - next_rate).alias("drop_off_rate"),
    )


def lead_cohorts(leads: DataFrame, pdeals_canon: DataFrame) -> DataFrame:
    """K5: partner x lead month cohorts.

    Deals are first rolled up per contact, so the lead side joins 1:1 and no
    (lead, deal) pair list is built even for contacts with many deals.
    """
    won = F.col("is_closed_won")
    per_contact = pdeals_canon.filter(F.col("partner_id").isNotNull() & F.col("contact_id").isNotNull()).groupBy("contact_id").agg(
        F.count("deal_id").alias("_deals"),
        F.count(F.when(won, F.col("deal_id"))).alias("_won"),
        F.sum(F.when(won, F.col("amount")).otherwise(F.lit(0))).alias("_rev"),
        F.sum(F.when(won, F.col("time_to_close_days"))).alias("_cyc_sum"),
        F.count(F.when(won, F.col("time_to_close_days"))).alias("_cyc_n"),
    )
    j = leads.filter(F.col("partner_id").isNotNull()).join(per_contact, "contact_id", "left")
    rev = F.when(F.col("_deals").isNull(), F.lit(0)).otherwise(F.col("_rev"))
    return j.groupBy("partner_id", "partner_name", F.col("lead_created_month").alias("cohort_month")).agg(
        F.count("contact_id").alias("cohort_leads"),
        F.count_if(F.col("reached_mql")).alias("cohort_mqls"),
        F.count_if(F.col("reached_sql")).alias("cohort_sqls"),
        F.coalesce(F.sum("_deals"), F.lit(0)).alias("cohort_deals"),
        F.coalesce(F.sum("_won"), F.lit(0)).alias("cohort_won_deals"),
        F.sum(rev).alias("cohort_won_revenue"),
        (F.sum("_cyc_sum") / F.sum("_cyc_n")).alias("cohort_avg_cycle_days"),
    )


def penetration(totals: DataFrame, pdeals_canon: DataFrame) -> DataFrame:
    """K6: our distinct won customers / the partner's total, per partner and date."""
    customer = F.coalesce(F.nullif(F.lower(F.trim("deal_name")), F.lit("")), F.col("contact_id").cast("string"))
    ours = pdeals_canon.filter(F.col("is_closed_won") & F.col("partner_id").isNotNull()).groupBy("partner_id").agg(
        F.count_distinct(customer).alias("our_customer_count"), F.min("deal_closed_won_at").alias("our_first_won_at"))
    j = totals.join(ours, "partner_id", "left")
    ours_n = F.coalesce(F.col("our_customer_count"), F.lit(0).cast("bigint"))
    return j.select("partner_id", "partner_name", "as_of_date", "total_customer_count", ours_n.alias("our_customer_count"),
                    X.safe_divide(ours_n, F.col("total_customer_count")).alias("penetration_rate"), "our_first_won_at")


def rep_performance(pdeals_canon: DataFrame) -> DataFrame:
    """K7: partner x owner deal outcomes; a null owner is its own group."""
    won, closed = F.col("is_closed_won"), F.col("is_closed")
    return pdeals_canon.filter(F.col("partner_id").isNotNull()).groupBy("partner_id", "deal_owner_id").agg(
        F.max("partner_name").alias("partner_name"),
        F.max("deal_owner_name").alias("deal_owner_name"),
        F.max("deal_owner_email").alias("deal_owner_email"),
        F.count("deal_id").alias("deals_total"),
        F.count_if(won).alias("deals_won"),
        F.count_if(closed & ~won).alias("deals_lost"),
        F.count_if(~closed).alias("deals_open"),
        X.safe_divide(F.count_if(won), F.count("deal_id")).alias("win_rate"),
        F.sum(F.when(won, F.col("amount")).otherwise(F.lit(0))).alias("revenue_closed_won"),
        F.avg(F.when(won, F.col("amount").cast("double"))).alias("avg_deal_size"),
        F.avg(F.when(won, F.col("time_to_close_days"))).alias("avg_cycle_days"),
        F.avg(F.when(won, F.col("sales_touches_total"))).alias("avg_sales_touches"),
    ).select("partner_id", "partner_name", "deal_owner_id", "deal_owner_name", "deal_owner_email", "deals_total",
             "deals_won", "deals_lost", "deals_open", "win_rate", "revenue_closed_won", "avg_deal_size",
             "avg_cycle_days", "avg_sales_touches")


def rep_performance_all(reps: DataFrame) -> DataFrame:
    """Any-partner roll-up of K7 per owner."""
    return reps.groupBy("deal_owner_id", "deal_owner_name").agg(
        F.sum("deals_total").alias("deals_total"), F.sum("deals_won").alias("deals_won"),
        F.sum("deals_lost").alias("deals_lost"), F.sum("deals_open").alias("deals_open"),
        F.sum("revenue_closed_won").alias("revenue_closed_won"),
    ).withColumn("win_rate", X.safe_divide(F.col("deals_won"), F.col("deals_total")))


# ---------------------------------------------------------------- K8 summary

PERIOD_KEYS = ["partner_id", "period_type", "period_start_date"]


def explode_periods(df: DataFrame, month_col: str, quarter_col: str, keep_null_dates: bool = False) -> DataFrame:
    """One row per (fact, period): month, quarter and all_time.

    Replaces the reference's join on ``all_time OR month = .. OR quarter = ..``
    (a nested-loop join in Spark) with an equi-grouping key. Month and quarter
    entries with a null date are dropped unless ``keep_null_dates`` (the spine
    keeps them, the metrics do not: a null date never equals a period).
    """
    periods = F.array(
        F.struct(F.lit("month").alias("period_type"), F.col(month_col).alias("period_start_date")),
        F.struct(F.lit("quarter").alias("period_type"), F.col(quarter_col).alias("period_start_date")),
        F.struct(F.lit("all_time").alias("period_type"), F.lit(None).cast("date").alias("period_start_date")),
    )
    out = df.withColumn("_p", F.explode(periods)).select("*", "_p.period_type", "_p.period_start_date").drop("_p")
    if not keep_null_dates:
        out = out.filter((F.col("period_type") == "all_time") | F.col("period_start_date").isNotNull())
    return out


def period_facts(leads: DataFrame, deals: DataFrame) -> DataFrame:
    """What K8 sums, at the grain of months: one read of the leads and one of the deals.

    A row holds one partner's leads of a month (kind ``lead``), the deals it
    created (``created``) or those it closed, won ones by amount (``closed``).
    Counts and sums add up to quarters and all time; averages are kept as sum
    and count, and the won amounts with their counts are a histogram that adds
    up too. Facts without a date have null month and quarter.
    """
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    total = lambda c: F.sum(F.col(c).cast("double"))
    lead = leads.filter(F.col("partner_id").isNotNull()).groupBy(
        "partner_id", F.lit("lead").alias("kind"), F.col("lead_created_month").alias("month"), F.col("lead_created_quarter").alias("quarter")).agg(
        F.max("partner_name").alias("partner_name"), F.count("contact_id").alias("total_leads"),
        n(F.col("source_type") == "partner_email").alias("leads_from_partner_email"), n(F.col("source_type") == "form").alias("leads_from_form"),
        n(F.col("reached_mql")).alias("leads_reached_mql"), n(F.col("reached_sql")).alias("leads_reached_sql"),
        n(F.col("is_disqualified")).alias("leads_disqualified"),
        total("hours_to_first_sales_touch").alias("hours_sum"), F.count("hours_to_first_sales_touch").alias("hours_n"))

    won = F.coalesce(F.col("is_closed_won"), F.lit(False))
    moments = F.array(
        F.struct(F.lit("created").alias("kind"), F.col("deal_created_month").alias("month"), F.col("deal_created_quarter").alias("quarter")),
        F.struct(F.lit("closed").alias("kind"), F.col("deal_close_month").alias("month"), F.col("deal_close_quarter").alias("quarter")))
    dated = deals.filter(F.col("partner_id").isNotNull()).select(
        "partner_id", "partner_name", "deal_id", won.alias("won"), (F.col("is_closed") & ~F.col("is_closed_won")).alias("lost"), "amount",
        "days_contact_to_deal", "time_to_close_days", "sales_touches_total", F.explode(moments).alias("_m")).select("*", "_m.*").drop("_m")
    created, closed = F.col("kind") == "created", F.col("kind") == "closed"
    only = lambda cond, c: F.when(cond, F.col(c))
    cycle, touches, days = (only(closed & F.col("won"), "time_to_close_days"), only(closed & F.col("won"), "sales_touches_total"),
                            only(created, "days_contact_to_deal"))
    deal = dated.groupBy("partner_id", "kind", "month", "quarter", only(closed & F.col("won"), "amount").alias("won_amount")).agg(
        F.max("partner_name").alias("partner_name"),
        F.count(only(created, "deal_id")).alias("total_deals_created"),
        F.sum(days.cast("double")).alias("days_sum"), F.count(days).alias("days_n"),
        n(closed & F.col("won")).alias("deals_closed_won"), n(closed & F.col("lost")).alias("deals_closed_lost"),
        F.sum(F.when(closed, F.when(F.col("won"), F.col("amount")).otherwise(F.lit(0)))).alias("revenue_closed_won"),
        F.sum(cycle.cast("double")).alias("cycle_sum"), F.count(cycle).alias("cycle_n"),
        F.sum(touches.cast("double")).alias("touches_sum"), F.count(touches).alias("touches_n"))
    return lead.unionByName(deal, allowMissingColumns=True)


_COUNTS = ["total_leads", "leads_from_partner_email", "leads_from_form", "leads_reached_mql", "leads_reached_sql", "leads_disqualified",
           "total_deals_created", "deals_closed_won", "deals_closed_lost"]
_MEANS = {"avg_hours_to_first_sales_touch": "hours", "avg_days_contact_to_deal": "days", "avg_deal_cycle_days": "cycle", "avg_sales_touches_to_close": "touches"}


def summary(facts: DataFrame, partners: DataFrame, penetration_df: DataFrame) -> DataFrame:
    """K8: partner x (month, quarter, all_time) KPI table, rolled up from :func:`period_facts`.

    K8a: a row for every (partner, period) that has a lead or a deal, and
    all_time for every listed partner. Leads and creations without a date have a
    month and a quarter row too (of null date), which count nothing, as a null
    date never equals a period.
    """
    kept = explode_periods(facts, "month", "quarter", keep_null_dates=True).filter(
        (F.col("kind") != "closed") | (F.col("period_type") == "all_time") | F.col("period_start_date").isNotNull())
    counts = (F.col("period_type") == "all_time") | F.col("period_start_date").isNotNull()
    sums = [*_COUNTS, "revenue_closed_won", *[f"{m}_{x}" for m in _MEANS.values() for x in ("sum", "n")]]
    amount = F.col("won_amount").cast("double") * F.col("deals_closed_won")
    kept = kept.select(*PERIOD_KEYS, "partner_name", "won_amount", *[F.when(counts, F.col(c)).alias(c) for c in sums],
                       F.when(counts, amount).alias("amount_sum"), F.when(counts & F.col("won_amount").isNotNull(), F.col("deals_closed_won")).alias("amount_n"),
                       (counts & (F.col("kind") == "closed")).alias("_close_hit"))
    listed = partners.select("partner_id", "partner_name", F.lit("all_time").alias("period_type"), F.lit(None).cast("date").alias("period_start_date"))
    j = kept.unionByName(listed, allowMissingColumns=True).groupBy(*PERIOD_KEYS).agg(
        F.max("partner_name").alias("partner_name"), F.max("_close_hit").alias("_close_hit"),
        *[F.sum(c).alias(c) for c in [*sums, "amount_sum", "amount_n"]])
    j = j.withColumns({**{name: X.safe_divide(F.col(f"{m}_sum"), F.col(f"{m}_n")) for name, m in _MEANS.items()},
                       "avg_deal_size": X.safe_divide(F.col("amount_sum"), F.col("amount_n")),
                       "revenue_closed_won": F.col("revenue_closed_won").cast("decimal(28,2)")})
    median_m = exact_quantile(kept.filter("won_amount is not null and amount_n > 0"), PERIOD_KEYS, "won_amount", "median_deal_size", weight="amount_n")
    j = join_null_safe(j, median_m, PERIOD_KEYS, "left")
    zero = F.lit(0).cast("bigint")
    leads_n = F.coalesce("total_leads", zero)
    deals_n = F.coalesce("total_deals_created", zero)
    won_n = F.coalesce("deals_closed_won", zero)
    # A period with no close facts sums to 0 (the reference's "else 0" over a null-extended row).
    revenue = F.when(~F.coalesce("_close_hit", F.lit(False)), F.lit(0).cast("decimal(28,2)")).otherwise(F.col("revenue_closed_won"))
    j = j.withColumn("_leads", leads_n).withColumn("_deals", deals_n).withColumn("_won", won_n).withColumn("_rev", revenue)

    # Totals per period over all partners, from the same month rows, summed in part before the shuffle and joined back.
    period = ["period_type", "period_start_date"]
    totals = kept.groupBy(*period).agg(
        F.sum("total_leads").alias("all_partners_leads"), F.sum("total_deals_created").alias("all_partners_deals"),
        F.sum("revenue_closed_won").alias("all_partners_revenue"))
    j = join_null_safe(j, totals, period, "left")

    lp = penetration_df.groupBy("partner_id").agg(
        F.max_by(F.struct("partner_name", "penetration_rate", "total_customer_count", "our_customer_count"),
                 F.col("as_of_date")).alias("_lp"))
    lp = lp.select(F.col("partner_id").alias("_lp_pid"), F.col("_lp.partner_name").alias("_lp_name"),
                   F.col("_lp.penetration_rate").alias("partner_penetration_rate"),
                   F.col("_lp.total_customer_count").alias("partner_total_customers"),
                   F.col("_lp.our_customer_count").alias("our_customers_at_partner"))
    j = j.join(lp, (F.col("partner_id") == F.col("_lp_pid")) & F.col("partner_name").eqNullSafe(F.col("_lp_name")), "left")

    sd = X.safe_divide
    return j.select(
        "partner_id", "partner_name", "period_type", "period_start_date",
        F.col("_leads").alias("total_leads"),
        F.coalesce("leads_from_partner_email", zero).alias("leads_from_partner_email"),
        F.coalesce("leads_from_form", zero).alias("leads_from_form"),
        F.coalesce("leads_reached_mql", zero).alias("leads_reached_mql"),
        F.coalesce("leads_reached_sql", zero).alias("leads_reached_sql"),
        F.coalesce("leads_disqualified", zero).alias("leads_disqualified"),
        sd(F.coalesce("leads_reached_mql", zero), F.col("_leads")).alias("mql_rate"),
        sd(F.coalesce("leads_reached_sql", zero), F.col("_leads")).alias("sql_rate"),
        sd(F.coalesce("leads_disqualified", zero), F.col("_leads")).alias("disqualified_rate"),
        F.col("_deals").alias("total_deals_created"),
        sd(F.col("_deals"), F.col("_leads")).alias("lead_to_deal_rate"),
        F.col("_won").alias("deals_closed_won"),
        F.coalesce("deals_closed_lost", zero).alias("deals_closed_lost"),
        sd(F.col("_won"), F.col("_deals")).alias("deal_to_won_rate"),
        sd(F.col("_won"), F.col("_leads")).alias("lead_to_won_rate"),
        "avg_hours_to_first_sales_touch", "avg_days_contact_to_deal", "avg_deal_cycle_days", "avg_sales_touches_to_close",
        F.coalesce(F.col("_rev"), F.lit(0).cast("decimal(28,2)")).alias("revenue_closed_won"),
        "avg_deal_size", "median_deal_size",
        sd(F.col("_rev"), F.col("_leads")).alias("revenue_per_lead"),
        sd(F.col("_rev"), F.col("_won")).alias("revenue_per_closed_won_deal"),
        sd(F.col("_leads"), F.col("all_partners_leads")).alias("share_of_total_leads"),
        sd(F.col("_deals"), F.col("all_partners_deals")).alias("share_of_total_deals"),
        sd(F.col("_rev"), F.col("all_partners_revenue")).alias("share_of_total_revenue"),
        "partner_total_customers", "our_customers_at_partner", "partner_penetration_rate",
    )


def rankings(summary_df: DataFrame) -> DataFrame:
    """K9: all_time leaderboard: 4 ranks, median cut-points, quadrant, flags.

    Ranks come from counts by value range (:func:`ranks_desc`), so no task ranks
    all partners; the cross join is with one row of cut-points.
    """
    base = summary_df.filter(F.col("period_type") == "all_time").select(
        "partner_id", "partner_name", "total_leads", "total_deals_created", "deals_closed_won", "revenue_closed_won",
        "deal_to_won_rate", "lead_to_won_rate", "revenue_per_lead", "avg_deal_size", "mql_rate", "sql_rate",
        "partner_penetration_rate")
    cut = base.agg(F.median("total_leads").alias("median_leads"),
                   F.median("lead_to_won_rate").alias("median_lead_to_won_rate"))
    j = base.crossJoin(F.broadcast(cut))  # one-row cut-points
    tl, ltw = F.col("total_leads"), F.col("lead_to_won_rate")
    ml, mr = F.col("median_leads"), F.col("median_lead_to_won_rate")
    quadrant = (
        F.when((tl >= ml) & (ltw >= mr), F.lit("high_volume_high_conversion"))
        .when((tl >= ml) & (ltw < mr), F.lit("high_volume_low_conversion"))
        .when((tl < ml) & (ltw >= mr), F.lit("low_volume_high_conversion"))
        .otherwise(F.lit("low_volume_low_conversion"))
    )
    ranks = {"revenue_closed_won": "rank_by_revenue", "deal_to_won_rate": "rank_by_close_rate", "revenue_per_lead": "rank_by_revenue_per_lead",
             "total_leads": "rank_by_lead_volume"}
    ranked = join_null_safe(j, ranks_desc(base, "partner_id", ranks), ["partner_id"]).select(
        *j.columns, *ranks.values(), quadrant.alias("volume_efficiency_quadrant"))
    t = lambda c: F.when(c, F.lit(True)).otherwise(F.lit(False))
    q = F.col("volume_efficiency_quadrant")
    return ranked.select(
        "*",
        t((F.col("rank_by_revenue") <= 5) | (q == "high_volume_high_conversion")).alias("is_top_performer"),
        t(q == "low_volume_high_conversion").alias("is_high_potential"),
        t((tl >= ml) & (ltw < mr / 2)).alias("is_underperformer"),
    )
