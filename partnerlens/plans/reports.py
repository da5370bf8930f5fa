"""Dashboard report queries Q1-Q15 and documented chart queries D1-D11.

Every function reads the stored marts (or the model graph) and returns a
DataFrame; a ``partner_id`` of ``None`` means "all partners" (one query for
every partner instead of one request per partner).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerlens.functions import columns as X
from partnerlens.operators.ranges import exact_quantile

PERIODS = ("all", "ytd", "last_12m", "qtd", "mtd")


def _for_partner(df: DataFrame, partner_id: str | None) -> DataFrame:
    return df if partner_id is None else df.filter(F.col("partner_id") == F.lit(partner_id))


def q_rankings(rankings: DataFrame) -> DataFrame:
    """Q1: leaderboard rows ordered by revenue rank."""
    return rankings.select(
        "partner_id", "partner_name", "total_leads", "deals_closed_won", "revenue_closed_won", "deal_to_won_rate",
        "lead_to_won_rate", "revenue_per_lead", "mql_rate", "volume_efficiency_quadrant", "rank_by_revenue",
        "is_top_performer", "is_high_potential", "is_underperformer", "partner_penetration_rate",
    ).orderBy("rank_by_revenue")


def period_predicate(period: str, as_of: dt.datetime) -> Column:
    """Q2: summary rows a report period covers (open-ended ranges as in the dashboard)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    start = F.col("period_start_date")
    month_rows = F.col("period_type") == "month"
    if period == "all":
        return F.col("period_type") == "all_time"
    if period == "ytd":
        return month_rows & (start >= X.year_start(now))
    if period == "last_12m":
        return month_rows & (start >= F.add_months(X.month_start(now), -11))
    if period == "qtd":
        return month_rows & (start >= X.quarter_start(now))
    if period == "mtd":
        return month_rows & (start == X.month_start(now))
    raise ValueError(f"unknown period {period!r}; expected one of {PERIODS}")


def normalize_period(value: str | None) -> str:
    return value if value in PERIODS else "all"


def q_totals(summary: DataFrame, period: str, as_of: dt.datetime) -> DataFrame:
    """Q3/Q4: headline totals for a period; missing sums are 0."""
    period = normalize_period(period)
    rows = summary.filter(period_predicate(period, as_of))
    active = (F.col("total_leads") > 0) | (F.col("total_deals_created") > 0) | (F.col("deals_closed_won") > 0)
    z = lambda c: F.coalesce(c, F.lit(0))
    return rows.agg(
        z(F.sum("total_leads")).cast("bigint").alias("total_leads"),
        z(F.sum("leads_reached_mql")).cast("bigint").alias("total_mql"),
        z(F.sum("leads_reached_sql")).cast("bigint").alias("total_sql"),
        z(F.sum("deals_closed_won")).cast("bigint").alias("deals_won"),
        z(F.sum("total_deals_created")).cast("bigint").alias("deals_total"),
        z(F.sum("revenue_closed_won")).alias("revenue"),
        F.count_distinct(F.when(active, F.col("partner_id"))).cast("bigint").alias("partners_active"),
    ).select(F.lit(period).alias("period"), "*")


def q_totals_all_periods(summary: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q2-Q4 for every period at once (one row per period)."""
    out = None
    for p in PERIODS:
        t = q_totals(summary, p, as_of)
        out = t if out is None else out.unionByName(t)
    return out


def q_kpis(totals: DataFrame) -> DataFrame:
    """MQL rate and lead-to-won rate from the totals."""
    return totals.select(
        "period",
        X.safe_divide(F.col("total_mql"), F.col("total_leads")).alias("mql_rate"),
        X.safe_divide(F.col("deals_won"), F.col("total_leads")).alias("lead_to_won_rate"),
    )


def q_monthly(summary: DataFrame, partner_id: str | None = None, by_partner: bool = False) -> DataFrame:
    """Q5: monthly series of one partner, of every partner (``by_partner``), or summed over all."""
    months = summary.filter((F.col("period_type") == "month"))
    if partner_id is not None or by_partner:
        return _for_partner(months, partner_id).select(
            "partner_id", "period_start_date", "total_leads", "deals_closed_won", "revenue_closed_won"
        ).orderBy("partner_id", F.col("period_start_date").asc_nulls_last())
    return months.groupBy("period_start_date").agg(
        F.sum("total_leads").cast("bigint").alias("total_leads"),
        F.sum("deals_closed_won").cast("bigint").alias("deals_closed_won"),
        F.sum("revenue_closed_won").alias("revenue_closed_won"),
    ).orderBy(F.col("period_start_date").asc_nulls_last())


def q_partner_all_time(summary: DataFrame, partner_id: str | None = None) -> DataFrame:
    """Q6: the all_time row of a partner (of every partner when ``None``)."""
    df = _for_partner(summary.filter(F.col("period_type") == "all_time"), partner_id).select(
        "partner_id", "partner_name", "period_type", "period_start_date", "total_leads", "leads_reached_mql",
        "leads_reached_sql", "deals_closed_won", "revenue_closed_won", "mql_rate", "sql_rate", "deal_to_won_rate",
        "lead_to_won_rate", "avg_deal_cycle_days", "partner_penetration_rate")
    return df.limit(1) if partner_id is not None else df


def q_funnel(funnel: DataFrame, partner_id: str | None = None) -> DataFrame:
    """Q7: funnel rows in stage order."""
    return _for_partner(funnel, partner_id).select(
        "partner_id", "deal_stage", "stage_order", "deals_entered", "deals_advanced", "deals_closed_won",
        "stage_conversion_rate", "stage_to_won_rate", "next_stage_conversion_rate", "drop_off_rate",
    ).orderBy("partner_id", "stage_order")


def q_reps(reps: DataFrame, partner_id: str | None = None) -> DataFrame:
    """Q8: reps of a partner by revenue, nulls last."""
    return _for_partner(reps, partner_id).select(
        "partner_id", "deal_owner_id", "deal_owner_name", "deal_owner_email", "deals_total", "deals_won", "deals_lost",
        "deals_open", "win_rate", "revenue_closed_won", "avg_deal_size", "avg_cycle_days",
    ).orderBy("partner_id", F.col("revenue_closed_won").desc_nulls_last())


def deal_status_class(won: Column, closed: Column) -> Column:
    return F.when(won, F.lit(0)).when(~closed, F.lit(1)).otherwise(F.lit(2))


def q_deals(pdeals: DataFrame, partner_id: str | None = None, closed: bool | None = None) -> DataFrame:
    """A partner's deals, won then open then lost, latest first (O3)."""
    df = _for_partner(pdeals, partner_id)
    if closed is not None:
        df = df.filter(F.coalesce("is_closed", F.lit(False)) == closed)
    latest = F.coalesce("deal_closed_won_at", "deal_close_date", "deal_created_at")
    return df.select(
        "partner_id", "deal_id", "deal_name", "deal_stage", "deal_status", "amount", "deal_owner_name", "deal_owner_email",
        "deal_created_at", "deal_close_date", "deal_closed_won_at", "is_closed_won", "is_closed", "source_type",
        "time_to_close_days", "sales_touches_total",
        deal_status_class(F.col("is_closed_won"), F.col("is_closed")).alias("status_class"),
    ).orderBy("partner_id", "status_class", latest.desc_nulls_last(), "deal_id")


def q_form_submissions(forms: DataFrame, contacts: DataFrame, contact_eng: DataFrame,
                       pdeals: DataFrame, leads: DataFrame) -> DataFrame:
    """Q10: partner-form submissions with the contact's first call and first partner deal."""
    subs = forms.filter(F.col("is_partner_referral_form")).select("submission_id", "contact_id", "form_name", "submitted_at")
    first_call = contact_eng.filter(F.col("engagement_type").isin("meeting", "call")).groupBy("contact_id").agg(
        F.min("engaged_at").alias("first_call_at"))
    # First deal per contact, earliest creation (nulls last), ties on deal_id.
    fd_cols = ["deal_id", "deal_name", "deal_created_at", "deal_stage", "deal_status", "amount", "is_closed_won",
               "deal_closed_won_at", "partner_name"]
    first_deal = pdeals.filter(F.col("contact_id").isNotNull()).groupBy("contact_id").agg(
        F.min(F.struct(F.col("deal_created_at").isNull().alias("_n"), F.col("deal_created_at").alias("_t"),
                       F.col("deal_id").alias("_id"), *[F.col(c) for c in fd_cols])).alias("_fd"))
    first_deal = first_deal.select("contact_id", *[F.col(f"_fd.{c}").alias(c if c != "partner_name" else "_fd_partner")
                                                   for c in fd_cols])
    c = contacts.select("contact_id", F.col("email").alias("contact_email"), F.col("first_name").alias("contact_first_name"),
                        F.col("last_name").alias("contact_last_name"), "company_name")
    pl = leads.select("contact_id", F.col("partner_name").alias("_lead_partner"))
    j = subs.join(c, "contact_id", "left").join(first_call, "contact_id", "left") \
        .join(first_deal, "contact_id", "left").join(pl, "contact_id", "left")
    return j.select(
        "submission_id", "submitted_at", "form_name", "contact_id", "contact_email", "contact_first_name",
        "contact_last_name", "company_name", F.coalesce("_fd_partner", "_lead_partner").alias("partner_name"),
        "first_call_at", "deal_id", "deal_name", "deal_created_at", "deal_stage", "deal_status", "amount",
        "is_closed_won", "deal_closed_won_at",
    )


def q_form_velocity(subs: DataFrame) -> DataFrame:
    """Lead label and form -> call -> deal velocity in days (null when missing or negative)."""
    name = F.nullif(F.concat_ws(" ", F.nullif("contact_first_name", F.lit("")), F.nullif("contact_last_name", F.lit(""))),
                    F.lit(""))
    return subs.select(
        "submission_id", "submitted_at", "partner_name", "deal_id", "deal_status",
        F.coalesce(F.nullif("company_name", F.lit("")), name, F.nullif("contact_email", F.lit("")), F.lit("—")).alias("lead_label"),
        X.days_between_nonneg(F.col("first_call_at"), F.col("submitted_at")).alias("form_to_call_days"),
        X.days_between_nonneg(F.col("deal_created_at"), F.col("first_call_at")).alias("call_to_deal_days"),
        X.days_between_nonneg(F.col("deal_created_at"), F.col("submitted_at")).alias("form_to_deal_days"),
    ).orderBy(F.col("submitted_at").desc_nulls_last(), "submission_id")


def q_partner_list(summary: DataFrame) -> DataFrame:
    """Q11: distinct partners of the all_time rows, by name."""
    return summary.filter(F.col("period_type") == "all_time").select("partner_id", "partner_name").distinct() \
        .orderBy(F.col("partner_name").asc_nulls_last())


def q_partner_counts(partners: DataFrame, app_counts: DataFrame) -> DataFrame:
    """Q12: every listed partner with its latest hand-entered customer count."""
    latest = app_counts.groupBy("partner_id").agg(
        F.max_by(F.struct("as_of_date", "total_customer_count"), F.col("as_of_date")).alias("_l"))
    latest = latest.select("partner_id", F.col("_l.total_customer_count").alias("latest_customer_count"),
                           F.col("_l.as_of_date").cast("string").alias("latest_as_of_date"))
    return partners.select("partner_id", "partner_name", "partner_domain", "partner_tier",
                           F.col("partner_start_date").cast("string").alias("partner_start_date")) \
        .join(latest, "partner_id", "left").orderBy(F.col("partner_name").asc_nulls_last())


def q_count_history(app_counts: DataFrame, partner_id: str | None = None) -> DataFrame:
    """Q13: count entries of a partner, newest first."""
    return _for_partner(app_counts, partner_id).select(
        "partner_id", F.col("as_of_date").cast("string").alias("as_of_date"), "total_customer_count", "notes",
    ).orderBy("partner_id", F.col("as_of_date").desc_nulls_last())


def q_top_revenue(rankings: DataFrame, n: int = 10) -> DataFrame:
    """Top n partners by revenue (a top-k report: the limit is the feature)."""
    rev = F.coalesce(F.col("revenue_closed_won"), F.lit(0))
    return rankings.select("partner_id", "partner_name", "revenue_closed_won") \
        .orderBy(rev.desc(), "partner_id").limit(n)


def q_quadrant(rankings: DataFrame) -> DataFrame:
    """Q15: scatter data; a null lead-to-won rate plots at 0."""
    return rankings.select("partner_id", "partner_name", "total_leads",
                           F.coalesce("lead_to_won_rate", F.lit(0.0)).alias("lead_to_won_rate"),
                           "revenue_closed_won", "volume_efficiency_quadrant")


# ------------------------------------------------------------ chart queries

def d_leads_by_month_source(leads: DataFrame) -> DataFrame:
    """Leads per month and source type."""
    return leads.filter(F.col("partner_id").isNotNull()).groupBy("lead_created_month", "source_type").agg(
        F.count_distinct("contact_id").alias("leads"))


def d_drop_off_callout(funnel: DataFrame) -> DataFrame:
    """Per partner, the stage with the greatest drop-off (ties: earliest stage)."""
    return funnel.filter(F.col("drop_off_rate").isNotNull()).groupBy("partner_id").agg(
        F.min(F.struct((-F.col("drop_off_rate")).alias("_d"), F.col("stage_order").alias("_o"),
                       F.col("deal_stage").alias("deal_stage"), F.col("drop_off_rate").alias("drop_off_rate"))).alias("_w")
    ).select("partner_id", "_w.deal_stage", "_w.drop_off_rate")


def d_source_split(leads: DataFrame) -> DataFrame:
    """D3: lead source split per partner."""
    return leads.groupBy("partner_id", "partner_name", "source_type").agg(F.count_distinct("contact_id").alias("leads"))


def d_form_breakdown(leads: DataFrame) -> DataFrame:
    """Form-sourced leads by company size and industry."""
    return leads.filter(F.col("source_type") == "form").groupBy("form_company_size", "form_industry").agg(
        F.count_distinct("contact_id").alias("leads"))


def d_time_to_touch(leads: DataFrame) -> DataFrame:
    """Hours to first sales touch per partner: mean, median, p90 (exact)."""
    h, key = "hours_to_first_sales_touch", ["partner_id"]
    ours = leads.filter(F.col("partner_id").isNotNull()).select("partner_id", h)
    means = ours.groupBy(*key).agg(F.avg(h).alias("avg_hours"), F.count(h).alias("n_touched"))
    return means.join(exact_quantile(ours, key, h, "p50_hours", 0.5), key, "left").join(exact_quantile(ours, key, h, "p90_hours", 0.9), key, "left")


def d_rep_partner_matrix(reps: DataFrame) -> DataFrame:
    """Rep x partner matrix (long form; pivot in the client or with ``.pivot``)."""
    return reps.groupBy("deal_owner_name", "partner_name").agg(
        F.sum("deals_won").cast("bigint").alias("deals_won"), F.sum("deals_total").cast("bigint").alias("deals_total"),
        F.sum("revenue_closed_won").alias("revenue_closed_won"),
    ).withColumn("win_rate", X.safe_divide(F.col("deals_won"), F.col("deals_total")))


def d_leads_by_owner(leads: DataFrame, owners: DataFrame) -> DataFrame:
    """Partner leads per contact owner."""
    

    o = owners.select(F.col("owner_id").alias("contact_owner_id"), "owner_name")
    return leads.join(o, "contact_owner_id", "left").groupBy("contact_owner_id", "owner_name").agg(
        F.count(F.lit(1)).alias("leads"))


def d_penetration_latest(pen: DataFrame) -> DataFrame:
    """Latest penetration per partner."""
    return pen.groupBy("partner_id").agg(
        F.max_by(F.struct("as_of_date", "penetration_rate", "our_customer_count", "total_customer_count"),
                 F.col("as_of_date")).alias("_l")
    ).select("partner_id", "_l.as_of_date", "_l.penetration_rate", "_l.our_customer_count", "_l.total_customer_count")


def d_global_filter(df: DataFrame, date_col: str | None = None, start=None, end=None,
                    partners: list[str] | None = None, owners: list[str] | None = None,
                    owner_col: str = "deal_owner_id") -> DataFrame:
    """The dashboard's global filters: date range, partners, owners."""
    if date_col and start is not None:
        df = df.filter(F.col(date_col) >= F.lit(start))
    if date_col and end is not None:
        df = df.filter(F.col(date_col) < F.lit(end))
    if partners:
        df = df.filter(F.col("partner_id").isin(*partners))
    if owners:
        df = df.filter(F.col(owner_col).isin(*owners))
    return df


def d_funnel_tiles(summary: DataFrame) -> DataFrame:
    """Lead-funnel counts of the all_time rows as (partner, step, value) via unpivot."""
    at = summary.filter(F.col("period_type") == "all_time").select(
        "partner_id", "total_leads", "leads_reached_mql", "leads_reached_sql", "total_deals_created", "deals_closed_won")
    return at.unpivot("partner_id", ["total_leads", "leads_reached_mql", "leads_reached_sql", "total_deals_created",
                                     "deals_closed_won"], "step", "value")


def d_velocity_tiles(summary: DataFrame) -> DataFrame:
    """The four velocity averages of the all_time rows as (partner, tile, value)."""
    tiles = ["avg_hours_to_first_sales_touch", "avg_days_contact_to_deal", "avg_deal_cycle_days", "avg_sales_touches_to_close"]
    at = summary.filter(F.col("period_type") == "all_time").select("partner_id", *[F.col(t).cast("double").alias(t) for t in tiles])
    return at.unpivot("partner_id", tiles, "tile", "value")


def d_quality_rates(summary: DataFrame) -> DataFrame:
    """MQL / SQL / disqualified rates by partner (all time)."""
    return summary.filter(F.col("period_type") == "all_time").select(
        "partner_id", "partner_name", "mql_rate", "sql_rate", "disqualified_rate")
