"""Intermediate models I1-I5: touches, primary contact, sales touches,
stage durations and partner attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerlens.config import EngineConfig
from partnerlens.functions import columns as X
from partnerlens.operators.joins import asc_nulls_last, first_per_key, or_equi_join


def _is_sales_touch(type_col: Column, direction: Column) -> Column:
    return type_col.isin("call", "meeting") | ((type_col == "email") & (direction == "outgoing"))


def contact_engagements(engagements: DataFrame, engagement_contacts: DataFrame) -> DataFrame:
    """Engagements of each contact (edge x engagement), the shared input of I1, I3 and I5d."""
    e = engagements.select("engagement_id", "engagement_type", "engaged_at", "email_direction", "email_from_domain")
    return engagement_contacts.select("engagement_id", "contact_id").join(e, "engagement_id")


def first_touch(contact_eng: DataFrame) -> DataFrame:
    """First engagement and first sales touch per contact.

    One aggregation replaces the reference's two aggregations plus full outer
    join: sales touches are a subset of all touches, so the key sets agree.
    """
    sales = _is_sales_touch(F.col("engagement_type"), F.col("email_direction"))
    return contact_eng.groupBy("contact_id").agg(
        F.min("engaged_at").alias("first_touch_at"),
        F.min(F.when(sales, F.col("engaged_at"))).alias("first_sales_touch_at"),
    )


def primary_contact(deal_contacts: DataFrame, contacts: DataFrame) -> DataFrame:
    """One primary contact per deal: flagged first, then earliest created, then smallest id."""
    joined = deal_contacts.join(contacts.select("contact_id", "contact_created_at"), "contact_id", "left")
    order = [~F.col("is_primary_contact"), *asc_nulls_last(F.col("contact_created_at")), F.col("contact_id")]
    return first_per_key(joined, ["deal_id"], order, ["contact_id"]).withColumnRenamed("contact_id", "primary_contact_id")


TOUCH_KINDS = ("total_touches", "outbound_emails", "calls", "meetings")


def sales_touches(deals: DataFrame, primary: DataFrame, contact_eng: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Distinct engagements of the primary contact inside [created, close or as_of].

    The reference writes an interval join (equi key + BETWEEN) and counts
    distinct engagements. Here the count comes from prefix sums instead:
    count in [a, b] = (# touches <= b) - (# touches < a). Touches and deal
    bounds are laid on one time line per contact; the line is cut into
    (contact, day) slices so one very busy contact spreads over many tasks.
    No (deal, engagement) pair is ever emitted. Every deal keeps a row.
    """
    as_of = X.ts_literal(cfg.as_of_literal)
    d = deals.select("deal_id", "deal_created_at", "deal_close_date").join(primary, "deal_id", "left")

    touch_flags = {
        "total_touches": F.lit(1),
        "outbound_emails": ((F.col("engagement_type") == "email") & (F.col("email_direction") == "outgoing")).cast("int"),
        "calls": (F.col("engagement_type") == "call").cast("int"),
        "meetings": (F.col("engagement_type") == "meeting").cast("int"),
    }
    asked = d.filter(F.col("primary_contact_id").isNotNull() & F.col("deal_created_at").isNotNull())
    touches = (
        contact_eng.filter(F.col("engaged_at").isNotNull())
        .join(asked.select(F.col("primary_contact_id").alias("contact_id")).distinct(), "contact_id", "left_semi")
        .select("contact_id", "engagement_id", "engaged_at", "engagement_type", "email_direction")
        .dropDuplicates(["contact_id", "engagement_id"])
        .select(F.col("contact_id"), F.col("engaged_at").alias("t"), F.lit(1).alias("kind"),
                F.lit(None).cast("string").alias("deal_id"), F.lit(None).cast("int").alias("side"),
                *[v.alias(k) for k, v in touch_flags.items()])
    )
    # Bound rows: side 0 = start (count strictly before t), side 1 = end (count up to and including t).
    # An open deal has a start only: its end count is its contact's total up to as_of.
    bounds = asked.select(
        F.col("primary_contact_id").alias("contact_id"),
        F.explode(F.array(
            F.struct(F.col("deal_created_at").alias("t"), F.lit(0).alias("kind"), F.lit(0).alias("side")),
            F.struct(F.col("deal_close_date").alias("t"), F.lit(2).alias("kind"), F.lit(1).alias("side")),
        )).alias("b"),
        F.col("deal_id"),
    ).filter(F.col("b.t").isNotNull()).select("contact_id", "b.t", "b.kind", "deal_id", "b.side", *[F.lit(0).alias(k) for k in TOUCH_KINDS])

    line = touches.unionByName(bounds).withColumn("day", F.to_date("t"))
    # Running totals inside each (contact, day) slice; kind orders start < touches < end at equal times.
    w_in = Window.partitionBy("contact_id", "day").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    running = line.select("contact_id", "day", "kind", "deal_id", "side",
                          *[F.sum(k).over(w_in).alias(f"_in_{k}") for k in TOUCH_KINDS])
    # Day totals = the largest running total of the slice (flags are >= 0); the data is already
    # partitioned by (contact, day), so this aggregation adds no shuffle of the time line.
    per_day = running.groupBy("contact_id", "day").agg(*[F.max(f"_in_{k}").alias(k) for k in TOUCH_KINDS])
    # Totals of the earlier days per contact: one row per active day, small.
    w_days = Window.partitionBy("contact_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    before_day = per_day.select("contact_id", "day", *[
        F.coalesce(F.sum(k).over(w_days), F.lit(0)).alias(f"_pre_{k}") for k in TOUCH_KINDS])
    at_bound = (
        running.filter(F.col("kind") != 1)
        .join(before_day, ["contact_id", "day"])
        .select("deal_id", "side", *[(F.col(f"_pre_{k}") + F.col(f"_in_{k}")).alias(k) for k in TOUCH_KINDS])
    )
    totals = touches.filter(F.col("t") <= as_of).groupBy("contact_id").agg(*[F.sum(k).alias(k) for k in TOUCH_KINDS])
    ends = asked.filter(F.col("deal_close_date").isNull()).join(totals, F.col("primary_contact_id") == F.col("contact_id")).select(
        "deal_id", F.lit(1).alias("side"), *TOUCH_KINDS)
    at_bound = at_bound.unionByName(ends)
    signed = lambda k: F.sum(F.when(F.col("side") == 1, F.col(k)).otherwise(-F.col(k)))
    per_deal = at_bound.groupBy("deal_id").agg(*[F.greatest(signed(k), F.lit(0)).cast("bigint").alias(k) for k in TOUCH_KINDS])
    return (
        d.select("deal_id").join(per_deal, "deal_id", "left")
        .select("deal_id", *[F.coalesce(F.col(k), F.lit(0).cast("bigint")).alias(k) for k in TOUCH_KINDS])
    )


def stage_durations(history: DataFrame, deals: DataFrame, cfg: EngineConfig) -> DataFrame:
    """I4: time per (deal, stage) over all entries, plus the deal's time to close."""
    as_of = X.ts_literal(cfg.as_of_literal)
    per_stage = history.groupBy("deal_id", "deal_stage").agg(
        F.count(F.lit(1)).alias("times_entered"),
        F.sum("seconds_in_stage").alias("total_seconds_in_stage"),
        (F.sum("seconds_in_stage") / F.lit(86400.0)).alias("total_days_in_stage"),
        F.min("entered_at").alias("first_entered_at"),
        F.max("effective_exited_at").alias("last_exited_at"),
    )
    secs = X.seconds_between(F.coalesce("deal_closed_won_at", "deal_close_date", as_of), F.col("deal_created_at"))
    totals = deals.select("deal_id", secs.alias("seconds_to_close"), X.safe_divide(secs, F.lit(86400.0)).alias("days_to_close"))
    return per_stage.join(totals, "deal_id", "left")


ATTRIBUTION_COLS = ["contact_id", "partner_id", "partner_name", "source_type", "attribution_method",
                    "attribution_evidence_at", "attribution_evidence_id"]


def _evidence(df: DataFrame, method: str, priority: int, source_type: Column | str,
              at: Column | None = None, ev_id: Column | None = None) -> DataFrame:
    st = F.lit(source_type) if isinstance(source_type, str) else source_type
    return df.select(
        "contact_id", "partner_id", "partner_name",
        st.alias("source_type"), F.lit(method).alias("attribution_method"), F.lit(priority).alias("priority"),
        (at if at is not None else F.lit(None)).cast("timestamp_ntz").alias("evidence_at"),
        (ev_id if ev_id is not None else F.lit(None)).cast("string").alias("evidence_id"),
    )


def attribution_evidence(contacts: DataFrame, partners: DataFrame, deals: DataFrame, deal_contacts: DataFrame,
                         forms: DataFrame, contact_eng: DataFrame, cfg: EngineConfig) -> DataFrame:
    """I5a-I5e: every piece of partner evidence per contact, before the pick (names may be null)."""
    p = partners.select("partner_id", "partner_name", "partner_name_key", "partner_domain")
    by_key = p.select("partner_id", F.col("partner_name").alias("_pname"), "partner_name_key")

    # Declared on the contact; unknown names kept as typed with a null id.
    declared = (
        contacts.filter(F.col("referring_partner_declared").isNotNull())
        .select("contact_id", "referring_partner_declared", X.name_key(F.col("referring_partner_declared")).alias("_k"))
        .join(by_key, F.col("_k") == F.col("partner_name_key"), "left")
        .withColumn("partner_name", F.coalesce("_pname", "referring_partner_declared"))
    )
    ev1 = _evidence(declared, "contact_referring_partner", 1, "partner_email")

    # Flagged-primary contact on a partner-sourced deal with a partner tag; earliest deal.
    tagged = deals.filter(F.col("is_partner_sourced_deal") & F.col("referring_partner_deal").isNotNull()).select(
        "deal_id", "deal_created_at", "referring_partner_deal")
    flagged = deal_contacts.filter(F.col("is_primary_contact")).select("deal_id", "contact_id")
    first_deal = first_per_key(
        tagged.join(flagged, "deal_id"), ["contact_id"],
        [*asc_nulls_last(F.col("deal_created_at")), F.col("deal_id")],
        ["deal_id", "deal_created_at", "referring_partner_deal"],
    )
    deal_ev = (
        first_deal.withColumn("_k", X.name_key(F.col("referring_partner_deal")))
        .join(by_key, F.col("_k") == F.col("partner_name_key"), "left")
        .withColumn("partner_name", F.coalesce("_pname", "referring_partner_deal"))
    )
    ev2 = _evidence(deal_ev, "deal_referring_partner", 2, "partner_email", F.col("deal_created_at"), F.col("deal_id"))

    # Earliest partner form (picked before dropping nameless ones).
    first_form = first_per_key(
        forms.filter(F.col("is_partner_referral_form")), ["contact_id"],
        [*asc_nulls_last(F.col("submitted_at")), F.col("submission_id")],
        ["submission_id", "submitted_at", "partner_name_from_form"],
    )
    form_ev = (
        first_form.withColumn("_k", X.name_key(F.col("partner_name_from_form")))
        .join(by_key, F.col("_k") == F.col("partner_name_key"), "left")
        .withColumn("partner_name", F.coalesce("_pname", "partner_name_from_form"))
    )
    ev3 = _evidence(form_ev, "form_submission", 3, "form", F.col("submitted_at"), F.col("submission_id"))

    # I5d: earliest incoming email from a known partner domain.
    domains = p.filter(F.col("partner_domain").isNotNull()).select(
        "partner_id", "partner_name", F.col("partner_domain").alias("email_from_domain"))
    incoming = contact_eng.filter((F.col("engagement_type") == "email") & (F.col("email_direction") == "incoming"))
    email_ev = first_per_key(
        incoming.join(domains, "email_from_domain"), ["contact_id"],
        [*asc_nulls_last(F.col("engaged_at")), F.col("engagement_id")],
        ["partner_id", "partner_name", "engaged_at", "engagement_id"],
    )
    ev4 = _evidence(email_ev, "partner_email_domain", 4, "partner_email", F.col("engaged_at"), F.col("engagement_id"))

    # I5e: referral source with either drill-down naming a partner (OR join rewritten as explode + equi).
    referral = contacts.filter(F.upper("original_source").isin(*cfg.referral_source_values)).select(
        "contact_id", "original_source_drill_down_1", "original_source_drill_down_2")
    ref_hits = or_equi_join(
        referral.select("contact_id", X.name_key(F.col("original_source_drill_down_1")).alias("_k1"),
                        X.name_key(F.col("original_source_drill_down_2")).alias("_k2")),
        [F.col("_k1"), F.col("_k2")],
        by_key.withColumnRenamed("_pname", "partner_name"), "partner_name_key",
    ).select("contact_id", "partner_id", "partner_name").distinct()
    ev5 = _evidence(ref_hits, "referral_original_source", 5, "partner_email")

    union = ev1.unionByName(ev2).unionByName(ev3).unionByName(ev4).unionByName(ev5)
    if cfg.use_source_marker_attribution:
        markers = [m.lower() for m in cfg.partner_contact_source_markers]
        marked = contacts.filter(F.col("lead_origin_declared").isin(*markers) | F.col("lead_source_declared").isin(*markers)).select(
            "contact_id", F.lit(None).cast("string").alias("partner_id"), F.lit("Unknown partner").alias("partner_name"))
        union = union.unionByName(_evidence(marked, "lead_source_marker", 6, "partner_email"))
    return union


def attribution(contacts: DataFrame, partners: DataFrame, deals: DataFrame, deal_contacts: DataFrame,
                forms: DataFrame, contact_eng: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per attributed contact; the best evidence wins (I5f).

    Priority: 1 declared on the contact, 2 deal tag via flagged-primary
    partner deal, 3 partner form, 4 incoming email from a partner domain,
    5 referral source drill-down. Within a priority the earliest evidence
    wins (nulls last), then the smallest partner id.
    """
    union = attribution_evidence(contacts, partners, deals, deal_contacts, forms, contact_eng, cfg)
    best = first_per_key(
        union.filter(F.col("partner_name").isNotNull()), ["contact_id"],
        [F.col("priority"), *asc_nulls_last(F.col("evidence_at")), *asc_nulls_last(F.col("partner_id")), F.col("evidence_id")],
        ["partner_id", "partner_name", "source_type", "attribution_method", "evidence_at", "evidence_id"],
    )
    return best.select(
        "contact_id", "partner_id", "partner_name", "source_type", "attribution_method",
        F.col("evidence_at").alias("attribution_evidence_at"), F.col("evidence_id").alias("attribution_evidence_id"),
    )
