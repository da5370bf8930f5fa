"""Staging models S1-S10: rename, type, flag. Projections only, no shuffles
except the anti-join of S10 and the small form lookup of S5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerlens.config import EngineConfig
from partnerlens.functions import columns as X

# Every cast of raw text to a type: raw table -> typed column -> (raw column, type). The projections below take
# their casts from here, and so does the count of values that a cast loses.
CASTS: dict[str, dict[str, tuple[str, str]]] = {
    "contact": {
        "company_size_employees": ("property_numberofemployees", "int"), "company_annual_revenue": ("property_annualrevenue", "numeric"),
        "contact_created_at": ("property_createdate", "timestamp"), "became_lead_at": ("property_hs_lifecyclestage_lead_date", "timestamp"),
        "became_mql_at": ("property_hs_lifecyclestage_marketingqualifiedlead_date", "timestamp"),
        "became_sql_at": ("property_hs_lifecyclestage_salesqualifiedlead_date", "timestamp"),
        "became_opportunity_at": ("property_hs_lifecyclestage_opportunity_date", "timestamp"),
        "became_customer_at": ("property_hs_lifecyclestage_customer_date", "timestamp")},
    "deal": {
        "deal_stage_probability": ("property_hs_deal_stage_probability", "double"), "amount": ("property_amount", "numeric"),
        "amount_home_currency": ("property_amount_in_home_currency", "numeric"), "deal_created_at": ("property_createdate", "timestamp"),
        "deal_close_date": ("property_closedate", "timestamp"), "deal_closed_won_at": ("property_hs_closed_won_date", "timestamp"),
        "is_closed_won": ("property_hs_is_closed_won", "bool"), "is_closed": ("property_hs_is_closed", "bool")},
    "engagement": {"engaged_at": ("engagement_timestamp", "timestamp")},
    "contact_form": {"submitted_at": ("submitted_at", "timestamp")},
    "deal_contact": {"is_primary_contact": ("is_primary", "bool")},
    "owner": {"owner_created_at": ("created_at", "timestamp"), "is_archived": ("archived", "bool")},
}


def typed(table: str, name: str) -> Column:
    """A declared cast; what cannot be cast is null."""
    return X.safe_cast(*CASTS[table][name]).alias(name)


def stg_contacts(contact: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per contact."""
    email = F.lower("property_email")
    cast = lambda name: typed("contact", name)
    return contact.select(
        F.col("id").alias("contact_id"),
        email.alias("email"),
        X.email_domain(F.col("property_email")).alias("email_domain"),
        F.col("property_firstname").alias("first_name"),
        F.col("property_lastname").alias("last_name"),
        F.col("property_company").alias("company_name"),
        F.col("property_jobtitle").alias("job_title"),
        F.col("property_industry").alias("industry"),
        cast("company_size_employees"),
        cast("company_annual_revenue"),
        F.lower("property_lifecyclestage").alias("lifecycle_stage"),
        F.lower("property_hs_lead_status").alias("lead_status"),
        cast("contact_created_at"),
        cast("became_lead_at"),
        cast("became_mql_at"),
        cast("became_sql_at"),
        cast("became_opportunity_at"),
        cast("became_customer_at"),
        F.col("property_hs_analytics_source").alias("original_source"),
        F.col("property_hs_analytics_source_data_1").alias("original_source_drill_down_1"),
        F.col("property_hs_analytics_source_data_2").alias("original_source_drill_down_2"),
        F.col("property_hs_latest_source").alias("latest_source"),
        F.col("property_hs_latest_source_data_1").alias("latest_source_drill_down_1"),
        F.col("property_hs_latest_source_data_2").alias("latest_source_drill_down_2"),
        F.col("property_hubspot_owner_id").alias("contact_owner_id"),
        X.trimmed_or_null(X.property_col("property", cfg.partner_name_contact_property)).alias("referring_partner_declared"),
        F.lower(X.trimmed_or_null(F.col("property_lead_origin"))).alias("lead_origin_declared"),
        F.lower(X.trimmed_or_null(F.col("property_lead_source"))).alias("lead_source_declared"),
        X.trimmed_or_null(F.col("property_partner_source")).alias("partner_source_notes"),
        F.col("_fivetran_synced").alias("_synced_at"),
    )


def stg_deals(deal: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per deal with status flags."""
    cast = lambda name: typed("deal", name)
    stage = F.lower("property_dealstage")
    closed_stages = list(cfg.closed_won_stages) + list(cfg.closed_lost_stages)
    is_won = F.coalesce(cast("is_closed_won"), F.lit(False))
    is_closed = F.coalesce(cast("is_closed"), stage.isin(*closed_stages), F.lit(False))
    source_raw = F.col("property_deal_source")
    partner_deal = X.property_col("property", cfg.partner_name_deal_property)
    rows = deal.select(
        F.col("deal_id"),
        F.col("property_dealname").alias("deal_name"),
        F.col("property_pipeline").alias("pipeline_id"),
        stage.alias("deal_stage"),
        cast("deal_stage_probability"),
        cast("amount"),
        cast("amount_home_currency"),
        cast("deal_created_at"),
        cast("deal_close_date"),
        cast("deal_closed_won_at"),
        is_won.alias("is_closed_won"),
        is_closed.alias("is_closed"),
        F.col("property_dealtype").alias("deal_type"),
        F.col("property_hubspot_owner_id").alias("deal_owner_id"),
        X.trimmed_or_null(source_raw).alias("deal_source"),
        (F.lower(F.trim(F.coalesce(source_raw, F.lit("")))) == F.lit(cfg.deal_source_partner_value.lower()))
        .alias("is_partner_sourced_deal"),
        X.trimmed_or_null(partner_deal).alias("referring_partner_deal"),
        X.trimmed_or_null(F.col("property_deal_source_detail")).alias("deal_source_detail"),
        F.col("_fivetran_synced").alias("_synced_at"),
    )
    status = (
        F.when(F.col("is_closed_won"), F.lit("won"))
        .when(F.col("is_closed") & ~F.col("is_closed_won"), F.lit("lost"))
        .otherwise(F.lit("open"))
    )
    cols = rows.columns
    at = cols.index("is_closed") + 1
    return rows.select(*cols[:at], status.alias("deal_status"), *cols[at:])


def stg_stage_history(hist: DataFrame, cfg: EngineConfig) -> DataFrame:
    """S3: one row per stage entry; open stages run to ``as_of``."""
    as_of = X.ts_literal(cfg.as_of_literal)
    entered = F.col("entered_at").cast("timestamp_ntz")
    exited = F.col("exited_at").cast("timestamp_ntz")
    effective = F.coalesce(exited, as_of)
    secs = X.seconds_between(effective, entered)
    return hist.filter(F.col("entered_at").isNotNull()).select(
        F.col("deal_id"),
        F.lower("stage_id").alias("deal_stage"),
        entered.alias("entered_at"),
        exited.alias("exited_at"),
        effective.alias("effective_exited_at"),
        secs.alias("seconds_in_stage"),
        X.safe_divide(secs, F.lit(86400)).alias("days_in_stage"),
    )


def stg_engagements(eng: DataFrame) -> DataFrame:
    """One row per engagement."""
    return eng.select(
        F.col("engagement_id"),
        F.lower("engagement_type").alias("engagement_type"),
        typed("engagement", "engaged_at"),
        F.col("owner_id").alias("engagement_owner_id"),
        F.col("engagement_source"),
        F.lower("email_metadata_direction").alias("email_direction"),
        F.lower("email_metadata_from_email").alias("email_from_address"),
        X.email_domain(F.col("email_metadata_from_email")).alias("email_from_domain"),
        F.col("email_metadata_subject").alias("email_subject"),
        F.col("_fivetran_synced").alias("_synced_at"),
    )


# Form keys read as firmographics, and the columns they land in.
FORM_FIRMOGRAPHIC_KEYS = ("company", "company_size", "numberofemployees", "industry", "country", "use_case")
FORM_FIRMOGRAPHIC_COLS = ("form_company_name", "form_company_size", "form_num_employees", "form_industry",
                          "form_country", "form_use_case")


def partner_form_flag(partner_name: Column, form_name: Column, cfg: EngineConfig) -> Column:
    names = [n.lower() for n in cfg.partner_referral_form_names]
    return (
        F.when(partner_name.isNotNull(), F.lit(True))
        .when(X.starts_with_ci(form_name, cfg.partner_form_name_prefix), F.lit(True))
        .when(F.lower(form_name).isin(*names), F.lit(True))
        .otherwise(F.lit(False))
    )


def stg_form_submissions(contact_form: DataFrame, form: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per submission with a contact; partner-form flag."""
    forms = form.select("form_id", F.col("name").alias("form_name"))
    raw_values = F.col("submission_values")
    partner_name = F.coalesce(*[X.trimmed_or_null(X.json_value(raw_values, k)) for k in cfg.partner_form_fields])
    firmo = [F.nullif(X.json_value(raw_values, k), F.lit("")).alias(c)
             for k, c in zip(FORM_FIRMOGRAPHIC_KEYS, FORM_FIRMOGRAPHIC_COLS)]
    return (
        contact_form.filter(F.col("contact_id").isNotNull())
        .join(forms, "form_id", "left")
        .select(
            F.col("conversion_id").alias("submission_id"),
            F.col("contact_id"),
            F.col("form_id"),
            F.col("form_name"),
            typed("contact_form", "submitted_at"),
            F.col("page_url").alias("submission_page_url"),
            raw_values.alias("submission_values_raw"),
            partner_name.alias("partner_name_from_form"),
            *firmo,
        )
        .withColumn("is_partner_referral_form",
                    partner_form_flag(F.col("partner_name_from_form"), F.col("form_name"), cfg))
    )


def stg_deal_contacts(edges: DataFrame) -> DataFrame:
    """Deal-contact edges; primary defaults to false."""
    return edges.filter(F.col("deal_id").isNotNull() & F.col("contact_id").isNotNull()).select(
        "deal_id", "contact_id",
        F.coalesce(typed("deal_contact", "is_primary_contact"), F.lit(False)).alias("is_primary_contact"),
    )


def stg_engagement_contacts(edges: DataFrame) -> DataFrame:
    """Engagement-contact edges."""
    return edges.filter(F.col("engagement_id").isNotNull() & F.col("contact_id").isNotNull()).select(
        "engagement_id", "contact_id")


def stg_owners(owner: DataFrame) -> DataFrame:
    """Owners with a display name."""
    return owner.select(
        "owner_id",
        F.col("email").alias("owner_email"),
        F.col("first_name").alias("owner_first_name"),
        F.col("last_name").alias("owner_last_name"),
        F.trim(F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit("")))).alias("owner_name"),
        F.col("team_id").alias("owner_team_id"),
        typed("owner", "owner_created_at"),
        F.coalesce(typed("owner", "is_archived"), F.lit(False)).alias("is_archived"),
    )


def stg_partners(ref_partners: DataFrame) -> DataFrame:
    """Partner dimension with its match key."""
    return ref_partners.select(
        "partner_id",
        "partner_name",
        X.name_key(F.col("partner_name")).alias("partner_name_key"),
        F.lower("partner_domain").alias("partner_domain"),
        "partner_tier",
        "partner_start_date",
    )


def stg_partner_totals(app_counts: DataFrame, seed_totals: DataFrame, partners: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Hand-entered counts (known partners only) win over seed rows for the same (partner, date)."""
    app = app_counts.join(partners.select("partner_id", "partner_name", "partner_name_key"), "partner_id").select(
        "partner_id", "partner_name", "partner_name_key", "as_of_date", "total_customer_count")
    seed_rows = seed_totals.select(
        "partner_id", "partner_name", X.name_key(F.col("partner_name")).alias("partner_name_key"),
        "as_of_date", "total_customer_count")
    return app.unionByName(seed_rows.join(app.select("partner_id", "as_of_date"), ["partner_id", "as_of_date"], "left_anti"))
