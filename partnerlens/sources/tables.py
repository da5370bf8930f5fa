"""Raw CRM tables, seeds and their declared schemas."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, TS, B, D, I = T.StringType(), T.TimestampNTZType(), T.BooleanType(), T.DateType(), T.IntegerType()

# The CRM property keys landed as property_* text columns (names as the CRM uses them).
CONTACT_PROPERTIES = [
    "email", "firstname", "lastname", "company", "jobtitle", "industry", "numberofemployees", "annualrevenue",
    "lifecyclestage", "hs_lead_status", "createdate", "hs_lifecyclestage_lead_date",
    "hs_lifecyclestage_marketingqualifiedlead_date", "hs_lifecyclestage_salesqualifiedlead_date",
    "hs_lifecyclestage_opportunity_date", "hs_lifecyclestage_customer_date", "hs_analytics_source",
    "hs_analytics_source_data_1", "hs_analytics_source_data_2", "hs_latest_source", "hs_latest_source_data_1",
    "hs_latest_source_data_2", "hubspot_owner_id", "referring_partner", "lead_origin", "lead_source", "partner_source",
]
DEAL_PROPERTIES = [
    "dealname", "pipeline", "dealstage", "hs_deal_stage_probability", "amount", "amount_in_home_currency",
    "createdate", "closedate", "hs_closed_won_date", "hs_is_closed_won", "hs_is_closed", "dealtype",
    "hubspot_owner_id", "deal_source", "referring_partner", "deal_source_detail",
]


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


LOAD_COLS = (("_fivetran_synced", TS), ("_archived", B))

SCHEMAS: dict[str, T.StructType] = {
    "contact": _struct(("id", S), *[(f"property_{p}", S) for p in CONTACT_PROPERTIES], *LOAD_COLS),
    "deal": _struct(("deal_id", S), *[(f"property_{p}", S) for p in DEAL_PROPERTIES], *LOAD_COLS),
    "deal_stage_history": _struct(("deal_id", S), ("stage_id", S), ("entered_at", TS), ("exited_at", TS)),
    "deal_contact": _struct(("deal_id", S), ("contact_id", S), ("is_primary", B)),
    "engagement": _struct(
        ("engagement_id", S), ("engagement_type", S), ("engagement_timestamp", TS), ("owner_id", S),
        ("engagement_source", S), ("email_metadata_direction", S), ("email_metadata_from_email", S),
        ("email_metadata_subject", S), *LOAD_COLS),
    "engagement_contact": _struct(("engagement_id", S), ("contact_id", S)),
    "owner": _struct(("owner_id", S), ("email", S), ("first_name", S), ("last_name", S), ("team_id", S),
                     ("created_at", TS), ("archived", B)),
    "form": _struct(("form_id", S), ("name", S)),
    "contact_form": _struct(("conversion_id", S), ("contact_id", S), ("form_id", S), ("submitted_at", TS),
                            ("page_url", S), ("submission_values", S)),
    "deal_pipeline_stage": _struct(("pipeline_id", S), ("stage_id", S), ("label", S),
                                   ("probability", T.DecimalType(18, 4)), ("display_order", I)),
    "partner_customer_counts": _struct(("partner_id", S), ("as_of_date", D), ("total_customer_count", I), ("notes", S)),
    "ref_partners": _struct(("partner_id", S), ("partner_name", S), ("partner_domain", S), ("partner_tier", S),
                            ("partner_start_date", D)),
    "partner_total_customers": _struct(("partner_id", S), ("partner_name", S), ("as_of_date", D),
                                       ("total_customer_count", I)),
}


@dataclass(frozen=True)
class RawTables:
    """The raw inputs of every model, one lazy DataFrame per table."""

    contact: DataFrame
    deal: DataFrame
    deal_stage_history: DataFrame
    deal_contact: DataFrame
    engagement: DataFrame
    engagement_contact: DataFrame
    owner: DataFrame
    form: DataFrame
    contact_form: DataFrame
    partner_customer_counts: DataFrame
    ref_partners: DataFrame
    partner_total_customers: DataFrame

    def with_(self, **changes: DataFrame) -> "RawTables":
        return replace(self, **changes)

    def names(self) -> list[str]:
        return [f.name for f in fields(self)]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared schema; missing columns become typed nulls."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


# Keys of the raw tables that the landing run merges into.
RAW_KEYS = {
    "owner": ["owner_id"], "contact": ["id"], "deal": ["deal_id"], "deal_stage_history": ["deal_id", "stage_id", "entered_at"],
    "deal_contact": ["deal_id", "contact_id"], "engagement": ["engagement_id"], "engagement_contact": ["engagement_id", "contact_id"],
    "form": ["form_id"], "contact_form": ["conversion_id"],
}


def raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A1/A2: scan one raw table under ``root/name``, plain Parquet or stored by key."""
    return conform(spark.read.option("mergeSchema", "true").parquet(f"{root}/{name}"), SCHEMAS[name])


def seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A3: CSV seed with declared column types; empty strings are nulls."""
    return (
        spark.read.schema(SCHEMAS[name])
        .option("header", True)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def load_raw(spark: SparkSession, root: str, seed_root: str | None = None) -> RawTables:
    """All raw tables from a landing folder (parquet per table) plus seeds (CSV)."""
    seed_root = seed_root or root
    kw = {n: raw(spark, root, n) for n in SCHEMAS if n not in ("ref_partners", "partner_total_customers", "deal_pipeline_stage")}
    kw["ref_partners"] = seed(spark, f"{seed_root}/ref_partners.csv", "ref_partners")
    kw["partner_total_customers"] = seed(spark, f"{seed_root}/partner_total_customers.csv", "partner_total_customers")
    return RawTables(**kw)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """A10: table sink (parquet), optionally partitioned (e.g. by month)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
