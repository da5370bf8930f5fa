"""Data-quality checks T1-T9 and source freshness A12.

Each check returns failure counts; ``run_checks`` evaluates a list of checks
from one scan of each table: a row gives one entry for each check that it
fails, and one for each of its keys that must be unique. The entries of all
tables are counted in one aggregation, of which ``failing_keys`` samples.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partnerlens.functions import columns as X
from partnerlens.operators.staging import CASTS


@dataclass(frozen=True)
class Check:
    kind: str                 # not_null | unique | accepted_values | accepted_range | expression
    model: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    failing: Column | None = None   # for kind=expression: predicate true on a failing row
    name: str | None = None
    severity: str = "error"

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}:{self.model}.{'+'.join(self.columns)}"


def _row_failure(c: Check) -> Column | None:
    if c.kind == "not_null":
        return F.col(c.columns[0]).isNull()
    if c.kind == "accepted_values":
        x = F.col(c.columns[0])
        return x.isNotNull() & ~x.isin(*c.values)
    if c.kind == "accepted_range":
        x = F.col(c.columns[0])
        bad = F.lit(False)
        if c.min_value is not None:
            bad = bad | (x < F.lit(c.min_value))
        if c.max_value is not None:
            bad = bad | (x > F.lit(c.max_value))
        return x.isNotNull() & bad
    if c.kind == "expression":
        return c.failing
    return None


def _entries(tables: dict[str, DataFrame], checks: list[Check], ids: dict[str, list[str]] | None = None) -> DataFrame:
    """no (of the check), key and n (rows that have the key): failing rows, and rows of keys that occur more than once.

    The key of a unique check is the key it names (T2: a single one that is
    null does not count; T3: nulls of a combination are equal), that of another
    check the row's own, where ``ids`` names it.
    """
    def entry(no: int, c: Check) -> Column:
        if c.kind == "unique":
            found = F.struct(F.lit(no).alias("no"), F.to_json(F.struct(*c.columns)).alias("key"))
            return F.when(F.col(c.columns[0]).isNotNull(), found) if len(c.columns) == 1 else found
        own = (ids or {}).get(c.model)
        key = F.to_json(F.struct(*own)) if own else F.lit(None).cast("string")
        return F.when(_row_failure(c), F.struct(F.lit(no).alias("no"), key.alias("key")))

    parts: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in checks):
        entries = [entry(no, c) for no, c in enumerate(checks) if c.model == model]
        parts.append(tables[model].select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.no", "e.key"))
    counted = reduce(DataFrame.unionByName, parts).groupBy("no", "key").agg(F.count(F.lit(1)).alias("n"))
    keys = [no for no, c in enumerate(checks) if c.kind == "unique"]
    return counted.filter(~F.col("no").isin(keys) | (F.col("n") > 1)) if keys else counted


def _listed(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    rows = [(no, c.label, c.model, "+".join(c.columns), c.severity) for no, c in enumerate(checks)]
    return next(iter(tables.values())).sparkSession.createDataFrame(rows, "no int, check string, model string, column_name string, severity string")


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """``(check, model, column_name, failures, severity, status)`` of every check, from one scan of each table."""
    failed = _entries(tables, checks).groupBy("no").agg(F.sum("n").alias("n"))
    f = F.coalesce("n", F.lit(0)).cast("bigint")
    return _listed(tables, checks).join(failed, "no", "left").select(
        "check", "model", "column_name", f.alias("failures"), "severity", F.when(f == 0, F.lit("pass")).otherwise(F.col("severity")).alias("status"))


def failing_keys(tables: dict[str, DataFrame], checks: list[Check], ids: dict[str, list[str]], most: int) -> DataFrame:
    """``(check, failing_key, n)``: of each check that fails the first ``most`` keys (as JSON), and how many rows have each."""
    first = Window.partitionBy("no").orderBy("key")
    few = _entries(tables, checks, ids).withColumn("place", F.row_number().over(first)).filter(F.col("place") <= most)
    return few.join(_listed(tables, checks), "no").select("check", F.col("key").alias("failing_key"), "n")


def close_before_create(deals: DataFrame) -> Check:
    """Close date earlier than create date (warn)."""
    return Check("expression", "partner_deals", ("deal_close_date", "deal_created_at"),
                 failing=F.col("deal_close_date") < F.col("deal_created_at"),
                 name="assert_deal_close_date_after_create", severity="warn")


def unlisted_lead_partners(leads: DataFrame, partners: DataFrame) -> DataFrame:
    """Lead partner names missing from the partner list, with lead counts (warn)."""
    keyed = leads.select("partner_name", F.lower(F.trim("partner_name")).alias("_k"))
    listed = partners.select(F.col("partner_name_key").alias("_k"))
    return keyed.join(listed, "_k", "left_anti").groupBy("partner_name").agg(F.count(F.lit(1)).alias("lead_count"))


def lost_by_cast(df: DataFrame, casts: dict[str, tuple[str, Column]]) -> DataFrame:
    """Per column, non-blank text values that a safe cast turned into null."""
    aggs = [F.count_if(F.nullif(F.trim(F.col(src)), F.lit("")).isNotNull() & typed.isNull()).alias(name)
            for name, (src, typed) in casts.items()]
    counts = df.agg(*aggs)
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(n).cast("bigint").alias("lost_values")) for n in casts]))
        .alias("r")).select("r.*")


def lost_by_declared_casts(tables: dict[str, DataFrame]) -> DataFrame:
    """T9 over every declared cast of these raw tables: ``(column_name, lost_values)``, the column as ``table.raw_column``."""
    parts = []
    for table, df in tables.items():
        casts = {f"{table}_{src}": (src, X.safe_cast(src, kind)) for src, kind in CASTS[table].values()}
        lost = lost_by_cast(df, casts)
        parts.append(lost.withColumn("column_name", F.concat(F.lit(f"{table}."), F.expr(f"substr(column_name, {len(table) + 2})"))))
    return reduce(DataFrame.unionByName, parts)


def freshness(df: DataFrame, table: str, ts_col: str, as_of: dt.datetime,
              warn_hours: float = 6, error_hours: float = 24) -> DataFrame:
    """Hours since the newest load time; pass / warn / error."""
    now = F.lit(as_of).cast("timestamp_ntz")
    latest = df.agg(F.max(ts_col).alias("max_loaded_at"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3.6e9)
    return latest.select(
        F.lit(table).alias("source_table"), "max_loaded_at", age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age > error_hours), F.lit("error"))
        .when(age > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


# The declared data tests, by model (sources and seeds under their raw names).
KEYS = [  # not null and unique
    "contact.id", "deal.deal_id", "engagement.engagement_id", "ref_partners.partner_id", "ref_partners.partner_name",
    "stg_contacts.contact_id", "stg_deals.deal_id", "stg_engagements.engagement_id", "stg_form_submissions.submission_id",
    "stg_owners.owner_id", "stg_partners.partner_id", "int_partner_contact_attribution.contact_id", "int_contact_first_touch.contact_id",
    "int_deal_primary_contact.deal_id", "int_deal_sales_touches.deal_id", "partner_leads.contact_id", "partner_deals.deal_id",
    "partner_rankings.partner_id",
]
COMBINATIONS = [  # unique together
    "partner_total_customers.partner_id+as_of_date", "stg_engagement_contacts.engagement_id+contact_id", "stg_deal_contacts.deal_id+contact_id",
    "stg_partner_totals.partner_id+as_of_date", "int_deal_stage_durations.deal_id+deal_stage", "partner_deal_stage_durations.deal_id+deal_stage",
    "partner_funnel_stage_conversion.partner_id+deal_stage", "partner_summary.partner_id+period_type+period_start_date",
    "partner_rep_performance.partner_id+deal_owner_id", "partner_penetration.partner_id+as_of_date", "partner_lead_cohorts.partner_id+cohort_month",
]
FILLED = [  # not null
    "partner_customer_counts.partner_id", "partner_customer_counts.as_of_date", "partner_customer_counts.total_customer_count",
    "partner_total_customers.partner_id", "partner_total_customers.as_of_date", "partner_total_customers.total_customer_count",
    "stg_contacts.contact_created_at", "stg_deals.deal_created_at", "stg_stage_history.deal_id", "stg_stage_history.deal_stage",
    "stg_stage_history.entered_at", "stg_form_submissions.contact_id", "stg_partners.partner_name",
    "int_partner_contact_attribution.partner_name", "int_partner_contact_attribution.source_type", "int_deal_primary_contact.primary_contact_id",
    "partner_leads.partner_name", "partner_leads.source_type", "partner_leads.lead_created_at", "partner_deals.partner_name",
    "partner_deals.deal_stage",
]
ACCEPTED = {
    "stg_deals.deal_status": ("won", "lost", "open"), "partner_deals.deal_status": ("won", "lost", "open"),
    "int_partner_contact_attribution.source_type": ("partner_email", "form"), "partner_leads.source_type": ("partner_email", "form"),
    "partner_rankings.volume_efficiency_quadrant": (
        "high_volume_high_conversion", "high_volume_low_conversion", "low_volume_high_conversion", "low_volume_low_conversion"),
}
RANGES = {
    "partner_total_customers.total_customer_count": (0, None), "partner_funnel_stage_conversion.stage_conversion_rate": (0, 1),
    "partner_funnel_stage_conversion.next_stage_conversion_rate": (0, 1), "partner_penetration.penetration_rate": (0, 100),
}


def standard_checks() -> list[Check]:
    """All declared data tests of sources, seeds, staging, intermediate and mart models."""
    def check(kind: str, at: str, **more) -> Check:
        model, columns = at.split(".")
        return Check(kind, model, tuple(columns.split("+")), **more)

    return [
        *(check(kind, at) for at in KEYS for kind in ("not_null", "unique")),
        *(check("unique", at) for at in COMBINATIONS), *(check("not_null", at) for at in FILLED),
        *(check("accepted_values", at, values=values) for at, values in ACCEPTED.items()),
        *(check("accepted_range", at, min_value=low, max_value=high) for at, (low, high) in RANGES.items()),
    ]
