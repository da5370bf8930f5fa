"""The scheduled refresh: build every mart and write it as a table.

``refresh(spark, raw, out_root)`` builds the model graph once, writes each
mart under ``out_root/<mart>`` and builds the dependent ones from what was
written. With ``full_refresh=False`` the incremental marts (partner_leads,
partner_deals) are built only for rows loaded within the look-back window and
merged into the stored ones, which are partitioned by month: only months that
hold a changed row are written. The other marts are built from the merged
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from partnerlens.config import EngineConfig
from partnerlens.operators import marts as K
from partnerlens.operators.merge import merge_into, read_keyed, write_keyed
from partnerlens.plans.models import Models
from partnerlens.sources.tables import RawTables, write_table

# The incremental marts: their key and the month that partitions them.
INCREMENTAL = {"partner_leads": (["contact_id"], "lead_created_month"), "partner_deals": (["deal_id"], "deal_created_month")}


def put_incremental(spark: SparkSession, name: str, df: DataFrame, path: str, full_refresh: bool, ready: bool = False) -> DataFrame:
    """Writes an incremental mart by month, or merges the look-back slice into it; returns the mart as it stands.

    ``ready``: df is a stored model (its key is unique by its making).
    """
    keys, month = INCREMENTAL[name]
    if not full_refresh:
        return merge_into(spark, path, df, keys, by=month, ready=ready, schema=df.schema)
    write_keyed(df, path, keys, by=month)
    return read_keyed(spark, path, df.schema)


def refresh(spark: SparkSession, raw: RawTables, out_root: str, cfg: EngineConfig | None = None,
            full_refresh: bool = True) -> dict[str, str]:
    """Build and write all marts; returns mart name -> path."""
    cfg = cfg or EngineConfig()
    m = Models(spark, raw, cfg, materialize="parquet", incremental=not full_refresh)
    written: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        written[name] = path = f"{out_root}/{name}"
        if name in INCREMENTAL:
            return put_incremental(spark, name, df, path, full_refresh, ready=True)
        write_table(df, path)
        return spark.read.schema(df.schema).parquet(path)

    leads = put("partner_leads", m.partner_leads)
    deals = put("partner_deals", m.partner_deals)
    canon = K.canonical_partner_names(deals, m.partners, cfg)
    put("partner_deal_stage_durations", K.deal_stage_durations(deals, m.stage_durations))
    put("partner_funnel_stage_conversion", K.funnel(canon, m.stage_durations, cfg, spark))
    put("partner_lead_cohorts", K.lead_cohorts(leads, canon))
    pen = put("partner_penetration", K.penetration(m.partner_totals, canon))
    reps = put("partner_rep_performance", K.rep_performance(canon))
    put("partner_rep_performance_all", K.rep_performance_all(reps))
    summary = put("partner_summary", K.summary(m.keep(K.period_facts(leads, canon)), m.partners, pen))
    put("partner_rankings", K.rankings(summary))
    m.release()
    return written
