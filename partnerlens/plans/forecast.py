"""Forecast F1-F3, run for every partner at once.

History is the partner's monthly summary series. The forecast keeps the
history rows (``kind = 'history'``) and adds ``horizon`` months: the mean of
the last ``trailing`` history rows' leads, grown by ``growth_pct`` per month
and scaled by an optional 12-value seasonality, then turned into won deals
and revenue with the lead-to-won rate and the average deal size.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed defaults of the forecast page.
DEFAULT_HORIZON = 6
DEFAULT_TRAILING = 6
DEFAULT_GROWTH_PCT = 3.0
DEFAULT_LEAD_TO_WON = 0.05
DEFAULT_AVG_DEAL = 10000.0
DEFAULT_WINDOW = 6


@dataclass(frozen=True)
class Assumptions:
    horizon_months: int = DEFAULT_HORIZON
    trailing_months: int = DEFAULT_TRAILING
    growth_pct_per_month: float = DEFAULT_GROWTH_PCT
    lead_to_won_rate: float | None = None   # None: use F1's per-partner default
    avg_deal_size: float | None = None
    seasonality: tuple[float, ...] | None = None  # 12 multipliers, Jan..Dec


def history(summary: DataFrame, key: str = "partner_id") -> DataFrame:
    """Monthly history points per key: (key, month, leads, deals_won, revenue)."""
    return summary.filter((F.col("period_type") == "month") & F.col("period_start_date").isNotNull()).select(
        key, F.col("period_start_date").alias("month"), F.col("total_leads").cast("double").alias("leads"),
        F.col("deals_closed_won").cast("double").alias("deals_won"),
        F.col("revenue_closed_won").cast("double").alias("revenue"))


def history_all(summary: DataFrame) -> DataFrame:
    """The all-partner series (the page without a partner) under key ``'all'``."""
    h = history(summary)
    return h.groupBy("month").agg(F.sum("leads").alias("leads"), F.sum("deals_won").alias("deals_won"),
                                  F.sum("revenue").alias("revenue")).select(F.lit("all").alias("partner_id"), "*")


def _recent(hist: DataFrame, n: int, key: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.col("month").desc())
    return hist.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max(1, n)).drop("_rn")


def forecast_defaults(hist: DataFrame, key: str = "partner_id", window: int = DEFAULT_WINDOW) -> DataFrame:
    """per key, lead-to-won rate and average deal size from the last ``window`` months."""
    r = _recent(hist, window, key).groupBy(key).agg(
        F.sum("leads").alias("_l"), F.sum("deals_won").alias("_w"), F.sum("revenue").alias("_r"))
    return r.select(
        key,
        F.lit(DEFAULT_HORIZON).alias("horizon_months"), F.lit(DEFAULT_TRAILING).alias("trailing_months"),
        F.lit(DEFAULT_GROWTH_PCT).alias("growth_pct_per_month"),
        F.when(F.col("_l") > 0, F.col("_w") / F.col("_l")).otherwise(F.lit(DEFAULT_LEAD_TO_WON)).alias("lead_to_won_rate"),
        F.when(F.col("_w") > 0, F.col("_r") / F.col("_w")).otherwise(F.lit(DEFAULT_AVG_DEAL)).alias("avg_deal_size"),
    )


def forecast(hist: DataFrame, a: Assumptions = Assumptions(), key: str = "partner_id",
             keys: DataFrame | None = None, as_of: dt.datetime | None = None) -> DataFrame:
    """history rows plus ``horizon`` forecast months per key.

    ``keys`` (optional) lists keys to forecast even without history; those
    start after the month of ``as_of`` with a zero baseline (V24).
    """
    defaults = forecast_defaults(hist, key)
    base = _recent(hist, a.trailing_months, key).groupBy(key).agg(
        F.greatest(F.avg("leads"), F.lit(0.0)).alias("_base"), F.max("month").alias("_last"))
    if keys is not None and as_of is not None:
        empty = keys.select(key).distinct().join(base.select(key), key, "left_anti")
        base = base.unionByName(empty.select(key, F.lit(0.0).alias("_base"),
                                             F.trunc(F.lit(as_of).cast("date"), "month").alias("_last")))
        defaults = defaults.unionByName(empty.select(
            key, F.lit(DEFAULT_HORIZON).alias("horizon_months"), F.lit(DEFAULT_TRAILING).alias("trailing_months"),
            F.lit(DEFAULT_GROWTH_PCT).alias("growth_pct_per_month"), F.lit(DEFAULT_LEAD_TO_WON).alias("lead_to_won_rate"),
            F.lit(DEFAULT_AVG_DEAL).alias("avg_deal_size")))
    rate = F.lit(a.lead_to_won_rate) if a.lead_to_won_rate is not None else F.col("lead_to_won_rate")
    size = F.lit(a.avg_deal_size) if a.avg_deal_size is not None else F.col("avg_deal_size")
    season = F.array(*[F.lit(float(x)) for x in a.seasonality]) if a.seasonality else None
    start = base.join(defaults, key).select(key, "_base", "_last", rate.alias("_rate"), size.alias("_size"))
    steps = start.select("*", F.explode(F.sequence(F.lit(1), F.lit(a.horizon_months))).alias("_i"))
    month = F.add_months(F.col("_last"), F.col("_i"))
    mult = F.pow(F.lit(1 + a.growth_pct_per_month / 100.0), F.col("_i"))
    if season is not None:
        mult = mult * F.element_at(season, F.month(month))
    leads = F.col("_base") * mult
    fc = steps.select(key, month.alias("month"), leads.alias("leads")).join(start.select(key, "_rate", "_size"), key) \
        .select(key, "month", "leads", (F.col("leads") * F.col("_rate")).alias("deals_won"),
                (F.col("leads") * F.col("_rate") * F.col("_size")).alias("revenue"), F.lit("forecast").alias("kind"))
    return hist.select(key, "month", "leads", "deals_won", "revenue", F.lit("history").alias("kind")).unionByName(fc)


def forecast_totals(fc: DataFrame, key: str = "partner_id") -> DataFrame:
    """sums over the forecast months per key."""
    return fc.filter(F.col("kind") == "forecast").groupBy(key).agg(
        F.sum("leads").alias("leads"), F.sum("deals_won").alias("deals"), F.sum("revenue").alias("revenue"))
