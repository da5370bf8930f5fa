"""Engine configuration: the pipeline variables plus a fixed ``as_of`` time.

Every time-relative step (open stages, open deals, look-back windows, report
periods, freshness) reads ``as_of`` instead of the wall clock, so a run is
repeatable and a rerun gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class EngineConfig:
    # Fixed values that must agree with the pipeline this engine replaces.
    partner_name_contact_property: str | None = "referring_partner"
    partner_name_deal_property: str | None = "referring_partner"
    deal_source_partner_value: str = "Partner Referral"
    partner_contact_source_markers: tuple[str, ...] = (
        "partner_referral",
        "partner",
        "partner referral (partner)",
    )
    partner_form_name_prefix: str = "Partner"
    partner_referral_form_names: tuple[str, ...] = ("Partner Referral", "Partner Introduction")
    partner_form_fields: tuple[str, ...] = ("partner_name", "partner_referral", "referring_partner")
    deal_stage_order: tuple[str, ...] = ("discovery", "demo", "proposal", "negotiation", "closed_won")
    closed_won_stages: tuple[str, ...] = ("closed_won",)
    closed_lost_stages: tuple[str, ...] = ("closed_lost",)
    mql_lifecycle_values: tuple[str, ...] = ("marketingqualifiedlead", "mql")
    sql_lifecycle_values: tuple[str, ...] = ("salesqualifiedlead", "sql")
    disqualified_lifecycle_values: tuple[str, ...] = ("other", "disqualified")
    disqualified_lead_status_values: tuple[str, ...] = ("unqualified", "disqualified", "bad_fit", "dq")
    referral_source_values: tuple[str, ...] = ("REFERRALS", "REFERRAL")
    incremental_lookback_days: int = 14
    # Replaces every "now()" of the original pipeline.
    as_of: dt.datetime = field(default_factory=lambda: dt.datetime(2002, 1, 1))
    # Optional sixth attribution method (lead origin / source markers); off as in the original.
    use_source_marker_attribution: bool = False

    @property
    def as_of_literal(self) -> str:
        return self.as_of.strftime("%Y-%m-%d %H:%M:%S")
