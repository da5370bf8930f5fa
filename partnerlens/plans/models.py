"""The model graph of one run: every staging, intermediate and mart model as a
lazily built DataFrame, each built once per ``Models`` object.

Models that feed several marts (attribution, stage durations, partner leads,
partner deals, summary) can be materialised once per run:
``materialize="parquet"`` writes them as Parquet tables in the shared folder
that ``spark.checkpoint.dir`` names and reads them back (survives executor
loss, cuts lineage; later plans read only the columns and row groups they
need), ``None`` keeps plain lazy plans (Spark then reuses identical exchanges
inside one query plan).
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from partnerlens.config import EngineConfig
from partnerlens.operators import intermediate as I
from partnerlens.operators import marts as K
from partnerlens.operators import staging as S
from partnerlens.session import drop_path, let_go, new_path, prepare_session
from partnerlens.sources.tables import RawTables

# How object dumps are compressed: the least of gzip takes half the time of its default.
DUMPED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


class Models:
    def __init__(self, spark: SparkSession, raw: RawTables, cfg: EngineConfig | None = None,
                 materialize: str | None = None, incremental: bool = False):
        self.spark = prepare_session(spark)
        self.raw = raw
        self.cfg = cfg or EngineConfig()
        self.materialize = materialize
        self.incremental = incremental
        self.sf_dir: str | None = None
        self.paths: list[str] = []

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str, cfg: EngineConfig | None = None, **kw) -> "Models":
        from partnerlens.sources.fixture import load_fixture

        prepare_session(spark)
        m = cls(spark, load_fixture(spark, sf_dir, cfg), cfg, **kw)
        m.sf_dir = sf_dir
        return m

    _SHARED_WITH_INCREMENTAL = ("contacts", "deals", "stage_history", "engagements", "form_submissions",
                                "deal_contacts", "engagement_contacts", "owners", "partners", "contact_engagements",
                                "first_touch", "primary_contact", "attribution", "stage_durations")

    def incremental_copy(self) -> "Models":
        """The look-back build of the incremental marts, reusing this run's upstream models."""
        inc = Models(self.spark, self.raw, self.cfg, materialize=self.materialize, incremental=True)
        inc.sf_dir = self.sf_dir
        for name in self._SHARED_WITH_INCREMENTAL:
            if name in self.__dict__:
                inc.__dict__[name] = self.__dict__[name]
        return inc

    def keep(self, df: DataFrame) -> DataFrame:
        """df as a table of this run, where models are materialised."""
        if self.materialize != "parquet":
            return df
        path = new_path(self.spark, "model")
        self.paths.append(path)
        df.write.parquet(path)
        let_go(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def new_path(self, name: str) -> str:
        """A path of this run in the shared folder."""
        self.paths.append(new_path(self.spark, name))
        return self.paths[-1]

    def release(self) -> None:
        """Deletes the materialised models; nothing may read them afterwards. (Else they go when the application ends.)"""
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths.clear()

    # ------------------------------------------------------------ landing
    @cached_property
    def landed_root(self) -> str:
        """Dumps of the fixture's objects landed by two runs, a full one and one a week later from its state.

        Between the runs, changed engagements are added to the dumps.
        """
        from partnerlens.plans.landing_run import landing_run
        from partnerlens.sources.fixture import changed_engagement_objects, dump_objects
        from partnerlens.sources.tables import write_table

        dumps, root = new_path(self.spark, "dumps"), new_path(self.spark, "raw")
        self.paths += [dumps, root]
        for kind, objs in dump_objects(self.spark, self.sf_dir, self.raw, self.cfg.as_of_literal).items():
            objs.write.options(**DUMPED).json(f"{dumps}/{kind}")
            let_go(self.spark)
        landing_run(self.spark, dumps, root, self.cfg.as_of - dt.timedelta(days=7))
        for kind, objs in changed_engagement_objects(self.spark, self.sf_dir, self.cfg.as_of - dt.timedelta(days=3)).items():
            objs.write.mode("append").options(**DUMPED).json(f"{dumps}/{kind}")
        landing_run(self.spark, dumps, root, self.cfg.as_of)
        write_table(self.raw.partner_customer_counts, f"{root}/partner_customer_counts")
        for name in ("ref_partners", "partner_total_customers"):
            getattr(self.raw, name).write.option("header", True).csv(f"{root}/{name}.csv")
        return root

    # ------------------------------------------------------------ staging
    @cached_property
    def contacts(self) -> DataFrame:
        return S.stg_contacts(self.raw.contact, self.cfg)

    @cached_property
    def deals(self) -> DataFrame:
        return S.stg_deals(self.raw.deal, self.cfg)

    @cached_property
    def stage_history(self) -> DataFrame:
        return S.stg_stage_history(self.raw.deal_stage_history, self.cfg)

    @cached_property
    def engagements(self) -> DataFrame:
        return S.stg_engagements(self.raw.engagement)

    @cached_property
    def form_submissions(self) -> DataFrame:
        return S.stg_form_submissions(self.raw.contact_form, self.raw.form, self.cfg)

    @cached_property
    def deal_contacts(self) -> DataFrame:
        return S.stg_deal_contacts(self.raw.deal_contact)

    @cached_property
    def engagement_contacts(self) -> DataFrame:
        return S.stg_engagement_contacts(self.raw.engagement_contact)

    @cached_property
    def owners(self) -> DataFrame:
        return S.stg_owners(self.raw.owner)

    @cached_property
    def partners(self) -> DataFrame:
        return S.stg_partners(self.raw.ref_partners)

    @cached_property
    def partner_totals(self) -> DataFrame:
        return S.stg_partner_totals(self.raw.partner_customer_counts, self.raw.partner_total_customers,
                                    self.partners, self.cfg)

    # ------------------------------------------------------- intermediate
    @cached_property
    def contact_engagements(self) -> DataFrame:
        # Read by I1, I3, I5d and Q10: materialised once per run.
        return self.keep(I.contact_engagements(self.engagements, self.engagement_contacts))

    @cached_property
    def first_touch(self) -> DataFrame:
        return I.first_touch(self.contact_engagements)

    @cached_property
    def primary_contact(self) -> DataFrame:
        # Read by I3 and K2 (twice: partner resolution and touches): materialised once per run.
        return self.keep(I.primary_contact(self.deal_contacts, self.contacts))

    def sales_touches_for(self, deals: DataFrame) -> DataFrame:
        return I.sales_touches(deals, self.primary_contact, self.contact_engagements, self.cfg)

    @cached_property
    def sales_touches(self) -> DataFrame:
        return self.sales_touches_for(self.deals)

    @cached_property
    def stage_durations(self) -> DataFrame:
        return self.keep(I.stage_durations(self.stage_history, self.deals, self.cfg))

    @cached_property
    def attribution(self) -> DataFrame:
        return self.keep(I.attribution(self.contacts, self.partners, self.deals, self.deal_contacts,
                                        self.form_submissions, self.contact_engagements, self.cfg))

    # -------------------------------------------------------------- marts
    @cached_property
    def partner_leads(self) -> DataFrame:
        return self.keep(K.partner_leads(self.contacts, self.attribution, self.first_touch, self.form_submissions,
                                          self.cfg, self.incremental))

    @cached_property
    def partner_deals(self) -> DataFrame:
        return self.keep(K.partner_deals(self.deals, self.primary_contact, self.attribution, self.partners,
                                          self.contacts, self.owners, self.sales_touches_for, self.cfg,
                                          self.incremental))

    @cached_property
    def partner_deals_canon(self) -> DataFrame:
        return K.canonical_partner_names(self.partner_deals, self.partners, self.cfg)

    @cached_property
    def deal_stage_durations(self) -> DataFrame:
        return K.deal_stage_durations(self.partner_deals, self.stage_durations)

    @cached_property
    def funnel(self) -> DataFrame:
        return K.funnel(self.partner_deals_canon, self.stage_durations, self.cfg, self.spark)

    @cached_property
    def lead_cohorts(self) -> DataFrame:
        return K.lead_cohorts(self.partner_leads, self.partner_deals_canon)

    @cached_property
    def penetration(self) -> DataFrame:
        return K.penetration(self.partner_totals, self.partner_deals_canon)

    @cached_property
    def rep_performance(self) -> DataFrame:
        return K.rep_performance(self.partner_deals_canon)

    @cached_property
    def rep_performance_all(self) -> DataFrame:
        return K.rep_performance_all(self.rep_performance)

    @cached_property
    def period_facts(self) -> DataFrame:
        # Read by K8's sums, totals and medians: the leads and deals themselves are read once.
        return self.keep(K.period_facts(self.partner_leads, self.partner_deals_canon))

    @cached_property
    def summary(self) -> DataFrame:
        return self.keep(K.summary(self.period_facts, self.partners, self.penetration))

    @cached_property
    def rankings(self) -> DataFrame:
        return K.rankings(self.summary)
