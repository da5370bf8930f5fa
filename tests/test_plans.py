"""Physical plan guards: no nested-loop or cartesian joins (except K9's one-row
cut-points), pushed filters reach the scans, scans read only needed columns."""

import contextlib
import io
import re

import pytest

from partnerlens.operators import marts as K
from partnerlens.plans.models import Models
from tests.conftest import SF0001


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def lazy(spark):
    return Models.from_fixture(spark, SF0001, materialize=None)


@pytest.mark.parametrize("name", ["attribution", "sales_touches", "partner_deals", "funnel", "lead_cohorts",
                                  "penetration", "rep_performance"])
def test_no_nested_loop_joins(lazy, name):
    txt = _plan(getattr(lazy, name))
    assert "NestedLoopJoin" not in txt and "CartesianProduct" not in txt


def test_rankings_only_cross_joins_one_row(models):
    txt = _plan(models.rankings)
    assert txt.count("BroadcastNestedLoopJoin") <= 2  # the node and its formatted detail entry
    assert "CartesianProduct" not in txt


def test_rankings_rank_in_many_tasks(models):
    plan = models.rankings._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("windowspecdefinition(_metric#" in w for w in windows)


def test_summary_reads_its_facts_once(spark, models):
    """The month rows come from one read of the leads and one of the deals; the summary reads the month rows alone."""
    facts = K.period_facts(models.partner_leads, models.partner_deals_canon)._jdf.queryExecution().optimizedPlan().toString()
    assert facts.count("Relation [contact_id#") == 1 and facts.count("Relation [deal_id#") == 1
    own = K.summary(models.period_facts, models.partners, models.keep(models.penetration))
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [contact_id#" not in plan and "Relation [deal_id#" not in plan


def test_scans_are_pruned(lazy):
    txt = _plan(lazy.partner_deals)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", txt)
    assert schemas
    # lineitem and events are wide; only the columns the models read may be scanned
    for s in schemas:
        cols = s.split(",")
        assert len(cols) <= 6, s
    assert "l_extendedprice" not in txt and "l_comment" not in txt


@pytest.mark.parametrize("name", ["partner_summary", "d_time_to_touch", "q_deals_open", "q_partner_all_time", "d_leads_by_month_source"])
def test_registered_plans_read_pruned_tables(spark, name):
    """The registered queries start from written Parquet tables: no row RDDs, only the columns they use."""
    from partnerlens.plans.catalog import REGISTRY

    txt = _plan(REGISTRY[name](spark, SF0001))
    assert "Scan parquet" in txt and "ExistingRDD" not in txt and "CartesianProduct" not in txt


def test_registered_report_reads_few_columns(spark):
    from partnerlens.plans.catalog import REGISTRY

    txt = _plan(REGISTRY["d_leads_by_month_source"](spark, SF0001))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", txt)
    assert schemas and all(len(s.split(",")) <= 4 for s in schemas)
