"""Oracle SQL per registered query key."""

from __future__ import annotations

import functools

from oracle.base import AS_OF, ratio, with_models

QUERIES: dict[str, str] = {}


def add(name: str, select: str) -> None:
    QUERIES[name] = select


for _n in ["stg_contacts", "stg_deals", "stg_stage_history", "stg_engagements", "stg_form_submissions",
           "stg_deal_contacts", "stg_engagement_contacts", "stg_owners", "stg_partners", "stg_partner_totals",
           "int_contact_first_touch", "int_deal_primary_contact", "int_deal_sales_touches", "int_deal_stage_durations",
           "int_partner_contact_attribution", "partner_leads", "partner_deals", "partner_deal_stage_durations",
           "partner_funnel_stage_conversion", "partner_lead_cohorts", "partner_penetration", "partner_rep_performance",
           "partner_summary", "partner_rankings"]:
    add(_n, f"SELECT * FROM {_n}")

add("partner_rep_performance_all", f"""
SELECT deal_owner_id, deal_owner_name, sum(COLUMNS(['deals_total', 'deals_won', 'deals_lost', 'deals_open', 'revenue_closed_won'])),
  {ratio('sum(deals_won)', 'sum(deals_total)')} AS win_rate
FROM partner_rep_performance GROUP BY deal_owner_id, deal_owner_name""")


# The driver's tables as far as the SQL reads them; types of results are worked out on them, without rows.
_DRIVER = {
    "region": "r_regionkey INTEGER, r_name VARCHAR",
    "nation": "n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_nationkey INTEGER, c_acctbal DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_linenumber INTEGER, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR",
}


@functools.cache
def _empty():
    import duckdb

    con = duckdb.connect()
    for table, columns in _DRIVER.items():
        con.execute(f"CREATE TABLE {table} ({columns})")
    return con


def shaped(name: str) -> str:
    """The query in the canonical result shape: whole numbers as BIGINT, money to 2 places, other fractions to 6, times without zone."""
    inner = with_models(QUERIES[name])
    out = []
    for column, kind, *_ in _empty().execute(f"DESCRIBE {inner}").fetchall():
        q = f'"{column}"'
        if kind.startswith("DECIMAL"):
            q = f"round(CAST({q} AS DOUBLE), 2) AS {q}"
        elif kind in ("DOUBLE", "FLOAT"):
            q = f"round({q}, 6) AS {q}"
        elif kind in ("INTEGER", "HUGEINT", "SMALLINT", "TINYINT", "UBIGINT"):
            q = f"CAST({q} AS BIGINT) AS {q}"
        out.append(q)
    return f"SELECT {', '.join(out)} FROM ({inner}) AS _q"


# ------------------------------------------------------------------ reports
add("q_rankings", """
SELECT partner_id, partner_name, total_leads, deals_closed_won, revenue_closed_won, deal_to_won_rate, lead_to_won_rate,
  revenue_per_lead, mql_rate, volume_efficiency_quadrant, rank_by_revenue, is_top_performer, is_high_potential,
  is_underperformer, partner_penetration_rate
FROM partner_rankings ORDER BY rank_by_revenue""")

# A report period is a first and a last month; all time is its own row.
_MONTHS = f"date_trunc('month', {AS_OF})"
_PERIODS = f"""(VALUES ('all', NULL, NULL), ('ytd', date_trunc('year', {AS_OF}), NULL), ('qtd', date_trunc('quarter', {AS_OF}), NULL),
  ('last_12m', {_MONTHS} - INTERVAL 11 MONTH, NULL), ('mtd', {_MONTHS}, {_MONTHS})) asked(period, first, last)"""
_TOTALS = f"""
SELECT period, CAST(coalesce(sum(total_leads), 0) AS BIGINT) AS total_leads, CAST(coalesce(sum(leads_reached_mql), 0) AS BIGINT) AS total_mql,
  CAST(coalesce(sum(leads_reached_sql), 0) AS BIGINT) AS total_sql, CAST(coalesce(sum(deals_closed_won), 0) AS BIGINT) AS deals_won,
  CAST(coalesce(sum(total_deals_created), 0) AS BIGINT) AS deals_total, coalesce(sum(revenue_closed_won), 0) AS revenue,
  count(DISTINCT partner_id) FILTER (WHERE greatest(total_leads, total_deals_created, deals_closed_won) > 0) AS partners_active
FROM {_PERIODS} LEFT JOIN partner_summary
  ON if(first IS NULL, period_type = 'all_time', period_type = 'month' AND period_start_date >= first AND period_start_date <= coalesce(last, DATE '9999-12-31'))
GROUP BY period"""
add("q_totals", _TOTALS)
add("q_kpis", f"""
SELECT period, {ratio('total_mql', 'total_leads')} AS mql_rate, {ratio('deals_won', 'total_leads')} AS lead_to_won_rate FROM ({_TOTALS}) t""")

add("q_monthly_all", """
SELECT period_start_date, sum(total_leads) AS total_leads, sum(deals_closed_won) AS deals_closed_won,
  sum(revenue_closed_won) AS revenue_closed_won
FROM partner_summary WHERE period_type = 'month' GROUP BY 1 ORDER BY 1""")
add("q_monthly_by_partner", """
SELECT partner_id, period_start_date, total_leads, deals_closed_won, revenue_closed_won
FROM partner_summary WHERE period_type = 'month'""")
add("q_partner_all_time", """
SELECT partner_id, partner_name, period_type, period_start_date, total_leads, leads_reached_mql, leads_reached_sql,
  deals_closed_won, revenue_closed_won, mql_rate, sql_rate, deal_to_won_rate, lead_to_won_rate, avg_deal_cycle_days,
  partner_penetration_rate
FROM partner_summary WHERE period_type = 'all_time'""")
add("q_funnel", """
SELECT partner_id, deal_stage, stage_order, deals_entered, deals_advanced, deals_closed_won, stage_conversion_rate,
  stage_to_won_rate, next_stage_conversion_rate, drop_off_rate
FROM partner_funnel_stage_conversion ORDER BY partner_id, stage_order""")
add("q_reps", """
SELECT partner_id, deal_owner_id, deal_owner_name, deal_owner_email, deals_total, deals_won, deals_lost, deals_open, win_rate,
  revenue_closed_won, avg_deal_size, avg_cycle_days
FROM partner_rep_performance ORDER BY partner_id, revenue_closed_won DESC NULLS LAST""")
_DEALS = """
SELECT COLUMNS(lambda d: d IN ('partner_id', 'deal_id', 'deal_name', 'deal_stage', 'deal_status', 'amount', 'deal_owner_name', 'deal_owner_email',
  'deal_created_at', 'deal_close_date', 'deal_closed_won_at', 'is_closed_won', 'is_closed', 'source_type', 'time_to_close_days', 'sales_touches_total')),
  if(is_closed_won, 0, if(coalesce(is_closed, FALSE), 2, 1)) AS status_class
FROM partner_deals"""
add("q_deals", _DEALS)
add("q_deals_closed", _DEALS + " WHERE is_closed")
add("q_deals_open", _DEALS + " WHERE is_closed IS DISTINCT FROM TRUE")

# Each partner form with its contact's first call and first deal.
_FORM_SUBS = """
SELECT form.submission_id, form.submitted_at, form.form_name, form.contact_id, person.email AS contact_email, person.first_name AS contact_first_name,
  person.last_name AS contact_last_name, person.company_name, coalesce(deal.partner_name, lead.partner_name) AS partner_name,
  (SELECT min(engaged_at) FROM touch WHERE touch.contact_id = form.contact_id AND kind IN ('call', 'meeting')) AS first_call_at,
  deal.deal_id, deal.deal_name, deal.deal_created_at, deal.deal_stage, deal.deal_status, deal.amount, deal.is_closed_won, deal.deal_closed_won_at
FROM stg_form_submissions form
LEFT JOIN stg_contacts person USING (contact_id) LEFT JOIN partner_leads lead USING (contact_id)
LEFT JOIN (SELECT DISTINCT ON (contact_id) * FROM partner_deals WHERE contact_id IS NOT NULL
           ORDER BY contact_id, deal_created_at NULLS LAST, deal_id) deal USING (contact_id)
WHERE form.is_partner_referral_form"""
add("q_form_submissions", _FORM_SUBS)


def _days_nonneg(end: str, start: str) -> str:
    d = f"((epoch_us({end}) - epoch_us({start})) / 1000000.0 / 86400.0)"
    return f"(CASE WHEN {d} >= 0 THEN {d} END)"


add("q_form_velocity", f"""
SELECT submission_id, submitted_at, partner_name, deal_id, deal_status,
  coalesce(NULLIF(company_name, ''), NULLIF(concat_ws(' ', NULLIF(contact_first_name, ''), NULLIF(contact_last_name, '')), ''),
           NULLIF(contact_email, ''), '—') AS lead_label,
  {_days_nonneg('first_call_at', 'submitted_at')} AS form_to_call_days,
  {_days_nonneg('deal_created_at', 'first_call_at')} AS call_to_deal_days,
  {_days_nonneg('deal_created_at', 'submitted_at')} AS form_to_deal_days
FROM ({_FORM_SUBS}) s""")
add("q_partner_list", "SELECT DISTINCT partner_id, partner_name FROM partner_summary WHERE period_type = 'all_time'")
add("q_partner_counts", """
WITH latest AS (
  SELECT * FROM (SELECT partner_id, as_of_date, total_customer_count,
                   row_number() OVER (PARTITION BY partner_id ORDER BY as_of_date DESC) AS rn
                 FROM raw_partner_customer_counts) x WHERE rn = 1)
SELECT p.partner_id, p.partner_name, p.partner_domain, p.partner_tier, CAST(p.partner_start_date AS VARCHAR) AS partner_start_date,
  l.total_customer_count AS latest_customer_count, CAST(l.as_of_date AS VARCHAR) AS latest_as_of_date
FROM stg_partners p LEFT JOIN latest l USING (partner_id)""")
add("q_count_history", """
SELECT partner_id, CAST(as_of_date AS VARCHAR) AS as_of_date, total_customer_count, CAST(NULL AS VARCHAR) AS notes
FROM raw_partner_customer_counts""")
add("q_top_revenue", """
SELECT partner_id, partner_name, revenue_closed_won FROM partner_rankings
ORDER BY coalesce(revenue_closed_won, 0) DESC, partner_id LIMIT 10""")
add("q_quadrant", """
SELECT partner_id, partner_name, total_leads, coalesce(lead_to_won_rate, 0) AS lead_to_won_rate, revenue_closed_won,
  volume_efficiency_quadrant FROM partner_rankings""")

add("d_leads_by_month_source", """
SELECT lead_created_month, source_type, count(DISTINCT contact_id) AS leads
FROM partner_leads WHERE partner_id IS NOT NULL GROUP BY 1, 2""")
add("d_drop_off_callout", """
SELECT partner_id, deal_stage, drop_off_rate FROM (
  SELECT partner_id, deal_stage, drop_off_rate,
    row_number() OVER (PARTITION BY partner_id ORDER BY drop_off_rate DESC, stage_order ASC) AS rn
  FROM partner_funnel_stage_conversion WHERE drop_off_rate IS NOT NULL) x WHERE rn = 1""")
add("d_source_split", """
SELECT partner_id, partner_name, source_type, count(DISTINCT contact_id) AS leads FROM partner_leads GROUP BY ALL""")
add("d_form_breakdown", """
SELECT form_company_size, form_industry, count(DISTINCT contact_id) AS leads FROM partner_leads WHERE source_type = 'form' GROUP BY ALL""")
add("d_time_to_touch", """
SELECT partner_id, avg(hours_to_first_sales_touch) AS avg_hours,
  quantile_cont(hours_to_first_sales_touch, 0.5) AS p50_hours, quantile_cont(hours_to_first_sales_touch, 0.9) AS p90_hours,
  count(hours_to_first_sales_touch) AS n_touched
FROM partner_leads WHERE partner_id IS NOT NULL GROUP BY 1""")
add("d_rep_partner_matrix", f"""
SELECT deal_owner_name, partner_name, sum(deals_won) AS deals_won, sum(deals_total) AS deals_total, sum(revenue_closed_won) AS revenue_closed_won,
  {ratio('sum(deals_won)', 'sum(deals_total)')} AS win_rate
FROM partner_rep_performance GROUP BY ALL""")
add("d_velocity_tiles", """
SELECT partner_id, t.tile, t.value FROM partner_summary, unnest([
  {tile: 'avg_hours_to_first_sales_touch', value: CAST(avg_hours_to_first_sales_touch AS DOUBLE)}, {tile: 'avg_days_contact_to_deal', value: avg_days_contact_to_deal},
  {tile: 'avg_deal_cycle_days', value: avg_deal_cycle_days}, {tile: 'avg_sales_touches_to_close', value: avg_sales_touches_to_close}]) AS u(t)
WHERE period_type = 'all_time'""")
add("d_deals_filtered", """
SELECT deal_id, partner_id, deal_owner_id, deal_created_at FROM partner_deals
WHERE deal_created_at >= TIMESTAMP '1996-01-01' AND partner_id IN ('p1', 'p3') AND deal_owner_id IN ('2', '5', '7')""")
for _one, _of in (("q_monthly_one", "q_monthly_by_partner"), ("q_partner_one", "q_partner_all_time"), ("q_funnel_one", "q_funnel"), ("q_reps_one", "q_reps"),
                  ("q_deals_one", "q_deals"), ("q_count_history_one", "q_count_history")):
    add(_one, f"SELECT * FROM ({QUERIES[_of]}) every WHERE partner_id = 'p3'")
add("d_leads_by_owner", """
SELECT l.contact_owner_id, o.owner_name, count(*) AS leads
FROM partner_leads l LEFT JOIN stg_owners o ON o.owner_id = l.contact_owner_id GROUP BY 1, 2""")
add("d_penetration_latest", """
SELECT partner_id, as_of_date, penetration_rate, our_customer_count, total_customer_count FROM (
  SELECT *, row_number() OVER (PARTITION BY partner_id ORDER BY as_of_date DESC) AS rn FROM partner_penetration) x
WHERE rn = 1""")
add("d_deals_in_range", """
SELECT deal_id, partner_id, deal_created_at, amount FROM partner_deals
WHERE deal_created_at >= TIMESTAMP '1997-01-01' AND deal_created_at < TIMESTAMP '1998-01-01'""")
add("d_funnel_tiles", """
SELECT partner_id, step, value FROM (
  SELECT partner_id, total_leads, leads_reached_mql, leads_reached_sql, total_deals_created, deals_closed_won
  FROM partner_summary WHERE period_type = 'all_time')
UNPIVOT (value FOR step IN (total_leads, leads_reached_mql, leads_reached_sql, total_deals_created, deals_closed_won))""")
add("d_quality_rates", """
SELECT partner_id, partner_name, mql_rate, sql_rate, disqualified_rate FROM partner_summary WHERE period_type = 'all_time'""")

# ----------------------------------------------------------------- forecast
def _forecast(series: str) -> str:
    """History and six months ahead: the mean leads of the last six months grow by 3 % a month; rate and deal size are theirs too."""
    return f"""
hist AS ({series}),
start AS (
  SELECT partner_id, greatest(avg(leads), 0.0) AS mean, max(month) AS last_month, sum(leads) AS l, sum(deals_won) AS w, sum(revenue) AS r
  FROM (FROM hist QUALIFY row_number() OVER (PARTITION BY partner_id ORDER BY month DESC) <= 6) recent GROUP BY partner_id),
defaults AS (
  SELECT partner_id, mean, last_month, 6 AS horizon_months, 6 AS trailing_months, CAST(3 AS DOUBLE) AS growth_pct_per_month,
    if(l > 0, w / l, 0.05) AS lead_to_won_rate, if(w > 0, r / w, 10000.0) AS avg_deal_size FROM start),
ahead AS (
  SELECT partner_id, CAST(last_month + to_months(CAST(i AS INTEGER)) AS DATE) AS month, mean * pow(1.03, i) AS leads,
    mean * pow(1.03, i) * lead_to_won_rate AS deals_won, mean * pow(1.03, i) * lead_to_won_rate * avg_deal_size AS revenue
  FROM defaults, range(1, 7) steps(i)),
forecast AS (SELECT *, 'history' AS kind FROM hist UNION ALL BY NAME SELECT *, 'forecast' AS kind FROM ahead)"""


_SERIES = """SELECT partner_id, period_start_date AS month, CAST(total_leads AS DOUBLE) AS leads, CAST(deals_closed_won AS DOUBLE) AS deals_won,
  CAST(revenue_closed_won AS DOUBLE) AS revenue FROM partner_summary WHERE period_type = 'month' AND period_start_date IS NOT NULL"""
_ALL = f"SELECT 'all' AS partner_id, month, sum(leads) AS leads, sum(deals_won) AS deals_won, sum(revenue) AS revenue FROM ({_SERIES}) s GROUP BY month"
_SUMS = "SELECT partner_id, sum(leads) AS leads, sum(deals_won) AS deals, sum(revenue) AS revenue FROM forecast WHERE kind = 'forecast' GROUP BY 1"
add("forecast_defaults", f"WITH {_forecast(_SERIES).strip()} SELECT * EXCLUDE (mean, last_month) FROM defaults")
add("forecast", f"WITH {_forecast(_SERIES).strip()} SELECT * FROM forecast")
add("forecast_totals", f"WITH {_forecast(_SERIES).strip()} {_SUMS}")
add("forecast_all", f"WITH {_forecast(_ALL).strip()} SELECT * FROM forecast")
add("forecast_all_totals", f"WITH {_forecast(_ALL).strip()} {_SUMS}")

# ------------------------------------------------------------------ publish
add("publish_targets", """
SELECT ['rankings', 'summary-month', 'penetration', 'summary-any', 'unknown'][r_regionkey + 1] AS id,
  ['partner_rankings', 'partner_summary', 'partner_penetration', 'partner_summary', 'partner_leads'][r_regionkey + 1] AS source_table,
  r_regionkey < 4 AS known_source FROM region""")


def _published(target: str, mart: str, properties: str, keys: tuple[str, ...] = (), title: str = "partner_name") -> str:
    """A mart's rows and the pages there are: partners with an even number have one, some a second one that is greater."""
    page = " || '/' || ".join(["'page'", "partner_id", *(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)])
    same = " AND ".join(["page.title = trim(mart.title)", *(f"page.{k} IS NOT DISTINCT FROM mart.{k}" for k in keys)])
    return f"""
WITH mart AS (SELECT *, {title} AS title FROM {mart}),
page AS (
  SELECT trim(title) AS title, {''.join(k + ', ' for k in keys)}max(if({page} LIKE '%4%', {page} || '-again', {page})) AS page_id
  FROM mart WHERE CAST(substr(partner_id, 2) AS BIGINT) % 2 = 0 GROUP BY ALL)
SELECT '{target}' AS target_id, if(page_id IS NULL, 'create', 'update') AS action, page_id, {properties}
FROM mart LEFT JOIN page ON {same}"""


_NAME = 'mart.title AS "Name"'
_RANKED = 'CAST(total_leads AS DOUBLE) AS "Leads", CAST(revenue_closed_won AS DOUBLE) AS "Revenue", is_top_performer AS "Top", volume_efficiency_quadrant AS "Quadrant"'
_WHEN = "CAST(mart.{} AS VARCHAR) AS \"When\""
add("publish_rankings", _published("rankings", "partner_rankings", f"{_NAME}, {_RANKED}"))
add("publish_penetration", _published("penetration", "partner_penetration",
    f"{_NAME}, {_WHEN.format('as_of_date')}, penetration_rate AS \"Rate\"", ("as_of_date",)))
add("publish_summary_month", _published("summary-month", "(FROM partner_summary WHERE period_type = 'month') monthly",
    f"{_NAME}, {_WHEN.format('period_start_date')}, CAST(total_leads AS DOUBLE) AS \"Leads\"", ("period_start_date",)).replace(
    "FROM mart WHERE CAST", "FROM (SELECT *, partner_name AS title FROM partner_summary) every WHERE CAST"))
add("publish_summary_unfiltered", _published("summary-any", "partner_summary",
    f"{_NAME}, mart.period_type AS \"Period\", {_WHEN.format('period_start_date')}, CAST(total_leads AS DOUBLE) AS \"Leads\"",
    ("period_type", "period_start_date")))
add("publish_long_titles", _published("rankings", "partner_rankings", _RANKED, (),
    "repeat('t', 2000) || if(partner_id = 'p1', 'NATION_2', partner_name)"))


def _status(target: str, query: str) -> str:
    return f"""SELECT '{target}' AS target_id, 'ok' AS status, count(*) || ' rows: ' || count(*) FILTER (WHERE page_id IS NULL) || ' created, '
  || count(page_id) || ' updated' AS message FROM ({QUERIES[query]}) plan"""


add("publish_log", f"""
SELECT *, {AS_OF} AS synced_at FROM (
  {_status('rankings', 'publish_rankings')} UNION ALL {_status('summary-month', 'publish_summary_month')}
  UNION ALL {_status('summary-any', 'publish_summary_unfiltered')}
  UNION ALL SELECT 'penetration', 'error', 'broken mart' UNION ALL SELECT 'unknown', 'error', 'unknown source table: partner_leads') every""")
add("rejected_counts", """
SELECT substr(CASE WHEN k % 5 = 1 THEN 'p' || k || repeat('x', 64) WHEN k % 10 = 4 THEN '' ELSE 'p' || k END, 1, 8) AS partner_id,
  if(k % 5 = 2, NULL, DATE '2001-06-30') AS as_of_date, if(k % 5 = 3, -k, k) AS total_customer_count,
  CASE WHEN k % 10 = 4 THEN 'partner_id is missing' WHEN k % 5 = 1 THEN 'partner_id is over 64 characters' WHEN k % 5 = 2 THEN 'as_of_date is missing'
       WHEN k % 5 = 3 THEN 'total_customer_count is negative' ELSE 'notes are over 500 characters' END AS reason
FROM (SELECT n_nationkey AS k FROM nation) n WHERE k % 5 <> 0""")
add("upsert_counts", """
SELECT partner_id, as_of_date, total_customer_count, CAST(NULL AS VARCHAR) AS notes FROM raw_partner_customer_counts a
WHERE NOT EXISTS (SELECT 1 FROM raw_partner_total_customers s WHERE s.partner_id = a.partner_id AND s.as_of_date = a.as_of_date)
UNION ALL
SELECT partner_id, as_of_date, total_customer_count, CAST(NULL AS VARCHAR) FROM raw_partner_total_customers
WHERE total_customer_count >= 0 AND length(trim(partner_id)) BETWEEN 1 AND 64 AND as_of_date IS NOT NULL""")
add("delete_counts", """
SELECT partner_id, as_of_date, total_customer_count, CAST(NULL AS VARCHAR) AS notes FROM raw_partner_customer_counts a
WHERE NOT EXISTS (SELECT 1 FROM raw_partner_total_customers s WHERE s.partner_id = a.partner_id AND s.as_of_date = a.as_of_date)""")

# ------------------------------------------------------------------ quality
add("check_close_before_create", """
SELECT 'assert_deal_close_date_after_create' AS "check", 'partner_deals' AS model, 'deal_close_date+deal_created_at' AS column_name,
  count(*) AS failures, 'warn' AS severity, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END AS status
FROM partner_deals WHERE deal_close_date < deal_created_at""")
add("check_unlisted_lead_partners", """
SELECT l.partner_name, count(*) AS lead_count
FROM partner_leads l LEFT JOIN stg_partners p ON lower(trim(l.partner_name)) = p.partner_name_key
WHERE p.partner_id IS NULL GROUP BY 1""")
# All casts of the five typed models, listed once more.
_LOSSES = """contact property_numberofemployees BIGINT, contact property_annualrevenue DECIMAL(18;2), contact property_createdate TIMESTAMP,
contact property_hs_lifecyclestage_lead_date TIMESTAMP, contact property_hs_lifecyclestage_marketingqualifiedlead_date TIMESTAMP,
contact property_hs_lifecyclestage_salesqualifiedlead_date TIMESTAMP, contact property_hs_lifecyclestage_opportunity_date TIMESTAMP,
contact property_hs_lifecyclestage_customer_date TIMESTAMP, deal property_hs_deal_stage_probability DOUBLE, deal property_amount DECIMAL(18;2),
deal property_amount_in_home_currency DECIMAL(18;2), deal property_createdate TIMESTAMP, deal property_closedate TIMESTAMP,
deal property_hs_closed_won_date TIMESTAMP, deal property_hs_is_closed_won BOOLEAN, deal property_hs_is_closed BOOLEAN,
engagement engagement_timestamp TIMESTAMP, contact_form submitted_at TIMESTAMP"""
add("check_lost_by_cast", " UNION ALL ".join(f"""
SELECT '{t}.{c}' AS column_name, count(*) FILTER (WHERE NULLIF(trim(CAST({c} AS VARCHAR)), '') IS NOT NULL
  AND TRY_CAST(NULLIF(CAST({c} AS VARCHAR), '') AS {kind.replace(';', ',')}) IS NULL) AS lost_values FROM raw_{t}"""
    for t, c, kind in (x.split() for x in _LOSSES.replace("\n", " ").split(","))))
_FAILING = " UNION ALL ".join([
    """SELECT 'not_null:contact.property_jobtitle' AS "check", '{"id":"' || id || '"}' AS failing_key, 1 AS n FROM raw_contact WHERE property_jobtitle IS NULL""",
    """SELECT 'unique:contact.property_company', '{"property_company":"' || property_company || '"}', count(*) FROM raw_contact
       WHERE property_company IS NOT NULL GROUP BY property_company HAVING count(*) > 1""",
    """SELECT 'unique:contact.property_industry+property_lifecyclestage',
       '{"property_industry":"' || property_industry || '","property_lifecyclestage":"' || property_lifecyclestage || '"}', count(*) FROM raw_contact
       GROUP BY property_industry, property_lifecyclestage HAVING count(*) > 1""",
    """SELECT 'accepted_values:contact.property_lifecyclestage', '{"id":"' || id || '"}', 1 FROM raw_contact
       WHERE property_lifecyclestage NOT IN ('lead', 'customer')""",
    """SELECT 'unique:deal_contact.deal_id', '{"deal_id":"' || deal_id || '"}', count(*) FROM raw_deal_contact GROUP BY deal_id HAVING count(*) > 1"""])
add("quality_failures", f"""
SELECT "check", failing_key, n FROM ({_FAILING}) every QUALIFY row_number() OVER (PARTITION BY "check" ORDER BY failing_key) <= 5""")
add("source_freshness", " UNION ALL ".join(f"""
SELECT '{t}' AS source_table, max(_fivetran_synced) AS max_loaded_at,
  (epoch_us({AS_OF}) - epoch_us(max(_fivetran_synced))) / 3.6e9 AS age_hours,
  CASE WHEN max(_fivetran_synced) IS NULL OR (epoch_us({AS_OF}) - epoch_us(max(_fivetran_synced))) / 3.6e9 > 24 THEN 'error'
       WHEN (epoch_us({AS_OF}) - epoch_us(max(_fivetran_synced))) / 3.6e9 > 6 THEN 'warn' ELSE 'pass' END AS status
FROM raw_{t}""" for t in ("contact", "deal", "engagement")))

# ------------------------------------------------------------------- merges
add("upsert_contacts", """
SELECT id, CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN 'customer' ELSE property_lifecyclestage END AS property_lifecyclestage,
  property_email,
  CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN _fivetran_synced + INTERVAL 2 HOUR ELSE _fivetran_synced END AS _fivetran_synced,
  _archived
FROM raw_contact""")
add("partner_leads_incremental_merge", "SELECT *, 'note ' || contact_id AS stored_note FROM partner_leads")
add("partner_deals_incremental_merge", "SELECT *, 'note ' || deal_id AS stored_note FROM partner_deals")
add("upsert_keeps_columns", """
SELECT id, property_email, if(CAST(id AS BIGINT) % 5 = 0, 'late', property_lifecyclestage) AS property_lifecyclestage, _fivetran_synced FROM raw_contact
UNION ALL SELECT 'new-' || id, NULL, 'new', _fivetran_synced FROM raw_contact WHERE CAST(id AS BIGINT) % 9 = 0""")

# ------------------------------------------------------------------ landing
add("land_contacts", f"SELECT * REPLACE ({AS_OF} AS _fivetran_synced) FROM raw_contact")
add("land_stage_history", "SELECT * FROM raw_deal_stage_history")
add("land_deal_contacts", """
SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, CAST(o_custkey AS VARCHAR) AS contact_id, TRUE AS is_primary FROM orders
UNION ALL
SELECT CAST(o.o_orderkey AS VARCHAR), CAST(o.o_custkey + 1 AS VARCHAR), FALSE FROM orders o
WHERE o.o_orderkey % 5 = 0 AND EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey + 1)""")
add("land_submissions", """
WITH s AS (
  SELECT event_id AS e, user_id AS u, 'f' || CAST(event_id % 5 AS VARCHAR) AS form_id,
    make_timestamp(CAST(floor(epoch_us(make_timestamp(epoch_us(TIMESTAMP '1995-01-01 00:00:00')
      + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) * 80)) / 1000) AS BIGINT) * 1000) AS submitted_at,
    'user' || CAST(user_id AS VARCHAR) || '@corp' || CAST(user_id % 50 AS VARCHAR) || '.example' AS email
  FROM events WHERE event_type = 'signup'),
idx AS (SELECT lower(property_email) AS em, min(id) AS cid FROM raw_contact
        WHERE property_email IS NOT NULL AND property_email <> '' GROUP BY 1)
SELECT CASE WHEN e % 3 = 0 THEN form_id || ':' || CAST(CAST(floor(epoch_us(submitted_at) / 1000000) AS BIGINT) AS VARCHAR) || ':' || email
            ELSE 's' || CAST(e AS VARCHAR) END AS conversion_id,
  idx.cid AS contact_id, form_id, submitted_at, email, CAST(e % 4 AS VARCHAR) AS company_size,
  CASE WHEN e % 2 = 0 THEN 'ind' || CAST((e + 1) % 6 AS VARCHAR) ELSE 'ind' || CAST(e % 6 AS VARCHAR) END AS industry,
  CAST(NULL AS VARCHAR) AS nameless
FROM s LEFT JOIN idx ON idx.em = lower(s.email)""")


# The declared data tests once more: columns that must be filled, keys, values and bounds.
_RAW = {"contact", "deal", "engagement", "ref_partners", "partner_total_customers", "partner_customer_counts"}
_KEYS = """contact id, deal deal_id, engagement engagement_id, ref_partners partner_id, ref_partners partner_name, stg_contacts contact_id, stg_deals deal_id,
stg_engagements engagement_id, stg_form_submissions submission_id, stg_owners owner_id, stg_partners partner_id, int_partner_contact_attribution contact_id,
int_contact_first_touch contact_id, int_deal_primary_contact deal_id, int_deal_sales_touches deal_id, partner_leads contact_id, partner_deals deal_id,
partner_rankings partner_id"""
_TOGETHER = """partner_total_customers partner_id+as_of_date, stg_engagement_contacts engagement_id+contact_id, stg_deal_contacts deal_id+contact_id,
stg_partner_totals partner_id+as_of_date, int_deal_stage_durations deal_id+deal_stage, partner_deal_stage_durations deal_id+deal_stage,
partner_funnel_stage_conversion partner_id+deal_stage, partner_summary partner_id+period_type+period_start_date,
partner_rep_performance partner_id+deal_owner_id, partner_penetration partner_id+as_of_date, partner_lead_cohorts partner_id+cohort_month"""
_FILLED = """partner_customer_counts partner_id, partner_customer_counts as_of_date, partner_customer_counts total_customer_count,
partner_total_customers partner_id, partner_total_customers as_of_date, partner_total_customers total_customer_count, stg_contacts contact_created_at,
stg_deals deal_created_at, stg_stage_history deal_id, stg_stage_history deal_stage, stg_stage_history entered_at, stg_form_submissions contact_id,
stg_partners partner_name, int_partner_contact_attribution partner_name, int_partner_contact_attribution source_type,
int_deal_primary_contact primary_contact_id, partner_leads partner_name, partner_leads source_type, partner_leads lead_created_at,
partner_deals partner_name, partner_deals deal_stage"""
_BAD = [
    ("accepted_values", "stg_deals deal_status", "deal_status NOT IN ('won', 'lost', 'open')"),
    ("accepted_values", "partner_deals deal_status", "deal_status NOT IN ('won', 'lost', 'open')"),
    ("accepted_values", "int_partner_contact_attribution source_type", "source_type NOT IN ('partner_email', 'form')"),
    ("accepted_values", "partner_leads source_type", "source_type NOT IN ('partner_email', 'form')"),
    ("accepted_values", "partner_rankings volume_efficiency_quadrant", "NOT regexp_full_match(volume_efficiency_quadrant, '(high|low)_volume_(high|low)_conversion')"),
    ("accepted_range", "partner_total_customers total_customer_count", "total_customer_count < 0"),
    ("accepted_range", "partner_funnel_stage_conversion stage_conversion_rate", "stage_conversion_rate NOT BETWEEN 0 AND 1"),
    ("accepted_range", "partner_funnel_stage_conversion next_stage_conversion_rate", "next_stage_conversion_rate NOT BETWEEN 0 AND 1"),
    ("accepted_range", "partner_penetration penetration_rate", "penetration_rate NOT BETWEEN 0 AND 100"),
]


def _quality_sql() -> str:
    """Failing rows of each test; of a key the rows that share it."""
    def one(kind: str, at: str, failing: str) -> str:
        model, columns = at.split()
        table = f"raw_{model}" if model in _RAW else model
        return f"""SELECT '{kind}:{model}.{columns}' AS "check", '{model}' AS model, '{columns}' AS column_name, ({failing.format(table=table)}) AS failures"""

    listed = lambda text: [x.strip() for x in text.replace("\n", " ").split(",")]
    rows = lambda condition: f"SELECT count(*) FROM {{table}} WHERE {condition}"
    parts = [one("not_null", at, rows(f"{at.split()[1]} IS NULL")) for at in listed(_KEYS) + listed(_FILLED)]
    for at in listed(_KEYS) + listed(_TOGETHER):
        columns = at.split()[1].replace("+", ", ")
        known = "" if ", " in columns else f" WHERE {columns} IS NOT NULL"
        parts.append(one("unique", at, f"SELECT coalesce(CAST(sum(n) AS BIGINT), 0) FROM (SELECT count(*) AS n FROM {{table}}{known} GROUP BY {columns} HAVING n > 1) d"))
    parts += [one(kind, at, rows(bad)) for kind, at, bad in _BAD]
    return "SELECT *, 'error' AS severity, if(failures = 0, 'pass', 'error') AS status FROM (" + " UNION ALL ".join(parts) + ") every"


add("quality_checks", _quality_sql())

# -------------------------------------------------------- more landing keys
add("land_deals", f"SELECT * REPLACE ({AS_OF} AS _fivetran_synced) FROM raw_deal")

_SCALED = ("make_timestamp(epoch_us(TIMESTAMP '1995-01-01 00:00:00') + "
           "(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) * 80)")
add("land_engagements", f"""
SELECT CAST(event_id AS VARCHAR) AS engagement_id,
  CASE event_type WHEN 'click' THEN 'EMAIL' WHEN 'view' THEN 'CALL' WHEN 'purchase' THEN 'MEETING'
       WHEN 'error' THEN 'NOTE' ELSE 'TASK' END AS engagement_type,
  CASE WHEN event_id % 3 <> 0 THEN make_timestamp(CAST(floor(epoch_us({_SCALED}) / 1000) AS BIGINT) * 1000)
       ELSE date_trunc('second', {_SCALED}) END AS engagement_timestamp,
  CAST(user_id % 10 AS VARCHAR) AS owner_id,
  CASE event_type WHEN 'click' THEN 'emails' WHEN 'view' THEN 'calls' WHEN 'purchase' THEN 'meetings'
       WHEN 'error' THEN 'notes' ELSE 'tasks' END AS engagement_source,
  CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'INCOMING' ELSE 'outgoing' END END
    AS email_metadata_direction,
  CASE WHEN event_type = 'click' THEN 'Rep@Nation' || CAST(user_id % 25 AS VARCHAR) || '.Example' END AS email_metadata_from_email,
  CAST(NULL AS VARCHAR) AS email_metadata_subject, {AS_OF} AS _fivetran_synced, FALSE AS _archived
FROM events""")
add("land_engagement_contacts", "SELECT CAST(event_id AS VARCHAR) AS engagement_id, CAST(user_id AS VARCHAR) AS contact_id FROM events")
add("land_owners", """
SELECT CAST(s_suppkey AS VARCHAR) AS owner_id, 'rep' || CAST(s_suppkey AS VARCHAR) || '@vendor.example' AS email,
  s_name AS first_name, CAST(NULL AS VARCHAR) AS last_name,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS team_id,
  CASE WHEN s_suppkey % 2 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' ELSE TIMESTAMP '2000-01-01 00:00:00' END AS created_at,
  CASE WHEN s_suppkey % 5 = 0 THEN FALSE ELSE s_suppkey % 7 = 0 END AS archived
FROM supplier""")
add("objects_modified_since", f"""
SELECT deal_id AS id, strftime(_fivetran_synced, '%Y-%m-%dT%H:%M:%SZ') AS "updatedAt" FROM raw_deal
WHERE _fivetran_synced >= {AS_OF} - INTERVAL 7 DAY""")
add("land_with_archived", "SELECT deal_id, property_dealstage, _archived FROM raw_deal")

add("scalar_functions", """
SELECT id,
  TRY_CAST(NULLIF(property_numberofemployees, '') AS BIGINT) AS employees,
  TRY_CAST(NULLIF(property_annualrevenue, '') AS DECIMAL(18,2)) AS revenue,
  TRY_CAST(NULLIF(CAST(_archived AS VARCHAR), '') AS BOOLEAN) AS archived,
  CASE WHEN NULLIF(TRY_CAST(NULLIF(property_numberofemployees, '') AS BIGINT), 0) IS NULL THEN NULL
       ELSE CAST(TRY_CAST(NULLIF(property_annualrevenue, '') AS DECIMAL(18,2)) AS DOUBLE)
            / TRY_CAST(NULLIF(property_numberofemployees, '') AS BIGINT) END AS revenue_per_employee,
  (epoch_us(TRY_CAST(NULLIF(property_hs_lifecyclestage_marketingqualifiedlead_date, '') AS TIMESTAMP))
   - epoch_us(TRY_CAST(NULLIF(property_createdate, '') AS TIMESTAMP))) / 1000000.0 AS seconds_to_mql,
  (epoch_us(TRY_CAST(NULLIF(property_hs_lifecyclestage_marketingqualifiedlead_date, '') AS TIMESTAMP))
   - epoch_us(TRY_CAST(NULLIF(property_createdate, '') AS TIMESTAMP))) / 1000000.0 / 3600.0 AS hours_to_mql,
  NULLIF(regexp_extract(lower(property_email), '@([^@]+)$', 1), '') AS email_domain,
  lower(trim(property_referring_partner)) AS partner_key,
  NULLIF(trim(property_referring_partner), '') AS partner_declared,
  CAST(date_trunc('month', TRY_CAST(NULLIF(property_createdate, '') AS TIMESTAMP)) AS DATE) AS created_month,
  CAST(date_trunc('quarter', TRY_CAST(NULLIF(property_createdate, '') AS TIMESTAMP)) AS DATE) AS created_quarter,
  CAST(date_trunc('month', TRY_CAST(NULLIF(property_createdate, '') AS TIMESTAMP)) - INTERVAL 11 MONTH AS DATE) AS created_month_minus_11,
  TRY_CAST(NULLIF(property_createdate, '') AS TIMESTAMP) - INTERVAL 14 DAY AS created_minus_14d,
  property_email AS json_roundtrip
FROM raw_contact""")

add("int_attribution_evidence", "SELECT * FROM int_attr_union")

# ------------------------------------------- raw tables after two landing runs
_WEEK = f"{AS_OF} - INTERVAL 7 DAY"
_LOADED = f"if(_fivetran_synced >= {_WEEK}, {AS_OF}, {_WEEK}) AS _fivetran_synced"
for _table in ("contact", "deal"):
    add(f"raw_{_table}", f"SELECT * REPLACE ({_LOADED}) FROM raw_{_table}")
add("raw_deal_stage_history", "SELECT * FROM raw_deal_stage_history")
add("raw_deal_contact", QUERIES["land_deal_contacts"])
# The second run reads what changed since (every seventh) and what has no readable modified time.
add("raw_engagement", f"""
SELECT * REPLACE (if(CAST(engagement_id AS BIGINT) % 7 = 0 OR CAST(engagement_id AS BIGINT) % 4 IN (2, 3), {AS_OF}, {_WEEK}) AS _fivetran_synced,
  if(CAST(engagement_id AS BIGINT) % 7 = 0, CAST(CAST(owner_id AS INTEGER) + 100 AS VARCHAR), owner_id) AS owner_id)
FROM ({QUERIES['land_engagements']}) e""")
add("raw_engagement_contact", QUERIES["land_engagement_contacts"])
add("raw_owner", QUERIES["land_owners"])
add("raw_form", """
SELECT if(k IN (1, 5), 'f' || k || '-guid', 'f' || k) AS form_id, 'Form ' || k AS name
FROM (SELECT DISTINCT event_id % 6 AS k FROM events WHERE event_type = 'signup') f WHERE k <> 5""")
add("raw_contact_form", f"""
SELECT conversion_id, contact_id, form_id, submitted_at, CAST(NULL AS VARCHAR) AS page_url,
  '{{"email":"' || email || '","company_size":"' || company_size || '","industry":"' || industry || '"}}' AS submission_values
FROM ({QUERIES['land_submissions']}) s""")
add("raw_partner_customer_counts", "SELECT *, CAST(NULL AS VARCHAR) AS notes FROM raw_partner_customer_counts")
add("sync_state", f"SELECT unnest(['contact', 'deal', 'engagement']) AS object_name, {AS_OF} AS last_sync_at")
add("seed_ref_partners", "SELECT * FROM raw_ref_partners")
add("seed_partner_total_customers", "SELECT * FROM raw_partner_total_customers")
