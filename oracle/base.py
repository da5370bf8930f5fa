"""DuckDB oracle SQL, written from the rules in words, independent of the DataFrame code.

``with_models(select)`` prefixes a final SELECT with every CTE below: the
fixture mapping (driver tables -> raw CRM tables), staging, intermediate and
mart models. DuckDB drops the CTEs a query does not read.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
LOOKBACK_DAYS = 14


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


def _days(ts: str, n: str) -> str:
    return f"(CAST({ts} AS TIMESTAMP) + to_days(CAST({n} AS INTEGER)))"


def _scale(ts: str) -> str:
    return ("make_timestamp(epoch_us(TIMESTAMP '1995-01-01 00:00:00') + "
            f"(epoch_us({ts}) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) * 80)")


def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _safe(x: str, t: str) -> str:
    return f"TRY_CAST(NULLIF(CAST({x} AS VARCHAR), '') AS {t})"


def seconds(end: str, start: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 1000000.0)"


def ratio(part: str, whole: str) -> str:
    """A share; null where the whole is zero or null."""
    return f"(CAST({part} AS DOUBLE) / NULLIF({whole}, 0))"


CTES: list[tuple[str, str]] = []


def cte(name: str, body: str) -> None:
    CTES.append((name, body))


# ----------------------------------------------------------------- fixture
cte("raw_ref_partners", f"""
SELECT 'p' || {_v('n.n_nationkey')} AS partner_id, n.n_name AS partner_name,
       CASE WHEN n.n_nationkey % 5 = 4 THEN NULL ELSE 'Nation' || {_v('n.n_nationkey')} || '.example' END AS partner_domain,
       r.r_name AS partner_tier, DATE '1995-01-01' AS partner_start_date
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

_CREATED = _iso(_days("TIMESTAMP '1994-07-01'", "(c.c_custkey * 37) % 2000"))
_QUALIFIED = _iso(_days("TIMESTAMP '1994-07-01'", "(c.c_custkey * 37) % 2000 + c.c_custkey % 30"))

cte("raw_contact", f"""
SELECT {_v('c.c_custkey')} AS id,
  CASE WHEN c.c_custkey % 97 = 0 THEN '' ELSE 'User' || {_v('c.c_custkey')} || '@Corp' || {_v('c.c_custkey % 50')} || '.Example' END AS property_email,
  if(c.c_custkey % 4 = 0, '', 'First' || c.c_custkey) AS property_firstname, if(c.c_custkey % 6 <> 0, 'Last' || (c.c_custkey % 100), NULL) AS property_lastname,
  if(c.c_custkey % 5 = 0, '', 'Company ' || (c.c_custkey % 50)) AS property_company,
  CASE c.c_custkey % 3 WHEN 0 THEN 'CTO' WHEN 1 THEN 'Buyer' END AS property_jobtitle, 'ind' || (c.c_custkey % 7) AS property_industry,
  CASE WHEN c.c_custkey % 13 = 0 THEN '' WHEN c.c_custkey % 21 = 7 THEN 'many' ELSE {_v('c.c_custkey % 1000')} END AS property_numberofemployees,
  if(c.c_custkey % 23 = 5, 'n/a', {_v('CAST(c.c_acctbal AS DECIMAL(18,2))')}) AS property_annualrevenue,
  CASE c.c_custkey % 6 WHEN 0 THEN 'lead' WHEN 1 THEN 'MarketingQualifiedLead' WHEN 2 THEN 'salesqualifiedlead'
       WHEN 3 THEN 'opportunity' WHEN 4 THEN 'customer' ELSE 'other' END AS property_lifecyclestage,
  CASE WHEN c.c_custkey % 17 = 0 THEN 'UNQUALIFIED' WHEN c.c_custkey % 19 = 0 THEN 'bad_fit' ELSE 'OPEN' END AS property_hs_lead_status,
  CASE WHEN c.c_custkey % 47 = 3 THEN 'soon' WHEN c.c_custkey % 49 = 4 THEN '' ELSE {_CREATED} END AS property_createdate,
  CASE WHEN c.c_custkey % 31 = 8 THEN 'not a date' WHEN c.c_custkey % 6 IN (2, 3, 4) AND c.c_custkey % 4 <> 0
       THEN {_QUALIFIED} ELSE '' END
       AS property_hs_lifecyclestage_marketingqualifiedlead_date,
  if(c.c_custkey % 2 = 0, {_CREATED}, '') AS property_hs_lifecyclestage_lead_date,
  if(c.c_custkey % 12 = 3, {_QUALIFIED}, NULL) AS property_hs_lifecyclestage_salesqualifiedlead_date,
  if(c.c_custkey % 6 = 3, {_QUALIFIED}, '') AS property_hs_lifecyclestage_opportunity_date,
  if(c.c_custkey % 6 = 4, {_QUALIFIED}, '') AS property_hs_lifecyclestage_customer_date,
  if(c.c_custkey % 3 = 0, 'DIRECT_TRAFFIC', NULL) AS property_hs_latest_source, 'd' || (c.c_custkey % 5) AS property_hs_latest_source_data_1,
  CAST(NULL AS VARCHAR) AS property_hs_latest_source_data_2,
  CASE WHEN c.c_custkey % 8 = 3 THEN 'REFERRALS' ELSE 'ORGANIC_SEARCH' END AS property_hs_analytics_source,
  CASE WHEN c.c_custkey % 8 = 3 THEN ' ' || lower(n.n_name) END AS property_hs_analytics_source_data_1,
  CASE WHEN c.c_custkey % 16 = 3 THEN 'NATION_' || {_v('c.c_custkey % 20')} END AS property_hs_analytics_source_data_2,
  {_v('c.c_custkey % 10')} AS property_hubspot_owner_id,
  CASE WHEN c.c_custkey % 10 = 0 THEN '  ' || lower(n.n_name) || ' ' WHEN c.c_custkey % 40 = 5 THEN 'Unlisted Partner' ELSE '' END
       AS property_referring_partner,
  if(c.c_custkey % 9 = 0, ' Partner Referral (Partner) ', '') AS property_lead_origin, if(c.c_custkey % 9 = 1, 'PARTNER', NULL) AS property_lead_source,
  if(c.c_custkey % 9 = 2, ' met at a fair ', NULL) AS property_partner_source,
  {_days(AS_OF, '-(c.c_custkey % 30)')} AS _fivetran_synced,
  c.c_custkey % 101 = 0 AS _archived
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

_STAGE = """CASE WHEN o.o_orderstatus = 'F' THEN 'Closed_Won'
     WHEN o.o_orderstatus = 'P' AND substr(o.o_orderpriority, 1, 1) IN ('4', '5') THEN 'closed_lost'
     WHEN substr(o.o_orderpriority, 1, 1) = '1' THEN 'negotiation'
     WHEN substr(o.o_orderpriority, 1, 1) = '2' THEN 'proposal'
     WHEN substr(o.o_orderpriority, 1, 1) = '3' THEN 'demo' ELSE 'discovery' END"""

cte("raw_deal_base", f"""
SELECT o.*, n.n_name, {_STAGE} AS stage FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("raw_deal", f"""
SELECT {_v('o_orderkey')} AS deal_id,
  'Company ' || {_v('o_custkey % 300')} || CASE WHEN o_orderkey % 5 = 0 THEN ' expansion' ELSE '' END AS property_dealname,
  'pipe' || (o_orderkey % 2) AS property_pipeline,
  if(o_orderkey % 29 <> 9, stage, NULL) AS property_dealstage,
  CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 21 = 3 THEN 'high' ELSE '0.' || (o_orderkey % 10) END AS property_hs_deal_stage_probability,
  CASE WHEN o_orderkey % 53 = 0 THEN '' ELSE {_v('CAST(o_totalprice AS DECIMAL(18,2))')} END AS property_amount,
  if(o_orderkey % 2 = 0, {_v('CAST(o_totalprice AS DECIMAL(18,2))')}, '') AS property_amount_in_home_currency,
  if(o_orderkey % 33 = 6, 'unknown', {_iso('o_orderdate')}) AS property_createdate,
  CASE WHEN stage IN ('Closed_Won', 'closed_lost')
       THEN {_iso(_days('o_orderdate', 'CASE WHEN o_orderkey % 97 = 0 THEN -3 ELSE o_orderkey % 90 END'))} ELSE '' END AS property_closedate,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 <> 0 THEN {_iso(_days('o_orderdate', 'o_orderkey % 90'))} ELSE '' END
       AS property_hs_closed_won_date,
  CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS property_hs_is_closed_won,
  CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN stage IN ('Closed_Won', 'closed_lost') THEN 'true' ELSE 'false' END AS property_hs_is_closed,
  if(o_orderkey % 2 = 0, 'existingbusiness', 'newbusiness') AS property_dealtype,
  {_v('o_orderkey % 11')} AS property_hubspot_owner_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'Partner Referral' WHEN 1 THEN ' partner referral ' WHEN 2 THEN 'Inbound' ELSE '' END
       AS property_deal_source,
  CASE WHEN o_orderkey % 6 IN (0, 1) THEN n_name WHEN o_orderkey % 24 IN (2, 8) THEN 'Unlisted Partner' ELSE '' END
       AS property_referring_partner,
  if(o_orderkey % 3 = 0, ' by phone ', NULL) AS property_deal_source_detail,
  {_days(AS_OF, '-(o_orderkey % 30)')} - INTERVAL 10 HOUR AS _fivetran_synced,
  o_orderkey % 103 = 0 AS _archived
FROM raw_deal_base""")

cte("raw_deal_contact", f"""
SELECT {_v('o_orderkey')} AS deal_id, {_v('o_custkey')} AS contact_id, o_orderkey % 3 <> 0 AS is_primary
FROM orders WHERE o_orderkey % 50 <> 7
UNION ALL
SELECT {_v('o.o_orderkey')}, {_v('o.o_custkey + 1')}, FALSE
FROM orders o WHERE o.o_orderkey % 5 = 0 AND EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey + 1)""")

cte("raw_deal_stage_history", f"""
SELECT deal_id, stage_id, entered_at,
       lead(entered_at) OVER (PARTITION BY deal_id ORDER BY entered_at, stage_id) AS exited_at
FROM (SELECT DISTINCT {_v('l_orderkey')} AS deal_id,
        CASE l_linenumber WHEN 1 THEN 'Discovery' WHEN 2 THEN 'demo' WHEN 3 THEN 'proposal' WHEN 4 THEN 'negotiation'
             WHEN 5 THEN 'closed_won' WHEN 6 THEN 'closed_lost' WHEN 7 THEN 'demo' END AS stage_id,
        CAST(l_shipdate AS TIMESTAMP) AS entered_at
      FROM lineitem) x""")

cte("raw_engagement", f"""
SELECT {_v('event_id')} AS engagement_id,
  CASE event_type WHEN 'click' THEN 'EMAIL' WHEN 'view' THEN 'call' WHEN 'purchase' THEN 'meeting'
       WHEN 'error' THEN 'note' WHEN 'signup' THEN 'task' END AS engagement_type,
  {_scale('ts')} AS engagement_timestamp,
  {_v('user_id % 10')} AS owner_id,
  CAST(NULL AS VARCHAR) AS engagement_source,
  CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'INCOMING' ELSE 'outgoing' END END AS email_metadata_direction,
  CASE WHEN event_type = 'click' THEN 'Rep@Nation' || {_v('user_id % 25')} || '.Example' END AS email_metadata_from_email,
  CAST(NULL AS VARCHAR) AS email_metadata_subject,
  {AS_OF} - INTERVAL 30 HOUR AS _fivetran_synced
FROM events""")

cte("raw_engagement_contact", f"SELECT {_v('event_id')} AS engagement_id, {_v('user_id')} AS contact_id FROM events")

cte("raw_owner", f"""
SELECT {_v('s.s_suppkey')} AS owner_id, 'rep' || {_v('s.s_suppkey')} || '@vendor.example' AS email,
  s.s_name AS first_name, CASE WHEN s.s_suppkey % 4 = 0 THEN NULL ELSE n.n_name END AS last_name,
  {_v('s.s_nationkey')} AS team_id, CAST(NULL AS TIMESTAMP) AS created_at, s.s_suppkey % 7 = 0 AS archived
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")

cte("raw_form", """
SELECT * FROM (VALUES ('f0', 'Partner Referral - A'), ('f1', 'partner introduction'), ('f2', 'Contact us'),
                      ('f3', CAST(NULL AS VARCHAR))) t(form_id, name)""")

cte("raw_contact_form", f"""
SELECT 's' || {_v('event_id')} AS conversion_id,
  CASE WHEN user_id % 23 = 0 THEN NULL ELSE {_v('user_id')} END AS contact_id,
  'f' || {_v('event_id % 5')} AS form_id,
  {_scale('ts')} AS submitted_at,
  CAST(NULL AS VARCHAR) AS page_url,
  '{{"email":"user' || {_v('user_id')} || '@corp' || {_v('user_id % 50')} || '.example","company_size":"' || {_v('event_id % 4')}
    || '","industry":"ind' || {_v('event_id % 6')} || '"'
    || CASE WHEN event_id % 7 = 0 THEN ',"partner_name":" nation_' || {_v('user_id % 25')} || ' "'
            WHEN event_id % 7 = 1 THEN ',"partner_name":"","referring_partner":"NATION_3"' ELSE '' END
    || '}}' AS submission_values
FROM events WHERE event_type = 'signup'""")

cte("raw_partner_customer_counts", f"""
SELECT 'p' || {_v('n.n_nationkey')} AS partner_id, d.as_of_date, CAST(100 + n.n_nationkey * 10 AS INTEGER) AS total_customer_count
FROM nation n CROSS JOIN (VALUES (DATE '2000-12-31'), (DATE '2001-12-31')) d(as_of_date)""")

cte("raw_partner_total_customers", f"""
SELECT 'p' || {_v('n.n_nationkey')} AS partner_id, n.n_name AS partner_name, d.as_of_date,
       CAST(n.n_nationkey * 5 AS INTEGER) AS total_customer_count
FROM nation n CROSS JOIN (VALUES (DATE '1999-12-31'), (DATE '2000-12-31')) d(as_of_date)""")

# ----------------------------------------------------------------- staging
cte("stg_contacts", f"""
SELECT id AS contact_id, lower(property_email) AS email,
  NULLIF(regexp_extract(lower(property_email), '@([^@]+)$', 1), '') AS email_domain,
  property_firstname AS first_name, property_lastname AS last_name, property_company AS company_name,
  property_jobtitle AS job_title, property_industry AS industry,
  {_safe('property_numberofemployees', 'BIGINT')} AS company_size_employees,
  {_safe('property_annualrevenue', 'DECIMAL(18,2)')} AS company_annual_revenue,
  lower(property_lifecyclestage) AS lifecycle_stage, lower(property_hs_lead_status) AS lead_status,
  {_safe('property_createdate', 'TIMESTAMP')} AS contact_created_at,
  {_safe('property_hs_lifecyclestage_lead_date', 'TIMESTAMP')} AS became_lead_at,
  {_safe('property_hs_lifecyclestage_marketingqualifiedlead_date', 'TIMESTAMP')} AS became_mql_at,
  {_safe('property_hs_lifecyclestage_salesqualifiedlead_date', 'TIMESTAMP')} AS became_sql_at,
  {_safe('property_hs_lifecyclestage_opportunity_date', 'TIMESTAMP')} AS became_opportunity_at,
  {_safe('property_hs_lifecyclestage_customer_date', 'TIMESTAMP')} AS became_customer_at,
  property_hs_analytics_source AS original_source,
  property_hs_analytics_source_data_1 AS original_source_drill_down_1,
  property_hs_analytics_source_data_2 AS original_source_drill_down_2,
  property_hs_latest_source AS latest_source, property_hs_latest_source_data_1 AS latest_source_drill_down_1,
  property_hs_latest_source_data_2 AS latest_source_drill_down_2,
  property_hubspot_owner_id AS contact_owner_id,
  NULLIF(trim(property_referring_partner), '') AS referring_partner_declared,
  lower(NULLIF(trim(property_lead_origin), '')) AS lead_origin_declared,
  lower(NULLIF(trim(property_lead_source), '')) AS lead_source_declared,
  NULLIF(trim(property_partner_source), '') AS partner_source_notes,
  _fivetran_synced AS _synced_at
FROM raw_contact""")

_FLAG = "lower(trim(coalesce(property_{}, '')))"

cte("stg_deals", f"""
SELECT deal_id, property_dealname AS deal_name, property_pipeline AS pipeline_id, lower(property_dealstage) AS deal_stage,
  {_safe('property_hs_deal_stage_probability', 'DOUBLE')} AS deal_stage_probability, {_safe('property_amount', 'DECIMAL(18,2)')} AS amount,
  {_safe('property_amount_in_home_currency', 'DECIMAL(18,2)')} AS amount_home_currency,
  {_safe('property_createdate', 'TIMESTAMP')} AS deal_created_at, {_safe('property_closedate', 'TIMESTAMP')} AS deal_close_date,
  {_safe('property_hs_closed_won_date', 'TIMESTAMP')} AS deal_closed_won_at, won AS is_closed_won, closed AS is_closed,
  if(won, 'won', if(closed, 'lost', 'open')) AS deal_status, property_dealtype AS deal_type, property_hubspot_owner_id AS deal_owner_id,
  NULLIF(trim(property_deal_source), '') AS deal_source, {_FLAG.format('deal_source')} = 'partner referral' AS is_partner_sourced_deal,
  NULLIF(trim(property_referring_partner), '') AS referring_partner_deal,
  NULLIF(trim(property_deal_source_detail), '') AS deal_source_detail, _fivetran_synced AS _synced_at
FROM raw_deal, LATERAL (SELECT coalesce({_safe('property_hs_is_closed_won', 'BOOLEAN')}, FALSE) AS won,
  coalesce({_safe('property_hs_is_closed', 'BOOLEAN')}, lower(property_dealstage) IN ('closed_won', 'closed_lost'), FALSE) AS closed) flags""")

cte("stg_stage_history", f"""
SELECT deal_id, deal_stage, entered_at, exited_at, effective_exited_at, seconds_in_stage,
  CASE WHEN NULLIF(86400, 0) IS NULL THEN NULL ELSE seconds_in_stage / 86400 END AS days_in_stage
FROM (SELECT deal_id, lower(stage_id) AS deal_stage, CAST(entered_at AS TIMESTAMP) AS entered_at,
        CAST(exited_at AS TIMESTAMP) AS exited_at, coalesce(exited_at, {AS_OF}) AS effective_exited_at,
        {seconds(f'coalesce(exited_at, {AS_OF})', 'entered_at')} AS seconds_in_stage
      FROM raw_deal_stage_history WHERE entered_at IS NOT NULL) h""")

cte("stg_engagements", f"""
SELECT engagement_id, lower(engagement_type) AS engagement_type,
  {_safe('engagement_timestamp', 'TIMESTAMP')} AS engaged_at, owner_id AS engagement_owner_id, engagement_source,
  lower(email_metadata_direction) AS email_direction, lower(email_metadata_from_email) AS email_from_address,
  NULLIF(regexp_extract(lower(email_metadata_from_email), '@([^@]+)$', 1), '') AS email_from_domain,
  email_metadata_subject AS email_subject, _fivetran_synced AS _synced_at
FROM raw_engagement""")

_FIELD = "NULLIF(trim(submission_values ->> '$.{}'), '')"
_ANSWER = "NULLIF(submission_values ->> '$.{}', '') AS form_{}"

# A partner form names a partner in one of three fields, or has a partner form's name.
cte("stg_form_submissions", f"""
SELECT conversion_id AS submission_id, contact_id, form_id, (SELECT max(name) FROM raw_form WHERE raw_form.form_id = sent.form_id) AS form_name,
  {_safe('submitted_at', 'TIMESTAMP')} AS submitted_at, page_url AS submission_page_url, submission_values AS submission_values_raw,
  coalesce({_FIELD.format('partner_name')}, {_FIELD.format('partner_referral')}, {_FIELD.format('referring_partner')}) AS partner_name_from_form,
  {', '.join(_ANSWER.format(field, name) for field, name in (('company', 'company_name'), ('company_size', 'company_size'),
             ('numberofemployees', 'num_employees'), ('industry', 'industry'), ('country', 'country'), ('use_case', 'use_case')))},
  partner_name_from_form IS NOT NULL OR EXISTS (FROM raw_form WHERE raw_form.form_id = sent.form_id AND name ILIKE 'partner%') AS is_partner_referral_form
FROM raw_contact_form sent WHERE contact_id IS NOT NULL""")

cte("stg_deal_contacts", """
SELECT deal_id, contact_id, coalesce(TRY_CAST(NULLIF(CAST(is_primary AS VARCHAR), '') AS BOOLEAN), FALSE) AS is_primary_contact
FROM raw_deal_contact WHERE deal_id IS NOT NULL AND contact_id IS NOT NULL""")

cte("stg_engagement_contacts", """
SELECT engagement_id, contact_id FROM raw_engagement_contact WHERE engagement_id IS NOT NULL AND contact_id IS NOT NULL""")

cte("stg_owners", f"""
SELECT owner_id, email AS owner_email, first_name AS owner_first_name, last_name AS owner_last_name,
  trim(concat(coalesce(first_name, ''), ' ', coalesce(last_name, ''))) AS owner_name, team_id AS owner_team_id,
  {_safe('created_at', 'TIMESTAMP')} AS owner_created_at,
  coalesce({_safe('archived', 'BOOLEAN')}, FALSE) AS is_archived
FROM raw_owner""")

cte("stg_partners", """
SELECT partner_id, partner_name, lower(trim(partner_name)) AS partner_name_key, lower(partner_domain) AS partner_domain,
  partner_tier, partner_start_date FROM raw_ref_partners""")

# Of a listed partner's counts the hand-entered one goes before the seed's; unlisted ids count only in the seed.
cte("stg_partner_totals", """
SELECT DISTINCT ON (partner_id, as_of_date) partner_id, partner_name, lower(trim(partner_name)) AS partner_name_key, as_of_date, total_customer_count
FROM (SELECT 1 AS weight, partner_id, listed.partner_name, as_of_date, total_customer_count
      FROM raw_partner_customer_counts INNER JOIN stg_partners listed USING (partner_id)
      UNION ALL SELECT 2, partner_id, partner_name, as_of_date, total_customer_count FROM raw_partner_total_customers) both_
ORDER BY partner_id, as_of_date, weight""")


def with_models(select: str) -> str:
    ctes = ",\n".join(f"{n} AS ({b})" for n, b in CTES)
    body = select.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ctes + ",\n" + body[5:]
    return "WITH " + ctes + "\n" + body
