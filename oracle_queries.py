"""DuckDB oracle SQL for the registered queries.

The queries work over the landing views derived from the star tables. All
events are one list of tagged signals that is grouped once; signals without a
service are spread over the services of their account before any join; charges
come from totals per account times the number of subscribed rows; links are
hashed from the natural keys. Decimal outputs are cast to double on both sides
for the comparison.
"""

from __future__ import annotations

import datetime as dt

EVENT_AS_OF = dt.datetime(2024, 1, 31)
BILLING_AS_OF = dt.datetime(1998, 6, 1)


def ts(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"


def d(x: dt.date) -> str:
    return f"DATE '{x:%Y-%m-%d}'"


def since(days: int, as_of: dt.datetime = EVENT_AS_OF) -> str:
    return ts(as_of - dt.timedelta(days=days))


def since_date(days: int, as_of: dt.datetime = BILLING_AS_OF) -> str:
    return d((as_of - dt.timedelta(days=days)).date())


def h(*cols: str) -> str:
    return "md5(concat_ws('||', " + ", ".join(f"coalesce(cast({c} as varchar), '')" for c in cols) + "))"


NOW = ts(EVENT_AS_OF)

VIEWS = f"""
party AS (
  SELECT cast(c_custkey AS varchar) AS party_id, 'individual' AS party_type,
         CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status,
         cast(NULL AS timestamp) AS created_at, cast(NULL AS timestamp) AS updated_at
  FROM customer),
account AS (
  SELECT cast(c_custkey AS varchar) AS account_id, cast(c_custkey AS varchar) AS party_id,
         c_name AS account_number, c_mktsegment AS account_type,
         CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status,
         cast(NULL AS timestamp) AS created_at, cast(NULL AS timestamp) AS closed_at
  FROM customer),
product_offering AS (
  SELECT cast(p_partkey AS varchar) AS product_offering_id, p_name AS name, p_type AS category,
         cast(p_size AS decimal(8,2)) AS data_limit_gb, cast(p_size * 100 AS bigint) AS voice_limit_min,
         cast(p_retailprice AS decimal(10,2)) AS price_chf, 'active' AS status,
         cast(NULL AS timestamp) AS created_at
  FROM part),
service AS (
  SELECT cast(o_orderkey AS varchar) AS service_id, cast(o_custkey AS varchar) AS account_id,
         o_orderpriority AS service_type,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'suspended' WHEN 'F' THEN 'terminated' END AS status,
         o_orderdate AS activated_at, cast(NULL AS timestamp) AS terminated_at
  FROM orders),
subscription AS (
  SELECT 'S' || cast(l_orderkey AS varchar) AS subscription_id, cast(l_orderkey AS varchar) AS service_id,
         cast(min(l_partkey) AS varchar) AS product_offering_id,
         CASE max(l_linestatus) WHEN 'O' THEN 'active' WHEN 'F' THEN 'cancelled' END AS status,
         cast(min(l_shipdate) AS date) AS start_date, cast(NULL AS date) AS end_date,
         cast(NULL AS date) AS renewal_date, min(l_shipdate) AS created_at
  FROM lineitem GROUP BY l_orderkey),
acct_svc AS (SELECT o_custkey, min(o_orderkey) AS svc_key FROM orders GROUP BY o_custkey),
ev AS (SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, a.svc_key
       FROM events e LEFT JOIN acct_svc a ON e.user_id = a.o_custkey),
usage_event AS (
  SELECT cast(event_id AS varchar) AS usage_id, cast(user_id AS varchar) AS account_id,
         cast(svc_key AS varchar) AS service_id,
         CASE event_type WHEN 'purchase' THEN 'data_mb' WHEN 'signup' THEN 'voice_min' END AS usage_type,
         cast(value AS decimal(12,4)) AS quantity, ts AS event_timestamp, 'rated' AS rating_status
  FROM ev WHERE event_type IN ('purchase', 'signup')),
customer_interaction AS (
  SELECT cast(event_id AS varchar) AS interaction_id, cast(user_id AS varchar) AS account_id,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE cast(svc_key AS varchar) END AS service_id,
         CASE WHEN event_type = 'click' THEN 'app' ELSE 'web' END AS channel,
         event_type AS interaction_type, 'completed' AS outcome, ts AS interaction_timestamp
  FROM ev WHERE event_type IN ('click', 'view')),
trouble_ticket AS (
  SELECT cast(event_id AS varchar) AS ticket_id, cast(user_id AS varchar) AS account_id,
         cast(svc_key AS varchar) AS service_id, 'technical' AS ticket_category,
         CASE event_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'critical' END AS severity,
         CASE event_id % 5 WHEN 0 THEN 'resolved' WHEN 1 THEN 'resolved' WHEN 2 THEN 'resolved'
                           WHEN 3 THEN 'in_progress' WHEN 4 THEN 'open' END AS status,
         ts AS opened_at, cast(NULL AS timestamp) AS resolved_at
  FROM ev WHERE event_type = 'error'),
service_lifecycle_event AS (
  SELECT cast(event_id AS varchar) AS lifecycle_event_id, cast(svc_key AS varchar) AS service_id,
         CASE event_type WHEN 'signup' THEN 'activation' WHEN 'purchase' THEN 'upgrade'
                         WHEN 'error' THEN 'suspension' WHEN 'view' THEN 'activation'
                         WHEN 'click' THEN 'activation' END AS event_type,
         event_type AS event_reason, 'customer' AS actor_type, ts AS event_timestamp
  FROM ev),
invoice AS (
  SELECT cast(o_orderkey AS varchar) AS invoice_id, cast(o_custkey AS varchar) AS account_id,
         'INV-' || cast(o_orderkey AS varchar) AS invoice_number, cast(o_orderdate AS date) AS invoice_date,
         cast(o_orderdate AS date) + 30 AS due_date, cast(o_totalprice AS decimal(10,2)) AS total_amount_chf,
         CASE WHEN o_orderstatus = 'P' THEN 'overdue' ELSE 'paid' END AS status, o_orderdate AS created_at
  FROM orders),
invoice_charge AS (
  SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS charge_id,
         cast(l_orderkey AS varchar) AS invoice_id,
         CASE l_returnflag WHEN 'N' THEN 'recurring_charge' WHEN 'R' THEN 'usage_charge'
                           WHEN 'A' THEN 'equipment_fee' END AS charge_type,
         'line ' || cast(l_linenumber AS varchar) AS charge_description,
         cast(l_quantity AS decimal(12,4)) AS quantity, cast(l_quantity AS decimal(10,2)) AS amount_chf,
         cast(l_shipdate AS date) AS charge_date
  FROM lineitem),
individual AS (
  SELECT 'I' || c_custkey AS individual_id, cast(c_custkey AS varchar) AS party_id, 'Customer' AS first_name,
         cast(c_custkey AS varchar) AS last_name, 'customer' || c_custkey || '@example.com' AS email,
         cast(NULL AS date) AS date_of_birth, cast(NULL AS timestamp) AS created_at
  FROM customer),
device AS (
  SELECT 'D' || c_custkey AS device_id, cast(c_custkey AS varchar) AS account_id, 'phone' AS device_type,
         cast(NULL AS varchar) AS manufacturer, c_mktsegment AS model, lpad(cast(c_custkey AS varchar), 15, '0') AS imei,
         CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status, cast(NULL AS timestamp) AS registered_at
  FROM customer),
sim_card AS (
  SELECT 'M' || c_custkey AS sim_id, cast(c_custkey AS varchar) AS account_id, 'D' || c_custkey AS device_id,
         '+41' || lpad(cast(c_custkey AS varchar), 9, '0') AS msisdn, '89' || lpad(cast(c_custkey AS varchar), 17, '0') AS iccid,
         CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status, cast(NULL AS timestamp) AS activated_at
  FROM customer),
app_event AS (
  SELECT cast(event_id AS varchar) AS app_event_id, cast(user_id AS varchar) AS account_id, 'D' || user_id AS device_id,
         event_type, cast(value AS decimal(8,2)) AS session_minutes, ts AS event_timestamp
  FROM events),
payment AS (
  SELECT 'P' || o_orderkey AS payment_id, cast(o_orderkey AS varchar) AS invoice_id,
         cast(o_totalprice AS decimal(10,2)) AS amount_chf, o_orderpriority AS payment_method,
         cast(o_orderdate AS date) + 20 AS payment_date,
         CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'settled' END AS status, o_orderdate AS created_at
  FROM orders),
agreement AS (
  SELECT 'A' || o_orderkey AS agreement_id, cast(o_custkey AS varchar) AS account_id, o_orderpriority AS agreement_type,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'suspended' WHEN 'F' THEN 'terminated' END AS status,
         cast(o_orderdate AS date) AS signed_date, cast(o_orderdate AS date) + 1 AS effective_date,
         cast(NULL AS date) AS termination_date, o_orderdate AS created_at
  FROM orders),
service_order AS (
  SELECT cast(o_orderkey AS varchar) AS order_id, cast(o_custkey AS varchar) AS account_id, o_orderpriority AS order_type,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'suspended' WHEN 'F' THEN 'terminated' END AS status,
         o_orderdate AS order_date, cast(NULL AS timestamp) AS fulfillment_date
  FROM orders)"""

DV = f"""
stg_account AS (
  SELECT account_id, party_id, account_number, account_type, status AS account_status,
         created_at AS account_created_at, closed_at AS account_closed_at,
         {h('account_id')} AS hk_account,
         {h('party_id', 'account_number', 'account_type', 'status', 'created_at', 'closed_at')} AS hd_account_profile,
         {NOW} AS load_dts, 'TELCO_STAGE.ACCOUNT' AS record_source
  FROM account),
stg_service AS (
  SELECT service_id, account_id, service_type, status AS service_status, activated_at, terminated_at,
         {h('service_id')} AS hk_service, {h('account_id', 'service_id')} AS hk_link_account_service,
         {h('account_id', 'service_type', 'status', 'activated_at', 'terminated_at')} AS hd_service_status,
         {NOW} AS load_dts, 'TELCO_STAGE.SERVICE' AS record_source
  FROM service),
stg_subscription AS (
  SELECT subscription_id, service_id, product_offering_id, status AS subscription_status,
         start_date, end_date, renewal_date,
         {h('subscription_id')} AS hk_subscription,
         {h('service_id', 'subscription_id')} AS hk_link_service_subscription,
         {h('product_offering_id', 'status', 'start_date', 'end_date', 'renewal_date')} AS hd_subscription_plan,
         {NOW} AS load_dts, 'TELCO_STAGE.SUBSCRIPTION' AS record_source
  FROM subscription),
stg_product_offering AS (
  SELECT product_offering_id, name AS product_offering_name, category AS product_category,
         data_limit_gb, voice_limit_min, price_chf, status AS product_status,
         {h('product_offering_id')} AS hk_product_offering,
         {h('name', 'category', 'data_limit_gb', 'voice_limit_min', 'price_chf', 'status')} AS hd_product_offering,
         {NOW} AS load_dts, 'TELCO_STAGE.PRODUCT_OFFERING' AS record_source
  FROM product_offering)"""


POINTS = "(VALUES ('critical', 4), ('high', 3), ('medium', 2)) points(severity, weight)"


def features(usage_days=30, inter_days=30, ticket_days=30, charge_days=30, sfx="") -> str:
    """signals: one row per kind of event, account and service (or none); billed: charges per account and service."""
    return f"""
signals{sfx} AS (
  SELECT kind, account_id, service_id, count(*) AS n, max(moment) AS latest, sum(amount) AS total,
         count(*) FILTER (mark IS NOT NULL AND mark <> 'resolved') AS unresolved,
         round(coalesce(sum(amount) FILTER (mark = 'data_mb'), 0), 2) AS megabytes,
         round(coalesce(sum(amount) FILTER (mark = 'voice_min'), 0), 2) AS minutes
  FROM (SELECT 'use' AS kind, account_id, service_id, event_timestamp AS moment, usage_type AS mark, quantity AS amount FROM usage_event
        UNION ALL SELECT 'contact', account_id, service_id, interaction_timestamp, NULL, NULL FROM customer_interaction
        UNION ALL SELECT 'ticket', account_id, service_id, opened_at, status, coalesce(weight, 1)
                  FROM trouble_ticket LEFT JOIN {POINTS} USING (severity)) events
  JOIN (VALUES ('use', {since(usage_days)}), ('contact', {since(inter_days)}), ('ticket', {since(ticket_days)})) spans(kind, begins)
    USING (kind)
  WHERE moment >= begins GROUP BY ALL),
billed{sfx} AS (
  SELECT owner.account_id, service_id, round(copies * charged, 2) AS charged, round(copies * recurring, 2) AS recurring
  FROM (SELECT account_id, sum(part) AS charged, sum(part_recurring) AS recurring
        FROM invoice JOIN (SELECT invoice_id, sum(amount_chf) AS part, coalesce(sum(amount_chf) FILTER (charge_type = 'recurring_charge'), 0) AS part_recurring
                           FROM invoice_charge WHERE charge_date >= {since_date(charge_days)} GROUP BY invoice_id) USING (invoice_id)
        GROUP BY account_id) owner
  JOIN (SELECT account_id, service_id, count(*) AS copies FROM subscription JOIN service USING (service_id) GROUP BY ALL) held
    USING (account_id))"""


def sat_health(name="sat_health", sfx="", merged=False, **win) -> str:
    """The satellite: usage, contacts, tickets and charges side by side per service, then bands and scores from these."""
    spread = f"""
spread{sfx} AS (
  SELECT kind, account_id, service_id, n, latest, total, unresolved FROM signals{sfx} WHERE service_id IS NOT NULL AND kind <> 'use'
  UNION ALL
  SELECT kind, account_id, service.service_id, n, latest, total, unresolved
  FROM signals{sfx} JOIN service USING (account_id) WHERE signals{sfx}.service_id IS NULL AND kind <> 'use')"""
    if merged:
        spread = spread.replace(f"spread{sfx} AS (", f"parts{sfx} AS (", 1) + f""",
spread{sfx} AS (
  SELECT kind, account_id, service_id, sum(n) AS n, max(latest) AS latest, sum(total) AS total, sum(unresolved) AS unresolved
  FROM parts{sfx} GROUP BY ALL)"""
    return features(sfx=sfx, **win) + "," + spread + f""",
known{sfx} AS (
  SELECT service.account_id, service.service_id, service.status AS service_status,
         uses.n AS uses, cast(uses.megabytes AS decimal(18,2)) AS megabytes,
         cast(contacts.n AS bigint) AS contacts, contacts.latest AS last_interaction_at, cast(tickets.unresolved AS bigint) AS unresolved,
         cast(cast(tickets.total AS double) / tickets.n AS decimal(18,6)) AS severity_index,
         cast(charged AS decimal(18,2)) AS charged, cast(recurring AS decimal(18,2)) AS recurring
  FROM service
  LEFT JOIN billed{sfx} USING (account_id, service_id)
  LEFT JOIN (FROM spread{sfx} WHERE kind = 'ticket') tickets USING (account_id, service_id)
  LEFT JOIN (FROM spread{sfx} WHERE kind = 'contact') contacts USING (account_id, service_id)
  LEFT JOIN (FROM signals{sfx} WHERE kind = 'use') uses ON uses.service_id = service.service_id),
{name} AS (
  SELECT {h('service_id')} AS hk_service, account_id, service_id, service_status,
    coalesce(uses, 0) AS usage_events_30d, coalesce(megabytes, 0) AS data_mb_30d, coalesce(contacts, 0) AS interaction_count_30d,
    last_interaction_at, coalesce(unresolved, 0) AS open_ticket_count_30d, coalesce(severity_index, 0) AS ticket_severity_index,
    coalesce(charged, 0) AS total_charges_30d, coalesce(recurring, 0) AS monthly_recurring_charge, {NOW} AS snapshot_at,
    list_filter(['critical', 'high', 'watch', 'healthy'], lambda band, i: [coalesce(unresolved, 0) >= 3, coalesce(contacts, 0) >= 5,
      coalesce(megabytes, 0) = 0 AND coalesce(service_status, '') = 'active', true][i])[1] AS support_risk_band,
    round(cast(least(15, coalesce(recurring, 0) / 8) + 100 - least(25, 5 * coalesce(contacts, 0)) - least(36, 12 * coalesce(unresolved, 0))
      AS decimal(18,6)), 2) AS support_health_score,
    {h('service_status', 'uses', 'megabytes', 'contacts', 'unresolved', 'severity_index', 'charged', 'recurring')} AS hashdiff,
    {NOW} AS load_dts, 'TELCO_DV2.SAT_SERVICE_SUPPORT_HEALTH' AS record_source
  FROM known{sfx})"""


def core(health="sat_health", name="core") -> str:
    """The core mart from the satellite's rows, which hold every service."""
    return f""",
{name} AS (
  SELECT party_id, account_id, account_number, service_id, subscription_id, offer AS product_offering_name, service_status,
         account.status AS billing_status, monthly_recurring_charge, data_mb_30d, interaction_count_30d, open_ticket_count_30d,
         support_health_score, support_risk_band, last_interaction_at, snapshot_at
  FROM {health} JOIN account USING (account_id)
  LEFT JOIN (SELECT service_id, subscription_id, name AS offer FROM subscription LEFT JOIN product_offering USING (product_offering_id)) plans
    USING (service_id))"""


def with_(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip().lstrip(",") if i else b for i, b in enumerate(blocks))


BASE = with_(VIEWS, DV)


def q(body: str, *extra: str) -> str:
    """Full statement: base views + extra CTE blocks + final select."""
    ctes = BASE + "".join(("," + e.strip().lstrip(",")) for e in extra)
    return ctes + "\n" + body


def _dbl(col: str, alias: str | None = None) -> str:
    return f"cast({col} AS double) AS {alias or col.split('.')[-1]}"


# every event of a service or an account under one key, grouped once; begins NULL: of all time
POSTURE_CTE = f""",
marks AS (
  SELECT kind, key, count(*) AS n, max(moment) AS latest, round(sum(amount), 2) AS megabytes
  FROM (SELECT 'use' AS kind, service_id AS key, event_timestamp AS moment, CASE usage_type WHEN 'data_mb' THEN quantity ELSE 0 END AS amount FROM usage_event
        UNION ALL SELECT 'contact', account_id, interaction_timestamp, NULL FROM customer_interaction
        UNION ALL SELECT 'unresolved', service_id, opened_at, NULL FROM trouble_ticket WHERE status <> 'resolved'
        UNION ALL SELECT 'life', service_id, event_timestamp, NULL FROM service_lifecycle_event) events
  LEFT JOIN (VALUES ('use', {since(30)}), ('contact', {since(30)})) spans(kind, begins) USING (kind)
  WHERE begins IS NULL OR moment >= begins GROUP BY kind, key),
posture AS (
  SELECT service_id, account_id, service_type, service.status AS service_status, plans.subscription_id, plans.offer AS product_offering_name,
         coalesce(uses.n, 0) AS usage_events_30d, coalesce(uses.megabytes, 0) AS data_mb_30d, coalesce(contacts.n, 0) AS interaction_count_30d,
         coalesce(tickets.n, 0) AS open_ticket_count, contacts.latest AS latest_interaction_at, lives.latest AS latest_lifecycle_event_at
  FROM service
  LEFT JOIN (FROM marks WHERE kind = 'life') lives ON lives.key = service_id
  LEFT JOIN (FROM marks WHERE kind = 'unresolved') tickets ON tickets.key = service_id
  LEFT JOIN (FROM marks WHERE kind = 'contact') contacts ON contacts.key = account_id
  LEFT JOIN (FROM marks WHERE kind = 'use') uses ON uses.key = service_id
  LEFT JOIN (SELECT service_id, subscription_id, name AS offer FROM subscription LEFT JOIN product_offering USING (product_offering_id)
             WHERE subscription.status <> 'cancelled') plans USING (service_id)
  WHERE service.status <> 'terminated')"""
POSTURE = q("SELECT * REPLACE (cast(data_mb_30d AS double) AS data_mb_30d) FROM posture", POSTURE_CTE)

USAGE_30D = q(f"""SELECT service_id, account_id, n AS usage_events_30d, {_dbl('megabytes', 'data_mb_30d')}, {_dbl('minutes', 'voice_min_30d')},
{NOW} AS snapshot_at FROM signals WHERE kind = 'use'""", features())
INTERACTIONS_30D = q(f"""SELECT account_id, service_id, n AS interaction_count_30d, latest AS last_interaction_at, {NOW} AS snapshot_at
FROM signals WHERE kind = 'contact'""", features())
TICKETS_30D = q(f"""SELECT account_id, service_id, unresolved AS open_ticket_count_30d,
cast(cast(cast(total AS double) / n AS decimal(18,6)) AS double) AS ticket_severity_index, {NOW} AS snapshot_at
FROM signals WHERE kind = 'ticket'""", features())
CHARGES_30D = q(f"""SELECT account_id, service_id, {_dbl('charged', 'total_charges_30d')}, {_dbl('recurring', 'monthly_recurring_charge')},
{NOW} AS snapshot_at FROM billed""", features())

DV_ACCOUNT = q("SELECT * FROM stg_account")
DV_SERVICE = q("SELECT * FROM stg_service")
DV_SUBSCRIPTION = q("""SELECT * REPLACE (cast(start_date AS timestamp) AS start_date, cast(end_date AS timestamp)
AS end_date, cast(renewal_date AS timestamp) AS renewal_date) FROM stg_subscription""")
DV_PRODUCT_OFFERING = q(f"""SELECT product_offering_id, product_offering_name, product_category,
{_dbl('data_limit_gb')}, voice_limit_min, {_dbl('price_chf')}, product_status, hk_product_offering,
hd_product_offering, load_dts, record_source FROM stg_product_offering""")

HUB_ACCOUNT = q("SELECT DISTINCT hk_account, account_id, load_dts, record_source FROM stg_account")
HUB_SERVICE = q("SELECT DISTINCT hk_service, service_id, load_dts, record_source FROM stg_service")
HUB_SUBSCRIPTION = q("SELECT DISTINCT hk_subscription, subscription_id, load_dts, record_source FROM stg_subscription")
HUB_PRODUCT_OFFERING = q("""SELECT DISTINCT hk_product_offering, product_offering_id, load_dts, record_source
FROM stg_product_offering""")
LINK_ACCOUNT_SERVICE = q(f"""
SELECT DISTINCT {h('account_id', 'service_id')} AS hk_link_account_service, {h('account_id')} AS hk_account, {h('service_id')} AS hk_service,
  {NOW} AS load_dts, 'TELCO_DV2.LINK_ACCOUNT_SERVICE' AS record_source FROM service WHERE account_id IN (SELECT account_id FROM account)""")
LINK_SERVICE_SUBSCRIPTION = q(f"""
SELECT DISTINCT {h('service_id', 'subscription_id')} AS hk_link_service_subscription, {h('service_id')} AS hk_service,
  {h('subscription_id')} AS hk_subscription, {NOW} AS load_dts, 'TELCO_DV2.LINK_SERVICE_SUBSCRIPTION' AS record_source
FROM subscription WHERE service_id IN (SELECT service_id FROM service)""")
SAT_ACCOUNT_PROFILE = q("""
SELECT hk_account, account_id, party_id, account_number, account_type, account_status, account_created_at,
       account_closed_at, hd_account_profile AS hashdiff, load_dts, record_source FROM stg_account""")

_SAT_OUT = f"""SELECT hk_service, account_id, service_id, service_status, usage_events_30d, {_dbl('data_mb_30d')},
interaction_count_30d, last_interaction_at, open_ticket_count_30d, {_dbl('ticket_severity_index')},
{_dbl('total_charges_30d')}, {_dbl('monthly_recurring_charge')}, snapshot_at, support_risk_band,
{_dbl('support_health_score')}, hashdiff, load_dts, record_source FROM sat_health"""
SHORT_WINDOWS = dict(inter_days=3, ticket_days=10)
SAT_HEALTH = q(_SAT_OUT, sat_health())
SAT_HEALTH_SHORT = q(_SAT_OUT, sat_health(**SHORT_WINDOWS))
SAT_HEALTH_MERGED = q(_SAT_OUT, sat_health(merged=True))

CORE = q(f"""SELECT party_id, account_id, account_number, service_id, subscription_id, product_offering_name,
service_status, billing_status, {_dbl('monthly_recurring_charge')}, {_dbl('data_mb_30d')}, interaction_count_30d,
open_ticket_count_30d, {_dbl('support_health_score')}, support_risk_band, last_interaction_at, snapshot_at
FROM core""", sat_health(), core())
SCORECARD = q(f"""SELECT account_id, service_id, usage_events_30d, {_dbl('data_mb_30d')}, interaction_count_30d,
open_ticket_count_30d, {_dbl('ticket_severity_index')}, {_dbl('total_charges_30d')},
{_dbl('monthly_recurring_charge')}, {_dbl('support_health_score')}, support_risk_band, snapshot_at
FROM sat_health""", sat_health())

STAGING = {
    "party": "party_id, party_type, status, created_at, updated_at",
    "account": "account_id, party_id, account_number, account_type, status, created_at, closed_at",
    "product_offering": "product_offering_id, name, category, cast(data_limit_gb AS double) AS data_limit_gb, "
                        "voice_limit_min, cast(price_chf AS double) AS price_chf, status, created_at",
    "service": "service_id, account_id, service_type, status, activated_at, terminated_at",
    "subscription": "subscription_id, service_id, product_offering_id, status, "
                    "cast(start_date AS timestamp) AS start_date, cast(end_date AS timestamp) AS end_date, "
                    "cast(renewal_date AS timestamp) AS renewal_date, created_at",
    "usage_event": "usage_id, account_id, service_id, usage_type, cast(quantity AS double) AS quantity, "
                   "event_timestamp, rating_status",
    "invoice": "invoice_id, account_id, invoice_number, cast(invoice_date AS timestamp) AS invoice_date, "
               "cast(due_date AS timestamp) AS due_date, "
               "cast(total_amount_chf AS double) AS total_amount_chf, status, created_at",
}
_DATE = lambda c: f"cast({c} AS timestamp) AS {c}"
STAGING |= {
    "individual": f"individual_id, party_id, first_name, last_name, email, {_DATE('date_of_birth')}, created_at",
    "device": "device_id, account_id, device_type, manufacturer, model, imei, status, registered_at",
    "sim_card": "sim_id, account_id, device_id, msisdn, iccid, status, activated_at",
    "app_event": f"app_event_id, account_id, device_id, event_type, {_dbl('session_minutes')}, event_timestamp",
    "payment": f"payment_id, invoice_id, {_dbl('amount_chf')}, payment_method, {_DATE('payment_date')}, status, created_at",
    "agreement": f"agreement_id, account_id, agreement_type, status, {_DATE('signed_date')}, {_DATE('effective_date')}, "
                 f"{_DATE('termination_date')}, created_at",
    "service_order": "order_id, account_id, order_type, status, order_date, fulfillment_date",
}
STAGING_SQL = {f"stg_{t}": q(f"SELECT {cols} FROM {t}") for t, cols in STAGING.items()}


def oracle_sql() -> dict[str, str]:
    out = {
        "support_posture": POSTURE,
        "usage_30d": USAGE_30D, "interactions_30d": INTERACTIONS_30D, "ticket_status_30d": TICKETS_30D,
        "charges_30d": CHARGES_30D,
        "dv_account": DV_ACCOUNT, "dv_service": DV_SERVICE, "dv_subscription": DV_SUBSCRIPTION,
        "dv_product_offering": DV_PRODUCT_OFFERING,
        "hub_account": HUB_ACCOUNT, "hub_service": HUB_SERVICE, "hub_subscription": HUB_SUBSCRIPTION,
        "hub_product_offering": HUB_PRODUCT_OFFERING,
        "link_account_service": LINK_ACCOUNT_SERVICE, "link_service_subscription": LINK_SERVICE_SUBSCRIPTION,
        "sat_account_profile": SAT_ACCOUNT_PROFILE,
        "sat_service_support_health": SAT_HEALTH, "sat_service_support_health_short": SAT_HEALTH_SHORT,
        "sat_service_support_health_merged": SAT_HEALTH_MERGED,
        "mart_subscriber360_core": CORE, "mart_health_scorecard": SCORECARD,
    }
    out.update(STAGING_SQL)
    out.update(oracle_sql_extra())
    return out


# ---- quality, metrics, catalog, semantic, gold ----------------------------------
from telvault.operators.catalog import (  # noqa: E402  (fixed tables shared with the oracle)
    ASSIGNMENT_TABLES, DOCUMENT_TABLES, EVENT_TABLES, NATURAL_KEYS, PUBLIC_SYNTHETIC, RESTRICTED_CONTACT,
    RESTRICTED_IDENTIFIER, SEMANTIC_TYPES, VALUE_PATTERNS,
)
from telvault.plans.contracts import CORE_RULES, CORE_SCHEMA, POSTURE_SCHEMA, SCORECARD_RULES  # noqa: E402
from telvault.schemas import COLUMN_TESTS, PRIMARY_KEYS, RELATIONSHIPS, RISK_BANDS, SCHEMAS  # noqa: E402

STAR = ("party", "account", "product_offering", "service", "subscription", "usage_event", "customer_interaction",
        "trouble_ticket", "service_lifecycle_event", "invoice", "invoice_charge", "individual", "device", "sim_card",
        "app_event", "payment", "agreement", "service_order")


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _inlist(vals) -> str:
    return "(" + ", ".join(_lit(v) for v in vals) + ")"


def _test(target, col, test, failures_sql) -> str:
    return (f"SELECT {_lit(target)} AS target, {_lit(col)} AS column_name, {_lit(test)} AS test, "
            f"cast(n AS bigint) AS failures, n = 0 AS passed FROM ({failures_sql}) x")


def _unique(t, c):
    return _test(t, c, "unique", f"SELECT count(*) AS n FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
                                 f"GROUP BY {c} HAVING count(*) > 1) d")


def _not_null(t, c):
    return _test(t, c, "not_null", f"SELECT count(*) AS n FROM {t} WHERE {c} IS NULL")


TEST_UNIQUE = q("\nUNION ALL\n".join(_unique(t, c) for t, c, k in COLUMN_TESTS if t in STAR and "unique" in k))
TEST_NOT_NULL = q("\nUNION ALL\n".join(_not_null(t, c) for t, c, k in COLUMN_TESTS if t in STAR and "not_null" in k))
# what the landing tables themselves are tested for
SOURCE_UNIQUE = """party.party_id individual.individual_id individual.email account.account_id account.account_number
product_offering.product_offering_id service.service_id subscription.subscription_id device.device_id device.imei sim_card.sim_id
sim_card.msisdn sim_card.iccid usage_event.usage_id app_event.app_event_id invoice.invoice_id invoice.invoice_number payment.payment_id
agreement.agreement_id service_order.order_id""".split()
SOURCE_NOT_NULL = """party.party_id party.party_type individual.individual_id individual.party_id account.account_id account.party_id
account.account_number product_offering.product_offering_id product_offering.name product_offering.price_chf service.service_id
service.account_id subscription.subscription_id subscription.service_id subscription.product_offering_id subscription.start_date
device.device_id device.account_id sim_card.sim_id sim_card.account_id usage_event.usage_id usage_event.account_id
usage_event.service_id usage_event.usage_type usage_event.quantity usage_event.event_timestamp app_event.app_event_id
app_event.account_id app_event.event_type app_event.event_timestamp invoice.invoice_id invoice.account_id invoice.invoice_number
invoice.invoice_date invoice.due_date invoice.total_amount_chf payment.payment_id payment.invoice_id payment.amount_chf
payment.payment_date agreement.agreement_id agreement.account_id service_order.order_id service_order.account_id""".split()
TEST_SOURCES = q("\nUNION ALL\n".join([_unique(*x.split(".")) for x in SOURCE_UNIQUE] + [_not_null(*x.split(".")) for x in SOURCE_NOT_NULL]))
USAGE_5D = q(f"""SELECT service_id, account_id, n AS usage_events_30d, {_dbl('megabytes', 'data_mb_30d')}, {_dbl('minutes', 'voice_min_30d')},
{NOW} AS snapshot_at FROM signals WHERE kind = 'use'""", features(usage_days=5))
TEST_RELATIONSHIPS = q("\nUNION ALL\n".join(
    _test(ch, cc, "relationships", f"SELECT count(*) AS n FROM {ch} c LEFT JOIN (SELECT DISTINCT {pc} AS k FROM {p} "
                                   f"WHERE {pc} IS NOT NULL) p ON c.{cc} = p.k WHERE c.{cc} IS NOT NULL AND p.k IS NULL")
    for ch, cc, p, pc in RELATIONSHIPS if ch in STAR and p in STAR))
MART_TESTS = sat_health() + core() + ",\nscorecard AS (SELECT * FROM sat_health)"
TEST_ACCEPTED = q("\nUNION ALL\n".join(
    _test(t, "support_risk_band", "accepted_values",
          f"SELECT count(DISTINCT support_risk_band) AS n FROM {src} WHERE support_risk_band IS NOT NULL "
          f"AND support_risk_band NOT IN {_inlist(RISK_BANDS)}")
    for t, src in (("mart_subscriber360_core", "core"), ("mart_subscriber_health_scorecard", "scorecard"))),
    MART_TESTS)
TEST_MART_NOT_NULL = q("\nUNION ALL\n".join(
    _test(t, c, "not_null", f"SELECT count(*) AS n FROM {src} WHERE {c} IS NULL")
    for t, src, cols in (("mart_subscriber360_core", "core", ("account_id", "service_id", "support_health_score")),
                         ("mart_subscriber_health_scorecard", "scorecard",
                          ("account_id", "service_id", "open_ticket_count_30d")))
    for c in cols), MART_TESTS)


def _rule(target, src, r) -> str:
    c = r.selector
    if r.type == "completeness":
        v = f"coalesce(cast(count({c}) AS double) / nullif(count(*), 0), 1.0)"
    elif r.type == "uniqueness":
        v = f"coalesce(cast(count(DISTINCT {c}) AS double) / nullif(count({c}), 0), 1.0)"
    elif r.type == "valid_values":
        v = f"coalesce(cast(count_if({c} IN {_inlist(r.values)}) AS double) / nullif(count({c}), 0), 1.0)"
    else:
        v = f"cast({'max' if r.operator in ('<', '<=') else 'min'}({c}) AS double)"
    return (f"SELECT {_lit(target)} AS target, {_lit(r.id)} AS rule_id, {_lit(r.type)} AS rule_type, "
            f"{_lit(c)} AS selector, value, cast({float(r.threshold)} AS double) AS threshold, {_lit(r.operator)} AS operator, "
            f"{_lit(r.severity)} AS severity, coalesce(value {r.operator} {float(r.threshold)}, "
            f"{'true' if r.type == 'accuracy' else 'false'}) AS passed "
            f"FROM (SELECT {v} AS value FROM {src}) x")


DQ_RULES = q("\nUNION ALL\n".join([_rule("mart_subscriber360_core", "core", r) for r in CORE_RULES]
                                  + [_rule("mart_subscriber_health_scorecard", "scorecard", r) for r in SCORECARD_RULES]),
             MART_TESTS)

# Spark types of the mart columns (the implementation's declared output types)
CORE_TYPES = dict(party_id="string", account_id="string", account_number="string", service_id="string",
                  subscription_id="string", product_offering_name="string", service_status="string",
                  billing_status="string", monthly_recurring_charge="decimal(18,2)", data_mb_30d="decimal(18,2)",
                  interaction_count_30d="bigint", open_ticket_count_30d="bigint",
                  support_health_score="decimal(18,2)", support_risk_band="string",
                  last_interaction_at="timestamp_ntz", snapshot_at="timestamp_ntz")
POSTURE_TYPES = dict(service_id="string", account_id="string", service_type="string", service_status="string",
                     subscription_id="string", product_offering_name="string", usage_events_30d="bigint",
                     data_mb_30d="decimal(18,2)", interaction_count_30d="bigint", open_ticket_count="bigint",
                     latest_interaction_at="timestamp_ntz", latest_lifecycle_event_at="timestamp_ntz")


def _schema_rows(target, src, contract, types) -> list[str]:
    out = []
    for name, typ, req in contract:
        c = name.lower()
        nulls = f"cast(count_if({c} IS NULL) AS bigint)" if req else "cast(max(NULL) AS bigint)"
        status = f"CASE WHEN {nulls} > 0 THEN 'required_null' ELSE 'ok' END" if req else "'ok'"
        passed = f"{nulls} = 0" if req else "count(*) >= 0"
        out.append(f"SELECT {_lit(target)} AS target, {_lit(name)} AS column_name, {_lit(typ)} AS expected_type, "
                   f"{_lit(types[c])} AS actual_type, {str(req).lower()} AS required, "
                   f"cast({nulls} AS bigint) AS null_count, {status} AS status, {passed} AS passed FROM {src}")
    return out


SCHEMA_CHECK = q("\nUNION ALL\n".join(
    _schema_rows("mart_subscriber360_core", "core", CORE_SCHEMA, CORE_TYPES)
    + _schema_rows("support_posture", "posture", POSTURE_SCHEMA, POSTURE_TYPES)), MART_TESTS, POSTURE_CTE)

ROW_RECONCILIATION = q("\nUNION ALL\n".join(
    f"SELECT {_lit(t)} AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS matched FROM {t}"
    for t in STAR))

FRESH = {"party": "updated_at", "account": "created_at", "product_offering": "created_at",
         "service": "activated_at", "subscription": "created_at", "usage_event": "event_timestamp",
         "invoice": "created_at", "individual": "created_at", "device": "registered_at", "sim_card": "activated_at",
         "app_event": "event_timestamp", "payment": "created_at", "agreement": "created_at", "service_order": "order_date"}
FRESHNESS = q("\nUNION ALL\n".join(
    f"SELECT {_lit(t)} AS table_name, {_lit(c)} AS loaded_at_field, latest, lag_hours, cast(6.0 AS double) AS slo_hours, "
    f"coalesce(lag_hours <= 6.0, false) AS passed FROM (SELECT max({c}) AS latest, "
    f"date_diff('microsecond', max({c}), {NOW}) / 3.6e9 AS lag_hours FROM {t}) x" for t, c in FRESH.items()))


def _pk(t):
    return PRIMARY_KEYS[t]


DATA_METRICS = q("\nUNION ALL\n".join(
    f"""SELECT {_lit(t)} AS table_name, metric, argument, value, expectation, expression,
  CASE metric WHEN 'ROW_COUNT' THEN value > 0 ELSE value = 0 END AS passed FROM (
  SELECT 'ROW_COUNT' AS metric, cast(NULL AS varchar) AS argument, count(*) AS value,
         {_lit(t + '_has_rows')} AS expectation, 'VALUE > 0' AS expression FROM {t}
  UNION ALL SELECT 'NULL_COUNT', {_lit(_pk(t))}, cast(count_if({_pk(t)} IS NULL) AS bigint), {_lit(_pk(t) + '_not_null')},
         'VALUE = 0' FROM {t}
  UNION ALL SELECT 'DUPLICATE_COUNT', {_lit(_pk(t))}, count({_pk(t)}) - count(DISTINCT {_pk(t)}),
         {_lit(_pk(t) + '_unique')}, 'VALUE = 0' FROM {t}) m""" for t in STAR))


def _case_semantic(name: str) -> str:
    for names, v in SEMANTIC_TYPES:
        if name in names:
            return v
    return "category_code"


def _tags(t: str, c: str) -> tuple[str, str, str, str]:
    sens = ("restricted_contact" if c in RESTRICTED_CONTACT else
            "restricted_identifier" if c.endswith("_id") or c in RESTRICTED_IDENTIFIER else
            "public_synthetic" if c in PUBLIC_SYNTHETIC else "internal_operational")
    role = ("primary_key" if c == PRIMARY_KEYS[t] else "natural_key" if c in NATURAL_KEYS else
            "foreign_key" if c.endswith("_id") else "descriptive")
    grain = ("event_level" if t in EVENT_TABLES else "document_level" if t in DOCUMENT_TABLES else
             "assignment_level" if t in ASSIGNMENT_TABLES else "entity_level")
    return _case_semantic(c), sens, role, grain


COLUMN_CATALOG = q("\nUNION ALL\n".join(
    f"SELECT {_lit(t)} AS table_name, {_lit(f.name)} AS column_name, {i + 1} AS ordinal, "
    f"{_lit(f.dataType.simpleString())} AS data_type, "
    + ", ".join(f"{_lit(v)} AS {k}" for k, v in zip(("semantic_type", "sensitivity", "identifier_role",
                                                     "record_grain"), _tags(t, f.name)))
    + f", cast(count_if({f.name} IS NULL) AS bigint) AS null_count, count({f.name}) AS non_null_count FROM {t}"
    for t in STAR for i, f in enumerate(SCHEMAS[t].fields)))


def _classify() -> str:
    parts = []
    for t in STAR:
        for f in SCHEMAS[t].fields:
            if f.dataType.simpleString() != "string":
                continue
            for j, (k, pat) in enumerate(VALUE_PATTERNS):
                parts.append(f"SELECT {_lit(t)} AS table_name, {_lit(f.name)} AS column_name, {_lit(k)} AS value_class, "
                             f"{j} AS priority, count({f.name}) AS non_null, "
                             f"cast(count_if(regexp_matches({f.name}, {_lit(pat)})) AS bigint) AS matches FROM {t}")
    return "\nUNION ALL\n".join(parts)


CLASSIFY = q("""
SELECT table_name, column_name, CASE WHEN ratio >= 0.8 THEN value_class ELSE 'unclassified' END AS value_class,
       round(ratio, 6) AS confidence, non_null AS non_null_values
FROM (SELECT *, row_number() OVER (PARTITION BY table_name, column_name ORDER BY ratio DESC, priority) AS rn
      FROM (SELECT *, CASE WHEN non_null > 0 THEN cast(matches AS double) / non_null ELSE 0.0 END AS ratio
            FROM cls) r) b
WHERE rn = 1""", "cls AS (" + _classify() + ")")

COLUMN_PROFILE = q("""
SELECT c.*, m.table_rows, m.pk_null_count, m.pk_duplicate_count, k.value_class, k.confidence
FROM catalog_rows c
LEFT JOIN (SELECT table_name,
                  max(CASE WHEN metric = 'ROW_COUNT' THEN value END) AS table_rows,
                  max(CASE WHEN metric = 'NULL_COUNT' THEN value END) AS pk_null_count,
                  max(CASE WHEN metric = 'DUPLICATE_COUNT' THEN value END) AS pk_duplicate_count
           FROM metric_rows GROUP BY table_name) m ON c.table_name = m.table_name
LEFT JOIN class_rows k ON c.table_name = k.table_name AND c.column_name = k.column_name""",
    "catalog_rows AS (" + COLUMN_CATALOG[len(BASE):].strip() + ")",
    "metric_rows AS (" + DATA_METRICS[len(BASE):].strip() + ")",
    "cls AS (" + _classify() + ")",
    "class_rows AS (" + CLASSIFY[CLASSIFY.index("\nSELECT table_name, column_name, CASE"):].strip() + ")")

METRIC_ARR = q("""
SELECT billing_status, cast(date_trunc('day', snapshot_at) AS timestamp) AS snapshot_at__day,
       cast(round(sum(CASE WHEN service_status = 'active' THEN monthly_recurring_charge END), 2) AS double)
         AS active_recurring_revenue,
       cast(round(cast(avg(support_health_score) AS decimal(38,10)), 2) AS double) AS avg_support_health_score,
       cast(round(sum(data_mb_30d), 2) AS double) AS data_mb_30d
FROM core GROUP BY 1, 2""", sat_health(), core())
METRIC_BAND = q("""
SELECT support_risk_band,
       cast(round(cast(avg(support_health_score) AS decimal(38,10)), 2) AS double) AS average_support_health,
       cast(sum(open_ticket_count_30d) AS bigint) AS open_ticket_pressure,
       cast(sum(interaction_count_30d) AS bigint) AS interaction_count_30d
FROM sat_health GROUP BY 1""", sat_health())

METRICS_ACROSS = q("""
SELECT coalesce(l.billing_status, r.billing_status) AS billing_status, active_recurring_revenue, open_ticket_pressure, average_support_health
FROM (SELECT billing_status, cast(round(sum(monthly_recurring_charge) FILTER (service_status = 'active'), 2) AS double) AS active_recurring_revenue
      FROM core GROUP BY 1) l
FULL JOIN (SELECT account.status AS billing_status, cast(sum(open_ticket_count_30d) AS bigint) AS open_ticket_pressure,
             cast(round(cast(avg(support_health_score) AS decimal(38,10)), 2) AS double) AS average_support_health
           FROM sat_health LEFT JOIN account USING (account_id) GROUP BY 1) r ON l.billing_status IS NOT DISTINCT FROM r.billing_status""",
    sat_health(), core())

_TIE = ("support_health_score ASC NULLS LAST, open_ticket_count_30d DESC NULLS LAST, "
        "interaction_count_30d DESC NULLS LAST, data_mb_30d DESC NULLS LAST, last_interaction_at DESC NULLS LAST")
C360_BODY = f"""
SELECT a.account_id, a.account_number, a.subscription_count, a.active_service_count,
       cast(coalesce(r.total_revenue_30d, 0) AS double) AS total_revenue_30d,
       cast(a.avg_health_score AS double) AS avg_health_score, a.high_risk_flag, a.last_interaction_at, a.snapshot_at
FROM agg a LEFT JOIN rev r ON a.account_id = r.account_id AND a.m = r.m"""
C360_BLOCKS = [
    sat_health("sat_b1", "_b1"), core("sat_b1", "core_b1"),
    sat_health("sat_b2", "_b2", **SHORT_WINDOWS), core("sat_b2", "core_b2"), f"""
core_dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY account_id, service_id, subscription_id
                                 ORDER BY product_rank, snapshot_at DESC, {_TIE}) AS rn
    FROM (SELECT *, 1 AS product_rank FROM core_b1 UNION ALL SELECT *, 2 AS product_rank FROM core_b2) u) x
  WHERE rn = 1),
agg AS (
  SELECT account_id, account_number, date_trunc('month', snapshot_at) AS m,
         count(DISTINCT subscription_id) AS subscription_count,
         count(DISTINCT CASE WHEN service_status = 'active' THEN service_id END) AS active_service_count,
         round(cast(avg(support_health_score) AS decimal(38,10)), 2) AS avg_health_score,
         bool_or(support_risk_band IN ('high', 'critical')) AS high_risk_flag,
         max(last_interaction_at) AS last_interaction_at, max(snapshot_at) AS snapshot_at
  FROM core_dedup GROUP BY 1, 2, 3),
sc_dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY account_id, service_id
                                 ORDER BY product_rank, snapshot_at DESC, total_charges_30d DESC NULLS LAST,
                                          {_TIE.rsplit(", ", 1)[0]}) AS rn
    FROM (SELECT *, 1 AS product_rank FROM sat_b1 UNION ALL SELECT *, 2 AS product_rank FROM sat_b2) u) x
  WHERE rn = 1),
rev AS (
  SELECT account_id, date_trunc('month', snapshot_at) AS m, sum(total_charges_30d) AS total_revenue_30d
  FROM sc_dedup GROUP BY 1, 2)"""]
CUSTOMER_360 = q(C360_BODY, *C360_BLOCKS)
METRIC_C360 = q("""
SELECT cast(date_trunc('day', snapshot_at) AS timestamp) AS snapshot_at__day,
       cast(sum(subscription_count) AS bigint) AS subscription_count,
       round(sum(total_revenue_30d), 2) AS total_revenue_30d,
       cast(round(cast(avg(avg_health_score) AS decimal(38,10)), 2) AS double) AS avg_health_score
FROM c360 GROUP BY 1""", *C360_BLOCKS, "c360 AS (" + C360_BODY + ")")

from telvault.plans.contracts import CUSTOMER_360_RULES  # noqa: E402
UPPER_RULES = q("""SELECT 'mart_subscriber360_core' AS target, id AS rule_id, 'accuracy' AS rule_type, 'support_health_score' AS selector,
  cast(v AS double) AS value, cast(threshold AS double) AS threshold, op AS operator, 'warn' AS severity, ok AS passed
FROM (SELECT max(support_health_score) AS hi, min(support_health_score) AS lo FROM core) m,
  LATERAL (SELECT 'score_at_most_100' AS id, hi AS v, 100 AS threshold, '<=' AS op, coalesce(hi <= 100, true) AS ok
           UNION ALL SELECT 'score_under_50', hi, 50, '<', coalesce(hi < 50, true)
           UNION ALL SELECT 'score_over_0', lo, 0, '>', coalesce(lo > 0, true)) r""", MART_TESTS)
C360_RULES = q("\nUNION ALL\n".join(_rule("customer_360", "c360", r) for r in CUSTOMER_360_RULES),
               *C360_BLOCKS, "c360 AS (" + C360_BODY + ")")

PARTY_NS = "6f65ba7cc96842b1987a5f4637b2f181"
PARTY_UUID = q(f"""
SELECT party_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
       || printf('%x', ((('0x' || substr(h, 17, 1))::int) & 3) | 8) || substr(h, 18, 3) || '-' || substr(h, 21, 12)
       AS party_uuid
FROM (SELECT party_id, sha1(unhex('{PARTY_NS}') || encode('party:' || party_id)) AS h FROM party) x""")


PII_MASKED_CORE = q(f"""SELECT party_id, account_id, sha256(account_number) AS account_number, service_id,
subscription_id, product_offering_name, service_status, billing_status, {_dbl('monthly_recurring_charge')},
{_dbl('data_mb_30d')}, interaction_count_30d, open_ticket_count_30d, {_dbl('support_health_score')},
support_risk_band, last_interaction_at, snapshot_at FROM core""", sat_health(), core())

KINDS = {"string": "s", "bigint": "i", "timestamp_ntz": "t", "date": "a", "boolean": "b"}


def _framed(t: str) -> str:
    """Text of a row: kind, length and value of each field, n for NULL."""
    parts = []
    for f in SCHEMAS[t].fields:
        text, kind = f"cast({f.name} AS varchar)", KINDS.get(f.dataType.simpleString(), "d")
        parts.append(f"coalesce('{kind}' || length({text}) || ':' || {text} || ';', 'n;')")
    return " || ".join(parts)


def _half(t: str, at: int) -> str:
    return f"cast(coalesce(sum(('0x' || substr(md5({_framed(t)}), {at}, 16))::UBIGINT::HUGEINT), 0) AS varchar)"


FINGERPRINTS_PORTABLE = q("\nUNION ALL\n".join(
    f"SELECT {_lit(t)} AS table_name, count(*) AS rows, {_half(t, 1)} || '-' || {_half(t, 17)} AS fingerprint FROM {t}" for t in STAR))


def _statistics(t: str) -> list[str]:
    out = []
    for f in SCHEMAS[t].fields:
        ordered = f.dataType.simpleString() in ("bigint", "int", "date", "boolean")
        low, high = (f"cast({x}({f.name}) AS varchar)" if ordered else "cast(NULL AS varchar)" for x in ("min", "max"))
        out.append(f"SELECT {_lit(t)} AS table_name, {_lit(f.name)} AS column_name, count(*) AS rows, count(*) - count({f.name}) AS null_count, "
                   f"{low} AS min_value, {high} AS max_value FROM {t}")
    return out


BRONZE_STATISTICS = q("\nUNION ALL\n".join(x for t in STAR for x in _statistics(t)))
BRONZE_RELOAD = q("""SELECT v.invoice_id, n AS charges, cast(total AS double) AS amount_chf, 'reloaded' AS status FROM invoice v
LEFT JOIN (SELECT invoice_id, count(*) AS n, sum(amount_chf) AS total FROM invoice_charge GROUP BY 1) c ON v.invoice_id = c.invoice_id""")
PUBLISHED_ACCOUNTS = q("SELECT account_id, upper(account_type) AS tier, status || '!' AS status FROM account")
INVOICE_DIFFERENCES = q(f"""SELECT max(invoice_id) AS invoice_id, row_md5, cast(count_if(side = 's') AS bigint) AS source_rows, cast(count_if(side = 't') AS bigint) AS target_rows FROM (
  SELECT 's' AS side, invoice_id, md5({_framed("invoice")}) AS row_md5 FROM invoice UNION ALL
  SELECT 't', invoice_id, md5({_framed("invoice")}) FROM (
    SELECT invoice_id, account_id, invoice_number, invoice_date, due_date, total_amount_chf,
      CASE WHEN invoice_id LIKE '%33' THEN 'changed' ELSE status END AS status, created_at
    FROM invoice, (VALUES (1), (2)) twice(i) WHERE invoice_id NOT LIKE '%77' AND (i = 1 OR invoice_id LIKE '%55')) copy) x
GROUP BY row_md5 HAVING count_if(side = 's') <> count_if(side = 't')""")

LANDING_MANIFEST = q("""SELECT t.*, digests, true AS passed FROM (SELECT 'invoice' AS table_name, cast(count(*) AS bigint) AS rows FROM invoice UNION ALL
SELECT 'invoice_charge', count(*) FROM invoice_charge) t, (VALUES ('plain'), ('ranges')) d(digests)""")
ACCOUNT_STATE = [  # object, property, declared, found, status
    *[(c, "type", k, k, "ok") for c, k in (("account_id", "string"), ("party_id", "string"), ("account_number", "string"), ("account_type", "string"),
                                           ("status", "string"), ("created_at", "timestamp_ntz"), ("closed_at", "timestamp_ntz"))],
    ("account_id", "comment", "Key of the account", "Key of the account", "ok"), ("account_id", "sensitivity", "internal", "internal", "ok"),
    ("account_number", "comment", "Number on the bill", "Number on the bill", "ok"), ("account_number", "sensitivity", "pii", "pii", "ok"),
    ("status", "comment", "State of the account", "Changed by hand", "changed"), ("tier", "type", None, "string", "added"),
    ("(table)", "comment", "Accounts of the customer's party", "Accounts of the customer's party", "ok"),
    ("(table)", "provider", "parquet", "parquet", "ok"), ("(table)", "partitions", "account_type", "account_type", "ok")]
_FILLED = " ".join(f"WHEN '{c}' THEN count({c})" for c in ("account_id", "party_id", "account_number", "account_type", "status", "created_at", "closed_at"))
CATALOGUE_DRIFT = q(" UNION ALL ".join(
    "SELECT " + ", ".join(f"{_lit(v) if v else 'cast(NULL AS varchar)'} AS {n}" for n, v in zip(("object", "property", "declared", "found", "status"), row))
    + f", {str(row[4] == 'ok').lower()} AS passed, CASE '{row[0]}' {_FILLED} WHEN 'tier' THEN count(account_type) ELSE count(*) END AS filled FROM account"
    for row in ACCOUNT_STATE))

DRIFTED = [("PAYMENT_ID", "STRING", True, "string", "0", "ok"), ("INVOICE_ID", "STRING", False, "bigint", "NULL", "retyped"),
           ("AMOUNT_CHF", "NUMBER", False, "decimal(10,2)", "NULL", "ok"), ("CURRENCY", "STRING", False, None, "NULL", "removed"),
           ("payment_method", None, False, "string", "NULL", "added")]
SCHEMA_DRIFT = " UNION ALL ".join(
    f"SELECT 'payment' AS target, '{n}' AS column_name, {_lit(t) if t else 'NULL'} AS expected_type, "
    f"{_lit(a) if a else 'NULL'} AS actual_type, {str(r).lower()} AS required, cast({k} AS bigint) AS null_count, "
    f"'{st}' AS status, {str(st == 'ok').lower()} AS passed" for n, t, r, a, k, st in DRIFTED)
LANDING_CSV = q(f"SELECT charge_id, invoice_id, charge_type, charge_description, {_dbl('quantity')}, {_dbl('amount_chf')}, "
                f"{_DATE('charge_date')} FROM invoice_charge")
LANDING_CSV_EMPTY = q("SELECT interaction_id, account_id, service_id, channel, interaction_type, "
                      "CASE WHEN service_id IS NULL THEN '' ELSE outcome END AS outcome, "
                      "date_trunc('second', interaction_timestamp) AS interaction_timestamp FROM customer_interaction")
LOAD_REPORT = q(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in (
    "invoice", "invoice_charge", "party", "account", "service", "subscription", "product_offering", "usage_event",
    "customer_interaction", "trouble_ticket")))

POSTURE_PARTS = {
    "usage_by_service_30d": f"SELECT key AS service_id, n AS usage_events_30d, {_dbl('megabytes', 'data_mb_30d')} FROM marks WHERE kind = 'use'",
    "interactions_by_account_30d": "SELECT key AS account_id, n AS interaction_count_30d, latest AS latest_interaction_at FROM marks WHERE kind = 'contact'",
    "open_tickets_all_time": "SELECT key AS service_id, n AS open_ticket_count FROM marks WHERE kind = 'unresolved'",
    "latest_lifecycle_event": "SELECT key AS service_id, latest AS latest_lifecycle_event_at FROM marks WHERE kind = 'life'",
}
POSTURE_PARTS_SQL = {k: q(v, POSTURE_CTE) for k, v in POSTURE_PARTS.items()}


def oracle_sql_extra() -> dict[str, str]:
    out = {
        "test_unique": TEST_UNIQUE, "test_not_null": TEST_NOT_NULL, "test_relationships": TEST_RELATIONSHIPS,
        "test_accepted_values": TEST_ACCEPTED,
        "test_mart_not_null": TEST_MART_NOT_NULL, "dq_rules": DQ_RULES, "schema_check": SCHEMA_CHECK,
        "row_reconciliation": ROW_RECONCILIATION, "freshness": FRESHNESS, "data_metrics": DATA_METRICS,
        "column_catalog": COLUMN_CATALOG, "classify_columns": CLASSIFY, "column_profile": COLUMN_PROFILE,
        "metric_active_recurring_revenue": METRIC_ARR, "metric_support_health_by_band": METRIC_BAND,
        "customer_360": CUSTOMER_360, "pii_masked_core": PII_MASKED_CORE,
        "metric_customer_360": METRIC_C360, "party_uuid": PARTY_UUID, "customer_360_rules": C360_RULES,
        "test_sources": TEST_SOURCES, "usage_5d": USAGE_5D, "metrics_across_models": METRICS_ACROSS,
        "bronze_statistics": BRONZE_STATISTICS, "bronze_reload": BRONZE_RELOAD, "published_accounts": PUBLISHED_ACCOUNTS,
        "invoice_differences": INVOICE_DIFFERENCES, "table_fingerprints_portable": FINGERPRINTS_PORTABLE, "dq_bounds": UPPER_RULES, "schema_drift": SCHEMA_DRIFT,
        "landing_manifest": LANDING_MANIFEST, "catalogue_drift": CATALOGUE_DRIFT,
        "landing_csv": LANDING_CSV, "landing_csv_empty": LANDING_CSV_EMPTY, "bronze_load_report": LOAD_REPORT,
    }
    out.update(POSTURE_PARTS_SQL)
    return out
