"""Contracts of the data products: output schemas, quality rules, SLOs.

Logical types are the contract families (STRING, NUMBER, INTEGER, DATE,
TIMESTAMP, BOOLEAN); ``True`` marks a required column.
"""

from __future__ import annotations

from telvault.operators.quality import Rule
from telvault.schemas import RISK_BANDS

# --- fixed values: exposed schemas of the products ---------------------------
CORE_SCHEMA = [
    ("PARTY_ID", "STRING", True), ("ACCOUNT_ID", "STRING", True), ("ACCOUNT_NUMBER", "STRING", True),
    ("SERVICE_ID", "STRING", True), ("SUBSCRIPTION_ID", "STRING", False), ("PRODUCT_OFFERING_NAME", "STRING", False),
    ("SERVICE_STATUS", "STRING", True), ("BILLING_STATUS", "STRING", True),
    ("MONTHLY_RECURRING_CHARGE", "NUMBER", True), ("DATA_MB_30D", "NUMBER", True),
    ("INTERACTION_COUNT_30D", "INTEGER", True), ("OPEN_TICKET_COUNT_30D", "INTEGER", True),
    ("SUPPORT_HEALTH_SCORE", "NUMBER", True), ("SUPPORT_RISK_BAND", "STRING", True),
    ("LAST_INTERACTION_AT", "TIMESTAMP", False), ("SNAPSHOT_AT", "TIMESTAMP", True),
]
SCORECARD_SCHEMA = [
    ("ACCOUNT_ID", "STRING", True), ("SERVICE_ID", "STRING", True), ("USAGE_EVENTS_30D", "INTEGER", True),
    ("DATA_MB_30D", "NUMBER", True), ("INTERACTION_COUNT_30D", "INTEGER", True),
    ("OPEN_TICKET_COUNT_30D", "INTEGER", True), ("TICKET_SEVERITY_INDEX", "NUMBER", True),
    ("TOTAL_CHARGES_30D", "NUMBER", True), ("MONTHLY_RECURRING_CHARGE", "NUMBER", True),
    ("SUPPORT_HEALTH_SCORE", "NUMBER", True), ("SUPPORT_RISK_BAND", "STRING", True),
    ("SNAPSHOT_AT", "TIMESTAMP", True),
]
POSTURE_SCHEMA = [
    ("SERVICE_ID", "STRING", True), ("ACCOUNT_ID", "STRING", True), ("SERVICE_TYPE", "STRING", True),
    ("SERVICE_STATUS", "STRING", True), ("SUBSCRIPTION_ID", "STRING", False),
    ("PRODUCT_OFFERING_NAME", "STRING", False), ("USAGE_EVENTS_30D", "INTEGER", True),
    ("DATA_MB_30D", "NUMBER", True), ("INTERACTION_COUNT_30D", "INTEGER", True),
    ("OPEN_TICKET_COUNT", "INTEGER", True), ("LATEST_INTERACTION_AT", "TIMESTAMP", False),
    ("LATEST_LIFECYCLE_EVENT_AT", "TIMESTAMP", False),
]
CUSTOMER_360_SCHEMA = [
    ("ACCOUNT_ID", "STRING", True), ("ACCOUNT_NUMBER", "STRING", True), ("SUBSCRIPTION_COUNT", "INTEGER", True),
    ("ACTIVE_SERVICE_COUNT", "INTEGER", True), ("TOTAL_REVENUE_30D", "NUMBER", True),
    ("AVG_HEALTH_SCORE", "NUMBER", True), ("HIGH_RISK_FLAG", "BOOLEAN", True),
    ("LAST_INTERACTION_AT", "TIMESTAMP", False), ("SNAPSHOT_AT", "TIMESTAMP", True),
]
SMOKE_SCHEMA = [("ID", "INTEGER", True), ("MESSAGE", "STRING", True), ("TRACK", "STRING", True),
                ("CREATED_AT", "TIMESTAMP", True)]

# --- fixed values: quality rules of the products -------------------------------
CORE_RULES = [
    Rule("account_id_not_null", "completeness", "account_id", 1.0, ">=", "error"),
    Rule("service_id_unique", "uniqueness", "service_id", 1.0, ">=", "error"),
    Rule("support_risk_band_valid", "valid_values", "support_risk_band", 1.0, ">=", "warn", RISK_BANDS),
    Rule("recurring_charge_non_negative", "accuracy", "monthly_recurring_charge", 0, ">=", "error"),
]
SCORECARD_RULES = [
    Rule("health_score_present", "completeness", "support_health_score", 1.0, ">=", "error"),
    Rule("open_ticket_count_present", "completeness", "open_ticket_count_30d", 1.0, ">=", "error"),
    Rule("support_health_non_negative", "accuracy", "support_health_score", 0, ">=", "error"),
]
CUSTOMER_360_RULES = [
    Rule("account_id_not_null", "completeness", "account_id", 1.0, ">=", "error"),
    Rule("subscription_count_non_negative", "accuracy", "subscription_count", 0, ">=", "error"),
    Rule("avg_health_in_range", "accuracy", "avg_health_score", 0, ">=", "warn"),
]

# --- fixed values: service levels (hours) -------------------------------------
SILVER_FRESHNESS_HOURS = 6.0
GOLD_FRESHNESS_HOURS = 24.0

# --- fixed values: freshness column of each landing table ---------------------
LOADED_AT_FIELDS = {
    "party": "updated_at", "individual": "created_at", "account": "created_at", "product_offering": "created_at",
    "service": "activated_at", "subscription": "created_at", "device": "registered_at",
    "sim_card": "activated_at", "usage_event": "event_timestamp", "app_event": "event_timestamp",
    "invoice": "created_at", "payment": "created_at", "agreement": "created_at", "service_order": "order_date",
}
