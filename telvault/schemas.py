"""Landing-table schemas, keys and relationships.

Schemas are declared, never inferred. Types follow the landing spec:
VARCHAR -> string, DATE -> date, TIMESTAMP_NTZ -> timestamp_ntz,
NUMBER(p,s) -> decimal(p,s), bare NUMBER -> bigint.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# --- fixed values: the 23 landing tables, columns in declared order -------
TABLE_DDL: dict[str, str] = {
    "party": "party_id string, party_type string, status string, created_at timestamp_ntz, updated_at timestamp_ntz",
    "individual": "individual_id string, party_id string, first_name string, last_name string, email string, "
                  "date_of_birth date, created_at timestamp_ntz",
    "geographic_address": "address_id string, party_id string, address_role string, street_name string, city string, "
                          "region_code string, postal_code string, country_code string, valid_from date, valid_to date",
    "contact_medium": "contact_medium_id string, party_id string, medium_type string, medium_value string, "
                      "usage_purpose string, preference_rank bigint, valid_from date, valid_to date",
    "account": "account_id string, party_id string, account_number string, account_type string, status string, "
               "created_at timestamp_ntz, closed_at timestamp_ntz",
    "party_role": "party_role_id string, party_id string, account_id string, role_type string, status string, "
                  "assigned_at timestamp_ntz, revoked_at timestamp_ntz",
    "product_offering": "product_offering_id string, name string, category string, data_limit_gb decimal(8,2), "
                        "voice_limit_min bigint, price_chf decimal(10,2), status string, created_at timestamp_ntz",
    "service": "service_id string, account_id string, service_type string, status string, "
               "activated_at timestamp_ntz, terminated_at timestamp_ntz",
    "subscription": "subscription_id string, service_id string, product_offering_id string, status string, "
                    "start_date date, end_date date, renewal_date date, created_at timestamp_ntz",
    "product_inventory": "product_id string, account_id string, product_offering_id string, service_id string, "
                         "status string, activated_at timestamp_ntz, terminated_at timestamp_ntz",
    "resource": "resource_id string, service_id string, resource_type string, resource_name string, "
                "resource_status string, assigned_at timestamp_ntz, released_at timestamp_ntz",
    "device": "device_id string, account_id string, device_type string, manufacturer string, model string, "
              "imei string, status string, registered_at timestamp_ntz",
    "sim_card": "sim_id string, account_id string, device_id string, msisdn string, iccid string, status string, "
                "activated_at timestamp_ntz",
    "usage_event": "usage_id string, account_id string, service_id string, usage_type string, quantity decimal(12,4), "
                   "event_timestamp timestamp_ntz, rating_status string",
    "app_event": "app_event_id string, account_id string, device_id string, event_type string, "
                 "session_minutes decimal(8,2), event_timestamp timestamp_ntz",
    "customer_interaction": "interaction_id string, account_id string, service_id string, channel string, "
                            "interaction_type string, outcome string, interaction_timestamp timestamp_ntz",
    "trouble_ticket": "ticket_id string, account_id string, service_id string, ticket_category string, "
                      "severity string, status string, opened_at timestamp_ntz, resolved_at timestamp_ntz",
    "service_lifecycle_event": "lifecycle_event_id string, service_id string, event_type string, "
                               "event_reason string, actor_type string, event_timestamp timestamp_ntz",
    "invoice": "invoice_id string, account_id string, invoice_number string, invoice_date date, due_date date, "
               "total_amount_chf decimal(10,2), status string, created_at timestamp_ntz",
    "invoice_charge": "charge_id string, invoice_id string, charge_type string, charge_description string, "
                      "quantity decimal(12,4), amount_chf decimal(10,2), charge_date date",
    "payment": "payment_id string, invoice_id string, amount_chf decimal(10,2), payment_method string, "
               "payment_date date, status string, created_at timestamp_ntz",
    "agreement": "agreement_id string, account_id string, agreement_type string, status string, signed_date date, "
                 "effective_date date, termination_date date, created_at timestamp_ntz",
    "service_order": "order_id string, account_id string, order_type string, status string, "
                     "order_date timestamp_ntz, fulfillment_date timestamp_ntz",
}

# --- fixed values: staging-model foreign keys (child, column, parent, column)
RELATIONSHIPS: list[tuple[str, str, str, str]] = [
    ("individual", "party_id", "party", "party_id"),
    ("account", "party_id", "party", "party_id"),
    ("service", "account_id", "account", "account_id"),
    ("subscription", "service_id", "service", "service_id"),
    ("subscription", "product_offering_id", "product_offering", "product_offering_id"),
    ("usage_event", "account_id", "account", "account_id"),
    ("app_event", "account_id", "account", "account_id"),
    ("invoice", "account_id", "account", "account_id"),
    ("payment", "invoice_id", "invoice", "invoice_id"),
    ("agreement", "account_id", "account", "account_id"),
    ("service_order", "account_id", "account", "account_id"),
]

# --- fixed values: staging-model column tests (table, column, tests) -------
COLUMN_TESTS: list[tuple[str, str, tuple[str, ...]]] = [
    ("party", "party_id", ("unique", "not_null")),
    ("individual", "individual_id", ("unique", "not_null")),
    ("individual", "party_id", ("not_null",)),
    ("individual", "email", ("unique",)),
    ("account", "account_id", ("unique", "not_null")),
    ("account", "party_id", ("not_null",)),
    ("account", "account_number", ("unique", "not_null")),
    ("product_offering", "product_offering_id", ("unique", "not_null")),
    ("product_offering", "name", ("not_null",)),
    ("product_offering", "price_chf", ("not_null",)),
    ("service", "service_id", ("unique", "not_null")),
    ("service", "account_id", ("not_null",)),
    ("subscription", "subscription_id", ("unique", "not_null")),
    ("subscription", "service_id", ("not_null",)),
    ("subscription", "product_offering_id", ("not_null",)),
    ("subscription", "start_date", ("not_null",)),
    ("device", "device_id", ("unique", "not_null")),
    ("device", "imei", ("unique",)),
    ("sim_card", "sim_id", ("unique", "not_null")),
    ("sim_card", "msisdn", ("unique",)),
    ("sim_card", "iccid", ("unique",)),
    ("usage_event", "usage_id", ("unique", "not_null")),
    ("usage_event", "account_id", ("not_null",)),
    ("usage_event", "quantity", ("not_null",)),
    ("usage_event", "event_timestamp", ("not_null",)),
    ("app_event", "app_event_id", ("unique", "not_null")),
    ("app_event", "account_id", ("not_null",)),
    ("app_event", "event_type", ("not_null",)),
    ("app_event", "event_timestamp", ("not_null",)),
    ("invoice", "invoice_id", ("unique", "not_null")),
    ("invoice", "account_id", ("not_null",)),
    ("invoice", "invoice_number", ("unique", "not_null")),
    ("invoice", "total_amount_chf", ("not_null",)),
    ("payment", "payment_id", ("unique", "not_null")),
    ("payment", "invoice_id", ("not_null",)),
    ("payment", "amount_chf", ("not_null",)),
    ("agreement", "agreement_id", ("unique", "not_null")),
    ("agreement", "account_id", ("not_null",)),
    ("service_order", "order_id", ("unique", "not_null")),
    ("service_order", "account_id", ("not_null",)),
]

# --- fixed values: tests of the landing tables themselves (table, column, tests)
SOURCE_TESTS: list[tuple[str, str, tuple[str, ...]]] = [
    ("party", "party_id", ("unique", "not_null")),
    ("party", "party_type", ("not_null",)),
    ("individual", "individual_id", ("unique", "not_null")),
    ("individual", "party_id", ("not_null",)),
    ("individual", "email", ("unique",)),
    ("account", "account_id", ("unique", "not_null")),
    ("account", "party_id", ("not_null",)),
    ("account", "account_number", ("unique", "not_null")),
    ("product_offering", "product_offering_id", ("unique", "not_null")),
    ("product_offering", "name", ("not_null",)),
    ("product_offering", "price_chf", ("not_null",)),
    ("service", "service_id", ("unique", "not_null")),
    ("service", "account_id", ("not_null",)),
    ("subscription", "subscription_id", ("unique", "not_null")),
    ("subscription", "service_id", ("not_null",)),
    ("subscription", "product_offering_id", ("not_null",)),
    ("subscription", "start_date", ("not_null",)),
    ("device", "device_id", ("unique", "not_null")),
    ("device", "account_id", ("not_null",)),
    ("device", "imei", ("unique",)),
    ("sim_card", "sim_id", ("unique", "not_null")),
    ("sim_card", "account_id", ("not_null",)),
    ("sim_card", "msisdn", ("unique",)),
    ("sim_card", "iccid", ("unique",)),
    ("usage_event", "usage_id", ("unique", "not_null")),
    ("usage_event", "account_id", ("not_null",)),
    ("usage_event", "service_id", ("not_null",)),
    ("usage_event", "usage_type", ("not_null",)),
    ("usage_event", "quantity", ("not_null",)),
    ("usage_event", "event_timestamp", ("not_null",)),
    ("app_event", "app_event_id", ("unique", "not_null")),
    ("app_event", "account_id", ("not_null",)),
    ("app_event", "event_type", ("not_null",)),
    ("app_event", "event_timestamp", ("not_null",)),
    ("invoice", "invoice_id", ("unique", "not_null")),
    ("invoice", "account_id", ("not_null",)),
    ("invoice", "invoice_number", ("unique", "not_null")),
    ("invoice", "invoice_date", ("not_null",)),
    ("invoice", "due_date", ("not_null",)),
    ("invoice", "total_amount_chf", ("not_null",)),
    ("payment", "payment_id", ("unique", "not_null")),
    ("payment", "invoice_id", ("not_null",)),
    ("payment", "amount_chf", ("not_null",)),
    ("payment", "payment_date", ("not_null",)),
    ("agreement", "agreement_id", ("unique", "not_null")),
    ("agreement", "account_id", ("not_null",)),
    ("service_order", "order_id", ("unique", "not_null")),
    ("service_order", "account_id", ("not_null",)),
]

# --- fixed values: accepted values of the support risk band ---------------
RISK_BANDS: tuple[str, ...] = ("healthy", "watch", "high", "critical")

# --- fixed values: logical type families of the contracts, plus the
# landing type names; anything unknown falls back to text ---------------
_TYPE_NAMES: dict[str, T.DataType] = {
    "VARCHAR": T.StringType(), "TEXT": T.StringType(), "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "TIMESTAMP_LTZ": T.TimestampType(), "TIMESTAMPTZ": T.TimestampType(), "TIMESTAMP_TZ": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
    "NUMBER": T.LongType(), "INTEGER": T.LongType(), "BIGINT": T.LongType(),
}


def parse_type(name: str) -> T.DataType:
    """Landing/contract type name -> Spark type (``NUMBER(p,s)`` -> decimal)."""
    n = name.strip().upper()
    if n.startswith("NUMBER(") or n.startswith("DECIMAL("):
        p, s = n[n.index("(") + 1:n.index(")")].split(",")
        return T.DecimalType(int(p), int(s))
    return _TYPE_NAMES.get(n, T.StringType())


_SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    "bigint": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType(),
}


def _spark_type(name: str) -> T.DataType:
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    return T.DecimalType(int(m.group(1)), int(m.group(2))) if m else _SPARK_TYPES[name]


def schema_for(table: str) -> T.StructType:
    """The declared StructType of a landing table (all columns nullable)."""
    fields = re.findall(r"(\w+) ([\w]+(?:\(\d+,\d+\))?)", TABLE_DDL[table])
    return T.StructType([T.StructField(n, _spark_type(t), True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {t: schema_for(t) for t in TABLE_DDL}


def primary_key(table: str, columns: list[str] | None = None) -> str:
    """Key rule: ``<table>_id`` if present, else the first ``*_id``, else column one."""
    cols = columns if columns is not None else SCHEMAS[table].fieldNames()
    if f"{table}_id" in cols:
        return f"{table}_id"
    for c in cols:
        if c.endswith("_id"):
            return c
    return cols[0]


PRIMARY_KEYS: dict[str, str] = {t: primary_key(t) for t in TABLE_DDL}
