"""Staging projections (rename / trim) and Data Vault staging (hash keys).

One schema-driven ``stage`` replaces fourteen hand-written select models;
``dv_stage`` adds hash keys, hashdiffs, ``load_dts`` and ``record_source``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telvault.functions.hashing import dv_hash, dv_hashdiff
from telvault.functions.windows import as_timestamp

# --- fixed values: output columns of the staging models --------------------
STAGING_COLUMNS: dict[str, list[str]] = {
    "party": ["party_id", "party_type", "status", "created_at", "updated_at"],
    "individual": ["individual_id", "party_id", "first_name", "last_name", "email", "date_of_birth", "created_at"],
    "account": ["account_id", "party_id", "account_number", "account_type", "status", "created_at", "closed_at"],
    "product_offering": ["product_offering_id", "name", "category", "data_limit_gb", "voice_limit_min",
                         "price_chf", "status", "created_at"],
    "service": ["service_id", "account_id", "service_type", "status", "activated_at", "terminated_at"],
    "subscription": ["subscription_id", "service_id", "product_offering_id", "status", "start_date",
                     "end_date", "renewal_date", "created_at"],
    "device": ["device_id", "account_id", "device_type", "manufacturer", "model", "imei", "status",
               "registered_at"],
    "sim_card": ["sim_id", "account_id", "device_id", "msisdn", "iccid", "status", "activated_at"],
    "usage_event": ["usage_id", "account_id", "service_id", "usage_type", "quantity", "event_timestamp",
                    "rating_status"],
    "app_event": ["app_event_id", "account_id", "device_id", "event_type", "session_minutes", "event_timestamp"],
    "invoice": ["invoice_id", "account_id", "invoice_number", "invoice_date", "due_date", "total_amount_chf",
                "status", "created_at"],
    "payment": ["payment_id", "invoice_id", "amount_chf", "payment_method", "payment_date", "status", "created_at"],
    "agreement": ["agreement_id", "account_id", "agreement_type", "status", "signed_date", "effective_date",
                  "termination_date", "created_at"],
    "service_order": ["order_id", "account_id", "order_type", "status", "order_date", "fulfillment_date"],
}

# --- fixed values: Data Vault staging definitions ---------------------------
# renames, hash keys (name -> business-key columns), hashdiff (name -> payload
# columns, by their new names), record source.
DV_STAGING: dict[str, dict] = {
    "account": {
        "columns": ["account_id", "party_id", "account_number", "account_type",
                    ("status", "account_status"), ("created_at", "account_created_at"),
                    ("closed_at", "account_closed_at")],
        "keys": {"hk_account": ["account_id"]},
        "hashdiff": ("hd_account_profile", ["party_id", "account_number", "account_type", "account_status",
                                            "account_created_at", "account_closed_at"]),
        "record_source": "TELCO_STAGE.ACCOUNT",
    },
    "service": {
        "columns": ["service_id", "account_id", "service_type", ("status", "service_status"),
                    "activated_at", "terminated_at"],
        "keys": {"hk_service": ["service_id"], "hk_link_account_service": ["account_id", "service_id"]},
        "hashdiff": ("hd_service_status", ["account_id", "service_type", "service_status", "activated_at",
                                           "terminated_at"]),
        "record_source": "TELCO_STAGE.SERVICE",
    },
    "subscription": {
        "columns": ["subscription_id", "service_id", "product_offering_id", ("status", "subscription_status"),
                    "start_date", "end_date", "renewal_date"],
        "keys": {"hk_subscription": ["subscription_id"],
                 "hk_link_service_subscription": ["service_id", "subscription_id"]},
        "hashdiff": ("hd_subscription_plan", ["product_offering_id", "subscription_status", "start_date",
                                              "end_date", "renewal_date"]),
        "record_source": "TELCO_STAGE.SUBSCRIPTION",
    },
    "product_offering": {
        "columns": ["product_offering_id", ("name", "product_offering_name"), ("category", "product_category"),
                    "data_limit_gb", "voice_limit_min", "price_chf", ("status", "product_status")],
        "keys": {"hk_product_offering": ["product_offering_id"]},
        "hashdiff": ("hd_product_offering", ["product_offering_name", "product_category", "data_limit_gb",
                                             "voice_limit_min", "price_chf", "product_status"]),
        "record_source": "TELCO_STAGE.PRODUCT_OFFERING",
    },
}


def stage(df: DataFrame, table: str) -> DataFrame:
    """Staging view of a landing table: the model's columns, in model order."""
    missing = [c for c in STAGING_COLUMNS[table] if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: input lacks columns {missing}")
    return df.select(*STAGING_COLUMNS[table])


def dv_stage(df: DataFrame, table: str, as_of) -> DataFrame:
    """Data Vault staging: renamed payload + hash keys + hashdiff + load metadata.

    Renames are applied first, so hashes see the new names (the models hash
    through lateral aliases).
    """
    spec = DV_STAGING[table]
    renamed = df.select([F.col(c[0]).alias(c[1]) if isinstance(c, tuple) else F.col(c)
                         for c in spec["columns"]])
    hd_name, hd_cols = spec["hashdiff"]
    extra = [dv_hash(*cols).alias(name) for name, cols in spec["keys"].items()]
    extra += [dv_hashdiff(*hd_cols).alias(hd_name),
              as_timestamp(as_of).alias("load_dts"),
              F.lit(spec["record_source"]).alias("record_source")]
    return renamed.select("*", *extra)
