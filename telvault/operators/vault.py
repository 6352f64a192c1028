"""Data Vault tables: hubs, links, satellites and the support-health satellite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telvault.functions.hashing import dv_hash, dv_hashdiff
from telvault.functions.scoring import health_score, risk_band
from telvault.functions.windows import as_timestamp
from telvault.operators.joins import exact_keys, probe_keys, wildcard_matches

# --- fixed values: record sources of the vault tables ----------------------
LINK_ACCOUNT_SERVICE_SOURCE = "TELCO_DV2.LINK_ACCOUNT_SERVICE"
LINK_SERVICE_SUBSCRIPTION_SOURCE = "TELCO_DV2.LINK_SERVICE_SUBSCRIPTION"
SAT_SUPPORT_HEALTH_SOURCE = "TELCO_DV2.SAT_SERVICE_SUPPORT_HEALTH"

SAT_SUPPORT_HEALTH_COLUMNS = [
    "hk_service", "account_id", "service_id", "service_status", "usage_events_30d", "data_mb_30d",
    "interaction_count_30d", "last_interaction_at", "open_ticket_count_30d", "ticket_severity_index",
    "total_charges_30d", "monthly_recurring_charge", "snapshot_at", "support_risk_band",
    "support_health_score", "hashdiff", "load_dts", "record_source",
]


def hub(dv_staged: DataFrame, hash_key: str, business_key: str) -> DataFrame:
    """Distinct (hash key, business key, load_dts, record_source)."""
    return dv_staged.select(hash_key, business_key, "load_dts", "record_source").distinct()


def link(driver: DataFrame, other: DataFrame, on: str, link_key: str, driver_key: str, other_key: str,
         record_source: str) -> DataFrame:
    """Distinct link rows from an inner equi-join of two staged entities.

    ``load_dts`` is the later of the two sides' load times.
    """
    d = driver.select(on, link_key, driver_key, F.col("load_dts").alias("__d_ld"))
    o = other.select(on, other_key, F.col("load_dts").alias("__o_ld"))
    return (d.join(o, on)
            .select(link_key, other_key, driver_key,
                    F.greatest("__o_ld", "__d_ld").alias("load_dts"),
                    F.lit(record_source).alias("record_source"))
            .distinct())


def link_account_service(dv_service: DataFrame, dv_account: DataFrame) -> DataFrame:
    out = link(dv_service, dv_account, "account_id", "hk_link_account_service", "hk_service", "hk_account",
               LINK_ACCOUNT_SERVICE_SOURCE)
    return out.select("hk_link_account_service", "hk_account", "hk_service", "load_dts", "record_source")


def link_service_subscription(dv_subscription: DataFrame, dv_service: DataFrame) -> DataFrame:
    out = link(dv_subscription, dv_service, "service_id", "hk_link_service_subscription", "hk_subscription",
               "hk_service", LINK_SERVICE_SUBSCRIPTION_SOURCE)
    return out.select("hk_link_service_subscription", "hk_service", "hk_subscription", "load_dts",
                      "record_source")


def sat_account_profile(dv_account: DataFrame) -> DataFrame:
    return dv_account.select(
        "hk_account", "account_id", "party_id", "account_number", "account_type", "account_status",
        "account_created_at", "account_closed_at", F.col("hd_account_profile").alias("hashdiff"),
        "load_dts", "record_source")


def sat_service_support_health(dv_service: DataFrame, usage: DataFrame, interactions: DataFrame,
                               tickets: DataFrame, charges: DataFrame, as_of,
                               merge_null_groups: bool = False) -> DataFrame:
    """Business satellite: one row per service and per matching feature row.

    Joins (all left, from the staged service):
      usage on service_id; interactions and tickets on account_id with a
      NULL service_id acting as a wildcard over the account's services;
      charges on (account_id, service_id).
    A service can therefore appear more than once (its own interaction
    group plus its account's NULL-service group) -- the model's behaviour.
    With ``merge_null_groups=True`` the matches of a service are combined
    into one row instead (counts summed, latest time kept, severity index
    re-formed from summed parts; ``tickets`` must then come from
    ``features.ticket_parts_30d``).

    Plan: usage (keyed by service only) joins first; then interactions,
    tickets and charges join on one probe key (account, service IS NULL,
    coalesce(service, '')), so the three joins share one hash partitioning
    of the service side (two shuffles of it in total, not four).
    """
    # the hash key is formed again at the end: its 32 letters would go through every shuffle of the services
    s = dv_service.select("account_id", "service_id", "service_status", "load_dts")
    i = interactions.select("account_id", "service_id", "interaction_count_30d", "last_interaction_at",
                            F.col("snapshot_at").alias("i_snap"))
    if merge_null_groups:
        t = tickets.select("account_id", "service_id", "open_ticket_count_30d", "severity_weight_sum",
                           "ticket_count_30d", F.col("snapshot_at").alias("t_snap"))
    else:
        t = tickets.select("account_id", "service_id", "open_ticket_count_30d", "ticket_severity_index",
                           F.col("snapshot_at").alias("t_snap"))
    c = charges.select("account_id", "service_id", "total_charges_30d", "monthly_recurring_charge",
                       F.col("snapshot_at").alias("c_snap"))
    u = usage.select(F.col("service_id").alias("__u_sid"), "usage_events_30d", "data_mb_30d",
                     F.col("snapshot_at").alias("u_snap"))

    keys = s.select("account_id", "service_id")
    on = ["account_id", "__wnull", "__wkey"]
    j = s.join(u, s.service_id == u.__u_sid, "left")
    j = probe_keys(j, "service_id")
    im = wildcard_matches(i, keys, "account_id", "service_id")
    tm = wildcard_matches(t, keys, "account_id", "service_id")
    if merge_null_groups:
        # at most two matches per service key (own group, NULL group): a small combine
        im = im.groupBy(*on).agg(F.sum("interaction_count_30d").alias("interaction_count_30d"),
                                 F.max("last_interaction_at").alias("last_interaction_at"),
                                 F.max("i_snap").alias("i_snap"))
        tm = (tm.groupBy(*on).agg(F.sum("open_ticket_count_30d").alias("open_ticket_count_30d"),
                                  F.sum("severity_weight_sum").alias("__wsum"),
                                  F.sum("ticket_count_30d").alias("__n"), F.max("t_snap").alias("t_snap"))
              .select(*on, "open_ticket_count_30d", "t_snap",
                      F.round(F.col("__wsum").cast("decimal(20,0)") / F.col("__n").cast("decimal(20,0)"), 6)
                      .cast("decimal(18,6)").alias("ticket_severity_index")))
    j = j.join(im, on, "left")
    j = j.join(tm, on, "left")
    j = j.join(exact_keys(c, "service_id"), on, "left")

    z = F.lit(0)
    open_t = F.coalesce("open_ticket_count_30d", z)
    inter = F.coalesce("interaction_count_30d", z)
    data_mb = F.coalesce(F.col("data_mb_30d").cast("decimal(18,2)"), z.cast("decimal(18,2)"))
    mrc = F.coalesce(F.col("monthly_recurring_charge").cast("decimal(18,2)"), z.cast("decimal(18,2)"))
    ld = F.col("load_dts")
    return j.select(
        dv_hash("service_id").alias("hk_service"), "account_id", "service_id", "service_status",
        F.coalesce("usage_events_30d", z).cast("bigint").alias("usage_events_30d"),
        data_mb.alias("data_mb_30d"),
        inter.cast("bigint").alias("interaction_count_30d"),
        "last_interaction_at",
        open_t.cast("bigint").alias("open_ticket_count_30d"),
        F.coalesce("ticket_severity_index", z.cast("decimal(18,6)")).alias("ticket_severity_index"),
        F.coalesce(F.col("total_charges_30d").cast("decimal(18,2)"), z.cast("decimal(18,2)")).alias("total_charges_30d"),
        mrc.alias("monthly_recurring_charge"),
        F.greatest(ld, F.coalesce("u_snap", ld), F.coalesce("i_snap", ld), F.coalesce("t_snap", ld),
                   F.coalesce("c_snap", ld)).alias("snapshot_at"),
        risk_band(open_t, inter, data_mb, F.col("service_status")).alias("support_risk_band"),
        health_score(open_t, inter, mrc).alias("support_health_score"),
        dv_hashdiff("service_status", F.col("usage_events_30d"), F.col("data_mb_30d").cast("decimal(18,2)"),
                    "interaction_count_30d", "open_ticket_count_30d", "ticket_severity_index",
                    F.col("total_charges_30d").cast("decimal(18,2)"),
                    F.col("monthly_recurring_charge").cast("decimal(18,2)")).alias("hashdiff"),
        as_timestamp(as_of).alias("load_dts"),
        F.lit(SAT_SUPPORT_HEALTH_SOURCE).alias("record_source"),
    )
