"""Marts: subscriber-360 core, health scorecard, support posture, customer 360."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telvault.functions.hashing import dv_hash
from telvault.functions.scoring import exact_avg
from telvault.operators.features import interactions_30d, latest_lifecycle, open_tickets, usage_30d

CORE_COLUMNS = [
    "party_id", "account_id", "account_number", "service_id", "subscription_id", "product_offering_name",
    "service_status", "billing_status", "monthly_recurring_charge", "data_mb_30d", "interaction_count_30d",
    "open_ticket_count_30d", "support_health_score", "support_risk_band", "last_interaction_at", "snapshot_at",
]
SCORECARD_COLUMNS = [
    "account_id", "service_id", "usage_events_30d", "data_mb_30d", "interaction_count_30d",
    "open_ticket_count_30d", "ticket_severity_index", "total_charges_30d", "monthly_recurring_charge",
    "support_health_score", "support_risk_band", "snapshot_at",
]
HEALTH_COLUMNS = ["hk_service", "last_interaction_at", *SCORECARD_COLUMNS]  # of the health satellite
POSTURE_COLUMNS = [
    "service_id", "account_id", "service_type", "service_status", "subscription_id", "product_offering_name",
    "usage_events_30d", "data_mb_30d", "interaction_count_30d", "open_ticket_count", "latest_interaction_at",
    "latest_lifecycle_event_at",
]


def subscriber360_core(sat_account: DataFrame, dv_service: DataFrame, dv_subscription: DataFrame,
                       dv_product_offering: DataFrame, sat_health: DataFrame, dv_account: DataFrame) -> DataFrame:
    """Core mart: account x service, left to subscription, plan, health, party."""
    a = sat_account.select("account_id", "account_number", F.col("account_status").alias("billing_status"))
    # the hash key is formed again where it is joined on: its 32 letters would go through every shuffle before
    s = dv_service.select("account_id", "service_id", "service_status")
    sub = dv_subscription.select(F.col("service_id").alias("__sub_sid"), "subscription_id",
                                 "product_offering_id")
    po = dv_product_offering.select(F.col("product_offering_id").alias("__po_id"), "product_offering_name")
    h = sat_health.select(F.col("hk_service").alias("__h_hk"), "monthly_recurring_charge", "data_mb_30d",
                          "interaction_count_30d", "open_ticket_count_30d", "support_health_score",
                          "support_risk_band", "last_interaction_at", "snapshot_at")
    p = dv_account.select(F.col("account_id").alias("__p_aid"), "party_id")
    # Each left join's condition uses only base (account, service) columns, so
    # the joins commute. The two account-keyed ones stand apart: back to back
    # they would share one shuffle, which AQE then cannot split for a hot account.
    # The health comes last: products that differ in it alone share the rest.
    j = (a.join(s, "account_id")
         .join(sub, F.col("service_id") == F.col("__sub_sid"), "left")
         .join(po, F.col("product_offering_id") == F.col("__po_id"), "left")
         .join(p, F.col("account_id") == F.col("__p_aid"), "left")
         .withColumn("hk_service", dv_hash("service_id"))
         .join(h, F.col("hk_service") == F.col("__h_hk"), "left"))
    return j.select(*CORE_COLUMNS)


def health_scorecard(sat_health: DataFrame) -> DataFrame:
    return sat_health.select(*SCORECARD_COLUMNS)


def support_posture(service: DataFrame, subscription: DataFrame, product_offering: DataFrame,
                    usage_event: DataFrame, customer_interaction: DataFrame, trouble_ticket: DataFrame,
                    service_lifecycle_event: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Support posture: non-terminated services with plan and pre-aggregated signals.

    Usage per service (window), interactions per *account* (window),
    unresolved tickets per service (all time), latest lifecycle event.
    The outer-join predicate ``sub.status <> 'cancelled'`` filters the
    subscription side before the join (same rows as the ON condition).
    """
    u = usage_30d(usage_event, as_of, days, by_account=False).withColumnRenamed("service_id", "__u_sid")
    i = interactions_30d(customer_interaction, as_of, days, by_service=False).withColumnRenamed("account_id", "__i_aid")
    t = open_tickets(trouble_ticket).withColumnRenamed("service_id", "__t_sid")
    lc = latest_lifecycle(service_lifecycle_event).withColumnRenamed("service_id", "__l_sid")
    s = service.filter(F.col("status") != "terminated").select(
        "service_id", "account_id", "service_type", F.col("status").alias("service_status"))
    sub = (subscription.filter(F.col("status") != "cancelled")
           .select(F.col("service_id").alias("__sub_sid"), "subscription_id", "product_offering_id"))
    po = product_offering.select(F.col("product_offering_id").alias("__po_id"), F.col("name").alias("product_offering_name"))
    j = (s.join(sub, F.col("service_id") == F.col("__sub_sid"), "left")
         .join(po, F.col("product_offering_id") == F.col("__po_id"), "left")
         .join(u, F.col("service_id") == F.col("__u_sid"), "left")
         .join(t, F.col("service_id") == F.col("__t_sid"), "left")
         .join(lc, F.col("service_id") == F.col("__l_sid"), "left")
         .join(i, F.col("account_id") == F.col("__i_aid"), "left"))
    z = F.lit(0)
    return j.select(
        "service_id", "account_id", "service_type", "service_status", "subscription_id",
        "product_offering_name",
        F.coalesce("usage_events_30d", z).cast("bigint").alias("usage_events_30d"),
        F.coalesce(F.col("data_mb_30d").cast("decimal(18,2)"), z.cast("decimal(18,2)")).alias("data_mb_30d"),
        F.coalesce("interaction_count_30d", z).cast("bigint").alias("interaction_count_30d"),
        F.coalesce("open_ticket_count", z).cast("bigint").alias("open_ticket_count"),
        "latest_interaction_at", "latest_lifecycle_event_at",
    )


def _rank_one(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep the first row per key under a total order (window over small groups)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def compose_products(products: list[DataFrame], keys: list[str], extra_order: list | None = None,
                     dealt_by: list[str] | None = None) -> DataFrame:
    """Union products of one schema (first = highest priority), one row per key.

    Priority, then newest snapshot, then ``extra_order`` decide; groups are
    keyed by service so no group is larger than a service's fan-out. The rows
    are dealt by ``dealt_by`` (some of ``keys``; default: all) before they are
    ranked: rows of one key lie in different products' partitions, so ranking
    them before the shuffle as well would sort everything twice.
    """
    ranked = None
    for rank, df in enumerate(products, start=1):
        r = df.withColumn("__product_rank", F.lit(rank))
        ranked = r if ranked is None else ranked.unionByName(r)
    order = [F.col("__product_rank").asc(), F.col("snapshot_at").desc()] + list(extra_order or [])
    return _rank_one(ranked.repartition(*(dealt_by or keys)), keys, order).drop("__product_rank")


def _core_tiebreak() -> list:
    """Tie-break among fan-out rows of one product: worst health first."""
    return [F.col("support_health_score").asc_nulls_last(), F.col("open_ticket_count_30d").desc_nulls_last(),
            F.col("interaction_count_30d").desc_nulls_last(), F.col("data_mb_30d").desc_nulls_last(),
            F.col("last_interaction_at").desc_nulls_last()]


def _scorecard_tiebreak() -> list:
    """Largest charges first: rows that tie here agree in all that the 360 takes of a scorecard."""
    return [F.col("total_charges_30d").desc_nulls_last()]


def customer_360(cores: list[DataFrame], scorecards: list[DataFrame]) -> DataFrame:
    """Gold customer 360 at account x month grain over composed silver products.

    * cores: rank-1 row per (account, service, subscription)
    * scorecards: rank-1 row per (account, service) -> revenue per account-month
    * counts are exact distinct counts; the risk flag is a boolean OR.
    """
    core = compose_products(cores, ["account_id", "service_id", "subscription_id"], _core_tiebreak(),
                            dealt_by=["account_id", "service_id"])
    core = core.withColumn("snapshot_month", F.date_trunc("month", "snapshot_at").cast("timestamp_ntz"))
    keys = ["account_id", "account_number", "snapshot_month"]
    score = F.col("support_health_score")
    # a service counts at the first of its active rows: the rows of a service lie together already, so both distinct
    # counts come from one pass over the composed core
    is_active = F.coalesce(F.col("service_status") == "active", F.lit(False))
    of_service = Window.partitionBy(*keys, "service_id").orderBy(is_active.desc())
    counts = (F.row_number().over(of_service) == 1) & is_active & F.col("service_id").isNotNull()
    core = core.withColumn("__active", counts.cast("bigint"))
    # one row per subscription first, then the account: two keyed partial aggregates, and no row is multiplied as it
    # would be by two distinct counts in one aggregate
    held = core.groupBy(*keys, "subscription_id").agg(
        F.sum("__active").alias("__active"),
        F.sum(score.cast("decimal(38,10)")).alias("__sum"), F.count(score).alias("__n"),
        F.bool_or(F.col("support_risk_band").isin("high", "critical")).alias("risk"),
        F.max("last_interaction_at").alias("last"), F.max("snapshot_at").alias("at"))
    agg = held.groupBy(*keys).agg(
        F.count("subscription_id").alias("subscription_count"), F.sum("__active").alias("active_service_count"),
        F.round(F.try_divide(F.sum("__sum").cast("decimal(38,10)"), F.sum("__n")), 2).cast("decimal(18,2)").alias("avg_health_score"),
        F.bool_or("risk").alias("high_risk_flag"), F.max("last").alias("last_interaction_at"), F.max("at").alias("snapshot_at"))
    sc = compose_products(scorecards, ["account_id", "service_id"], _scorecard_tiebreak())
    rev = (sc.withColumn("snapshot_month", F.date_trunc("month", "snapshot_at").cast("timestamp_ntz"))
           .groupBy(F.col("account_id").alias("__r_aid"), F.col("snapshot_month").alias("__r_m"))
           .agg(F.sum("total_charges_30d").cast("decimal(38,2)").alias("total_revenue_30d")))
    j = agg.join(rev, (F.col("account_id") == F.col("__r_aid")) & (F.col("snapshot_month") == F.col("__r_m")),
                 "left")
    return j.select(
        "account_id", "account_number", "subscription_count", "active_service_count",
        F.coalesce("total_revenue_30d", F.lit(0).cast("decimal(38,2)")).alias("total_revenue_30d"),
        "avg_health_score", "high_risk_flag", "last_interaction_at", "snapshot_at")
