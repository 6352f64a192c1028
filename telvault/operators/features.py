"""Trailing-window feature aggregates (pre-aggregated before any join).

Every aggregate is a hash aggregate with a map-side partial step, so a hot
key (one account with a third of all events) is combined inside each input
partition before the shuffle and never lands as raw rows on one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telvault.functions.scoring import severity_weight
from telvault.functions.windows import as_timestamp, trailing_date_window, trailing_rows


def usage_30d(usage_event: DataFrame, as_of, days: int = 30, by_account: bool = True) -> DataFrame:
    """Usage per (service, account) -- or per service for the posture product.

    count(*), round(sum(data_mb quantity), 2), round(sum(voice_min quantity), 2).
    """
    keys = ["service_id", "account_id"] if by_account else ["service_id"]
    q = F.col("quantity")
    aggs = [
        F.count(F.lit(1)).alias("usage_events_30d"),
        F.round(F.sum(F.when(F.col("usage_type") == "data_mb", q).otherwise(F.lit(0))), 2).alias("data_mb_30d"),
    ]
    if by_account:
        aggs.append(F.round(F.sum(F.when(F.col("usage_type") == "voice_min", q).otherwise(F.lit(0))), 2)
                    .alias("voice_min_30d"))
    out = (trailing_rows(usage_event, "event_timestamp", as_of, days)
           .groupBy(*keys).agg(*aggs))
    if by_account:
        out = out.withColumn("snapshot_at", as_timestamp(as_of))
    return out


def interactions_30d(customer_interaction: DataFrame, as_of, days: int = 30, by_service: bool = True) -> DataFrame:
    """Interactions per (account, service) -- NULL service is its own group -- or per account."""
    keys = ["account_id", "service_id"] if by_service else ["account_id"]
    last = "last_interaction_at" if by_service else "latest_interaction_at"
    out = (trailing_rows(customer_interaction, "interaction_timestamp", as_of, days)
           .groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("interaction_count_30d"),
                F.max("interaction_timestamp").alias(last)))
    if by_service:
        out = out.withColumn("snapshot_at", as_timestamp(as_of))
    return out


def ticket_status_30d(trouble_ticket: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Tickets opened in the window per (account, service).

    open_ticket_count_30d = count_if(status <> 'resolved') (NULL status not
    counted); ticket_severity_index = avg severity weight, kept as an exact
    decimal(18,6) so its hash text is engine independent.
    """
    return (trailing_rows(trouble_ticket, "opened_at", as_of, days)
            .groupBy("account_id", "service_id")
            .agg(F.count_if(F.col("status") != "resolved").alias("open_ticket_count_30d"),
                 F.avg(severity_weight("severity")).cast("decimal(18,6)").alias("ticket_severity_index"))
            .withColumn("snapshot_at", as_timestamp(as_of)))


def ticket_parts_30d(trouble_ticket: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Ticket aggregates in additive form (open count, weight sum, ticket count).

    Used when groups must be merged later (NULL-service group into the
    service's own group): averages are re-formed from the summed parts.
    """
    return (trailing_rows(trouble_ticket, "opened_at", as_of, days)
            .groupBy("account_id", "service_id")
            .agg(F.count_if(F.col("status") != "resolved").alias("open_ticket_count_30d"),
                 F.sum(severity_weight("severity")).cast("bigint").alias("severity_weight_sum"),
                 F.count(F.lit(1)).alias("ticket_count_30d"))
            .withColumn("snapshot_at", as_timestamp(as_of)))


def open_tickets(trouble_ticket: DataFrame) -> DataFrame:
    """All-time unresolved tickets per service (posture definition)."""
    return (trouble_ticket.filter(F.col("status") != "resolved")
            .groupBy("service_id").agg(F.count(F.lit(1)).alias("open_ticket_count")))


def latest_lifecycle(service_lifecycle_event: DataFrame) -> DataFrame:
    """Latest lifecycle event per service (max, not a window function)."""
    return (service_lifecycle_event.groupBy("service_id")
            .agg(F.max("event_timestamp").alias("latest_lifecycle_event_at")))


def charges_30d(invoice_charge: DataFrame, invoice: DataFrame, service: DataFrame,
                subscription: DataFrame, as_of, days: int = 30, snapshot_as_of=None) -> DataFrame:
    """Charges per (account, service) through invoice -> account -> service -> subscription.

    The model joins every charge of an account to every subscribed service
    of that account and sums per (account, service). Since a sum distributes
    over that product, the same numbers come from aggregates, without
    materialising charge x service pairs:

        total(a, s) = n_service_rows(a, s) * n_subscriptions(s) * charges(a)

    ``charges(a)`` = charges pre-aggregated per invoice (partial aggregation
    on the largest table), joined to invoices, summed per account. Every
    join below is at most one-row-per-key on one side, so output rows are
    bounded by the service table, whatever the skew.
    """
    amt = F.col("amount_chf")
    per_invoice = (invoice_charge.filter(trailing_date_window("charge_date", as_of, days))
                   .groupBy("invoice_id")
                   .agg(F.sum(amt).alias("tot"),
                        F.sum(F.when(F.col("charge_type") == "recurring_charge", amt).otherwise(F.lit(0)))
                        .alias("rec")))
    per_account = (per_invoice.join(invoice.select("invoice_id", "account_id"), "invoice_id")
                   .groupBy("account_id")
                   .agg(F.sum("tot").alias("tot"), F.sum("rec").alias("rec")))
    subs = subscription.groupBy("service_id").agg(F.count(F.lit(1)).alias("n_sub"))
    svc = (service.select("account_id", "service_id")
           .groupBy("account_id", "service_id").agg(F.count(F.lit(1)).alias("n_svc")))
    mult = (F.col("n_svc") * F.col("n_sub")).cast("decimal(20,0)")
    out = (svc.join(subs, "service_id")
           .join(per_account, "account_id")
           .select("account_id", "service_id",
                   F.round(F.col("tot") * mult, 2).cast("decimal(38,2)").alias("total_charges_30d"),
                   F.round(F.col("rec") * mult, 2).cast("decimal(38,2)").alias("monthly_recurring_charge"),
                   as_timestamp(snapshot_as_of if snapshot_as_of is not None else as_of).alias("snapshot_at")))
    return out
