"""

Every query derives the telco landing tables from the star tables of
``sf_dir`` (``telvault.sources.star``) and runs the library on them, over
the whole tables. At the very end decimal columns become double and date
columns timestamp (``_portable``), so both engines hand back the same
value types for the comparison; the library itself keeps decimals/dates.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.functions.hashing import stable_uuid
from telvault.operators import catalog, features, metrics, quality, semantic
from telvault.operators.staging import STAGING_COLUMNS, stage
from telvault.plans import contracts
from telvault.plans.silver import Windows, build_silver, customer_360, support_posture
from telvault.schemas import COLUMN_TESTS, RELATIONSHIPS, RISK_BANDS, SCHEMAS, SOURCE_TESTS
from telvault.session import apply_runtime_conf, checkpoint_dir, materialize
from telvault.sinks import publish, readback
from telvault.sources import days, files, fingerprints, footers, generations
from telvault.sources.star import BILLING_AS_OF, EVENT_AS_OF, StarSource

try:  # the training-data operators are an optional subpackage
    from telvault.llm.oracle import SQL as LLM_SQL
    from telvault.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as e:
    if e.name != "telvault.llm":  # what it needs is missing, not the subpackage
        raise
    LLM_QUERIES, LLM_SQL = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"
SHORT = Windows(interactions=3, tickets=10)


def _portable(df: DataFrame) -> DataFrame:
    """Engine-neutral value types for the comparison: decimal -> double, date -> timestamp."""
    def conv(f):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)
    return df.select([conv(f) for f in df.schema.fields])


def _star(spark: SparkSession, sf_dir: str) -> StarSource:
    apply_runtime_conf(spark)
    return StarSource(spark, sf_dir)


def _silver(spark, sf_dir, windows: Windows = Windows(), merge_null_groups: bool = False):
    return build_silver(_star(spark, sf_dir).tables(), EVENT_AS_OF, BILLING_AS_OF, windows,
                        merge_null_groups=merge_null_groups)


def q_support_posture(spark, sf_dir):
    return _portable(support_posture(_star(spark, sf_dir).tables(), EVENT_AS_OF))


def _silver_attr(attr: str, windows: Windows = Windows()):
    def run(spark, sf_dir):
        return _portable(getattr(_silver(spark, sf_dir, windows), attr))
    run.__name__ = f"q_{attr}"
    return run


def q_sat_health_merged(spark, sf_dir):
    """Support-health satellite with NULL-service groups merged: one row per service."""
    return _portable(_silver(spark, sf_dir, merge_null_groups=True).sat_service_support_health)


def _stage(table: str):
    def run(spark, sf_dir):
        return _portable(stage(_star(spark, sf_dir).table(table), table))
    run.__name__ = f"q_stg_{table}"
    return run


# ---- data tests, rules, checks ----------------------------------------------
def q_test_unique(spark, sf_dir):
    return quality.run_column_tests(_star(spark, sf_dir).tables(), COLUMN_TESTS, kinds=("unique",))


def q_test_sources(spark, sf_dir):
    """The tests of the landing tables themselves."""
    return quality.run_column_tests(_star(spark, sf_dir).tables(), SOURCE_TESTS)


def q_usage_5d(spark, sf_dir):
    """Usage of the last five days from events laid out by day: folders before the window are not read."""
    path = f"{_bronze_dir(spark)}/usage_by_day"
    days.write_by_day(_star(spark, sf_dir).table("usage_event"), path, "event_timestamp")
    events = days.read_by_day(spark, path, SCHEMAS["usage_event"])
    return _portable(features.usage_30d(events, EVENT_AS_OF, days=5))


def q_metrics_across_models(spark, sf_dir):
    """Core and scorecard metrics by billing status, which only the core has."""
    m = _marts(spark, sf_dir)
    bound = {"core": (semantic.CORE_MODEL, m["mart_subscriber360_core"]), "scorecard": (semantic.SCORECARD_MODEL, m["mart_subscriber_health_scorecard"])}
    return _portable(semantic.metric_query_across(
        bound, ["active_recurring_revenue", "open_ticket_pressure", "average_support_health"], ["BILLING_STATUS"],
        via={"BILLING_STATUS": "ACCOUNT_ID"}, round_digits=2))


def q_test_not_null(spark, sf_dir):
    return quality.run_column_tests(_star(spark, sf_dir).tables(), COLUMN_TESTS, kinds=("not_null",))


def q_test_relationships(spark, sf_dir):
    return quality.run_relationship_tests(_star(spark, sf_dir).tables(), RELATIONSHIPS)


def _marts(spark, sf_dir):
    """Both marts over one written support-health satellite (built once, read twice)."""
    s = build_silver(_star(spark, sf_dir).tables(), EVENT_AS_OF, BILLING_AS_OF, materialize=True)
    return {"mart_subscriber360_core": s.subscriber360_core, "mart_subscriber_health_scorecard": s.health_scorecard}


def q_test_accepted_values(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return quality.union_all([quality.test_accepted_values(df, "support_risk_band", RISK_BANDS, t)
                           for t, df in m.items()])


def q_test_mart_not_null(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return quality.union_all([
        quality.test_not_null(m["mart_subscriber360_core"], "mart_subscriber360_core",
                              ["account_id", "service_id", "support_health_score"]),
        quality.test_not_null(m["mart_subscriber_health_scorecard"], "mart_subscriber_health_scorecard",
                              ["account_id", "service_id", "open_ticket_count_30d"])])


def q_dq_rules(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return quality.union_all([
        quality.evaluate_rules(m["mart_subscriber360_core"], contracts.CORE_RULES, "mart_subscriber360_core"),
        quality.evaluate_rules(m["mart_subscriber_health_scorecard"], contracts.SCORECARD_RULES,
                               "mart_subscriber_health_scorecard")])


def q_schema_check(spark, sf_dir):
    star = _star(spark, sf_dir)
    core = build_silver(star.tables(), EVENT_AS_OF, BILLING_AS_OF).subscriber360_core
    posture = support_posture(star.tables(), EVENT_AS_OF)
    return quality.union_all([
        quality.check_schema(core, contracts.CORE_SCHEMA, target="mart_subscriber360_core"),
        quality.check_schema(posture, contracts.POSTURE_SCHEMA, target="support_posture")])


def _bronze_dir(spark) -> str:
    return f"{checkpoint_dir(spark)}/bronze/{uuid.uuid4().hex}"


def q_row_reconciliation(spark, sf_dir):
    """Row counts of all derived tables against their written and re-read bronze copies."""
    tables = _star(spark, sf_dir).tables()
    bronze = _bronze_dir(spark)
    files.ingest(tables, bronze)
    return quality.reconcile_counts(tables, files.read_bronze(spark, bronze, tables))


def q_bronze_load_report(spark, sf_dir):
    """The three source-aligned acquisitions into bronze: rows as counted while writing."""
    star, bronze = _star(spark, sf_dir), _bronze_dir(spark)
    reports = [files.acquire(product, star.table, bronze) for product in files.ACQUISITIONS]
    return quality.union_all(reports).select("table_name", "rows")


def q_landing_csv(spark, sf_dir):
    """The charges, landed as CSV and read back with their declared schema."""
    path = f"{_bronze_dir(spark)}/invoice_charge"
    files.write_landing_csv(_star(spark, sf_dir).table("invoice_charge"), path)
    return _portable(files.read_landing_csv(spark, path, "invoice_charge"))


def q_landing_csv_empty(spark, sf_dir):
    """The interactions, landed with empty outcomes where no service is named, and read back with empty fields kept.
    The landing format has whole seconds."""
    path = f"{_bronze_dir(spark)}/customer_interaction"
    rows = _star(spark, sf_dir).table("customer_interaction")
    rows = rows.withColumn("outcome", F.when(F.col("service_id").isNull(), "").otherwise(F.col("outcome")))
    files.write_landing_csv(rows, path, quote_empty=False)
    return _portable(files.read_landing_csv(spark, path, "customer_interaction", keep_empty=True))


def q_freshness(spark, sf_dir):
    return quality.freshness(_star(spark, sf_dir).tables(), contracts.LOADED_AT_FIELDS, EVENT_AS_OF,
                             contracts.SILVER_FRESHNESS_HOURS)


BOUND_RULES = [quality.Rule("score_at_most_100", "accuracy", "support_health_score", 100, "<=", "warn"),
               quality.Rule("score_under_50", "accuracy", "support_health_score", 50, "<", "warn"),
               quality.Rule("score_over_0", "accuracy", "support_health_score", 0, ">", "warn")]


def q_dq_bounds(spark, sf_dir):
    """Accuracy rules from above and below."""
    return quality.evaluate_rules(_silver(spark, sf_dir).subscriber360_core, BOUND_RULES, "mart_subscriber360_core")


DRIFT_CONTRACT = [("PAYMENT_ID", "STRING", True), ("INVOICE_ID", "STRING", False), ("AMOUNT_CHF", "NUMBER", False),
                  ("CURRENCY", "STRING", False)]


def q_schema_drift(spark, sf_dir):
    """A payment frame that has an added, a removed and a retyped column, against its contract."""
    pay = _star(spark, sf_dir).table("payment").select(
        "payment_id", F.col("invoice_id").cast("bigint").alias("invoice_id"), "amount_chf", "payment_method")
    return quality.check_schema(pay, DRIFT_CONTRACT, target="payment")


def q_data_metrics(spark, sf_dir):
    return metrics.data_metrics(_star(spark, sf_dir).tables())


def q_column_catalog(spark, sf_dir):
    return catalog.column_catalog(_star(spark, sf_dir).tables())


def q_column_profile(spark, sf_dir):
    return catalog.column_profile(_star(spark, sf_dir).tables())


def q_classify_columns(spark, sf_dir):
    return catalog.classify_columns(_star(spark, sf_dir).tables())


# ---- metric layer, gold, masking ----------------------------------------------
def q_metric_active_recurring_revenue(spark, sf_dir):
    core = _silver(spark, sf_dir).subscriber360_core
    return _portable(semantic.metric_query(
        semantic.CORE_MODEL, core, ["active_recurring_revenue", "avg_support_health_score", "data_mb_30d"],
        ["BILLING_STATUS"], grain="day", round_digits=2))


def q_metric_support_health_by_band(spark, sf_dir):
    sc = _silver(spark, sf_dir).health_scorecard
    return _portable(semantic.metric_query(
        semantic.SCORECARD_MODEL, sc, ["average_support_health", "open_ticket_pressure", "interaction_count_30d"],
        ["SUPPORT_RISK_BAND"], round_digits=2))


def _customer_360(spark, sf_dir):
    tables = _star(spark, sf_dir).tables()
    # each silver product's health satellite feeds its core and its scorecard:
    # it is written once (shared folder) instead of built twice
    b1 = build_silver(tables, EVENT_AS_OF, BILLING_AS_OF, materialize=True)
    b2 = build_silver(tables, EVENT_AS_OF, BILLING_AS_OF, SHORT, materialize=True)
    return customer_360([b1, b2])


def q_customer_360(spark, sf_dir):
    return _portable(_customer_360(spark, sf_dir))


def q_customer_360_rules(spark, sf_dir):
    """Gold contract rules over the customer 360 (one aggregate, one row per rule)."""
    gold = _customer_360(spark, sf_dir)
    return quality.evaluate_rules(gold, contracts.CUSTOMER_360_RULES, "customer_360")


def q_metric_customer_360(spark, sf_dir):
    gold = _customer_360(spark, sf_dir)
    return _portable(semantic.metric_query(
        semantic.CUSTOMER_360_MODEL, gold, ["subscription_count", "total_revenue_30d", "avg_health_score"],
        grain="day", round_digits=2))


# fixed value: namespace of the deterministic party ids
PARTY_NAMESPACE = "6f65ba7c-c968-42b1-987a-5f4637b2f181"


def q_party_uuid(spark, sf_dir):
    party = _star(spark, sf_dir).table("party")
    return party.select("party_id", stable_uuid(PARTY_NAMESPACE, F.concat(F.lit("party:"), "party_id"))
                        .alias("party_uuid"))


def q_table_fingerprints_portable(spark, sf_dir):
    """Content fingerprint (rows, sums of both halves of the rows' md5) per landing table."""
    star = _star(spark, sf_dir)
    return quality.union_all([fingerprints.fingerprint(df, portable=True).select(F.lit(t).alias("table_name"), "rows", "fingerprint")
                              for t, df in star.tables().items()])


def q_bronze_statistics(spark, sf_dir):
    """Rows, NULLs, minima and maxima of every column of the written bronze tables, from their footers."""
    tables, bronze = _star(spark, sf_dir).tables(), _bronze_dir(spark)
    files.ingest(tables, bronze)
    paths = generations.current(spark, bronze)
    return quality.union_all([footers.column_statistics(spark, paths[t], SCHEMAS[t], t) for t in tables])


def q_bronze_reload(spark, sf_dir):
    """The charges after a second load that fails at its third table, and one that replaces the invoices alone."""
    star, bronze = _star(spark, sf_dir), _bronze_dir(spark)
    files.ingest({t: star.table(t) for t in ("invoice", "invoice_charge", "account")}, bronze)
    drifted = star.table("account").withColumn("more", F.lit(1))
    try:
        files.ingest({"invoice": star.table("invoice").limit(0), "invoice_charge": star.table("invoice_charge").limit(0), "account": drifted}, bronze)
    except files.SchemaDriftError:
        pass
    files.ingest({"invoice": star.table("invoice").withColumn("status", F.lit("reloaded"))}, bronze)
    now = files.read_bronze(spark, bronze, ("invoice", "invoice_charge"))
    return _portable(now["invoice_charge"].groupBy("invoice_id").agg(F.count(F.lit(1)).alias("charges"), F.sum("amount_chf").alias("amount_chf"))
                     .join(now["invoice"].select("invoice_id", "status"), "invoice_id", "right"))


def q_published_accounts(spark, sf_dir):
    """Accounts published, amended by a column, rebuilt and then replaced by another schema; read back from the catalogue."""
    name = f"accounts_{uuid.uuid4().hex}"
    account = _star(spark, sf_dir).table("account")
    publish.publish(account, name, "amend-and-build")
    publish.publish(account.withColumn("tier", F.upper("account_type")), name, "amend-and-build")
    publish.publish(spark.table(name).withColumn("status", F.concat("status", F.lit("!"))), name, "amend-and-build")
    publish.publish(spark.table(name).select("account_id", "tier", "status"), name, "replace-and-build", allow_data_loss=True)
    return spark.table(name)


ACCOUNT_COMMENTS = {"account_id": "Key of the account", "account_number": "Number on the bill", "status": "State of the account"}
ACCOUNT_TAGS = {"account_number": "pii", "account_id": "internal"}


def q_catalogue_drift(spark, sf_dir):
    """Accounts published with comments, tags and a layout, drifted by hand and rebuilt: the catalogue against the contract."""
    name = publish.target_name("account", "default", None, f"account_{uuid.uuid4().hex}")
    account = _star(spark, sf_dir).table("account")
    ported = publish.with_comments(catalog.tag_columns(account, ACCOUNT_TAGS), ACCOUNT_COMMENTS)
    publish.publish(ported, name, "amend-and-build", partition_by="account_type")
    publish.comment_table(spark, name, "Accounts of the customer's party")
    contract = readback.TableContract(ported.schema, "Accounts of the customer's party", partitions=("account_type",))
    readback.assert_as_declared(readback.catalogue_drift(spark, name, contract))
    publish.comment_table(spark, name, columns={"status": "Changed by hand"})
    publish.publish(account.withColumn("tier", F.upper("account_type")), name, "amend-and-build", partition_by="account_type")
    return readback.catalogue_drift(spark, name, contract).join(readback.filled(spark.table(name)), "object", "left")


def q_landing_manifest(spark, sf_dir):
    """Invoices and charges landed as CSV: two manifests of their files, by plain digests and by ranges, each verified."""
    star, root, tables = _star(spark, sf_dir), _bronze_dir(spark), ["invoice", "invoice_charge"]
    for t in tables:
        files.write_landing_csv(star.table(t), f"{root}/{t}")
    checks = []
    for chunk_bytes in (None, 1 << 20):
        declared = materialize(files.file_manifest(spark, root, tables, chunk_bytes=chunk_bytes))
        found = files.file_manifest(spark, root, tables, chunk_bytes=chunk_bytes, tasks=3)
        checks.append(quality.verify_manifest(declared, found).select("*", F.lit("plain" if chunk_bytes is None else "ranges").alias("digests")))
    return (quality.union_all(checks).groupBy("table_name", "digests")
            .agg(F.sum("actual_rows").alias("rows"), F.bool_and("passed").alias("passed")))


def q_invoice_differences(spark, sf_dir):
    """Invoices against a written copy with rows lost, changed and doubled: where the two differ."""
    invoice = _star(spark, sf_dir).table("invoice")
    ends = lambda x: F.col("invoice_id").endswith(x)
    copy = invoice.where(~ends("77")).withColumn("status", F.when(ends("33"), "changed").otherwise(F.col("status")))
    copy = materialize(copy.unionAll(copy.where(ends("55"))))
    return fingerprints.differences(invoice, copy, ["invoice_id"])


def q_pii_masked_core(spark, sf_dir):
    s = _silver(spark, sf_dir)
    upstream = catalog.tag_columns(s.sat_account_profile, {"account_number": "pii"})
    return _portable(catalog.mask(catalog.propagate_tags(upstream, s.subscriber360_core)))


def _posture_part(fn):
    def run(spark, sf_dir):
        t = _star(spark, sf_dir).tables()
        return _portable(fn(t))
    return run


POSTURE_PARTS = {
    "usage_by_service_30d": _posture_part(
        lambda t: features.usage_30d(t["usage_event"], EVENT_AS_OF, by_account=False)),
    "interactions_by_account_30d": _posture_part(
        lambda t: features.interactions_30d(t["customer_interaction"], EVENT_AS_OF, by_service=False)),
    "open_tickets_all_time": _posture_part(lambda t: features.open_tickets(t["trouble_ticket"])),
    "latest_lifecycle_event": _posture_part(lambda t: features.latest_lifecycle(t["service_lifecycle_event"])),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the subscriber-360 core mart over the sf0.001 star tables."""
    return _silver_attr("subscriber360_core")(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "support_posture": q_support_posture,
        "usage_30d": _silver_attr("usage"),
        "interactions_30d": _silver_attr("interactions"),
        "ticket_status_30d": _silver_attr("tickets"),
        "charges_30d": _silver_attr("charges"),
        "dv_account": _silver_attr("dv_account"),
        "dv_service": _silver_attr("dv_service"),
        "dv_subscription": _silver_attr("dv_subscription"),
        "dv_product_offering": _silver_attr("dv_product_offering"),
        "hub_account": _silver_attr("hub_account"),
        "hub_service": _silver_attr("hub_service"),
        "hub_subscription": _silver_attr("hub_subscription"),
        "hub_product_offering": _silver_attr("hub_product_offering"),
        "link_account_service": _silver_attr("link_account_service"),
        "link_service_subscription": _silver_attr("link_service_subscription"),
        "sat_account_profile": _silver_attr("sat_account_profile"),
        "sat_service_support_health": _silver_attr("sat_service_support_health"),
        "sat_service_support_health_short": _silver_attr("sat_service_support_health", SHORT),
        "sat_service_support_health_merged": q_sat_health_merged,
        "mart_subscriber360_core": _silver_attr("subscriber360_core"),
        "mart_health_scorecard": _silver_attr("health_scorecard"),
    }
    for t in STAGING_COLUMNS:
        out[f"stg_{t}"] = _stage(t)
    out.update({
        "test_unique": q_test_unique, "test_not_null": q_test_not_null,
        "test_relationships": q_test_relationships, "test_accepted_values": q_test_accepted_values,
        "test_mart_not_null": q_test_mart_not_null, "dq_rules": q_dq_rules, "schema_check": q_schema_check,
        "row_reconciliation": q_row_reconciliation, "freshness": q_freshness, "data_metrics": q_data_metrics,
        "column_catalog": q_column_catalog, "classify_columns": q_classify_columns,
        "column_profile": q_column_profile,
        "metric_active_recurring_revenue": q_metric_active_recurring_revenue,
        "metric_support_health_by_band": q_metric_support_health_by_band,
        "customer_360": q_customer_360, "pii_masked_core": q_pii_masked_core,
        "metric_customer_360": q_metric_customer_360, "party_uuid": q_party_uuid,
        "customer_360_rules": q_customer_360_rules,
        "dq_bounds": q_dq_bounds, "schema_drift": q_schema_drift,
        "landing_csv": q_landing_csv, "landing_csv_empty": q_landing_csv_empty, "bronze_load_report": q_bronze_load_report,
        "table_fingerprints_portable": q_table_fingerprints_portable,
        "bronze_statistics": q_bronze_statistics, "bronze_reload": q_bronze_reload,
        "test_sources": q_test_sources, "usage_5d": q_usage_5d, "metrics_across_models": q_metrics_across_models,
        "published_accounts": q_published_accounts, "invoice_differences": q_invoice_differences,
        "catalogue_drift": q_catalogue_drift, "landing_manifest": q_landing_manifest,
    })
    out.update(POSTURE_PARTS)
    out.update(LLM_QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    from oracle_queries import oracle_sql as _oracle
    return _oracle() | LLM_SQL
