"""Staging models, drift on catalog tables, metric overrides, smoke table, views."""

import datetime as dt

import pytest

from telvault.operators import metrics, quality
from telvault.operators.metrics import MetricSpec
from telvault.operators.staging import STAGING_COLUMNS, stage
from telvault.plans import contracts
from telvault.schemas import SCHEMAS
from telvault.sinks import publish as P


@pytest.mark.parametrize("table", sorted(STAGING_COLUMNS))
def test_staging_models_select_in_model_order(spark, table):
    df = spark.createDataFrame([], SCHEMAS[table])
    out = stage(df, table)
    assert out.columns == STAGING_COLUMNS[table]
    assert all(out.schema[c].dataType == SCHEMAS[table][c].dataType for c in out.columns)


def test_stage_rejects_missing_column(spark):
    df = spark.createDataFrame([], SCHEMAS["party"]).drop("status")
    with pytest.raises(ValueError):
        stage(df, "party")


def test_drift_against_catalog_table(spark):
    name = "default.drift_core"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([("a1", "s1")], "account_id string, service_id string").write.saveAsTable(name)
    contract = [("ACCOUNT_ID", "STRING", True), ("SERVICE_ID", "STRING", True), ("SNAPSHOT_AT", "TIMESTAMP", True)]
    got = {r.column_name: r.status for r in quality.check_table_drift(spark, name, contract).collect()}
    assert got == {"ACCOUNT_ID": "ok", "SERVICE_ID": "ok", "SNAPSHOT_AT": "removed"}


def test_metric_config_overrides_defaults(spark):
    df = spark.createDataFrame([("i1",), ("i2",)], "invoice_id string")
    cfg = {"invoice": [MetricSpec("ROW_COUNT", None, "invoice_volume", "VALUE >= 3")]}
    rows = metrics.data_metrics({"invoice": df}, cfg).collect()
    assert [(r.metric, r.value, r.expectation, r.passed) for r in rows] == [("ROW_COUNT", 2, "invoice_volume", False)]


def test_smoke_table_not_null_schema(spark):
    t = P.smoke_table(spark, "default.smoke_t", "hello", "A1", dt.datetime(2026, 1, 15, 12))
    assert t.count() == 1
    rep = {r.column_name: r.status for r in quality.check_schema(t, contracts.SMOKE_SCHEMA).collect()}
    assert set(rep.values()) == {"ok"}


def test_register_views(spark):
    names = P.register_views({"party": spark.createDataFrame([], SCHEMAS["party"])}, prefix="v_")
    assert names == ["v_party"] and spark.sql("SELECT count(*) AS n FROM v_party").first().n == 0


def test_gold_rules_on_empty_frame_are_vacuous(spark):
    df = spark.createDataFrame([], "account_id string, subscription_count bigint, avg_health_score double")
    rep = {r.rule_id: r.passed for r in quality.evaluate_rules(df, contracts.CUSTOMER_360_RULES, "c360").collect()}
    assert rep["account_id_not_null"] is True and rep["subscription_count_non_negative"] is True


def test_reconcile_raises_and_manifest_verification(spark, tmp_path):
    from telvault.sources import files
    df = spark.createDataFrame([("p1", "i", "a", None, None)], SCHEMAS["party"])
    rep = quality.reconcile_counts({"party": df}, {"party": df.union(df)})
    with pytest.raises(quality.ReconciliationError):
        quality.assert_reconciled(rep)
    files.write_landing_csv(df, str(tmp_path / "party"))
    actual = files.file_manifest(spark, str(tmp_path), ["party"])
    declared = actual.withColumn("rows", actual.rows + 1)
    n_files = actual.count()
    got = [r.status for r in quality.verify_manifest(declared, actual).collect()]
    assert got == ["rows_differ"] * n_files
    assert [r.status for r in quality.verify_manifest(actual, actual).collect()] == ["ok"] * n_files
    missing = quality.verify_manifest(actual, actual.limit(0)).select("status").distinct().collect()
    assert [r.status for r in missing] == ["missing"]


def test_auto_tag_and_comments_persist(spark):
    from telvault.operators import catalog
    df = spark.createDataFrame([("a@b.ch", "x")], "email string, note string")
    cls = catalog.classify_columns({"individual": df})
    tagged = catalog.auto_tag(df, cls, "individual")
    assert tagged.schema["email"].metadata == {"value_class": "email"} and tagged.schema["note"].metadata == {}
    name = "default.commented"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    P.with_comments(df, {"email": "contact address"}).write.saveAsTable(name)
    desc = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert desc["email"] == "contact address"
