"""Product run end to end on the sf0.001 star tables: gate, publish, report."""

import pytest

from telvault.plans import product
from telvault.plans.silver import build_silver
from telvault.sinks.publish import DataLossError
from telvault.sources.star import BILLING_AS_OF, EVENT_AS_OF, StarSource

SF = "/root/testdata/sf0.001"


def test_run_silver_product_publishes_and_reports(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS silver_t")
    for t in ("subscriber360_core_v1", "subscriber_health_scorecard_v1"):
        spark.sql(f"DROP TABLE IF EXISTS silver_t.{t}")
    silver = build_silver(StarSource(spark, SF).tables(), EVENT_AS_OF, BILLING_AS_OF)
    out = product.run_silver_product(silver, "silver_t", "amend-and-build", buckets=4)
    core = out["core"]["table"]
    assert core.count() == silver.subscriber360_core.count() > 0
    rules = {r.rule_id: r.passed for r in out["core"]["rules"].collect()}
    assert set(rules) == {"account_id_not_null", "service_id_unique", "support_risk_band_valid",
                          "recurring_charge_non_negative"}
    assert rules["account_id_not_null"] and rules["support_risk_band_valid"]
    fresh = out["scorecard"]["freshness"].first()
    assert fresh.lag_hours == 0.0 and fresh.passed
    with pytest.raises(DataLossError):
        product.run_silver_product(silver, "silver_t", "replace-and-build")


def test_schema_gate_blocks_drift(spark):
    silver = build_silver(StarSource(spark, SF).tables(), EVENT_AS_OF, BILLING_AS_OF)
    drifted = silver.subscriber360_core.drop("billing_status")
    with pytest.raises(product.ContractViolation):
        product.gate_schema(drifted, product.CORE_EXPOSE)


def test_posture_product_replaces(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_t")
    tables = StarSource(spark, SF).tables()
    n_first = product.run_posture_product(tables, EVENT_AS_OF, "bronze_t")["table"].count()
    with pytest.raises(DataLossError):   # replacing needs consent
        product.run_posture_product(tables, EVENT_AS_OF, "bronze_t")
    b = product.run_posture_product(tables, EVENT_AS_OF, "bronze_t", allow_data_loss=True)   # same rows, not doubled
    assert b["table"].count() == n_first > 0


def test_gold_product_tags_pii_and_reports(spark):
    from telvault.plans.silver import Windows
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_t")
    tables = StarSource(spark, SF).tables()
    b1 = build_silver(tables, EVENT_AS_OF, BILLING_AS_OF)
    b2 = build_silver(tables, EVENT_AS_OF, BILLING_AS_OF, Windows(interactions=3, tickets=10))
    out = product.run_gold_product([b1, b2], "gold_t")
    t = out["table"]
    assert t.schema["account_number"].metadata.get("sensitivity") == "pii"
    assert {r.rule_id for r in out["rules"].collect()} == {"account_id_not_null", "subscription_count_non_negative",
                                                           "avg_health_in_range"}
    assert out["freshness"].first().passed


def test_cli_commands(spark, capsys):
    from telvault.__main__ import main
    assert main(["metrics", "--sf-dir", SF]) == 0
    assert "ROW_COUNT" in capsys.readouterr().out
    rc = main(["test", "--sf-dir", SF])
    out = capsys.readouterr().out
    assert "contract rules" in out and rc in (0, 1)
    assert main(["build", "--sf-dir", SF, "--schema", "cli_t"]) == 0
    assert spark.table("cli_t.customer_360_cdp_v1").count() > 0
