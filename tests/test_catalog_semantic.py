from pyspark.sql import functions as F

from telvault.operators import catalog, semantic


def test_classify_and_catalog(spark):
    df = spark.createDataFrame([("i1", "a@b.ch", "+41791234567", "x"), ("i2", "c@d.com", "+41797654321", None)],
                               "individual_id string, email string, msisdn string, note string")
    got = {r.column_name: r.value_class for r in catalog.classify_columns({"individual": df.drop("individual_id")})
           .collect()}
    assert got == {"email": "email", "msisdn": "phone", "note": "unclassified"}
    cat = {r.column_name: (r.semantic_type, r.sensitivity, r.identifier_role, r.null_count)
           for r in catalog.column_catalog({"individual": df}).collect()}
    assert cat["email"] == ("email_handle", "restricted_contact", "natural_key", 0)
    assert cat["note"][3] == 1 and cat["individual_id"][2] == "primary_key"


def test_propagate_and_mask(spark):
    up = catalog.tag_columns(spark.createDataFrame([("N1",)], "account_number string"), {"account_number": "pii"})
    down = spark.createDataFrame([("N1", 3)], "ACCOUNT_NUMBER string, n int")
    m = catalog.mask(catalog.propagate_tags(up, down)).first()
    assert m.ACCOUNT_NUMBER == spark.range(1).select(F.sha2(F.lit("N1"), 256)).first()[0] and m.n == 3


def test_metric_filter(spark):
    df = spark.createDataFrame([("active", 10.0, 50.0), ("suspended", 5.0, 70.0), ("active", 1.0, 90.0)],
                               "service_status string, monthly_recurring_charge double, support_health_score double")
    df = df.withColumn("billing_status", F.lit("active")).withColumn("snapshot_at", F.lit("2026-01-15").cast("timestamp_ntz"))
    r = semantic.metric_query(semantic.CORE_MODEL, df, ["active_recurring_revenue", "avg_support_health_score"],
                              ["BILLING_STATUS"], grain="day", round_digits=2).first()
    assert float(r.active_recurring_revenue) == 11.0 and float(r.avg_support_health_score) == 70.0


def test_metric_by_entity_and_validation(spark):
    import pytest
    df = spark.createDataFrame([("a1", 3, 1, 50.0, "high"), ("a1", 2, 0, 70.0, "healthy"), ("a2", 0, 4, 90.0, "healthy")],
                               "account_id string, open_ticket_count_30d int, interaction_count_30d int, "
                               "support_health_score double, support_risk_band string")
    df = df.withColumn("service_id", F.lit("s")).withColumn("snapshot_at", F.lit("2026-01-15").cast("timestamp_ntz"))
    rows = {r.account_id: r.open_ticket_pressure for r in semantic.metric_query(
        semantic.SCORECARD_MODEL, df, ["open_ticket_pressure"], ["ACCOUNT_ID"]).collect()}
    assert rows == {"a1": 5, "a2": 0}
    with pytest.raises(KeyError):
        semantic.metric_query(semantic.SCORECARD_MODEL, df.drop("open_ticket_count_30d"), ["open_ticket_pressure"])
    with pytest.raises(KeyError):
        semantic.metric_query(semantic.SCORECARD_MODEL, df, ["open_ticket_pressure"], ["service_status"])
