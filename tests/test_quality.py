"""Data tests, rules, schema checks and metrics: one failing row per planted defect."""

import datetime as dt

from telvault.operators import metrics, quality
from telvault.operators.quality import Rule
from telvault.schemas import RISK_BANDS


def test_column_tests_and_relationships(spark):
    acc = spark.createDataFrame([("a1", "p1"), ("a1", "p2"), (None, "p3"), ("a4", None)],
                                "account_id string, party_id string")
    party = spark.createDataFrame([("p1",), ("p2",)], "party_id string")
    rep = {(r.column_name, r.test): r.failures for r in
           quality.column_tests(acc, "account", [("account_id", ("unique", "not_null")),
                                                 ("party_id", ("not_null",))]).collect()}
    assert rep == {("account_id", "unique"): 1, ("account_id", "not_null"): 1, ("party_id", "not_null"): 1}
    rel = quality.test_relationships(acc, "party_id", party, "party_id", "account").first()
    assert rel.failures == 1 and not rel.passed   # p3 is an orphan; NULL child is not


def test_accepted_values(spark):
    df = spark.createDataFrame([("healthy",), ("bogus",), ("bogus",), (None,)], "support_risk_band string")
    r = quality.test_accepted_values(df, "support_risk_band", RISK_BANDS, "m").first()
    assert r.failures == 1


def test_rules_and_assert(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -2.0), (None, 3.0)], "k string, v double")
    rules = [Rule("k_complete", "completeness", "k", 1.0), Rule("k_unique", "uniqueness", "k", 1.0),
             Rule("v_pos", "accuracy", "v", 0, ">=", "warn")]
    rep = {r.rule_id: (round(r.value, 4), r.passed) for r in quality.evaluate_rules(df, rules, "t").collect()}
    assert rep == {"k_complete": (0.6667, False), "k_unique": (0.5, False), "v_pos": (-2.0, False)}
    try:
        quality.assert_quality(quality.evaluate_rules(df, rules, "t"))
        raise AssertionError("expected failure")
    except quality.QualityError as e:
        assert "k_complete" in str(e) and "v_pos" not in str(e)


def test_strict_schema_three_drifts(spark):
    df = spark.createDataFrame([("x", 1, 2)], "a string, b int, extra int")
    contract = [("A", "STRING", True), ("B", "STRING", True), ("C", "DATE", False)]
    got = {r.column_name: r.status for r in quality.check_schema(df, contract).collect()}
    assert got == {"A": "ok", "B": "retyped", "C": "removed", "extra": "added"}


def test_freshness_and_reconcile(spark):
    t = spark.createDataFrame([(dt.datetime(2026, 1, 15, 8),)], "ts timestamp_ntz")
    r = quality.freshness({"x": t}, {"x": "ts"}, dt.datetime(2026, 1, 15, 12), 6).first()
    assert r.lag_hours == 4.0 and r.passed
    rec = quality.reconcile_counts({"x": t}, {"x": t.union(t)}).first()
    assert (rec.source_rows, rec.target_rows, rec.matched) == (1, 2, False)


def test_data_metrics_defaults(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,)], "party_id string")
    rep = {r.metric: (r.value, r.passed) for r in metrics.data_metrics({"party": df}).collect()}
    assert rep == {"ROW_COUNT": (3, True), "NULL_COUNT": (1, False), "DUPLICATE_COUNT": (1, False)}
