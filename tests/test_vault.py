"""Vault, feature and mart operators on hand-made frames, against brute force."""

import datetime as dt
from decimal import Decimal
from collections import Counter

from pyspark.sql import functions as F

from telvault.operators import features, marts
from telvault.operators.joins import wildcard_left_join
from telvault.operators.staging import dv_stage
from telvault.plans.silver import build_silver, support_posture
from telvault.schemas import SCHEMAS

AS_OF = dt.datetime(2026, 1, 15, 12)
T0 = dt.datetime(2026, 1, 10)


def frame(spark, table, rows):
    """Rows as dicts -> frame with the landing schema (missing columns NULL)."""
    names = SCHEMAS[table].fieldNames()
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], SCHEMAS[table])


def empty(spark, table):
    return spark.createDataFrame([], SCHEMAS[table])


def inputs(spark, **tables):
    base = {t: empty(spark, t) for t in ("account", "service", "subscription", "product_offering", "usage_event",
                                         "customer_interaction", "trouble_ticket", "invoice", "invoice_charge",
                                         "service_lifecycle_event")}
    base.update({k: frame(spark, k, v) for k, v in tables.items()})
    return base


def test_wildcard_null_service(spark):
    svc = spark.createDataFrame([("s1", "a1"), ("s2", "a1"), ("s3", "a2")], "service_id string, account_id string")
    inter = spark.createDataFrame([("a1", "s1", 3), ("a1", None, 2)], "account_id string, service_id string, n int")
    got = Counter((r.service_id, r.n) for r in wildcard_left_join(svc, inter, "account_id", "service_id").collect())
    assert got == Counter({("s1", 2): 1, ("s1", 3): 1, ("s2", 2): 1, ("s3", None): 1})


def test_wildcard_matches_theta_join(spark):
    import random
    rnd = random.Random(7)
    svc = [(f"s{i}", f"a{rnd.randrange(5)}") for i in range(40)] + [(None, "a1")]
    right = [(f"a{rnd.randrange(6)}", rnd.choice([None, "", f"s{rnd.randrange(45)}"]), i) for i in range(60)]
    s = spark.createDataFrame(svc, "service_id string, account_id string")
    r = spark.createDataFrame(right, "account_id string, service_id string, n int")
    s.createOrReplaceTempView("ws"), r.createOrReplaceTempView("wr")
    brute = spark.sql("""SELECT s.service_id, s.account_id, r.n FROM ws s LEFT JOIN wr r
                         ON s.account_id = r.account_id
                         AND coalesce(s.service_id, '') = coalesce(r.service_id, s.service_id)""")
    got = wildcard_left_join(s, r, "account_id", "service_id").select("service_id", "account_id", "n")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, brute.collect()))


def test_charges_algebra_matches_literal_join(spark):
    ins = inputs(
        spark,
        service=[dict(service_id=f"s{i}", account_id=f"a{i % 3}") for i in range(7)] + [dict(service_id="s0", account_id="a1")],
        subscription=[dict(subscription_id=f"u{i}", service_id=f"s{i % 5}") for i in range(8)],
        invoice=[dict(invoice_id=f"i{i}", account_id=f"a{i % 4}") for i in range(6)] + [dict(invoice_id="i0", account_id="a2")],
        invoice_charge=[dict(charge_id=f"c{i}", invoice_id=f"i{i % 7}", amount_chf=Decimal(str(i * 1.25)) if i % 9 else None,
                             charge_type="recurring_charge" if i % 2 else "usage_charge",
                             charge_date=dt.date(2026, 1, 1) if i % 4 else dt.date(2025, 11, 1))
                        for i in range(30)],
    )
    for t in ("invoice_charge", "invoice", "service", "subscription"):
        ins[t].createOrReplaceTempView(f"c_{t}")
    brute = spark.sql("""
        SELECT svc.account_id, sub.service_id, round(sum(ic.amount_chf), 2) AS t,
               round(sum(CASE WHEN ic.charge_type = 'recurring_charge' THEN ic.amount_chf ELSE 0 END), 2) AS r
        FROM c_invoice_charge ic JOIN c_invoice inv ON ic.invoice_id = inv.invoice_id
        JOIN c_service svc ON inv.account_id = svc.account_id
        JOIN c_subscription sub ON svc.service_id = sub.service_id
        WHERE ic.charge_date >= date '2025-12-16' GROUP BY svc.account_id, sub.service_id""")
    got = features.charges_30d(ins["invoice_charge"], ins["invoice"], ins["service"], ins["subscription"], AS_OF)
    norm = lambda rows: Counter((a, s, None if t is None else float(t), None if r is None else float(r))
                                for a, s, t, r in rows)
    assert norm(got.select("account_id", "service_id", "total_charges_30d", "monthly_recurring_charge").collect()) \
        == norm(brute.collect())


def test_no_feature_rows_is_watch_100(spark):
    ins = inputs(spark, account=[dict(account_id="a1", party_id="p1", account_number="N1", status="active")],
                 service=[dict(service_id="s1", account_id="a1", status="active")])
    row = build_silver(ins, AS_OF).health_scorecard.first()
    assert row.support_risk_band == "watch" and str(row.support_health_score) == "100.00"


def test_critical_and_fanout(spark):
    ins = inputs(
        spark,
        service=[dict(service_id="s1", account_id="a1", status="active"),
                 dict(service_id="s2", account_id="a1", status="active")],
        trouble_ticket=[dict(ticket_id=f"t{i}", account_id="a1", service_id="s1", status="open", severity="high",
                             opened_at=T0) for i in range(3)],
        customer_interaction=[dict(interaction_id=f"i{i}", account_id="a1", service_id=None if i < 4 else "s1",
                                   interaction_timestamp=T0) for i in range(9)],
    )
    rows = build_silver(ins, AS_OF).sat_service_support_health.collect()
    s1 = sorted((r.interaction_count_30d, r.support_risk_band, str(r.support_health_score))
                for r in rows if r.service_id == "s1")
    assert s1 == [(4, "critical", "44.00"), (5, "critical", "39.00")]   # NULL group + own group
    s2 = [(r.interaction_count_30d, r.open_ticket_count_30d) for r in rows if r.service_id == "s2"]
    assert s2 == [(4, 0)]


def test_posture_outer_join_predicate_and_all_time_tickets(spark):
    old = AS_OF - dt.timedelta(days=90)
    ins = inputs(
        spark,
        service=[dict(service_id="s1", account_id="a1", status="active", service_type="mobile"),
                 dict(service_id="s9", account_id="a1", status="terminated")],
        subscription=[dict(subscription_id="u1", service_id="s1", status="cancelled")],
        trouble_ticket=[dict(ticket_id="t1", account_id="a1", service_id="s1", status="open", opened_at=old)],
    )
    rows = support_posture(ins, AS_OF).collect()
    assert len(rows) == 1 and rows[0].subscription_id is None and rows[0].open_ticket_count == 1
    sc = build_silver(ins, AS_OF).health_scorecard.filter("service_id = 's1'").first()
    assert sc.open_ticket_count_30d == 0


def test_hubs_unique_and_links(spark):
    ins = inputs(spark, account=[dict(account_id="a1"), dict(account_id="a1"), dict(account_id="a2")],
                 service=[dict(service_id="s1", account_id="a1"), dict(service_id="s2", account_id="a2")])
    s = build_silver(ins, AS_OF)
    assert s.hub_account.count() == 2
    assert s.link_account_service.count() == 2
    assert s.hub_account.groupBy("hk_account").count().filter("count > 1").count() == 0


def test_dv_stage_hash_through_alias(spark):
    df = frame(spark, "service", [dict(service_id="s1", account_id="a1", service_type="m", status="active")])
    r = dv_stage(df, "service", AS_OF).first()
    expect = spark.range(1).select(F.md5(F.lit("a1||m||active||||")).alias("h")).first().h
    assert r.hd_service_status == expect and r.service_status == "active"


def test_customer_360_priority_and_counts(spark):
    ins = inputs(
        spark,
        account=[dict(account_id="a1", party_id="a1", account_number="N1", status="active")],
        service=[dict(service_id="s1", account_id="a1", status="active"),
                 dict(service_id="s2", account_id="a1", status="suspended")],
        subscription=[dict(subscription_id="u1", service_id="s1"), dict(subscription_id="u2", service_id="s2")],
    )
    b1, b2 = build_silver(ins, AS_OF), build_silver(ins, AS_OF)
    r = marts.customer_360([b1.subscriber360_core, b2.subscriber360_core],
                           [b1.health_scorecard, b2.health_scorecard]).collect()
    assert len(r) == 1
    assert (r[0].subscription_count, r[0].active_service_count, r[0].high_risk_flag) == (2, 1, False)


def test_customer_360_computes_each_part_once(spark, tmp_path):
    """The composed core is ranked once, charges alike are written once, and no satellite's hash is written for a mart."""
    from telvault.plans.silver import Windows, prepare

    ins = inputs(
        spark,
        account=[dict(account_id=a, party_id=a, account_number="N", status="active") for a in ("a1", "a2")],
        service=[dict(service_id=s, account_id="a1", status=x) for s, x in (("s1", "active"), ("s2", "active"), ("s3", None), (None, "active"))],
        subscription=[dict(subscription_id=u, service_id=s) for u, s in (("u1", "s1"), ("u2", "s1"), ("u2", "s2"), ("u3", "s3"))],
    )
    both = prepare([build_silver(ins, AS_OF, materialize=True),
                    build_silver(ins, AS_OF, windows=Windows(interactions=3, tickets=10), materialize=True)])
    assert both[0].charges is both[1].charges and "hashdiff" not in both[0].mart_health.columns
    assert set(both[0].mart_health.columns) == set(marts.HEALTH_COLUMNS)
    cores = [p.subscriber360_core.where("account_number <> 'core_marker'") for p in both]
    df = marts.customer_360(cores, [p.health_scorecard for p in both])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("core_marker") == len(cores)
    r = df.collect()
    # s1 has two subscriptions and counts once; u2 is held by two services and counts once; no service is null
    assert [(x.account_id, x.subscription_count, x.active_service_count) for x in r] == [("a1", 3, 2)]


def test_satellite_forms_its_hash_key_after_the_joins(spark):
    ins = inputs(spark, service=[dict(service_id="s1", account_id="a1", status="active"), dict(service_id=None, account_id="a1")])
    sat = build_silver(ins, AS_OF).sat_service_support_health
    plan = sat._jdf.queryExecution().optimizedPlan().toString()
    assert sum("hk_service" in line for line in plan.splitlines()) == 1
    md5 = {s: spark.range(1).select(F.md5(F.lit(s or ""))).first()[0] for s in ("s1", None)}
    assert {r.service_id: r.hk_service for r in sat.collect()} == md5


def test_wildcard_hot_group(spark):
    """One account with most services: every service gets the NULL-group row once."""
    svc = spark.createDataFrame([(f"s{i}", "hot" if i < 300 else f"a{i}") for i in range(320)],
                                "service_id string, account_id string")
    right = spark.createDataFrame([("hot", None, 7), ("hot", "s5", 1), ("a301", None, 2)],
                                  "account_id string, service_id string, n int")
    from telvault.operators.joins import wildcard_matches
    m = wildcard_matches(right, svc, "account_id", "service_id")
    got = Counter((r["account_id"], r["__wkey"], r["n"]) for r in m.collect())
    assert sum(1 for k in got if k[2] == 7) == 300 and got[("hot", "s5", 1)] == 1
    assert got[("a301", "s301", 2)] == 1 and sum(got.values()) == 302


def test_merge_null_groups_one_row_per_service(spark):
    ins = inputs(
        spark,
        service=[dict(service_id="s1", account_id="a1", status="active"),
                 dict(service_id="s2", account_id="a1", status="active")],
        trouble_ticket=[dict(ticket_id=f"t{i}", account_id="a1", service_id=None if i == 0 else "s1",
                             status="open", severity=("critical", "high", "low")[i], opened_at=T0)
                        for i in range(3)],
        customer_interaction=[dict(interaction_id=f"i{i}", account_id="a1", service_id=None if i < 4 else "s1",
                                   interaction_timestamp=T0) for i in range(9)],
    )
    rows = {r.service_id: r for r in build_silver(ins, AS_OF, merge_null_groups=True)
            .sat_service_support_health.collect()}
    assert len(rows) == 2
    s1, s2 = rows["s1"], rows["s2"]
    assert (s1.interaction_count_30d, s1.open_ticket_count_30d, str(s1.ticket_severity_index)) == (9, 3, "2.666667")
    assert (s1.support_risk_band, str(s1.support_health_score)) == ("critical", "39.00")
    assert (s2.interaction_count_30d, s2.open_ticket_count_30d, str(s2.ticket_severity_index)) == (4, 1, "4.000000")
