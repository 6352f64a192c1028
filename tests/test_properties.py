"""Property tests: rewrites equal their literal definitions on generated inputs."""

import hashlib
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telvault.functions import dv_hash, health_score
from telvault.operators.joins import wildcard_left_join

FAST = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

text = st.one_of(st.none(), st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FF), max_size=6))


@FAST
@given(st.lists(st.tuples(text, text, text), min_size=1, max_size=8))
def test_dv_hash_is_md5_of_joined_text(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r.h for r in df.select(dv_hash("a", "b", "c").alias("h")).collect()]
    want = [hashlib.md5("||".join("" if v is None else v for v in r).encode()).hexdigest() for r in rows]
    assert got == want


@FAST
@given(st.lists(st.tuples(st.integers(0, 10), st.integers(0, 12),
                          st.decimals(min_value=0, max_value=400, places=2, allow_nan=False)),
                min_size=1, max_size=10))
def test_health_score_matches_decimal_half_up(spark, rows):
    df = spark.createDataFrame(rows, "o int, i int, m decimal(18,2)")
    got = [r.s for r in df.select(health_score(F.col("o"), F.col("i"), F.col("m")).alias("s")).collect()]
    for (o, i, m), s in zip(rows, got):
        raw = Decimal(100) - min(12 * o, 36) - min(5 * i, 25) + min(Decimal(m) / 8, Decimal(15))
        assert s == raw.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert Decimal("39") <= s <= Decimal("115")


key = st.sampled_from([None, "", "s1", "s2", "s3", "s4"])
grp = st.sampled_from([None, "a1", "a2", "a3"])


@FAST
@given(st.lists(st.tuples(key, grp), max_size=10), st.lists(st.tuples(grp, key, st.integers(0, 99)), max_size=10))
def test_wildcard_join_equals_theta_join(spark, left, right):
    s = spark.createDataFrame(left, "service_id string, account_id string")
    r = spark.createDataFrame(right, "account_id string, service_id string, n int")
    s.createOrReplaceTempView("pl"), r.createOrReplaceTempView("pr")
    brute = spark.sql("""SELECT l.service_id, l.account_id, r.n FROM pl l LEFT JOIN pr r
                         ON l.account_id = r.account_id
                         AND coalesce(l.service_id, '') = coalesce(r.service_id, l.service_id)""")
    got = wildcard_left_join(s, r, "account_id", "service_id").select("service_id", "account_id", "n")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, brute.collect()))


acc = st.sampled_from(["a1", "a2", "a3", None])
svc = st.sampled_from(["s1", "s2", "s3", "s4", None])
inv = st.sampled_from(["i1", "i2", "i3", None])
amount = st.one_of(st.none(), st.decimals(min_value=0, max_value=50, places=2, allow_nan=False))


@FAST
@given(st.lists(st.tuples(svc, acc), max_size=6), st.lists(st.tuples(svc), max_size=6),
       st.lists(st.tuples(inv, acc), max_size=5),
       st.lists(st.tuples(inv, st.sampled_from(["recurring_charge", "usage_charge"]), amount), max_size=10))
def test_charges_algebra_equals_literal_join(spark, services, subs, invoices, charges):
    import datetime as dt
    from telvault.operators.features import charges_30d
    s = spark.createDataFrame(services, "service_id string, account_id string")
    u = spark.createDataFrame(subs, "service_id string")
    i = spark.createDataFrame(invoices, "invoice_id string, account_id string")
    c = spark.createDataFrame([(a, b, m, dt.date(2026, 1, 10)) for a, b, m in charges],
                              "invoice_id string, charge_type string, amount_chf decimal(10,2), charge_date date")
    for n, df in (("ps", s), ("pu", u), ("pi", i), ("pc", c)):
        df.createOrReplaceTempView(n)
    brute = spark.sql("""
        SELECT svc.account_id, sub.service_id, round(sum(ic.amount_chf), 2) AS t,
               round(sum(CASE WHEN ic.charge_type = 'recurring_charge' THEN ic.amount_chf ELSE 0 END), 2) AS r
        FROM pc ic JOIN pi inv ON ic.invoice_id = inv.invoice_id JOIN ps svc ON inv.account_id = svc.account_id
        JOIN pu sub ON svc.service_id = sub.service_id GROUP BY svc.account_id, sub.service_id""")
    got = charges_30d(c, i, s, u, dt.datetime(2026, 1, 15)).select(
        "account_id", "service_id", "total_charges_30d", "monthly_recurring_charge")
    norm = lambda rows: Counter(tuple(None if v is None else str(float(v)) if not isinstance(v, str) else v
                                      for v in r) for r in rows)
    assert norm(got.collect()) == norm(brute.collect())
