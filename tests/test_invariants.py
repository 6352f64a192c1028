"""Invariants over the star-derived landing tables."""

from pyspark.sql import functions as F

from telvault.plans.silver import build_silver
from telvault.schemas import RISK_BANDS
from telvault.sources.star import BILLING_AS_OF, EVENT_AS_OF, StarSource

SF = "/root/testdata/sf0.001"


def test_silver_invariants(spark):
    s = build_silver(StarSource(spark, SF).tables(), EVENT_AS_OF, BILLING_AS_OF, materialize=True)
    d8 = s.sat_service_support_health
    n = d8.count()
    assert s.health_scorecard.count() == n                      # R2 is a projection of D8
    assert s.subscriber360_core.count() == n                    # at most one subscription per service here
    for hub, hk in ((s.hub_account, "hk_account"), (s.hub_service, "hk_service"),
                    (s.hub_subscription, "hk_subscription"), (s.hub_product_offering, "hk_product_offering")):
        assert hub.groupBy(hk).count().filter("count > 1").count() == 0
    stats = d8.agg(F.min("support_health_score").alias("lo"), F.max("support_health_score").alias("hi"),
                   F.count_if(~F.col("support_risk_band").isin(list(RISK_BANDS))).alias("bad_band"),
                   F.count_distinct("service_id").alias("services")).first()
    assert 39 <= stats.lo and stats.hi <= 115 and stats.bad_band == 0
    assert stats.services == s.dv_service.count()               # every service has a health row
    # the merged variant has exactly one row per service
    m = build_silver(StarSource(spark, SF).tables(), EVENT_AS_OF, BILLING_AS_OF, merge_null_groups=True)
    assert m.sat_service_support_health.count() == stats.services


def test_dv_hash_is_stable_across_runs(spark):
    a = build_silver(StarSource(spark, SF).tables(), EVENT_AS_OF, BILLING_AS_OF).dv_service
    b = build_silver(StarSource(spark, SF).tables(), EVENT_AS_OF, BILLING_AS_OF).dv_service
    cols = ["service_id", "hk_service", "hd_service_status"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
