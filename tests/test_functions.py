import uuid

from pyspark.sql import functions as F

from telvault.functions import dv_hash, health_score, risk_band, stable_uuid, trailing_window

NS = "6f65ba7c-c968-42b1-987a-5f4637b2f181"


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_dv_hash_keeps_null_positions(spark):
    assert one(spark, dv_hash(F.lit("a"), F.lit(None))) == "0ae6123d3c5880f7dcd032e2411f563b"


def test_dv_hash_stable_across_types(spark):
    a = one(spark, dv_hash(F.lit(1.5).cast("decimal(12,4)"), F.lit("x")))
    b = one(spark, dv_hash(F.lit("1.5000"), F.lit("x")))
    assert a == b


def test_stable_uuid_matches_uuid5(spark):
    df = spark.createDataFrame([(f"party:{i}",) for i in range(50)], "n string")
    got = {r.n: r.u for r in df.select("n", stable_uuid(NS, "n").alias("u")).collect()}
    assert got["party:1"] == "54452bda-7a46-568f-aa78-397aa08e09b7"
    for n, u in got.items():
        assert u == str(uuid.uuid5(uuid.UUID(NS), n))


def test_health_score_cases(spark):
    # critical wins: 100 - 36 - 25 = 39; charge cap +15; half-up tie 12.28/8 = 1.535 -> 101.54
    assert str(one(spark, health_score(F.lit(3), F.lit(9), F.lit(0)))) == "39.00"
    assert str(one(spark, health_score(F.lit(0), F.lit(0), F.lit(200)))) == "115.00"
    assert str(one(spark, health_score(F.lit(0), F.lit(0), F.lit(12.28)))) == "101.54"


def test_risk_band_order(spark):
    assert one(spark, risk_band(F.lit(3), F.lit(9), F.lit(0), F.lit("active"))) == "critical"
    assert one(spark, risk_band(F.lit(0), F.lit(5), F.lit(0), F.lit("active"))) == "high"
    assert one(spark, risk_band(F.lit(0), F.lit(0), F.lit(0), F.lit("active"))) == "watch"
    assert one(spark, risk_band(F.lit(0), F.lit(0), F.lit(0), F.lit("suspended"))) == "healthy"


def test_window_edge_included_and_no_upper_bound(spark):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, trailing_window(ts("2024-01-01 00:00:00"), "2024-01-31", 30)) is True
    assert one(spark, trailing_window(ts("2023-12-31 23:59:59"), "2024-01-31", 30)) is False
    assert one(spark, trailing_window(ts("2024-02-15 00:00:00"), "2024-01-31", 30)) is True


def test_checkpoint_dir_is_stable(spark):
    from telvault.session import checkpoint_dir
    a = checkpoint_dir(spark)
    assert checkpoint_dir(spark) == a == spark.conf.get("spark.checkpoint.dir")
