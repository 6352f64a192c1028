"""Landing CSV round trip, ingest gate, manifest, publish modes, streaming landing."""

import datetime as dt
import os

import pytest

from telvault.sinks import publish as P
from telvault.sources import files
from telvault.schemas import SCHEMAS
from telvault.session import checkpoint_dir


def _party(spark):
    rows = [("p1", "individual", "active", dt.datetime(2026, 1, 1, 8), None),
            ("p2", "organization", "closed", dt.datetime(2026, 1, 2, 9, 30), dt.datetime(2026, 1, 3))]
    return spark.createDataFrame(rows, SCHEMAS["party"])


def test_csv_round_trip_with_null_token(spark, tmp_path):
    p = str(tmp_path / "party")
    files.write_landing_csv(_party(spark), p)
    text = "".join(open(os.path.join(p, f)).read() for f in os.listdir(p) if f.endswith(".csv"))
    assert "\\N" in text
    back = files.read_landing_csv(spark, p, "party")
    assert back.schema == SCHEMAS["party"]
    assert sorted(back.collect()) == sorted(_party(spark).collect())


def test_csv_failfast_on_bad_timestamp(spark, tmp_path):
    p = tmp_path / "bad"
    p.mkdir()
    (p / "x.csv").write_text("party_id,party_type,status,created_at,updated_at\np1,i,a,not-a-time,\\N\n")
    with pytest.raises(Exception):
        files.read_landing_csv(spark, str(p), "party").collect()


def _care(folder, *lines):
    folder.mkdir()
    head = ",".join(SCHEMAS["customer_interaction"].names)
    (folder / "x.csv").write_text("\n".join([head, *lines]) + "\n")
    return str(folder)


def test_csv_keeps_empty_fields(spark, tmp_path):
    p = _care(tmp_path / "care", 'i1,a1,\\N,call,,"",2024-01-02 03:04:05', 'i2,a1,"s, 1","say ""hi""","two\tparts",ok,\\N', ",,,,,,\\N")
    got = files.read_landing_csv(spark, p, "customer_interaction", keep_empty=True)
    assert got.schema == SCHEMAS["customer_interaction"]
    assert sorted(tuple(r) for r in got.collect()) == [
        ("", "", "", "", "", "", None), ("i1", "a1", None, "call", "", "", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("i2", "a1", "s, 1", 'say "hi"', "two\tparts", "ok", None)]
    plain = files.read_landing_csv(spark, p, "customer_interaction")
    assert plain.where("channel = 'call' and service_id is null and interaction_type is null and outcome = ''").count() == 1


@pytest.mark.parametrize("line", ["i1,a1,s1,call,x,ok,", 'i1,a1,s1,call,x,ok,""', "i1,a1,s1,call,x,ok,noon"])
def test_csv_with_empty_fields_kept_refuses_what_is_no_timestamp(spark, tmp_path, line):
    p = _care(tmp_path / "care", line)
    with pytest.raises(Exception, match="malformed timestamp_ntz in interaction_timestamp"):
        files.read_landing_csv(spark, p, "customer_interaction", keep_empty=True).collect()


@pytest.mark.parametrize("quote_empty", [True, False])
def test_csv_round_trip_of_empty_texts(spark, tmp_path, quote_empty):
    rows = [("c1", "", None, "", 1, 2, dt.date(2024, 1, 2)), ("c2", "i", "t", None, None, None, None), ("", "", "", "", None, None, None)]
    df = spark.createDataFrame(rows, "charge_id string, invoice_id string, charge_type string, charge_description string, q int, a int, charge_date date")
    df = df.selectExpr("charge_id", "invoice_id", "charge_type", "charge_description", "cast(q as decimal(12,4)) quantity",
                       "cast(a as decimal(10,2)) amount_chf", "charge_date")
    files.write_landing_csv(df, str(tmp_path / "c"), quote_empty=quote_empty)
    back = files.read_landing_csv(spark, str(tmp_path / "c"), "invoice_charge", keep_empty=True)
    assert back.schema == SCHEMAS["invoice_charge"] and back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_cluster_without_a_shared_folder_is_refused():
    class Session:
        def __init__(self, master, **conf):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = {"spark.sql.warehouse.dir": "/wh/"} | conf

    shared = {"spark.checkpoint.dir": "hdfs://x/shared/"}
    assert checkpoint_dir(Session("local[4]")) == checkpoint_dir(Session("local")) == "/wh/_shared"
    assert checkpoint_dir(Session("yarn", **shared)) == "hdfs://x/shared"
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://https://h"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(Session(master))


def test_ingest_report_and_drift_gate(spark, tmp_path):
    rep = files.ingest({"party": _party(spark)}, str(tmp_path / "bronze")).collect()
    assert [(r.table_name, r.rows) for r in rep] == [("party", 2)]
    drifted = _party(spark).withColumnRenamed("status", "state")
    with pytest.raises(files.SchemaDriftError):
        files.ingest({"party": drifted}, str(tmp_path / "bronze2"))


def test_manifest_rows_and_hash(spark, tmp_path):
    files.write_landing_csv(_party(spark), str(tmp_path / "party"))
    m = files.file_manifest(spark, str(tmp_path), ["party"]).collect()
    assert sum(r.rows for r in m) == 2 and all(len(r.sha256) == 64 for r in m)


def test_publish_modes(spark):
    df = _party(spark)
    name = "default.pub_party"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert P.publish(df, name, "dry-run").count() == 5 and not spark.catalog.tableExists(name)
    P.publish(df, name, "create-only")                              # structure only
    assert spark.table(name).count() == 0 and spark.table(name).columns == df.columns
    P.publish(df, name, "amend-and-build")                          # rows rebuilt
    assert spark.table(name).count() == 2
    P.publish(df.withColumn("tier", df.status), name, "amend")       # additive column, rows kept
    assert "tier" in spark.table(name).columns and spark.table(name).count() == 2
    with pytest.raises(P.DataLossError):
        P.publish(df, name, "amend-and-build")                      # frame lacks `tier`: a removal
    P.publish(df.withColumn("tier", df.party_type), name, "amend-and-build")   # rebuild: not appended
    assert spark.table(name).count() == 2 and spark.table(name).filter("tier = party_type").count() == 2
    with pytest.raises(P.DataLossError):
        P.publish(df, name, "replace")
    P.publish(df, name, "replace", allow_data_loss=True)
    assert spark.table(name).count() == 0 and "tier" not in spark.table(name).columns
    P.publish(df, name, "replace-and-build", allow_data_loss=True)
    assert spark.table(name).count() == 2
    P.comment_table(spark, name, "parties", {"party_id": "key"})
    assert P.target_name("mart_core", "DEV", alias="SUBSCRIBER360_CORE_V1") == "DEV.SUBSCRIBER360_CORE_V1"


def test_streaming_landing_available_now(spark, tmp_path):
    from telvault.streaming.landing import land_stream
    src = tmp_path / "in"
    files.write_landing_csv(_party(spark), str(src))
    q = land_stream(spark, str(src), "party", str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    q2 = land_stream(spark, str(src), "party", str(tmp_path / "out"), str(tmp_path / "ck"))
    q2.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2   # rerun lands nothing twice


def test_bucketed_tables_join_without_shuffle(spark):
    a = spark.range(1000).selectExpr("cast(id as string) AS service_id", "id % 7 AS x")
    b = spark.range(1000).selectExpr("cast(id as string) AS service_id", "id % 5 AS y")
    for name, df in (("default.bk_a", a), ("default.bk_b", b)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        P.full_refresh(df, name, bucket_by=(8, "service_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("default.bk_a").join(spark.table("default.bk_b"), "service_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and j.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_materialization(spark, tmp_path):
    df = spark.createDataFrame([("s1", "2026-01-15"), ("s2", "2026-01-16")], "service_id string, snapshot_date string")
    back = P.materialize_table(df, str(tmp_path / "m"), partition_by="snapshot_date")
    parts = sorted(d for d in os.listdir(tmp_path / "m") if d.startswith("snapshot_date="))
    assert parts == ["snapshot_date=2026-01-15", "snapshot_date=2026-01-16"]
    assert back.filter("snapshot_date = '2026-01-16'").count() == 1
