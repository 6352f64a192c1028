"""More source/sink coverage: empty CSV fields, typed table DDL, CTAS, ports, star views, stream batches."""

import datetime as dt

import pytest

from telvault.plans.silver import REQUIRED_INPUTS, require_ports
from telvault.schemas import SCHEMAS
from telvault.sinks import publish as P
from telvault.sources import files
from telvault.sources.star import StarSource

SF = "/root/testdata/sf0.001"


def test_unquoted_empty_field_is_null(spark, tmp_path):
    p = tmp_path / "party"
    p.mkdir()
    (p / "a.csv").write_text('party_id,party_type,status,created_at,updated_at\n'
                             'p1,,"active",2026-01-01 08:00:00,\\N\n')
    r = files.read_landing_csv(spark, str(p), "party").first()
    assert r.party_type is None and r.updated_at is None and r.created_at == dt.datetime(2026, 1, 1, 8)


def test_create_typed_table_and_ctas(spark):
    spark.sql("DROP TABLE IF EXISTS default.typed_invoice")
    P.create_typed_table(spark, "default.typed_invoice", "invoice")
    t = spark.table("default.typed_invoice")
    assert t.schema.simpleString() == SCHEMAS["invoice"].simpleString() and t.count() == 0
    P.create_typed_table(spark, "default.typed_invoice", "invoice")          # idempotent
    spark.sql("DROP TABLE IF EXISTS default.ctas_t")
    out = P.create_or_replace_as_select(spark.range(3).selectExpr("id AS n"), "default.ctas_t")
    out2 = P.create_or_replace_as_select(spark.range(5).selectExpr("id AS n", "id * 2 AS m"), "default.ctas_t")
    assert out2.count() == 5 and out2.columns == ["n", "m"]


def test_missing_input_port_raises(spark):
    with pytest.raises(KeyError):
        require_ports({"account": spark.range(1)}, REQUIRED_INPUTS)


def test_star_views_conform_to_landing_schemas(spark):
    star = StarSource(spark, SF)
    for t in star.TABLES:
        assert star.table(t).schema.simpleString() == SCHEMAS[t].simpleString(), t
    assert "service" in star.tables() and "party_role" not in star.tables()
    with pytest.raises(KeyError):
        star.table("party_role")


def test_stream_lands_only_new_files(spark, tmp_path):
    from telvault.streaming.landing import land_stream
    src = tmp_path / "in"
    src.mkdir()
    header = "party_id,party_type,status,created_at,updated_at\n"
    (src / "a.csv").write_text(header + "p1,i,active,2026-01-01 08:00:00,\\N\n")
    land_stream(spark, str(src), "party", str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    (src / "b.csv").write_text(header + "p2,i,active,2026-01-02 08:00:00,\\N\np3,o,closed,2026-01-03 08:00:00,\\N\n")
    land_stream(spark, str(src), "party", str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    ids = sorted(r.party_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert ids == ["p1", "p2", "p3"]


def test_acquire_products_then_build_from_bronze(spark, tmp_path):
    from telvault.plans.silver import build_silver
    from telvault.sources.star import BILLING_AS_OF, EVENT_AS_OF
    star = StarSource(spark, SF)
    bronze = str(tmp_path / "bronze")
    reports = {p: files.acquire(p, star.table, bronze).collect() for p in files.ACQUISITIONS}
    assert [r.table_name for r in reports["usage"]] == ["usage_event", "customer_interaction", "trouble_ticket"]
    landed = {r.table_name: r.rows for rs in reports.values() for r in rs}
    assert landed["service"] == star.table("service").count()
    tables = files.read_bronze(spark, bronze, landed)
    direct = build_silver(star.tables(), EVENT_AS_OF, BILLING_AS_OF).health_scorecard
    via_bronze = build_silver(tables, EVENT_AS_OF, BILLING_AS_OF).health_scorecard
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, via_bronze.collect()))
