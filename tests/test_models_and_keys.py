"""Key tests in one scan, metrics across models, events by day, and the plans of the reworked queries."""

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from telvault.operators import metrics, quality
from telvault.operators import semantic as S
from telvault.schemas import COLUMN_TESTS, SCHEMAS, SOURCE_TESTS
from telvault.sources import days

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("bits", [64, 4])
def test_repeated_values_are_exact_under_collisions(spark, bits):
    """With 4 bits of hash most values collide, and only true repetitions count."""
    rng = random.Random(2)
    rows = [(k, rng.choice([None, *range(500)]), f"s{rng.randint(0, 90)}" if k % 7 else None, None if k % 10 == 0 else 1.5) for k in range(300)]
    df = spark.createDataFrame(rows, "a bigint, b int, c string, d double").repartition(4)
    got = quality.repeated_values(df, ["a", "b", "c"], ["a", "d", "c"], hash_bits=bits)
    for i, c in enumerate("abc"):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[c] == (sum(values.count(v) > 1 for v in set(values)), sum(r[i] is None for r in rows))
    assert got["d"] == (0, 30)
    assert quality.repeated_values(df.limit(0), ["a"], ["b"]) == {"a": (0, 0), "b": (0, 0)}


def test_one_scan_of_a_table_without_repetitions(spark, monkeypatch):
    df = spark.range(1000).select("id", F.col("id").cast("string").alias("t"))
    written = []
    monkeypatch.setattr(quality, "materialize", lambda d: written.append(d) or d)
    report = quality.column_tests(df, "x", [("id", ("unique", "not_null")), ("t", ("unique",))]).collect()
    assert not written and all(r["passed"] for r in report) and len(report) == 3


def test_source_tests_are_a_list_of_their_own():
    uses = lambda tests, kind: sum(kind in k for _, _, k in tests)
    assert (uses(SOURCE_TESTS, "unique"), uses(SOURCE_TESTS, "not_null")) == (20, 44)
    assert (uses(COLUMN_TESTS, "unique"), uses(COLUMN_TESTS, "not_null")) == (20, 36)
    assert all(c in SCHEMAS[t].fieldNames() for t, c, _ in SOURCE_TESTS)


def test_metrics_of_several_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, "b"), (2, "b")], "k int, v string")
    specs = [metrics.MetricSpec("DUPLICATE_COUNT", "v", "x", "VALUE = 0"), metrics.MetricSpec("NULL_COUNT", "k", "y", "VALUE > 0"),
             metrics.MetricSpec("ROW_COUNT", None, "z", "VALUE = 5"), metrics.MetricSpec("DUPLICATE_COUNT", "k", "w", "VALUE = 2")]
    got = {(r["metric"], r["argument"]): (r["value"], r["passed"]) for r in metrics.data_metrics({"t": df}, {"t": specs}).collect()}
    assert got == {("DUPLICATE_COUNT", "v"): (2, False), ("NULL_COUNT", "k"): (1, True), ("ROW_COUNT", None): (5, True), ("DUPLICATE_COUNT", "k"): (2, True)}
    none = {r["metric"]: r["value"] for r in metrics.data_metrics({"t": df.limit(0)}, {"t": specs[:1] + specs[2:3]}).collect()}
    assert none == {"DUPLICATE_COUNT": 0, "ROW_COUNT": 0}


def model(name, entities, measures=(), dimensions=()):
    return S.SemanticModel(name, tuple(S.Entity(*e) for e in entities), tuple(S.Measure(m, "sum", True) for m in measures),
                           tuple(S.Dimension(d) for d in dimensions))


@pytest.fixture
def shop(spark):
    """Orders of customers of regions: orders > customers > regions, each by an entity."""
    orders = spark.createDataFrame([(1, 10, 5.0), (2, 10, 7.0), (3, 11, 1.0), (4, 12, 9.0), (5, None, 2.0)], "order_id int, customer_id int, amount double")
    customers = spark.createDataFrame([(10, 1, 100.0), (11, 1, 50.0), (12, 2, 10.0), (13, 3, 4.0)], "customer_id int, region_id int, credit double")
    regions = spark.createDataFrame([(1, "north"), (2, "south")], "region_id int, region string")
    return {"orders": (model("o", [("order_id", "primary"), ("customer_id", "foreign")], ["amount"]), orders),
            "customers": (model("c", [("customer_id", "primary"), ("region_id", "foreign")], ["credit"]), customers),
            "regions": (model("r", [("region_id", "primary")], [], ["region"]), regions)}


def test_metrics_of_two_models_do_not_fan_out(shop):
    got = S.metric_query_across(shop, ["amount", "credit"], ["region"])
    # region 3 has no name, and an order has no customer: both are under NULL
    assert {tuple(r) for r in got.collect()} == {("north", 13.0, 150.0), ("south", 9.0, 10.0), (None, 2.0, 4.0)}
    by_customer = {tuple(r) for r in S.metric_query_across(shop, ["credit", "orders.amount"], ["customer_id"]).collect()}
    assert by_customer == {(10, 100.0, 12.0), (11, 50.0, 1.0), (12, 10.0, 9.0), (13, 4.0, None), (None, None, 2.0)}


def test_a_lookup_side_with_repeated_rows_does_not_fan_out(spark, shop):
    m, regions = shop["regions"]
    twice = shop | {"regions": (m, regions.unionAll(regions).unionAll(spark.createDataFrame([(1, "zenith")], regions.schema)))}
    assert {tuple(r) for r in S.metric_query_across(twice, ["credit"], ["region"]).collect()} == {("north", 150.0), ("south", 10.0), (None, 4.0)}


def test_paths_that_are_refused(shop):
    m, orders = shop["orders"]
    both = shop | {"orders": (model("o", [("order_id", "primary"), ("customer_id", "foreign"), ("region_id", "foreign")], ["amount"]), orders.withColumn("region_id", F.lit(2)))}
    assert {tuple(r) for r in S.metric_query_across(both, ["amount"], ["region"]).collect()} == {("south", 24.0)}  # the shortest path is one
    home = model("c", [("customer_id", "primary"), ("region_id", "foreign")], ["credit"], ["region"])
    two = both | {"customers": (home, both["customers"][1].withColumn("region", F.lit("home")))}
    with pytest.raises(S.AmbiguousPathError, match="2 paths"):
        S.metric_query_across(two, ["amount"], ["region"])
    assert S.metric_query_across(two, ["amount"], ["region"], via={"region": "region_id"}).collect()[0][0] == "south"
    with pytest.raises(S.AmbiguousPathError, match="0 paths"):  # customers have many orders: that way rows would multiply
        S.metric_query_across(shop, ["credit"], ["order_id"])
    with pytest.raises(KeyError):
        S.metric_query_across(shop, ["nothing"], ["region"])


def test_a_window_reads_its_own_days_only(spark, tmp_path):
    from telvault.operators.features import usage_30d
    from telvault.sources.star import EVENT_AS_OF
    schema = SCHEMAS["usage_event"]
    rows = spark.range(3000).select(*[
        (F.lit(EVENT_AS_OF).cast("timestamp_ntz") - F.make_dt_interval(F.col("id") % 30, F.lit(1))).alias(f.name) if f.name == "event_timestamp"
        else F.lit("1").cast(f.dataType).alias(f.name) for f in schema.fields])
    path = str(tmp_path / uuid.uuid4().hex)
    days.write_by_day(rows, path, "event_timestamp")
    events = days.read_by_day(spark, path, schema)
    got = usage_30d(events, EVENT_AS_OF, days=5)
    assert got.collect()[0]["usage_events_30d"] == 500 == usage_30d(rows, EVENT_AS_OF, days=5).collect()[0]["usage_events_30d"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_day", plan)
    all_files = len(events.inputFiles())
    metrics_ = got._jdf.queryExecution().executedPlan().toString()
    scan = events.where(F.col(days.DAY) >= F.date_sub(F.lit(EVENT_AS_OF.date()), 5))
    assert scan.select(F.input_file_name()).distinct().count() == 5 and all_files == 30 and metrics_


def test_customer_360_multiplies_no_rows(spark):
    plan = E.queries()["customer_360"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    plan = E.queries()["data_metrics"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
