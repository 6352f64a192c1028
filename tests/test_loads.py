"""Fingerprints, differences, footer statistics, generations of loads and staged publishing."""

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from telvault.schemas import SCHEMAS
from telvault.sinks import publish as P
from telvault.sources import files, fingerprints, footers, generations


@pytest.mark.parametrize("portable", [False, True])
def test_fingerprint_is_of_a_multiset(spark, portable):
    one = lambda rows, kind="x string, y string": fingerprints.fingerprint(spark.createDataFrame(rows, kind).repartition(3), portable).first()
    rows = [("a", None), ("b", "c"), ("b", "c"), (None, "a")]
    assert one(rows) == one(rows[::-1])
    # repeated rows count, NULL is not empty, and values do not run into each other or change places
    different = [rows, rows[:3], rows + [rows[1]], [("a", ""), *rows[1:]], [("b", None), *rows[1:]], [(None, "a"), *rows[1:]],
                 [("a", None), ("bc", ""), ("b", "c"), (None, "a")], [("1:a", None), *rows[1:]]]
    assert len({one(r) for r in different}) == len(different)
    numbers = lambda values: one([(v,) for v in values], "n bigint")
    assert numbers([1, 1, 5]) != numbers([9, 9, 5]) and numbers([1, 5, 1]) == numbers([5, 1, 1])
    assert numbers([])["rows"] == 0 and numbers([])["fingerprint"] == "0-0"
    assert numbers([1])["fingerprint"] != one([("1",)], "n string")["fingerprint"]


def test_differences_are_those_of_counted_rows(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, "", "x", "ü"]), rng.randint(0, 2)) for k in [*range(400), None, 7, 7]]
    other = [(k, t, n + (rng.random() < 0.03)) for k, t, n in rows if rng.random() > 0.03]
    other += rng.sample(other, 10) + [(1000, None, 1)]
    kind = "id bigint, t string, `a.b` int"
    a, b = spark.createDataFrame(rows, kind), spark.createDataFrame(other, kind)
    got = fingerprints.differences(a, b, ["id"], buckets=8, parts=4).collect()
    left, right = Counter(rows), Counter(other)
    want = Counter((r[0], left[r], right[r]) for r in {*left, *right} if left[r] != right[r])
    assert Counter((r["id"], r["source_rows"], r["target_rows"]) for r in got) == want and len(want) > 20
    assert fingerprints.differences(a, a.orderBy(F.rand(1)), ["id"]).count() == 0
    with pytest.raises(ValueError):
        fingerprints.differences(a, b.withColumn("t", F.col("id")), ["id"])


def test_footers_answer_without_reading_a_column(spark, tmp_path):
    rng = random.Random(5)
    df = spark.createDataFrame([(k, None if k % 3 else k, f"t{k}", None) for k in range(3000)], "a bigint, b int, c string, d date").repartition(5)
    path = str(tmp_path / "t")
    df.write.parquet(path)
    opened = footers.open_table(spark, path, df.schema).agg(F.count(F.lit(1)), F.count("b"), F.min("a"), F.max("a"))
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(b), MIN(a), MAX(a)]" in plan
    assert tuple(opened.first()) == (3000, 1000, 0, 2999)
    got = {r["column_name"]: tuple(r)[2:] for r in footers.column_statistics(spark, path, df.schema, "t").collect()}
    assert got == {"a": (3000, 0, "0", "2999"), "b": (3000, 2000, "0", "2997"), "c": (3000, 0, None, None), "d": (3000, 3000, None, None)}
    df.limit(0).write.parquet(path + "0")
    assert {tuple(r)[2:] for r in footers.column_statistics(spark, path + "0", df.schema, "t").collect()} == {(0, 0, None, None)}
    assert spark.conf.get(footers.V1_SOURCES).count("parquet") == 1 and rng


def _stream(spark, n, tag):
    schema = SCHEMAS["party"]
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in ("party_id", "status")]
    return spark.range(n).select(F.col("id").cast("string").alias("party_id"), F.lit(tag).alias("status"), *cols).select(*schema.fieldNames())


def test_a_load_is_seen_whole_or_not_at_all(spark, tmp_path):
    sink = str(tmp_path / "bronze")
    with pytest.raises(FileNotFoundError):
        files.read_bronze(spark, sink, ["party"])
    three = lambda n, tag: {"party": _stream(spark, n, tag), "account": account(n), "service": service(n)}
    blank = lambda t: spark.createDataFrame([], SCHEMAS[t])
    account = lambda n: blank("account").unionAll(spark.range(n).select(*[F.lit(None).cast(f.dataType) for f in SCHEMAS["account"].fields]))
    service = lambda n: blank("service").unionAll(spark.range(n).select(*[F.lit(None).cast(f.dataType) for f in SCHEMAS["service"].fields]))
    files.ingest(three(5, "one"), sink, load_id="first")
    seen = lambda: {t: df.count() for t, df in files.read_bronze(spark, sink, ["party", "account", "service"]).items()}
    assert seen() == {"party": 5, "account": 5, "service": 5}

    # the third stream fails in the middle of its rows: all three tables stay as they were
    broken = three(9, "two") | {"service": service(9).withColumn("service_type", F.raise_error(F.lit("source lost")).cast("string"))}
    with pytest.raises(Exception, match="source lost"):
        files.ingest(broken, sink, load_id="second")
    assert seen() == {"party": 5, "account": 5, "service": 5}
    # the replay under its id completes it, and a further one changes nothing
    for _ in range(2):
        report = files.ingest(three(9, "two"), sink, load_id="second").collect()
        assert {r["table_name"]: r["rows"] for r in report} == {"party": 9, "account": 9, "service": 9} == seen()
    assert len(generations.commits(spark, sink)) == 2

    # a load of one table leaves the others at their generation; what nothing reads any more can go
    files.ingest({"party": _stream(spark, 2, "three")}, sink, load_id="third")
    assert seen() == {"party": 2, "account": 9, "service": 9}
    assert generations.retire(spark, sink) == ["first"] and seen() == {"party": 2, "account": 9, "service": 9}


def _names(spark, name):
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(name))


@pytest.mark.parametrize("layout", [{}, {"bucket_by": (4, "id")}, {"partition_by": "part"}])
def test_a_failed_replacement_leaves_the_old_rows(spark, layout):
    name = f"staged_{uuid.uuid4().hex}"
    old = spark.range(100).select("id", (F.col("id") % 3).alias("part"), F.lit("old").alias("what"))
    P.full_refresh(old, name, **layout)
    bad = old.withColumn("what", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise("new"))
    for attempt in (lambda: P.full_refresh(bad, name, **layout), lambda: P.publish(bad, name, "amend-and-build", **layout),
                    lambda: P.publish(bad.drop("part").withColumn("part", F.lit(1)), name, "replace-and-build", True, **layout)):
        with pytest.raises(Exception, match="lost"):
            attempt()
        assert _names(spark, name) == [name]
        assert [tuple(r) for r in spark.table(name).groupBy("what").count().collect()] == [("old", 100)]


@pytest.mark.parametrize("layout", [{}, {"bucket_by": (4, "id")}, {"partition_by": "part"}])
def test_replacements_are_read_and_keep_the_layout(spark, layout):
    name = f"staged_{uuid.uuid4().hex}"
    rows = spark.range(60).select("id", F.lit("a").alias("what"), (F.col("id") % 3).alias("part"))
    P.full_refresh(rows, name, **layout)
    before = P._layout(spark, name)
    # a table may be rebuilt from itself
    P.publish(spark.table(name).where("id < 50").withColumn("what", F.lit("b")), name, "amend-and-build")
    assert P._layout(spark, name) == before and _names(spark, name) == [name]
    assert [tuple(r) for r in spark.table(name).groupBy("what").count().collect()] == [("b", 50)]
    P.publish(spark.table(name).select("id", "part", F.lit(1).alias("more")), name, "replace-and-build", allow_data_loss=True, **layout)
    assert sorted(spark.table(name).columns) == ["id", "more", "part"] and spark.table(name).count() == 50
    assert P._layout(spark, name) == before
    spark.sql(f"DROP TABLE {name}")


def test_a_version_with_too_few_rows_is_refused(spark, monkeypatch):
    name = f"staged_{uuid.uuid4().hex}"
    P.full_refresh(spark.range(10), name)
    monkeypatch.setattr(P.footers, "row_count", lambda *a: 9)
    with pytest.raises(P.PublishError):
        P.full_refresh(spark.range(20), name)
    monkeypatch.undo()
    assert spark.table(name).count() == 10 and _names(spark, name) == [name]
