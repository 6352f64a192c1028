"""Files digested by ranges, and published tables read back from the catalogue."""

import hashlib
import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from telvault.operators import catalog, quality
from telvault.schemas import SCHEMAS
from telvault.sinks import publish as P
from telvault.sinks import readback
from telvault.sources import chunks, files


def _root(data: bytes, size: int) -> str:
    parts = [data[i:i + size] for i in range(0, max(len(data), 1), size)]
    return hashlib.sha256("\n".join(hashlib.sha256(p).hexdigest() for p in parts).encode()).hexdigest()


def test_ranges_of_files(spark, tmp_path):
    rng = random.Random(2)
    contents = {f"f {i}.bin": rng.randbytes(n) for i, n in enumerate((0, 1, 99, 100, 101, 5000))}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    listed = chunks.list_files(spark, str(tmp_path), "bin")
    by_name = lambda df: {r["file"].rsplit("/", 1)[1]: r for r in df.collect()}
    plain = by_name(chunks.file_digests(listed))
    assert {n: r["sha256"] for n, r in plain.items()} == {n: hashlib.sha256(d).hexdigest() for n, d in contents.items()}
    for tasks in (1, 3, 16):
        got = by_name(chunks.file_digests(listed, 100, tasks))
        assert {n: r["sha256"] for n, r in got.items()} == {n: _root(d, 100) for n, d in contents.items()}
        assert {n: (r["bytes"], r["ranges"]) for n, r in got.items()} == {n: (len(d), max(1, -(-len(d) // 100))) for n, d in contents.items()}
    spread = chunks.range_digests(listed.where("bytes = 5000"), 100, 8).select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 4  # one file, many tasks
    with pytest.raises(ValueError):
        chunks.range_digests(listed, 0)


def test_file_over_the_limit_of_a_cell(spark, tmp_path):
    (tmp_path / "big.bin").write_bytes(b"x" * 5000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        with pytest.raises(Exception, match="(?i)length|exceed"):
            spark.read.format("binaryFile").load(str(tmp_path)).select(F.sha2("content", 256)).collect()
        listed = chunks.list_files(spark, str(tmp_path), "bin")
        assert chunks.file_digests(listed, 512).first()["sha256"] == _root(b"x" * 5000, 512)
        assert chunks.file_digests(listed).first()["sha256"] == hashlib.sha256(b"x" * 5000).hexdigest()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_file_that_shrinks_is_an_error(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    listed = chunks.list_files(spark, str(tmp_path), "bin").withColumn("bytes", F.col("bytes") + 1)
    with pytest.raises(Exception, match="shorter"):
        chunks.file_digests(listed).collect()


def test_changed_byte_is_found_by_both_manifests(spark, tmp_path):
    party = spark.createDataFrame([(f"p{i}", "i", "a", None, None) for i in range(50)], SCHEMAS["party"]).coalesce(1)
    files.write_landing_csv(party, str(tmp_path / "party"))
    before = {size: files.file_manifest(spark, str(tmp_path), ["party"], chunk_bytes=size).collect() for size in (None, 64)}
    landed = next(Path(tmp_path / "party").glob("*.csv"))
    landed.write_bytes(landed.read_bytes().replace(b"p49", b"q49"))
    (landed.parent / f".{landed.name}.crc").unlink()
    for size, rows in before.items():
        assert [r["rows"] for r in rows] == [50]
        declared = spark.createDataFrame(rows, "table_name string, file string, bytes bigint, sha256 string, rows bigint, columns string")
        now = files.file_manifest(spark, str(tmp_path), ["party"], chunk_bytes=size)
        assert [r["status"] for r in quality.verify_manifest(declared, now).collect()] == ["hash_differs"]


def _published(spark, **layout):
    name = f"default.t_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "id bigint, number string, kind string")
    df = P.with_comments(catalog.tag_columns(df, {"number": "pii"}), {"id": "it's the key", "number": "back\\slash"})
    P.publish(df, name, "amend-and-build", **layout)
    P.comment_table(spark, name, "The owner's table")
    return name, df


@pytest.mark.parametrize("layout, declared", [({}, {}), ({"partition_by": "kind"}, {"partitions": ("kind",)}), ({"bucket_by": (4, "id")}, {"buckets": (4, "id")})])
def test_catalogue_keeps_what_was_declared(spark, layout, declared):
    name, df = _published(spark, **layout)
    contract = readback.TableContract(df.schema, "The owner's table", **declared)
    assert readback.assert_as_declared(readback.catalogue_drift(spark, name, contract)).count() >= 8
    # rows built anew from a frame without comments and tags, with a column more
    bare = spark.createDataFrame([(3, "b", "x", 1.5)], "id bigint, number string, kind string, more double")
    P.publish(bare, name, "amend-and-build", **layout)
    assert [tuple(r) for r in spark.table(name).select("id", "number", "kind", "more").collect()] == [(3, "b", "x", 1.5)]
    found = {(r["object"], r["property"]): r["status"] for r in readback.catalogue_drift(spark, name, contract).collect()}
    assert found.pop(("more", "type")) == "added" and set(found.values()) == {"ok"}


def test_drift_is_told_by_property(spark):
    name, df = _published(spark)
    P.comment_table(spark, name, "Another", {"id": "other"})
    declared = readback.TableContract(df.withColumn("kind", F.lit(1)).withColumn("lost", F.lit("")).schema, "The owner's table", "orc", ("kind",), location="/x")
    report = readback.catalogue_drift(spark, name, declared)
    got = {(r["object"], r["property"]): r["status"] for r in report.where("not passed").collect()}
    assert got == {("id", "comment"): "changed", ("kind", "type"): "changed", ("lost", "type"): "missing", ("(table)", "comment"): "changed",
                   ("(table)", "provider"): "changed", ("(table)", "partitions"): "missing", ("(table)", "location"): "changed"}
    with pytest.raises(readback.CatalogueDriftError, match="lost.type: missing"):
        readback.assert_as_declared(report)
    assert {r["object"]: r["filled"] for r in readback.filled(spark.table(name)).collect()} == {"(table)": 2, "id": 2, "number": 1, "kind": 2}
