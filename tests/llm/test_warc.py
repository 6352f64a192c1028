import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from telvault.llm import common, warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://x/{k}", None if k % 11 == 0 else "" if k % 13 == 0 else "same page" if k % 3 == 0 else f"<p>é{k}</p>\r\n\r\nWARC/1.1\r\n" * (k % 5)) for k in range(80)]
    rows += [(5, "http://x/5", "<p>é5</p>"), (3, "http://y", "same page"), (None, "http://n", "no id"), (None, "http://n", "same page"), (900, None, "z" * 3_000_000)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)


def written(spark, pages, **options):
    warc.register(spark)
    path = common.shared_path(spark, "test-archive")
    warc.with_revisits(pages, "page_id", "html", "url").write.format("warc").options(**options).mode("append").save(path)
    return path


@pytest.mark.parametrize("options", [{}, {"split_bytes": "300", "file_bytes": "2000"}])
def test_round_trip(spark, pages, options):
    path = written(spark, pages, **options)
    got = sorted((r["record_id"], r["record_type"], r["refers_to"] or "", r["payload_digest"], r["payload_bytes"], bytes(r["payload"]), r["target_uri"] or "")
                 for r in spark.read.format("warc").load(path).collect())
    top, want = {}, []
    for r in pages.collect():
        data = (r["html"] or "").encode()
        if r["page_id"] is not None:
            top[data] = max(top.get(data, -1), r["page_id"])
    for r in pages.collect():
        data = (r["html"] or "").encode()
        to = top.get(data, r["page_id"])
        again = to != r["page_id"]
        name = f"urn:key:{'null' if r['page_id'] is None else r['page_id']}"
        want.append((name, "revisit" if again else "response", f"urn:key:{to}" if again else "", digest(data), len(data), b"" if again else data, r["url"] or ""))
    assert got == sorted(want)


def test_predicates_are_pushed_and_payloads_skipped(spark, pages):
    path = written(spark, pages)
    df = spark.read.format("warc").schema("record_id string, record_type string").load(path)
    few = df.where("record_type = 'revisit' and record_id like 'urn:key:1%'")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan warc" in plan and "Filter (" not in plan and "+- Filter" not in plan  # both are left to the reader
    assert few.count() == len([r for r in df.collect() if r["record_type"] == "revisit" and r["record_id"].startswith("urn:key:1")]) > 0
    reader = warc.WarcReader(df.schema, {"path": path})
    from pyspark.sql.datasource import EqualTo
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), EqualTo(("payload_bytes",), 3)])) == [EqualTo(("payload_bytes",), 3)]


def test_archives_of_others(spark, tmp_path):
    """Uncompressed, and gzip members without skip lengths; folded and unknown headers; one file as path."""
    warc.register(spark)

    def record(kind, uri, block):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{uri}>\r\nWARC-Target-URI: {uri}\r\nX-Other: a\r\n b\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
        return head.encode() + block + b"\r\n\r\n"

    records = [record("warcinfo", "i", b"software: x\r\n"), record("response", "u1", b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\nbody " * 1),
               record("response", "u2", b"HTTP/1.1 200 OK\r\n\r\n" + b"y" * 50_000), record("request", "u1", b"GET / HTTP/1.1\r\n\r\n")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    for path in (str(tmp_path / "a.warc"), str(tmp_path / "b.warc.gz")):
        rows = spark.read.format("warc").load(path).where("record_type = 'response'").collect()
        assert [(r["target_uri"], bytes(r["payload"])) for r in rows] == [("u1", b"body "), ("u2", b"y" * 50_000)]
        assert spark.read.format("warc").schema("target_uri string").load(path).count() == 4
    assert spark.read.format("warc").load(str(tmp_path)).count() == 8


def test_files_of_a_lost_task_are_not_read(spark, pages):
    path = written(spark, pages)
    fs, root = warc.open_fs(path)
    with fs.open_output_stream(f"{root}/part-lost.warc.gz", compression=None) as f:
        f.write(warc.gzip_member(warc.record_bytes({"record_id": "lost", "payload": b"x"}))[:40])
    assert spark.read.format("warc").load(path).count() == pages.count()


def test_files_of_a_failed_job_are_not_read(spark, tmp_path):
    """Without any commit: what the job wrote is there, and the folder is empty to the reader."""
    path = str(tmp_path / "failed")
    writer = warc.WarcWriter({"path": path}, False)
    import pyarrow as pa
    written = writer.write(iter([pa.RecordBatch.from_pylist([{"record_id": f"r{k}", "payload": b"x"} for k in range(20)])]))
    assert len(written.files) == 1 and (tmp_path / "failed" / written.files[0][0]).exists()
    warc.register(spark)
    assert spark.read.format("warc").load(path).count() == 0
    writer.commit([written])
    assert spark.read.format("warc").load(path).count() == 20


def test_archives_of_others_stay_when_rows_are_appended(spark, pages, tmp_path):
    folder = tmp_path / "both"
    folder.mkdir()
    (folder / "part-00001.warc").write_bytes(b"".join(warc.record_bytes({"record_id": f"o{k}", "payload": b"y"}) for k in range(5)))
    (folder / "other.warc.gz").write_bytes(b"".join(warc.gzip_member(warc.record_bytes({"record_id": f"f{k}", "payload": b"y"})) for k in range(20)))
    warc.register(spark)
    read = lambda: sorted(r[0] for r in spark.read.format("warc").load(str(folder)).select("record_id").collect())
    assert len(read()) == 25
    (folder / "part-00001.warc").rename(folder / "own.warc")
    more = spark.createDataFrame([(f"n{k}", b"z") for k in range(3)], "record_id string, payload binary")
    more.write.format("warc").mode("append").save(str(folder))
    assert read() == sorted([f"o{k}" for k in range(5)] + [f"f{k}" for k in range(20)] + [f"n{k}" for k in range(3)])


def test_paths_follow_the_default_file_system(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://cluster/")
    conf.set("fs.viewfs.mounttable.cluster.link./shared", f"file://{tmp_path}")
    try:
        assert warc.qualified(spark, "/shared/x") == "viewfs://cluster/shared/x"
        assert warc.qualified(spark, f"file://{tmp_path}") == f"file:{tmp_path}" or warc.qualified(spark, f"file://{tmp_path}") == f"file://{tmp_path}"
    finally:
        conf.set("fs.defaultFS", before)


def test_a_wrong_digest_and_foreign_columns_are_refused(spark, tmp_path):
    warc.register(spark)
    data = warc.record_bytes({"record_id": "a", "payload": b"right"}).replace(b"right", b"wrong")
    (tmp_path / "a.warc").write_bytes(data)
    with pytest.raises(Exception, match="does not match its digest"):
        spark.read.format("warc").load(str(tmp_path)).collect()
    with pytest.raises(Exception, match="not columns of a WARC record"):
        spark.range(1).write.format("warc").mode("append").save(str(tmp_path / "b"))


def test_empty_table(spark, pages):
    path = written(spark, pages.where("false"))
    assert spark.read.format("warc").load(path).count() == 0


def test_base32_is_the_digest(spark):
    assert spark.range(1).select(warc.base32(F.sha1(F.lit("abc").cast("binary"))).alias("d")).first()["d"] == digest(b"abc")
