"""WARC archives as a Spark data source (reader and writer).

``spark.read.format("warc").load(folder)`` plans one partition per file, or per
run of records where the folder's manifest lists record offsets. Predicates on
record_type, record_id, target_uri, payload_digest and refers_to are pushed
into the reader (with ``spark.sql.python.filterPushdown.enabled``). The
reader inflates a record until its headers are complete, tests the predicates,
and goes on to the payload only for records that pass and only if the schema
asks for ``payload``; other records are stepped over by the ``sl`` lengths of
the WARC standard's gzip members (else by Content-Length, or by inflating
without keeping).

``df.write.format("warc").mode("append").save(folder)`` writes one gzip member
per record. Executors write straight to the folder under names that begin with
``_``; the commit writes a manifest of the files of successful tasks. A folder is
read as the files of its manifests and all archives (``.warc``, ``.warc.gz``) whose
names do not begin with ``_`` or ``.``, so what a lost executor or a failed job left
behind is never read, and archives of others are, beside written ones or alone.

A path without a scheme is a local one for the source, which sees no Hadoop
configuration; ``qualified`` gives the URI that Spark's default file system makes
of it.

Defined results: null payload is written as empty; null record_type as
``response``; null dates as the epoch; other null headers are left out and read
back as null; an empty table gives an empty archive; extra columns are refused.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    Not,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from telvault.llm.common import shared_path, shared_table

SCHEMA = ("record_id string, record_type string, warc_date string, target_uri string, refers_to string, "
          "payload_digest string, payload_bytes long, content_type string, payload binary")
# WARC header of each column that is written
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "warc_date": "WARC-Date",
           "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
           "payload_bytes": "X-Payload-Length"}
URIS = {"record_id", "refers_to"}  # in angle brackets
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PUSHED = {"record_type", "record_id", "target_uri", "payload_digest", "refers_to"}
MANIFEST = "_manifest"
SPLIT_BYTES = 64 << 20
FILE_BYTES = 1 << 30
BATCH_BYTES = 4 << 20


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:"):
            uri = "file:///" + uri[5:].lstrip("/")
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def gzip_member(record: bytes, level: int = 1) -> bytes:
    """A gzip member whose ``sl`` extra field has its compressed and plain length."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(record) + z.flush()
    total = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(row: dict) -> bytes:
    """A WARC record of a row: an HTTP response block, or a revisit's header block."""
    payload = row.get("payload") or b""
    kind = row.get("record_type") or "response"
    revisit = kind == "revisit"
    if not revisit:
        row = row | {"payload_digest": sha1_base32(payload), "payload_bytes": len(payload)}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {row.get('content_type') or 'text/html; charset=utf-8'}\r\n"
    http = (http + ("\r\n" if revisit else f"Content-Length: {len(payload)}\r\n\r\n")).encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = row.get(column)
        if column == "record_type":
            value = kind
        elif column == "warc_date":
            value = value or "1970-01-01T00:00:00Z"
        elif column == "record_id":
            value = value or f"urn:uuid:{uuid.uuid4()}"
        if value is not None:
            value = str(value).replace("\r", "%0D").replace("\n", "%0A")
            value = f"<{value}>" if column in URIS else f"sha1:{value}" if column == "payload_digest" else value
            lines.append(f"{header}: {value}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list  # of [name, bytes, offsets of records that begin a split]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        if overwrite:
            raise ValueError("a WARC folder is only appended to: choose a new folder")
        self.path = options["path"]
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        files, out, at = [], None, 0
        try:
            for batch in iterator:
                columns = batch.schema.names
                for i in range(batch.num_rows):
                    if out is None or at >= self.file_bytes:
                        if out is not None:
                            out.close()
                            files[-1][1] = at
                        name, at = f"_part-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        files.append([name, 0, [0]])
                    if at - files[-1][2][-1] >= self.split_bytes:
                        files[-1][2].append(at)
                    at += out.write(gzip_member(record_bytes({c: batch.column(k)[i].as_py() for k, c in enumerate(columns)})))
        finally:
            if out is not None:
                out.close()
                files[-1][1] = at
        return Written(files)

    def commit(self, messages) -> None:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        fs, root = open_fs(self.path)
        for m in messages:
            for name, _, _ in m.files if m is not None else []:
                fs.delete_file(f"{root}/{name}")


@dataclass
class WarcSplit(InputPartition):
    path: str
    start: int
    end: int | None


class Source:
    """Plain bytes of one record at a time, from a gzip member or from an uncompressed file."""

    def __init__(self, fs, path: str, start: int):
        self.file, self.at = fs.open_input_file(path), start
        self.size = self.file.size()

    def next(self, end: int):
        """(head, rest) of the record at the current place: header text, and a function that gives the block or skips it."""
        if self.at >= end:
            return None
        self.file.seek(self.at)
        raw = self.file.read(min(4096, self.size - self.at))
        if not raw.strip():  # padding at the end
            return None
        return self.member(raw) if raw[:2] == b"\x1f\x8b" else self.plain(raw)

    def member(self, raw: bytes):
        start, z, skip = self.at, zlib.decompressobj(31), 0
        if raw[3] & 4 and raw[12:14] == b"sl":
            skip = struct.unpack("<I", raw[16:20])[0]
        plain = z.decompress(raw)
        read = len(raw)
        while b"\r\n\r\n" not in plain and not z.eof:
            more = self.file.read(1 << 16)
            if not more:
                raise ValueError(f"a record that begins at byte {start} is cut off")
            read += len(more)
            plain += z.decompress(more)
        head, _, begun = plain.partition(b"\r\n\r\n")

        def rest(wanted: bool):
            nonlocal read
            if not wanted and skip:
                self.at = start + skip
                return b""
            parts = [begun]
            while not z.eof:
                more = self.file.read(1 << 16)
                if not more:
                    raise ValueError(f"a record that begins at byte {start} is cut off")
                read += len(more)
                got = z.decompress(more)
                if wanted:
                    parts.append(got)
            self.at = start + read - len(z.unused_data)
            return b"".join(parts)

        return head, rest

    def plain(self, raw: bytes):
        start = self.at
        while b"\r\n\r\n" not in raw:
            more = self.file.read(1 << 14)
            if not more:
                raise ValueError(f"a record that begins at byte {start} is cut off")
            raw += more
        head = raw.partition(b"\r\n\r\n")[0]
        length = int(parse_head(head).get("content-length", 0))

        def rest(wanted: bool):
            self.at = start + len(head) + 4 + length + 4
            if not wanted:
                return b""
            self.file.seek(start + len(head) + 4)
            return self.file.read(length)

        return head, rest


def parse_head(head: bytes) -> dict:
    lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out, last = {}, None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:  # folded line
            out[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return out


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.fieldNames()
        self.arrow = None
        self.schema = schema
        self.path = options["path"]
        self.verify = str(options.get("verify", "true")).lower() == "true"
        self.tests: list = []

    def pushFilters(self, filters):
        for f in filters:
            known = getattr(f, "attribute", None) or getattr(getattr(f, "child", None), "attribute", ())
            if len(known) == 1 and known[0] in PUSHED and (
                    isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)) or isinstance(f, Not) and isinstance(f.child, EqualTo)):
                self.tests.append(f)
            else:
                yield f

    def passes(self, row: dict) -> bool:
        for f in self.tests:
            negated = isinstance(f, Not)
            f = f.child if negated else f
            x = row.get(f.attribute[0])
            if x is None:
                return False
            if isinstance(f, EqualTo) and (x == f.value) == negated:
                return False
            if isinstance(f, In) and x not in f.value:
                return False
            if isinstance(f, StringStartsWith) and not x.startswith(f.value):
                return False
        return True

    def partitions(self):
        fs, root = open_fs(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            return [WarcSplit(self.path, 0, None)]
        there = sorted((i for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))), key=lambda i: i.base_name)
        base = self.path.rstrip("/")
        out, written = [], set()
        manifests = [i for i in there if i.base_name.startswith(MANIFEST)]
        for m in manifests:
            with fs.open_input_stream(m.path) as f:
                for name, size, begins in json.loads(f.read()):
                    written.add(name)
                    out += [WarcSplit(f"{base}/{name}", a, b) for a, b in zip(begins, [*begins[1:], size])]
        for i in there:
            # beside a manifest, part- is what this writer named its files before
            own = i.base_name.startswith(("_", ".")) or manifests and i.base_name.startswith("part-")
            if i.base_name.endswith((".warc", ".warc.gz")) and not own and i.base_name not in written:
                out.append(WarcSplit(f"{base}/{i.base_name}", 0, None))
        return out or [WarcSplit("", 0, 0)]

    def read(self, split: WarcSplit):
        from pyspark.sql.pandas.types import to_arrow_schema
        schema, rows, held = to_arrow_schema(self.schema), [], 0
        if split.path:
            fs, path = open_fs(split.path)
            source = Source(fs, path, split.start)
            end = source.size if split.end is None else split.end
            while (got := source.next(end)) is not None:
                head, rest = got
                row = self.row(parse_head(head))
                if not self.passes(row):
                    rest(False)
                    continue
                if "payload" in self.columns:
                    self.payload(row, rest(True))
                    held += len(row["payload"])
                else:
                    rest(False)
                rows.append({c: row.get(c) for c in self.columns})
                held += 400
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    @staticmethod
    def row(head: dict) -> dict:
        row = {c: head.get(h.lower()) for c, h in HEADERS.items()}
        for c in URIS:
            row[c] = row[c] and row[c].strip("<>")
        row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix("sha1:")
        row["payload_bytes"] = row["payload_bytes"] and int(row["payload_bytes"])
        row["content_type"] = head.get("content-type")
        row["content_length"] = int(head.get("content-length", 0))
        return row

    def payload(self, row: dict, block: bytes) -> None:
        block = block[:row["content_length"]]
        if (row["content_type"] or "").startswith("application/http"):
            http, _, block = block.partition(b"\r\n\r\n")
            row["content_type"] = next((x.split(":", 1)[1].strip() for x in http.decode("latin-1").split("\r\n")
                                        if x.lower().startswith("content-type:")), None)
        row["payload"] = block
        if row["record_type"] != "revisit":
            if self.verify and row["payload_digest"] and row["payload_digest"] != sha1_base32(block):
                raise ValueError(f"{row['record_id']}: the payload does not match its digest")
            row["payload_bytes"] = len(block)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        unknown = set(schema.fieldNames()) - {*HEADERS, "content_type", "payload"}
        if unknown:
            raise ValueError(f"not columns of a WARC record: {sorted(unknown)}")
        return WarcWriter(dict(self.options), overwrite)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark itself resolves it: with the scheme and host of the default file system where it names none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def with_revisits(df: DataFrame, key: str, payload: str, uri: str | None = None, least_bytes: int = 0) -> DataFrame:
    """WARC rows of ``df``: of equal payloads of at least ``least_bytes``, the one with the largest key is the
    response and the others are revisits without payload that refer to it.

    Equal means equal SHA-1 and length. Rows that repeat the largest key are all responses, as are all rows of a
    payload that has no key; null payloads are empty ones. Only keys and digests are shuffled to find the
    revisits, and the payloads only by (key, digest), so that a payload that a third of the rows share stays spread.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.select(F.col(key).alias("key"), (F.col(uri) if uri else F.lit(None).cast("string")).alias("target_uri"),
                     body.alias("payload"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("payload_bytes"))
    known = shared_table(rows.where(F.col("payload_bytes") >= least_bytes).select("key", "digest", "payload_bytes"), "digests")
    # grouped by the digest alone and joined on digest and length: both sides get an exchange that AQE can split
    groups = known.groupBy("digest").agg(F.max("key").alias("response"), F.count(F.lit(1)).alias("n"),
                                         F.max("payload_bytes").alias("payload_bytes")).where("n > 1")
    copies = (known.join(groups, ["digest", "payload_bytes"]).where("not (key <=> response) and response is not null")
              .select("key", "digest", "response").distinct())
    copies = shared_table(copies, "revisits")
    a, b = rows.alias("a"), copies.alias("b")
    joined = a.join(b, F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.digest") == F.col("b.digest")), "left")
    revisit = F.col("b.response").isNotNull()
    urn = lambda c: F.concat(F.lit("urn:key:"), F.coalesce(c.cast("string"), F.lit("null")))
    return joined.select(
        urn(F.col("a.key")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "a.target_uri", F.when(revisit, urn(F.col("b.response"))).alias("refers_to"),
        # an archive names digests in base32, which has no SQL function: the writer forms it from the payload, and
        # for a revisit from the hex digest
        F.when(revisit, base32(F.col("a.digest"))).alias("payload_digest"),
        F.col("a.payload_bytes"), F.when(~revisit, F.col("a.payload")).alias("payload"))


def base32(hex_digest):
    """Upper-case base32 of a hex SHA-1: 160 bits as 8 groups of 20, each 4 characters of the alphabet."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    number = lambda k: F.conv(F.substring(hex_digest, 1 + 5 * k, 5), 16, 10).cast("int")
    return F.concat(*[F.substring(F.lit(alphabet), (F.shiftright(number(k), s).bitwiseAND(31) + 1), F.lit(1))
                      for k in range(8) for s in (15, 10, 5, 0)])


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = qualified(spark, shared_path(spark, "archive"))
    with_revisits(pages, "page_id", "html", "url").write.format("warc").mode("append").save(path)
    page = lambda c: F.expr(f"try_cast(substring({c}, 9) as bigint)")  # noqa: E731  after urn:key:
    return (spark.read.format("warc").load(path)
            .select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    page("refers_to").alias("refers_to"), "target_uri", F.length("payload").cast("long").alias("stored_bytes")))
