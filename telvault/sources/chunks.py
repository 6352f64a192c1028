"""Digests of files by byte ranges.

Files are listed with their lengths, cut into ranges of a fixed size and dealt to
tasks range by range, so a file of any size is digested by many tasks, each holding
one small block at a time. A file's root is the digest of its ranges' digests in
order: it depends on the bytes and the range size alone, never on the number of tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
RANGE_SCHEMA = "file string, bytes bigint, start bigint, length bigint, sha256 string"


def _open(uri: str):
    if uri.startswith(("file:", "/")):
        return pafs.LocalFileSystem().open_input_file("/" + uri.removeprefix("file:").lstrip("/"))
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def _range_digest(uri: str, start: int, length: int) -> str:
    digest = hashlib.sha256()
    with _open(uri) as f:
        f.seek(start)
        while length > 0:
            block = f.read(min(length, BLOCK_BYTES))
            if not block:
                raise OSError(f"{uri} has become shorter since it was listed")
            digest.update(block)
            length -= len(block)
    return digest.hexdigest()


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [_range_digest(r["file"], r["start"], r["length"]) for r in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string())], [*b.schema.names, "sha256"])


def list_files(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """(file, bytes) of the files below ``path``, empty ones too; no content is read.

    A scan skips empty files; their names are taken from the listing that the driver holds for it.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").load(path)
    scanned = found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    local = lambda c: F.regexp_replace(c, "^file:/+", "/")
    named = spark.createDataFrame([(unquote(f),) for f in found.inputFiles()], "name string").select(local("name").alias("name"))
    return (named.join(scanned.withColumn("name", local("file")), "name", "left")
            .select(F.coalesce("file", "name").alias("file"), F.coalesce("bytes", F.lit(0).cast("bigint")).alias("bytes")))


def range_digests(files: DataFrame, chunk_bytes: int | None = CHUNK_BYTES, tasks: int | None = None) -> DataFrame:
    """(file, bytes, start, length, sha256) of every range of ``files`` (file, bytes).

    ``chunk_bytes=None`` makes one range of each file, whose digest is the plain one of
    the file. An empty file is one empty range. ``tasks`` defaults to the session's
    shuffle partitions. A file that shrinks while it is read is an error.
    """
    spark = files.sparkSession
    if chunk_bytes is not None and chunk_bytes < 1:
        raise ValueError("chunk_bytes must be positive")
    if chunk_bytes is None:
        ranges = files.select("file", "bytes", F.lit(0).cast("bigint").alias("start"), F.col("bytes").alias("length"))
    else:
        size = F.lit(chunk_bytes).cast("bigint")
        starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)), size)
        ranges = (files.select("file", "bytes", F.explode(starts).alias("start"))
                  .select("file", "bytes", "start", F.least(size, F.col("bytes") - F.col("start")).alias("length")))
    # by number: the rows are few and small, the work behind them is not
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(n, "file", "start").mapInArrow(_digest_batches, RANGE_SCHEMA)


def file_digests(files: DataFrame, chunk_bytes: int | None = None, tasks: int | None = None) -> DataFrame:
    """(file, bytes, ranges, sha256) per file: its plain digest, or with ``chunk_bytes`` its root.

    The list of a file's digests is 64 characters a range: 10 MB for 10 TB in ranges of 64 MiB.
    """
    found = range_digests(files, chunk_bytes, tasks)
    if chunk_bytes is None:
        return found.select("file", "bytes", F.lit(1).cast("bigint").alias("ranges"), "sha256")
    ordered = F.array_sort(F.collect_list(F.struct("start", "sha256")))
    return found.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("ranges"), ordered.alias("__d")).select(
        "file", "bytes", "ranges", F.sha2(F.array_join(F.col("__d.sha256"), "\n"), 256).alias("sha256"))
