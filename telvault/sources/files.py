"""Landing-file readers, acquisition into bronze, load reports, manifests."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.schemas import SCHEMAS
from telvault.sources import chunks, generations

# --- fixed values: landing file format -----------------------------------------
NULL_TOKEN = "\\N"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


# one set of options for reader, writer and stream
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "nullValue": NULL_TOKEN,
               "timestampNTZFormat": TIMESTAMP_FORMAT, "dateFormat": DATE_FORMAT}
CSV_READ_OPTIONS = CSV_OPTIONS | {"mode": "FAILFAST", "enforceSchema": False}


def read_landing_csv(spark: SparkSession, path: str, table: str, keep_empty: bool = False) -> DataFrame:
    """Typed CSV scan of a landing file: header, '"'-quoted, ``\\N`` and unquoted empty -> NULL.

    The declared schema is enforced against the header (``enforceSchema=False``
    checks names) and any malformed value aborts the read (``FAILFAST``).

    With ``keep_empty`` only ``\\N`` is NULL: an empty field, quoted or not, is
    the empty text in a text column and malformed in any other. Spark reads
    unquoted empty fields as NULL before it converts them, so the columns are
    read as text, where NULL then says "empty", and converted afterwards.
    """
    schema = SCHEMAS[table]
    if not keep_empty:
        return spark.read.schema(schema).options(**CSV_READ_OPTIONS).csv(path)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = spark.read.schema(text).options(**CSV_READ_OPTIONS | {"nullValue": ""}).csv(path)
    return rows.select(*[_kept(f) for f in schema])


def _kept(f: T.StructField) -> Column:
    """A declared column from its text, NULL where the field is empty."""
    said = F.coalesce(F.col(f.name), F.lit(""))
    value = said if isinstance(f.dataType, T.StringType) else said.try_cast(f.dataType)
    wrong = F.concat(F.lit(f"malformed {f.dataType.simpleString()} in {f.name}: '"), said, F.lit("'"))
    return (F.when(said == NULL_TOKEN, F.lit(None)).when(value.isNull(), F.raise_error(wrong).cast(f.dataType))
            .otherwise(value).cast(f.dataType).alias(f.name))


def write_landing_csv(df: DataFrame, path: str, quote_empty: bool = True) -> None:
    """Write a frame in the landing file format (round trip of ``read_landing_csv``). Empty texts are written as
    ``""``, or without ``quote_empty`` as nothing; either is read back with ``keep_empty``."""
    empty = {} if quote_empty else {"emptyValue": ""}
    df.write.mode("overwrite").options(**CSV_OPTIONS, **empty).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Parallel JDBC scan of one source stream (range-partitioned on a numeric column).

    Without a partition column the read is a single task; give one for any
    table of size. The driver jar must be on the classpath.
    """
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=properties or {})
    return spark.read.jdbc(url, table, properties=properties or {})


def contract_of(table: str) -> list[tuple[str, str, bool]]:
    """Strict landing contract of a table: declared names and type families."""
    fam = {"string": "STRING", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "bigint": "INTEGER",
           "boolean": "BOOLEAN"}
    out = []
    for f in SCHEMAS[table].fields:
        t = f.dataType.simpleString()
        out.append((f.name, "NUMBER" if t.startswith("decimal") else fam.get(t, "STRING"), False))
    return out


class SchemaDriftError(RuntimeError):
    pass


def landing_drift(df: DataFrame, table: str) -> list[tuple[str, str]]:
    """Exact drift of a frame's schema against the declared landing schema."""
    want = {f.name: f.dataType for f in SCHEMAS[table].fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    out = [(c, "added") for c in have if c not in want]
    out += [(c, "removed") for c in want if c not in have]
    out += [(c, "retyped") for c in want if c in have and have[c] != want[c]]
    return out


def ingest(streams: dict[str, DataFrame | Callable[[], DataFrame]], sink_dir: str,
           strict: bool = True, load_id: str | None = None) -> DataFrame:
    """Land source streams in bronze as one generation (``mode: full_refresh``).

    Per stream: strict schema check (added / removed / retyped columns stop
    the load), then a write into the load's own folder. When all streams are
    there, one commit makes them the current generation; until then, and after
    a failure, readers see the generation before (``generations``). A retried
    run (at-least-once delivery) under the same ``load_id`` writes the same
    folders anew, or nothing if it was committed.
    Returns the load report: (table_name, rows, path), counted on write by
    an observation, not by a second scan.
    """
    from pyspark.sql import Observation

    spark = SparkSession.getActiveSession()
    load_id = load_id or uuid.uuid4().hex
    rows = generations.committed(spark, sink_dir, load_id)
    folder = generations.load_dir(sink_dir, load_id)
    if rows is None:
        rows = {}
        for name, src in streams.items():
            df = src() if callable(src) else src
            problems = landing_drift(df, name)
            if problems and strict:
                raise SchemaDriftError(f"{name}: " + ", ".join(f"{c}:{k}" for c, k in problems))
            obs = Observation(f"load_{name}")
            df.select(*SCHEMAS[name].fieldNames()).observe(obs, F.count(F.lit(1)).alias("rows")) \
                .write.mode("overwrite").parquet(f"{folder}/{name}")
            rows[name] = int(obs.get["rows"])
        generations.commit(spark, sink_dir, load_id, rows)
    return spark.createDataFrame([(t, n, f"{folder}/{t}") for t, n in rows.items()], "table_name string, rows bigint, path string")


def file_manifest(spark: SparkSession, root: str, tables: list[str], fmt: str = "csv", chunk_bytes: int | None = None,
                  tasks: int | None = None) -> DataFrame:
    """Manifest of landed files: (table_name, file, bytes, sha256, rows, columns), one row per file.

    ``sha256`` is the plain digest of a file's bytes, streamed by one task per file. For files of any
    size give ``chunk_bytes``: it is then the root over the digests of ranges of that many bytes, which
    are spread over all tasks (``chunks``); manifests compare if their range sizes are equal. Row counts
    come from one typed scan per table, by the name of the file.
    """
    frames = []
    for t in tables:
        path = os.path.join(root, t)
        digests = chunks.file_digests(chunks.list_files(spark, path, fmt), chunk_bytes, tasks)
        data = read_landing_csv(spark, path, t) if fmt == "csv" else spark.read.parquet(path)
        counts = data.groupBy(F.col("_metadata.file_name").alias("__name")).agg(F.count(F.lit(1)).alias("rows"))
        digests = digests.withColumn("__name", F.element_at(F.split("file", "/"), -1))
        frames.append(digests.join(counts, "__name", "left")
                      .select(F.lit(t).alias("table_name"), "file", "bytes", "sha256",
                              F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                              F.lit(",".join(SCHEMAS[t].fieldNames())).alias("columns")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- fixed values: streams of the three source-aligned acquisitions ------------
ACQUISITIONS: dict[str, tuple[str, ...]] = {
    "billing": ("invoice", "invoice_charge"),
    "party": ("party", "account", "service", "subscription", "product_offering"),
    "usage": ("usage_event", "customer_interaction", "trouble_ticket"),
}


def acquire(product: str, read_stream: Callable[[str], DataFrame], bronze_dir: str,
            strict: bool = True, load_id: str | None = None) -> DataFrame:
    """Full-refresh acquisition of one source-aligned product into bronze.

    ``read_stream(name)`` returns the source stream as a DataFrame (for
    example ``lambda t: read_jdbc(spark, url, t, ...)``, a landing-CSV
    reader, or the star adapter's ``table``). Each stream passes the strict
    schema gate; all of them become current by one commit. Returns the load
    report.
    """
    return ingest({name: (lambda n=name: read_stream(n)) for name in ACQUISITIONS[product]}, bronze_dir, strict, load_id)


def read_bronze(spark: SparkSession, bronze_dir: str, tables) -> dict[str, DataFrame]:
    """Current generation of bronze tables, with their declared schemas (no inference)."""
    paths = generations.current(spark, bronze_dir)
    missing = [t for t in tables if t not in paths]
    if missing:
        raise FileNotFoundError(f"no committed load of {bronze_dir} holds {', '.join(missing)}")
    return {t: spark.read.schema(SCHEMAS[t]).parquet(paths[t]) for t in tables}
