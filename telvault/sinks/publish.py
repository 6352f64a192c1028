"""Writing products: full refresh, create-or-replace, publish modes, comments."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.schemas import SCHEMAS
from telvault.sources import footers


def target_name(model: str, default_schema: str, custom_schema: str | None = None,
                alias: str | None = None) -> str:
    """Schema routing: a custom schema is used verbatim (not prefixed); alias wins over model name."""
    schema = custom_schema.strip() if custom_schema else default_schema
    return f"{schema}.{alias or model}"


def create_typed_table(spark: SparkSession, name: str, table: str, fmt: str = "parquet") -> None:
    """Create an empty table with a landing table's declared schema (if missing)."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], SCHEMAS[table]).write.format(fmt).saveAsTable(name)


def _writer(df: DataFrame, fmt: str, partition_by=None, bucket_by: tuple[int, str] | None = None):
    """DataFrameWriter with optional layout.

    ``partition_by``: column(s) for directory partitioning (time pruning on
    reads, e.g. a snapshot date). ``bucket_by``: (buckets, column) so later
    joins and aggregations on that key read co-located buckets instead of
    shuffling (for example the service key of the satellites and marts).
    """
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if bucket_by:
        n, col = bucket_by
        w = w.bucketBy(n, col).sortBy(col)
    return w


class PublishError(RuntimeError):
    pass


def _layout(spark: SparkSession, name: str) -> dict[str, str]:
    """Format, buckets and partition columns of a catalogue table, as its description says."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    out = {k: rows.get(k, "") for k in ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")}
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return out | {"partitions": ",".join(parts)}


def staged_replace(df: DataFrame, name: str, fmt: str = "parquet", partition_by=None,
                   bucket_by: tuple[int, str] | None = None) -> None:
    """Replace the table ``name`` (or create it) by ``df``: written beside, checked, then switched.

    The new version is a table of its own until it is complete and holds as many rows as were written; a
    failure up to then leaves the old rows as they are, and removes the attempt from the catalogue. The switch is
    one catalogue change, of the location, if schema and layout stay; else the old table gives its name, and its
    comment, to the complete new one. ``df`` may read ``name`` itself.
    """
    spark = df.sparkSession
    schema, _, table = name.rpartition(".")
    version = f"{name}__v{uuid.uuid4().hex[:12]}"
    base = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri.rstrip("/")
    path = f"{base}/{table}__versions/{version.rpartition('__')[2]}"
    seen = Observation(f"publish_{uuid.uuid4().hex}")
    try:
        _writer(df.observe(seen, F.count(F.lit(1)).alias("rows")), fmt, partition_by, bucket_by).option("path", path).saveAsTable(version)
        found = footers.row_count(spark, path, spark.table(version).schema) if fmt == "parquet" else spark.table(version).count()
        if found != seen.get["rows"]:
            raise PublishError(f"{name}: {seen.get['rows']} rows were written and {found} are there")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {version} RENAME TO {name}")
        return
    described = lambda t: [(f.name, f.dataType, f.metadata.get("comment")) for f in spark.table(t).schema]
    if described(name) == described(version) and (layout := _layout(spark, name)) == _layout(spark, version) and not layout["partitions"]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {name}")
        spark.sql(f"DROP TABLE {version}")  # of the entry: its files are at the location that ``name`` has now
    else:
        comment = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").select("data_type").collect()
        comment_table(spark, version, comment[-1][0] if comment else None)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {version} RENAME TO {name}")


def full_refresh(df: DataFrame, name: str, fmt: str = "parquet", partition_by=None,
                 bucket_by: tuple[int, str] | None = None) -> None:
    """Replace the table's content (and schema) with ``df``; until that is complete the old rows are read."""
    staged_replace(df, name, fmt, partition_by, bucket_by)


def create_or_replace_as_select(df: DataFrame, name: str, fmt: str = "parquet", partition_by=None,
                                bucket_by: tuple[int, str] | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE name AS SELECT ...; returns the table."""
    full_refresh(df, name, fmt, partition_by, bucket_by)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, path: str, partition_by=None) -> DataFrame:
    """Table materialization to a (shared) path; later steps read the written files (lineage cut)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


class DataLossError(RuntimeError):
    pass


PUBLISH_MODES = ("dry-run", "create-only", "amend", "amend-and-build", "replace", "replace-and-build")


def schema_diff(current: T.StructType | None, new: T.StructType) -> DataFrame:
    """(column_name, change, old_type, new_type) for added / removed / retyped columns."""
    spark = SparkSession.getActiveSession()
    old = {f.name.lower(): f for f in (current.fields if current else [])}
    neu = {f.name.lower(): f for f in new.fields}
    rows = []
    for k, f in neu.items():
        if k not in old:
            rows.append((f.name, "added", None, f.dataType.simpleString()))
        elif old[k].dataType != f.dataType:
            rows.append((f.name, "retyped", old[k].dataType.simpleString(), f.dataType.simpleString()))
    for k, f in old.items():
        if k not in neu:
            rows.append((f.name, "removed", f.dataType.simpleString(), None))
    return spark.createDataFrame(rows, "column_name string, change string, old_type string, new_type string")


def publish(df: DataFrame, name: str, mode: str = "amend-and-build", allow_data_loss: bool = False,
            fmt: str = "parquet", partition_by=None, bucket_by: tuple[int, str] | None = None) -> DataFrame:
    """Apply a product table in one of the contract apply modes.

    Structure-only modes (no rows written):
      * ``dry-run``: nothing changes; returns the schema diff.
      * ``create-only``: create the table (empty, ``df``'s schema) if it is
        missing; an existing table is left as it is.
      * ``amend``: create if missing, else additive evolution only -- new
        columns are added; removed or retyped columns fail.
      * ``replace``: drop and recreate empty; destructive, so an existing
        table needs ``allow_data_loss=True``.
    ``*-and-build`` modes then (re)build the rows: ``amend-and-build``
    replaces the rows of the amended table, whose columns keep the comments
    and tags that ``df`` does not set anew; ``replace-and-build``
    replaces table and schema with ``df``. Rows are replaced by a staged
    write and a switch (``staged_replace``), so a failed job loses none.
    Returns the schema diff against the table as it was.
    """
    if mode not in PUBLISH_MODES:
        raise ValueError(f"mode must be one of {PUBLISH_MODES}")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    current = spark.table(name).schema if exists else None
    diff = schema_diff(current, df.schema)
    if mode == "dry-run":
        return diff
    if mode.startswith("replace"):
        if exists and not allow_data_loss:
            raise DataLossError(f"{name}: replace is destructive; pass allow_data_loss=True")
        src = df if mode == "replace-and-build" else df.limit(0)
        staged_replace(src, name, fmt, partition_by, bucket_by)
        return diff
    if not exists:
        _writer(df.limit(0), fmt, partition_by, bucket_by).saveAsTable(name)
    elif mode != "create-only":
        breaking = diff.filter(F.col("change") != "added").collect()   # one row per column
        if breaking:
            raise DataLossError(f"{name}: amend cannot apply " + ", ".join(f"{b.column_name}:{b.change}" for b in breaking))
        added = [f for f in df.schema.fields if f.name.lower() not in {c.name.lower() for c in current.fields}]
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (" +
                      ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added) + ")")
    if mode == "amend-and-build":
        target_cols = spark.table(name).columns
        lower = {c.lower(): c for c in df.columns}
        known = {f.name: f.metadata for f in spark.table(name).schema.fields}
        rows = df.select(*[F.col(lower[c.lower()]).alias(c, metadata=known[c] | df.schema[lower[c.lower()]].metadata) for c in target_cols])
        had = _layout(spark, name)
        buckets = (int(had["Num Buckets"]), had["Bucket Columns"].strip("[]`")) if had["Num Buckets"] else None
        if buckets and "`" in buckets[1]:  # several columns: the rows are inserted into the table as it is laid out
            rows.write.insertInto(name, overwrite=True)
        else:
            staged_replace(rows, name, had["Provider"] or fmt, had["partitions"].split(",") if had["partitions"] else None, buckets)
    return diff


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments as field metadata (persisted by saveAsTable)."""
    return df.select([F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": comments[c]})
                      if c in comments else F.col(c) for c in df.columns])


def comment_table(spark: SparkSession, name: str, comment: str | None = None,
                  columns: dict[str, str] | None = None) -> None:
    """Persist table and column comments on a catalog table."""
    esc = lambda s: s.replace("\\", "\\\\").replace("'", "\\'")
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS '{esc(comment)}'")
    for c, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{c}` COMMENT '{esc(text)}'")


def smoke_table(spark: SparkSession, name: str, message: str, track: str, created_at) -> DataFrame:
    """Typed one-row table with NOT NULL columns (id, message, track, created_at)."""
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("message", T.StringType(), False),
                           T.StructField("track", T.StringType(), False),
                           T.StructField("created_at", T.TimestampNTZType(), False)])
    df = spark.createDataFrame([(1, message, track, created_at)], schema)
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """View materialization: expose lazy frames to SQL as temporary views (no data is written)."""
    names = []
    for t, df in tables.items():
        df.createOrReplaceTempView(prefix + t)
        names.append(prefix + t)
    return names
