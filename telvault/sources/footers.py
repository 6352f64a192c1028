"""Counts, minima and maxima of Parquet tables from their footers.

The second version of Spark's Parquet reader pushes aggregates without filters or
groups into the scan: the answer comes from the statistics in the files' footers
and no column is read. Minima and maxima are kept there in a comparable form for
numbers and dates only, so texts and timestamps are counted alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

V1_SOURCES = "spark.sql.sources.useV1SourceList"
ORDERED = (T.IntegralType, T.DateType, T.FloatType, T.DoubleType, T.BooleanType)


def open_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet files under ``path`` by the reader that answers aggregates from footers."""
    before = spark.conf.get(V1_SOURCES)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(V1_SOURCES, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(V1_SOURCES, before)


def row_count(spark: SparkSession, path: str, schema: T.StructType) -> int:
    return open_table(spark, path, schema).agg(F.count(F.lit(1))).first()[0] or 0  # files without rows have nothing to sum


def column_statistics(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """(table_name, column_name, rows, null_count, min_value, max_value) per column; the last two as text, NULL for texts,
    decimals and timestamps and for columns without values.

    All counts, and the bounds of columns without NULLs, come from footers. A run of rows that are all NULL has no
    bounds in its footer, so a column that has NULLs beside values is read, alone with others of that kind. One row
    a table comes to the driver, three times.
    """
    pushed, scanned = open_table(spark, path, schema), spark.read.schema(schema).parquet(path)
    counts = pushed.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{f.name}`")) for f in schema.fields]).first()
    rows, *there = [n or 0 for n in counts]  # files without rows have nothing to sum
    there = dict(zip(schema.fieldNames(), there))
    ordered = [f.name for f in schema.fields if isinstance(f.dataType, ORDERED) and there[f.name]]
    bounds: dict[str, tuple] = {}
    for df, names in ((pushed, [c for c in ordered if there[c] == rows]), (scanned, [c for c in ordered if there[c] < rows])):
        if names:
            # the casts to text are left to a projection above, which does not hinder the push-down
            one = df.agg(*[g(F.col(f"`{c}`")).alias(f"{k}{j}") for j, c in enumerate(names) for k, g in (("a", F.min), ("b", F.max))])
            got = one.select(*[F.col(c).cast("string") for c in one.columns]).first()
            bounds |= {c: (got[2 * j], got[2 * j + 1]) for j, c in enumerate(names)}
    out = [(name, f.name, rows, rows - there[f.name], *bounds.get(f.name, (None, None))) for f in schema.fields]
    return spark.createDataFrame(out, "table_name string, column_name string, rows bigint, null_count bigint, min_value string, max_value string")
