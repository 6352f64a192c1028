"""What the catalogue says of a published table, against what was declared.

Both are lists of (object, property, value), where an object is the table or one of its
columns, so one comparison covers types, comments, tags and layout. They have a few rows
per column and never depend on the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE = "(table)"
STATE_SCHEMA = "object string, property string, value string"


@dataclass(frozen=True)
class TableContract:
    """Declared table: fields with comments and tags as their metadata, table comment and layout."""

    schema: T.StructType
    comment: str | None = None
    provider: str = "parquet"
    partitions: tuple[str, ...] = ()
    buckets: tuple[int, str] | None = None
    location: str | None = None  # None: wherever the catalogue keeps it


def _columns(schema: T.StructType, tags: tuple[str, ...]) -> list[tuple[str, str, str]]:
    out = []
    for f in schema.fields:
        out.append((f.name.lower(), "type", f.dataType.simpleString()))
        out += [(f.name.lower(), k, str(f.metadata[k])) for k in ("comment", *tags) if f.metadata.get(k) not in (None, "")]
    return out


def _table(comment, provider, partitions, buckets, location) -> list[tuple[str, str, str]]:
    values = {"comment": comment, "provider": provider.lower(), "partitions": ",".join(partitions).lower(),
              "buckets": f"{buckets[0]} by {buckets[1].lower()}" if buckets else None, "location": location}
    return [(TABLE, k, v) for k, v in values.items() if v]


def declared_state(spark: SparkSession, contract: TableContract, tags: tuple[str, ...] = ("sensitivity",)) -> DataFrame:
    """(object, property, value) of a contract; names in lower case."""
    c = contract
    rows = _columns(c.schema, tags) + _table(c.comment, c.provider, c.partitions, c.buckets, c.location)
    return spark.createDataFrame(rows, STATE_SCHEMA)


def catalogue_state(spark: SparkSession, name: str, tags: tuple[str, ...] = ("sensitivity",)) -> DataFrame:
    """(object, property, value) of a table as the catalogue describes it; no row of it is read."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()  # a row per column and property
    at = next(i for i, r in enumerate(described) if r["col_name"].startswith("# Detailed Table Information"))
    detail = {r["col_name"]: r["data_type"] for r in described[at + 1:]}
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    buckets = (int(detail["Num Buckets"]), detail["Bucket Columns"].strip("[]").replace("`", "")) if detail.get("Num Buckets") else None
    rows = _columns(spark.table(name).schema, tags)
    rows += _table(detail.get("Comment"), detail.get("Provider", ""), partitions, buckets, detail.get("Location"))
    return spark.createDataFrame(rows, STATE_SCHEMA)


def catalogue_drift(spark: SparkSession, name: str, contract: TableContract, tags: tuple[str, ...] = ("sensitivity",)) -> DataFrame:
    """(object, property, declared, found, status, passed) of every declared or found property.

    ``status`` is ok, changed, missing (declared only) or added (found only). The location is
    compared only where the contract names one.
    """
    found = catalogue_state(spark, name, tags).withColumnRenamed("value", "found")
    if contract.location is None:
        found = found.where(~((F.col("object") == TABLE) & (F.col("property") == "location")))
    declared = declared_state(spark, contract, tags).withColumnRenamed("value", "declared")
    status = (F.when(F.col("found").isNull(), "missing").when(F.col("declared").isNull(), "added")
              .when(F.col("declared") != F.col("found"), "changed").otherwise("ok"))
    return (declared.join(found, ["object", "property"], "full").select("object", "property", "declared", "found", status.alias("status"))
            .withColumn("passed", F.col("status") == "ok"))


class CatalogueDriftError(RuntimeError):
    pass


def assert_as_declared(report: DataFrame) -> DataFrame:
    """Raise if a property differs from what was declared; all of them are named."""
    bad = report.where("not passed").orderBy("object", "property").collect()  # at most a few rows per column
    if bad:
        raise CatalogueDriftError("the catalogue differs: " + ", ".join(f"{b.object}.{b.property}: {b.status}" for b in bad))
    return report


def filled(df: DataFrame) -> DataFrame:
    """(object, filled): rows of the table, and non-NULL values of each column, from one scan."""
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(quoted(c)).alias(f"__c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(TABLE).alias("object"), F.col("__rows").alias("filled"))]
    rows += [F.struct(F.lit(c.lower()).alias("object"), F.col(f"__c{i}").alias("filled")) for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*rows)))
