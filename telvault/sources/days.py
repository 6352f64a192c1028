"""Events laid out by day, so that a trailing window reads its own days only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.functions.windows import DAY


def write_by_day(df: DataFrame, path: str, ts: str) -> None:
    """Write events in a folder for each day of ``ts`` (NULL: a folder of its own).

    Rows are gathered by day before the write, or every task would write a file into every folder; a day that
    outgrows a task is split again at run time (rebalance).
    """
    rows = df.withColumn(DAY, F.to_date(F.col(ts)))
    rows.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(path)


def read_by_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Events written by ``write_by_day``, with their partition column."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(path)
