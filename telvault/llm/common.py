"""Shared helpers: written intermediates, gapless positions, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named in ``spark.checkpoint.dir``.

    Only where that setting is absent in a local session (tests) a folder in the
    warehouse is used; on a cluster that is an error, for the warehouse may be
    each machine's own folder. Each application has its own subfolder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{base.rstrip('/')}/llm/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def give_back() -> None:
    """Return a worker's free memory to the machine: workers live on between tasks, beside the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, forget: Callable[[], None] = lambda: None) -> None:
    """Said by a task's function as it begins: this worker keeps caches of ``owner`` only, which ``forget`` empties. Those
    that another operator left are emptied now."""
    for other in [o for o in _HELD if o != owner]:
        _HELD.pop(other)()
    if owner not in _HELD:
        give_back()
    _HELD[owner] = forget


def quoted(name: str) -> Column:
    """The column of that very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_table(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder, in a folder for each value of ``partition_by``, and return the written table.

    It cuts the lineage (a lost executor re-reads files instead of replaying
    the plan), lets several consumers read one result, and gives Catalyst the
    true size, by which it chooses the join.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete this application's written intermediates."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` has it (in any case)."""
    used = {c.lower() for df in frames for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def crc32_text(c: Column) -> Column:
    """Unsigned CRC-32 of a value's decimal text."""
    return F.crc32(c.cast("string").cast("binary"))


def gapless_position(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in each group, by ``order``.

    A window would put a whole group in one task. Here the rows are dealt by
    range of (group, order), written once, and each (group, partition) run gets
    the number of rows before it. ``group`` may not be null. Rows equal in all
    of ``group`` and ``order`` are interchangeable.
    """
    part, row, first, n, before = (fresh(x, df) for x in ("_part", "_row", "_first", "_n", "_before"))
    keys = [*group, *order]
    dealt = (df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in keys]).sortWithinPartitions(*keys)
             .withColumn(part, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id()))
    dealt = shared_table(dealt, "dealt")
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = (dealt.groupBy(*group, part).agg(F.min(row).alias(first), F.count(F.lit(1)).alias(n))
            .withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).drop(n))
    runs = shared_table(runs, "runs")
    return (dealt.join(runs, [*group, part])
            .withColumn(name, F.col(row) - F.col(first) + F.col(before))
            .drop(part, row, first, before))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b bigint) as (node, label): the smallest node reached.

    Alternating large-star and small-star rounds: every round points nodes at
    the smallest neighbour, by grouped minima and joins, and is written to the
    shared folder; only two counters per round come to the driver. Stars are
    reached after a number of rounds logarithmic in the longest path.
    """
    a, b = F.col("a"), F.col("b")
    stars = edges.where("a <> b").select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct()
    stars, state = shared_table(stars, "stars"), None
    for _ in range(max_rounds):
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        # large star: every larger neighbour is pointed at the smallest of the neighbourhood; the minima are
        # written so that a hub's rows meet them in a join that AQE can split
        both = stars.select(F.col("v").alias("x"), F.col("u").alias("y")).unionAll(
            stars.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = shared_table(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), "least")
        large = shared_table(both.where("y > x").join(least, "x").select(
            F.col("y").alias("v"), F.col("m").alias("u")).distinct(), "large")
        # small star: a node and its smaller neighbours are pointed at the smallest of these
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        stars = shared_table(large.join(least, "v").select(
            F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")).where("e.u <> e.m")
            .select(F.col("e.u").alias("v"), F.col("e.m").alias("u")).distinct(), "stars")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (stars.select(F.col("v").alias("node"), F.col("u").alias("label"))
            .unionAll(stars.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()))
