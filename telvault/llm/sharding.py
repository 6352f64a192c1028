"""Sharding of documents by longest-processing-time scheduling.

Rows that must stay together (equal texts) form a group whose size is the sum of
its rows' sizes. Groups go from the largest to the smallest to the least loaded
shard, which a heap names. Sizes are taken to ``SIZE_BITS`` significant bits, so
the driver deals a histogram with at most 2**12 + 2**11 * 51 entries whatever
the input: exact sizes below 4,096, larger ones to one part in 2,048, each class
at its mean. Which groups of a class go to which shard is settled by their
position in the class, found without a task that holds a class.

Defined results: a null text has size 1 and CRC 0, and all null texts are one
group; an empty text is another; repeated rows get slots of their own; an empty
table gives an empty result; further columns of the input are dropped.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telvault.llm.common import gapless_position, shared_table

SIZE_BITS = 12


def longest_first(classes: list[tuple[int, int, float]], n_shards: int) -> dict[int, list[int]]:
    """For (class, groups, mean size): per class the number of groups up to and with each shard, cumulated.

    Each group goes to the least loaded shard (of equal loads, the lowest number). Many groups of one size are
    first poured to a common level under the one that the heap would reach, and the rest goes through the heap.
    """
    loads, out = [0.0] * n_shards, {}
    for key, count, mean in sorted(classes, key=lambda c: -c[2]):
        got = [0] * n_shards
        if count > 4 * n_shards:
            order = sorted(range(n_shards), key=lambda j: loads[j])
            below = 0.0
            for p in range(1, n_shards + 1):
                below += loads[order[p - 1]]
                level = (below + count * mean) / p
                if p == n_shards or level <= loads[order[p]]:
                    break
            for j in order[:p]:
                got[j] = max(0, int((level - loads[j]) / mean) - 1)
                loads[j] += got[j] * mean
        heap = [(x, j) for j, x in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(count - sum(got)):
            x, j = heap[0]
            got[j] += 1
            loads[j] = x + mean
            heapq.heapreplace(heap, (loads[j], j))
        total, out[key] = 0, []
        for x in got:
            total += x
            out[key].append(total)
    return out


def shard_by_size(df: DataFrame, id_col: str, size_col: str, group_col: str, n_shards: int) -> DataFrame:
    """``df`` (a narrow table: it is written and shuffled) with ``shard`` and the gapless ``slot`` in it.

    ``group_col`` may not be null; rows of a group get one shard.
    """
    rows = shared_table(df, "rows")
    groups = rows.groupBy(group_col).agg(F.sum(size_col).alias("_size"))
    unit = F.expr(f"shiftleft(1L, greatest(0, length(bin(_size)) - {SIZE_BITS}))")
    groups = groups.select(group_col, "_size", (F.col("_size") - F.col("_size") % unit).alias("_class"))
    placed = gapless_position(groups, ["_class"], [group_col], "_place")
    classes = [tuple(r) for r in placed.groupBy("_class").agg(F.count(F.lit(1)), F.avg("_size")).collect()]
    dealt = longest_first(classes, n_shards)
    plan = df.sparkSession.createDataFrame(pa.table({
        "_class": pa.array(dealt.keys(), pa.int64()), "_ends": pa.array(dealt.values(), pa.list_(pa.int64()))}),
        "_class bigint, _ends array<bigint>")
    # bounded by the number of size classes (see above), under 15 MB for 16 shards
    shards = placed.join(F.broadcast(plan), "_class").select(
        group_col, F.expr("cast(size(filter(_ends, e -> e <= _place)) as int)").alias("shard"))
    out = rows.join(shared_table(shards, "shards"), group_col)
    return gapless_position(out, ["shard"], [id_col, group_col], "slot")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, data = F.col("text"), F.col("text").cast("binary")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(data), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(data, 256)), F.lit(b"")).alias("text_key"))
    return shard_by_size(rows, "doc_id", "size", "text_key", 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
