import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from telvault.llm import sharding

SF = "/root/testdata/sf0.01"


def naive(classes, n):
    heap, out = [(0.0, j) for j in range(n)], []
    for _, count, mean in sorted(classes, key=lambda c: -c[2]):
        for _ in range(count):
            x, j = heapq.heappop(heap)
            heapq.heappush(heap, (x + mean, j))
    return sorted(x for x, _ in heap)


@pytest.mark.parametrize("n", [1, 3, 16])
def test_pouring_reaches_what_the_heap_does(n):
    rng = random.Random(n)
    for _ in range(30):
        classes = [(k, rng.choice([1, 2, 7, 300, 5000]), float(rng.randint(1, 10_000))) for k in range(rng.randint(1, 12))]
        dealt = sharding.longest_first(classes, n)
        loads = [sum((dealt[k][j] - (dealt[k][j - 1] if j else 0)) * m for k, _, m in classes) for j in range(n)]
        assert [round(x, 3) for x in sorted(loads)] == [round(x, 3) for x in naive(classes, n)]
        assert all(dealt[k][-1] == c for k, c, _ in classes)


def check(rows, docs, n=16):
    by, shard_of, loads, groups = defaultdict(list), {}, Counter(), Counter()
    for r in rows:
        by[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    of = defaultdict(set)
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(t)
    for r in rows:
        if len(set(texts[r["doc_id"]])) == 1:
            of[texts[r["doc_id"]][0]].add(r["shard"])
    assert all(len(s) == 1 for s in of.values())
    for i, t in docs:
        groups[t] += len((t or "").encode()) + 1
    mean = sum(loads.values()) / n
    assert max(loads.values()) <= max(1.02 * mean, max(groups.values())) + 10


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = sharding.op3_sharding(spark, SF).collect()
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    check(rows, docs)


def test_messy_rows(spark, messy, empty):
    def placed(df):
        return sharding.shard_by_size(df.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                                                F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
                                                F.coalesce("text", F.lit("\0none")).alias("key")), "doc_id", "size", "key", 5)
    check(placed(messy).collect(), [(r["doc_id"], r["text"]) for r in messy.collect()], 5)
    assert placed(empty).count() == 0
