"""Importance resampling against its definition, the draw against a sort, and messy rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from telvault.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def runs(text, most):
    words = WORD.findall((text or "").translate(UPPER))
    return len(words), [" ".join(words[k:k + n]) for n in range(1, most + 1) for k in range(len(words) - n + 1)]


def want(docs, target, most=1, buckets=10_000, least=20, percent=10):
    """(id, n_features, weight, score) and the ids drawn, in order."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in runs(t, most)[1])
    t = Counter(bucket(f) for x in target for f in runs(x, most)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    rows, able = [], []
    for i, text in docs:
        n_words, features = runs(text, most)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        if n_words >= least:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    return Counter(rows), able[:len(able) * percent // 100]


@pytest.mark.parametrize("most, buckets", [(1, 10_000), (2, 97)])
def test_against_its_definition(spark, messy, most, buckets):
    target = spark.createDataFrame([("a b Koko",), (None,), ("ri tu ba-ba",)], "text string")
    got = resampling.resample(messy, target, most=most, buckets=buckets).collect()
    docs = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    rows, drawn = want(docs, [r["text"] for r in target.collect()], most, buckets)
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == rows
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1)) and drawn
    assert [(r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in ranked] == drawn


def test_empty_tables(spark, messy, empty):
    assert resampling.resample(empty, messy).count() == 0
    none = resampling.resample(messy, empty)
    assert none.count() == messy.count() and none.where("rank is not null").count() > 0
    assert resampling.resample(messy.where("text is null"), messy).where("rank is not null").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_cutoff_by_bisection(spark, seed):
    """Against a sort, with many ties, the ends of bigint, and rows that repeat."""
    rng = random.Random(seed)
    far = [-(1 << 63), (1 << 63) - 1, 0, -1]
    rows = [(rng.choice([*range(4), *far]), rng.choice([*range(3), *far])) for _ in range(200)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").cache()
    for n in (0, 1, 7, 60, 199, 200):
        kept = Counter(tuple(r) for r in df.where(resampling.highest(df, [F.col("a"), F.col("b")], n)).collect())
        order = sorted(rows, reverse=True)
        assert kept == Counter(r for r in rows if n and r >= order[n - 1])


def test_the_draw_sorts_and_moves_only_selected_rows(spark, messy):
    text = resampling.resample(messy, messy)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in text and "Window" not in text  # both come before, on the selected rows and the ranges
