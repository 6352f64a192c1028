"""Line deduplication against its definition, the levels of runs, and the plan of their merge joins."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from telvault.llm import linededup

UPPER = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(UPPER)


def want(docs, least_chars=40, least_docs=5):
    low = -(1 << 63)
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add((low if i is None else i, t))
    out = Counter()
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < least_docs or max(h[0] for h in holders[key(x)]) == (low if i is None else i)]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.fixture(scope="module")
def paged(spark, messy):
    """Documents that share lines: of any case, with blanks around, twice in one text, at the edge of length, in null and repeated ids."""
    rng = random.Random(7)
    common = ["Menu – Home – Contact – About us – Imprint – Help", "x" * 40, "y" * 39, "é" * 40, "  padded with blanks on both sides, forty and more\t", "tail" * 12]
    rows = []
    for k in range(60):
        lines = [f"own line number {k} of a text that nobody else has at all {rng.random()}"]
        lines += [rng.choice([str.upper, str.lower, lambda s: "\x0b " + s + "\r"])(x) for x in common[:-1] if rng.random() < 0.5]
        lines += lines[-1:] * rng.randint(0, 2) + ["", "short"]
        rng.shuffle(lines)
        rows.append((None if k in (3, 50) else k // 2 if k % 9 == 0 else k, "\n".join(lines)))
    rows += [(70 + k, common[-1]) for k in range(6)] + [(80, rows[5][1]), (80, rows[5][1])]
    extra = spark.createDataFrame(rows, "doc_id bigint, text string")
    return messy.unionByName(extra, allowMissingColumns=True)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 3), (7, 2)])
def test_against_its_definition(spark, paged, batches, fanout):
    got = linededup.without_common_lines(paged, batches=batches, fanout=fanout)
    docs = [(r["doc_id"], r["text"]) for r in paged.select("doc_id", "text").collect()]
    found = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect())
    assert found == want(docs) and sum(r[2] for r in found) > 50


def test_empty_table(spark, empty):
    assert linededup.without_common_lines(empty).count() == 0


def test_levels_of_runs(spark):
    """Ten batches, three runs a level: no line is in two runs, totals are exact, and each batch returns its new lines."""
    rng, runs, seen, n, top = random.Random(1), linededup.Runs(spark, 3), set(), Counter(), {}
    for b in range(10):
        rows = [(100 - 3 * b - rng.randint(0, 2), rng.randint(0, 1), rng.randint(0, 60), 1) for _ in range(40)]
        lines = spark.createDataFrame([(i, k2, 0, h, h * 7) for i, k2, h, _ in rows], "k1 bigint, k2 bigint, pos int, h1 bigint, h2 bigint")
        new = {r["h1"] for r in runs.add(lines).collect()}
        assert new == {h for *_, h, _ in rows} - seen
        for i, _, h, _ in rows:
            if h not in seen:
                top[h] = max(top.get(h, i), i)
        for h, count in Counter(h for _, _, h, _ in set(rows)).items():
            n[h] += count
        seen |= new
        assert all(len(level) < 3 for level in runs.levels)
        held = [r["h1"] for t in runs.tables() for r in t.collect()]
        assert len(held) == len(set(held)) == len(seen)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {(r["h1"], r["n"], r["top"]) for r in runs.totals().collect()} == {(h, n[h], top[h]) for h in seen}
    assert linededup.Runs(spark).totals().count() == 0


def test_a_run_is_merged_without_a_shuffle_or_sort(spark):
    lines = spark.range(5000).select(F.col("id").alias("k1"), F.lit(0).alias("k2"), F.lit(0).alias("pos"), F.xxhash64("id").alias("h1"), F.col("id").alias("h2"))
    runs = linededup.Runs(spark)
    runs.add(lines)
    runs.add(lines.where("id % 2 = 0"))
    a, b = runs.tables()
    joined = a.join(b.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
    assert joined.count() == 5000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan


def test_query_has_no_python_in_its_plan(spark):
    plan = linededup.op12_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_kept_text_digest(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in linededup.op12_line_dedup(spark, sf).collect())
    assert got == Counter({(i, n, d, hashlib.sha256(t.encode()).hexdigest()): c for (i, n, d, t), c in want(docs).items()})
