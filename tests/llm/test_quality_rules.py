import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from telvault.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {p for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_measures_of_messy_rows(spark, messy, empty):
    got = Counter(tuple(r) for r in q.measures(messy, ["doc_id"], "text").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    assert got == Counter((r["doc_id"], *brute(r["text"])) for r in messy.collect())
    assert q.measures(empty, ["doc_id"], "text").count() == 0


@pytest.mark.parametrize("n, p", [(5, 0.3), (400, 0.01), (2000, 0.004), (30_000, 0.02)])
def test_binomial_tail_is_exact(spark, n, p):
    ks = sorted({0, 1, int(n * p / 2), max(0, int(n * p) - 1), int(n * p)})
    got = spark.createDataFrame([(k, n) for k in ks], "k int, n int").select("k", q.binomial_tail(F.col("k"), F.col("n"), p).alias("x")).collect()
    for r in got:
        if n <= 2000:
            want = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(r["k"] + 1))
        else:
            term, want = (1 - p) ** n, 0.0
            for i in range(r["k"] + 1):
                want += term
                term *= (n - i) / (i + 1) * p / (1 - p)
        assert r["x"] == pytest.approx(want, rel=1e-7)


def made(spark, good, good_over, bad, lang):
    """Measured rows of a stratum: good texts of which some have 0.25 symbols a word, and bad ones with 3."""
    zero = "10L as n_lines, 0L as n_dup_lines, 0L as n_repeat_words, 0L as n_capitals, 500L as word_chars, 100L as n_words, false as base_failed"
    rows = spark.range(good + bad).selectExpr(f"id + {ord(lang[0]) * 1000000} as doc_id", f"'{lang}' as lang",
                                              f"if(id < {good_over}, 25L, if(id < {good}, 0L, 300L)) as n_symbols", f"int(id < {good}) as quality", *zero.split(", "))
    return rows


def test_cutoffs_follow_the_exact_test(spark):
    level = 0.05 / (len(q.RULES) * 3)
    limit = q.LIMIT / len(q.RULES)
    few = next(k for k in range(1, 100) if sum(comb(6000, i) * limit ** i * (1 - limit) ** (6000 - i) for i in range(k + 1)) > level)
    rows = made(spark, 6000, few, 50, "aa").unionAll(made(spark, 6000, few - 1, 50, "bb")).unionAll(made(spark, 200, 0, 50, "cc"))
    # the bad ones of "bb" are only caught by a strict cutoff
    rows = rows.withColumn("n_symbols", F.when((F.col("lang") == "bb") & (F.col("quality") == 0), 15).otherwise(F.col("n_symbols")))
    cuts = {r["stratum"]: r["cut_symbols"] for r in q.cutoffs(rows, rows.select("doc_id", "quality"), "doc_id", "lang").collect()}
    assert cuts.get("aa") == 2.0  # all bad ones are caught there; stricter ones catch no more
    assert cuts.get("bb") == 0.1  # one rejection fewer than the test forbids
    assert "cc" not in cuts       # too few labels to prove anything
    strict = rows.where("lang = 'aa'").withColumn("n_symbols", F.when(F.col("quality") == 0, 15).otherwise(F.col("n_symbols")))
    others = rows.where("lang <> 'aa'")
    cuts = {r["stratum"]: r["cut_symbols"] for r in q.cutoffs(strict.unionAll(others), rows.select("doc_id", "quality"), "doc_id", "lang").collect()}
    assert cuts.get("aa") is None  # the cutoffs before the catching one already reject too many good ones


def test_kept_rows(spark, messy, empty):
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    kept = q.kept_rows(messy, labels)
    assert kept.columns == messy.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        (r["doc_id"], r["text"]) for r in messy.collect() if not brute(r["text"])[-1])
    assert q.kept_rows(empty, labels).count() == 0 and q.kept_rows(messy, labels.where("false")).count() == kept.count()


def test_query_has_no_python_in_its_plan(spark):
    plan = q.op6_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
