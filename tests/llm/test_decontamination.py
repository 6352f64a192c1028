import re
from collections import Counter

from telvault.llm import decontamination as d


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def brute(text, items, width):
    words, hit, named = tokens(text), set(), set()
    for item, said in items:
        w = tokens(said)
        for s in range(max(1, len(w) - width + 1)) if w else ():
            run = w[s:s + width]
            for at in range(len(words) - len(run) + 1):
                if words[at:at + len(run)] == run:
                    hit.update(range(at, at + len(run)))
                    named.add(item)
    return len(words), len(hit), sorted(str(i) for i in named if i is not None), len(hit) > 0 and 20 * len(hit) >= len(words)


def test_messy_rows(spark, messy, empty, texts, words):
    items = [(1, "alpha beta gamma delta epsilon"), (2, "ÉTÉ one-two; one two one two"), (3, "the"), (4, None), (5, ""), (6, "-- !!"), (None, "alpha beta"),
             (7, " ".join(words[:30])), (8, " ".join(words[10:25])), (10, "alpha BETA gamma delta epsilon"), (10, "zz"), (11, "ba ba ba ba ba ba")]
    docs = [(100, "x Alpha beta, gamma delta epsilon zeta"), (101, "alpha beta alpha beta gamma delta Epsilon"), (102, "été One two one two; one two"), (103, "ÉTÉ one two one two one two the"),
            (104, " ".join(words[5:40])), (105, ("pad " * 500) + " ".join(words[:30])), (106, "ba " * 50), (107, "zz"), (107, "zz"), (107, "other"), (None, "zz the"), (None, None)]
    schema = messy.schema
    more = spark.createDataFrame([(i, t) + (None,) * (len(schema) - 2) for i, t in docs], schema)
    rows = messy.unionAll(more)
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id bigint, text string, words string, start int")
    for width in (5, 13):
        got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in d.report(rows, bench, width=width).collect())
        want = Counter()
        for r in rows.collect():
            n, hit, named, bad = brute(r["text"], items, width)
            want[r["doc_id"], n, hit, tuple(named), bad] += 1
        assert got == want
    clean = d.clean_rows(rows, bench)
    assert clean.columns == rows.columns
    assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == Counter((r["doc_id"], r["text"]) for r in rows.collect() if not brute(r["text"], items, 13)[-1])
    assert d.report(empty, bench).count() == 0
    assert {r["n_hit"] for r in d.report(messy, bench.where("false")).collect()} == {0}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x x b x a b"), (2, "b a"), (3, "a x x x x x x x x b"), (4, "a a")], "doc_id bigint, text string")
    index = d.build_index(docs, "doc_id", "text")
    pairs = spark.createDataFrame([(1, "a", "b", 3), (2, "a", "b", 1), (3, "a", "a", 2)], "pair int, a string, b string, most int")
    got = {(r["pair"], r["k1"], r["pos_a"], r["pos_b"]) for r in d.proximity_matches(index, pairs).collect()}
    want = set()
    for doc, text in ((1, "a x x b x a b"), (2, "b a"), (3, "a x x x x x x x x b"), (4, "a a")):
        w = text.split()
        for p, a, b, most in ((1, "a", "b", 3), (2, "a", "b", 1), (3, "a", "a", 2)):
            want |= {(p, doc, i, j) for i, x in enumerate(w) for j, y in enumerate(w) if x == a and y == b and i != j and abs(i - j) <= most}
    assert got == want


def test_main_path_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = d.report(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.findall("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)
