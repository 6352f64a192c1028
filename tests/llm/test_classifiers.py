import math
import zlib
from collections import Counter

import numpy as np
import pytest

from telvault.llm import ftrl, quality_classifier, toxicity

SF = "/root/testdata/sf0.1"


def scored(spark, query, label):
    rows = query(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    return rows, rows.join(labels, "doc_id").where("held_out").toPandas()


def test_toxicity_on_held_out_documents(spark):
    rows, held = scored(spark, toxicity.op4_toxicity, "toxic")
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    y, p = held["toxic"] == 1, held["predicted"] == 1
    assert y.sum() > 50 and p[y].mean() >= 0.85 and p[~y].mean() <= 0.01  # 300 toxic texts to learn from, in four languages
    assert held["score"].between(0, 1).all() and ((held["score"] >= 0.7) == p).all()


def test_quality_on_held_out_documents(spark):
    _, held = scored(spark, quality_classifier.op10_quality_classifier, "quality")
    y, p = held["quality"] == 1, held["predicted"] == 1
    assert (~y).sum() > 50 and p[y].mean() >= 0.95 and p[~y].mean() <= 0.06


@pytest.mark.parametrize("module, fit, column", [(toxicity, toxicity.fit_toxicity, "toxic"), (quality_classifier, quality_classifier.fit_quality, "quality")])
def test_messy_rows(spark, messy, empty, module, fit, column):
    labels = spark.createDataFrame([(k, k % 2, None if k % 7 == 0 else k % 3 % 2) for k in range(50)] + [(None, 1, 1), (5, 1, 1), (5, 1, 1)],
                                   "doc_id bigint, toxic int, quality int")
    model = fit(messy, labels)
    got = model.score(messy, ["doc_id", "lang"], "text").collect()
    assert len(got) == messy.count() and all(0 <= r["score"] <= 1 for r in got)
    kept = toxicity.clean(messy, model)
    assert kept.columns == messy.columns and kept.count() == sum(r["score"] < 0.7 for r in got)
    none = {round(r["score"], 12) for r in model.score(messy.where("text is null or text = ''"), ["doc_id"], "text").collect()}
    assert len(none) == 1  # the bias alone
    assert model.score(empty, ["doc_id"], "text").count() == 0
    unlearned = fit(messy, labels.where("false"))
    assert {r["score"] for r in unlearned.score(messy, ["doc_id"], "text").collect()} == {0.5}


def test_updates_follow_the_definition():
    """One coordinate, against FTRL-proximal written out by hand."""
    rates, z, n, w = ftrl.Rates(0.5, 1.0, 0.1, 0.2, 1, 0, 1), 0.0, 0.0, 0.0
    xs = [(1.0, 1.0), (2.0, 0.0), (0.5, 1.0), (1.0, 1.0)]
    at, weights, bias = ftrl.fit([(np.array([0]), np.array([x]), y) for x, y in xs], 4, rates)
    for x, y in xs:
        w = 0.0 if abs(z) <= 0.1 else -(z - np.sign(z) * 0.1) / ((1 + n ** 0.5) / 0.5 + 0.2)
        g = (4 / 6 if y else 4 / 2) * (1 / (1 + np.exp(-w * x)) - y) * x  # three of four are ones
        z += g - ((n + g * g) ** 0.5 - n ** 0.5) / 0.5 * w
        n += g * g
    w = 0.0 if abs(z) <= 0.1 else -(z - np.sign(z) * 0.1) / ((1 + n ** 0.5) / 0.5 + 0.2)
    assert bias == 0 and at.tolist() == [0] and weights.tolist() == pytest.approx([w])


def naive_score(model, text):
    """Features by plain loops over Python integers, the dot product over a dict."""
    f, whole = model.features, 1 << 64
    mix = [int(m) for m in ftrl.MIX]
    at, w, total = model.weights.value
    weights = dict(zip(at.tolist(), np.float32(w).tolist()))

    def place(x):
        return ((x ^ x >> 29) * mix[3] % whole) >> (64 - f.bits)

    words = f.words(text) if text else []
    forms = [[zlib.crc32(f"{k}{x}".encode()) for k, x in enumerate(f.forms(word))] for word in words]
    found = [place(x * mix[0] % whole) for word in forms for x in word]
    first = [word[0] for word in forms]
    for k, gap in enumerate(f.gaps):
        for i in range(len(first) - gap[-1]):
            x = (first[i] * mix[1] + k + 1) % whole
            for g in gap:
                x = ((x ^ x >> 31) * mix[2] + first[i + g]) % whole
            found.append(place(x))
            if gap == (1,) and first[i] == first[i + 1]:
                found.append(place(mix[2]))
    for feature, n in Counter(found).items():
        total += weights.get(feature, 0.0) * ((n / len(found)) ** 0.5 if f.share else 1.0)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def test_fit_holds_little_more_than_its_coordinates():
    """A sample as large as it may be has 30 million coordinates, which took eight bytes each several times over."""
    import tracemalloc

    rng, size = np.random.default_rng(1), 1 << 14
    examples = [(np.append(np.sort(rng.choice(size, 8000, replace=False)), size).astype(np.int32), np.ones(8001, np.float32), float(k % 2))
                for k in range(400)]
    tracemalloc.start()
    at, _, _ = ftrl.fit(examples, size, ftrl.Rates(epochs=1, steps=1, l1=0.0, least_texts=205))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    seen = Counter(c for a, _, _ in examples for c in a[:-1].tolist())
    assert at.tolist() == sorted(c for c, n in seen.items() if n >= 205)
    assert peak < 1.5 * sum(a.nbytes + x.nbytes for a, x, _ in examples)


@pytest.mark.parametrize("module, query, fit, remainder", [(toxicity, toxicity.op4_toxicity, toxicity.fit_toxicity, (3, 1)),
                                                           (quality_classifier, quality_classifier.op10_quality_classifier, quality_classifier.fit_quality, (4, 2))])
def test_whole_query_against_plain_loops(spark, module, query, fit, remainder):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = lambda i: zlib.crc32(str(i).encode()) % remainder[0] == remainder[1]
    seen = [r["doc_id"] for r in labels.select("doc_id").collect() if not held(r["doc_id"])]
    model = fit(docs, labels.where(labels.doc_id.isin(seen)))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = query(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = naive_score(model, texts[r["doc_id"]])
        assert r["score"] == pytest.approx(want, abs=1e-5) and r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.7)


def test_sample_is_bounded_in_rows_and_bytes(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('word ', 20 + cast(id % 7 as int)) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as label")
    rows = ftrl.sample(docs, labels, "doc_id", "text", 100, 1 << 20).collect()
    assert len(rows) == 100 and sum(r["label"] for r in rows) == 50
    few = ftrl.sample(docs, labels, "doc_id", "text", 100, 4000).collect()
    sizes = [sum(len(r["text"]) for r in few if r["label"] == y) for y in (0, 1)]
    assert all(1500 < s <= 2000 for s in sizes) and {r["id"] for r in few} <= {r["id"] for r in rows}


def test_features_stay_within_their_text():
    table = ftrl.WordTable(toxicity.forms)
    alone, _ = toxicity.FEATURES.split(["a b c"], table)
    both, doc = toxicity.FEATURES.split(["a b c", None, "", "d e"], table)
    assert sorted(both[doc == 0]) == sorted(alone) and set(doc) == {0, 3}
    assert len(both[doc == 3]) == 2 * 5 + 1  # five forms of two words, one pair
