import itertools
import re
import zlib

import numpy as np

from telvault.llm import langid

SF = "/root/testdata/sf0.01"


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    for k, n in ((1, 4), (2, 7), (3, 6)):
        e, a, pi = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
        starts = np.array([True] + [x == 3 for x in range(1, n)])
        post, moves, begins = langid.Chain(a, pi).run(e, starts)
        want, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
        for path in itertools.product(range(k), repeat=n):
            s = sum(e[t, y] + (pi[y] if starts[t] else a[path[t - 1], y]) for t, y in enumerate(path))
            total += np.exp(s)
            for t, y in enumerate(path):
                want[t, y] += np.exp(s)
                if not starts[t]:
                    pairs[path[t - 1], y] += np.exp(s)
        np.testing.assert_allclose(post, want / total, atol=1e-9)
        np.testing.assert_allclose(moves, pairs / total, atol=1e-9)
        np.testing.assert_allclose(begins, (want / total)[starts].sum(axis=0), atol=1e-9)


def test_long_chain_does_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    e, a, pi = rng.normal(size=(500, 4)) * 5, rng.normal(size=(4, 4)), rng.normal(size=4)
    starts = rng.random(500) < 0.02
    starts[0] = True
    post = langid.Chain(a, pi).run(e, starts)[0]
    monkeypatch.setattr(langid, "BLOCK", 7)
    np.testing.assert_allclose(langid.Chain(a, pi).run(e, starts)[0], post, atol=1e-9)


def test_held_out_documents(spark):
    rows = langid.op5_langid(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    assert rows.count() == docs.count()
    held = rows.join(docs, "doc_id").where(r"held_out and lang is not null and (lang_pred <> 'und' or text rlike '\\p{L}')").toPandas()
    assert len(held) > 100 and (held["lang"] == held["lang_pred"]).mean() >= 0.97


def naive_label(model, text):
    """(language, score) by forward-backward over the words of one text, one after the other, in logarithms."""
    used, weights, moves, begin, members = model.parts.value
    theta = dict(zip(used.tolist(), weights))
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not words:
        return "und", 0.0
    none = np.zeros(len(model.languages))
    hashed = [langid.features(w) + ([(1 << langid.BITS) + members[w]] if w in members else []) for w in words]
    e = np.array([sum((theta.get(f, none) for f in h), none) for h in hashed])
    ahead, behind = [begin + e[0]], [none]
    for t in range(1, len(words)):
        ahead.append(np.logaddexp.reduce(ahead[-1][:, None] + moves, axis=0) + e[t])
    for t in range(len(words) - 1, 0, -1):
        behind.append(np.logaddexp.reduce(moves + (e[t] + behind[-1])[None, :], axis=1))
    both = np.array(ahead) + np.array(behind[::-1])
    sums = np.exp(both - np.logaddexp.reduce(both, axis=1, keepdims=True)).sum(axis=0)
    return model.languages[int(sums.argmax())], sums.max() / len(words)


def test_whole_query_against_plain_loops(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in docs.select("doc_id").collect()}
    model = langid.fit_languages(docs.where(docs.doc_id.isin([i for i, h in held.items() if not h])))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = langid.op5_langid(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        lang, score = naive_label(model, texts[r["doc_id"]])
        assert (r["lang_pred"], r["held_out"]) == (lang, held[r["doc_id"]])
        np.testing.assert_allclose(r["score"], score, atol=1e-6)


def test_words_of_code_switched_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_languages(docs)
    de, es = (docs.where(f"lang = '{x}' and n_chars between 1500 and 4000").orderBy("doc_id").first()["text"] for x in ("de", "es"))
    said, chances = model.word_chances([" ".join(de.split()[:25] + es.split()[:25] + de.split()[25:50])])
    best = [model.languages[k] for k in chances.argmax(axis=1)]
    n, m = (len(langid.WORDS.findall(" ".join(t.split()[:25]).lower())) for t in (de, es))
    assert best[:n].count("de") >= 0.9 * n and best[n:n + m].count("es") >= 0.9 * m and best[n + m:].count("de") >= 0.9 * len(best[n + m:])


def test_messy_rows(spark, messy, empty):
    model = langid.fit_languages(messy, most=30)
    rows = {(r["doc_id"], r["text"]): None for r in messy.collect()}
    got = model.label(messy, "doc_id", "text").collect()
    assert len(got) == messy.count() and {r["lang_pred"] for r in got} <= {"en", "fr", "und"} and all(0 <= r["score"] <= 1 for r in got)
    none = model.label(messy.where("text is null or not text rlike '\\\\p{L}'"), "doc_id", "text").collect()
    assert none and {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)} and rows
    assert model.label(empty, "doc_id", "text").count() == 0
    unlearned = langid.fit_languages(empty)
    assert {r["lang_pred"] for r in unlearned.label(messy, "doc_id", "text").collect()} == {"und"}
    numbers = model.predict(["², ½ 12", "漢字", "a"])[0]
    assert numbers[0] == "und" and "und" not in numbers[1:]
