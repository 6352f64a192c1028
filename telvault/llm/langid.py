"""Language identification by a linear-chain conditional random field over words.

Each word of a text has a language; neighbours depend on each other by learned
transitions. A word's features are its first and last characters (affixes), its
character n-grams, itself, and whether it is in the lexicon of a language (words
that the training texts of one language have far more often than the others).
Training texts are cut into runs of words and put together anew across
languages, so that the transitions are learned from switches. Forward-backward
gives each word's chances, and a text's language is the one with the largest
sum over its words.

A batch of texts is one long chain with a fresh start at each text. It is cut into
blocks whose transfer matrices are taken together, so the recurrences run over
whole arrays and a very long text costs no more per word than a short one.

Defined results: of languages with equal sums the first by name is said; null
texts and texts without a letter are ``und`` with score 0, as is all if there is nothing to learn from; repeated rows repeat; null languages
are not learned from; further columns are dropped.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telvault.llm.bpe import pieces_of
from telvault.llm.common import crc32_text, quoted, shared_table

TRAIN_ROWS = 600  # bound of the texts that are learned from, for each language
LANGUAGES = 500  # more are refused: the model holds weights for each
BITS = 18
BLOCK = 48  # words of a block of the chain
STEP = 20_000  # words of a training step
EPOCHS = 2
RATE = 0.15
CACHED = 400_000  # words of a worker's cache
LETTER = regex.compile(r"\p{L}")
WORDS = re.compile(r"[^\W\d_]+")  # runs of letters


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word."""
    framed = f"<{word}>"
    out = [f"w{word}"]
    out += [f"p{word[:k]}" for k in (1, 2, 3) if k <= len(word)]
    out += [f"s{word[-k:]}" for k in (1, 2, 3, 4) if k <= len(word)]
    out += [f"g{framed[k:k + 3]}" for k in range(len(framed) - 2)]
    return [zlib.crc32(x.encode()) >> (32 - BITS) for x in out]


class Chain:
    """Forward-backward over one long chain of words in blocks."""

    def __init__(self, transitions: np.ndarray, begin: np.ndarray):
        self.a, self.pi = np.exp(transitions - transitions.max()), np.exp(begin - begin.max())

    def run(self, emissions: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(posteriors, expected transitions, expected begins); ``starts`` marks the first word of each text."""
        n, k = emissions.shape
        blocks = -(-n // BLOCK)
        psi = np.ones((blocks * BLOCK, k))
        psi[:n] = np.exp(emissions - emissions.max(axis=1, keepdims=True))
        first = np.zeros(blocks * BLOCK, bool)
        first[:n] = starts
        first[n:] = True  # padding: texts of one word
        psi, first = psi.reshape(blocks, BLOCK, k), first.reshape(blocks, BLOCK)

        def forward(v, t):  # v: (blocks, rows, k)
            moved = v @ self.a
            f = first[:, t]
            if f.any():
                moved[f] = v[f].sum(axis=2, keepdims=True) * self.pi
            moved *= psi[:, t, None, :]
            return moved / moved.max(axis=(1, 2), keepdims=True)

        through = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
        for t in range(BLOCK):
            through = forward(through, t)
        ahead, behind = np.ones((blocks, k)), np.ones((blocks, k))
        for b in range(1, blocks):
            v = ahead[b - 1] @ through[b - 1]
            ahead[b] = v / v.sum()
        for b in range(blocks - 2, -1, -1):
            v = through[b + 1] @ behind[b + 1]
            behind[b] = v / v.sum()
        alpha, before = np.empty((blocks, BLOCK, k)), np.empty((blocks, BLOCK, k))
        v = ahead[:, None, :]
        for t in range(BLOCK):
            before[:, t] = v[:, 0]
            v = forward(v, t)
            alpha[:, t] = v[:, 0]
        beta, v = np.empty((blocks, BLOCK, k)), behind
        for t in range(BLOCK - 1, -1, -1):
            beta[:, t] = v
            w = v * psi[:, t]
            v = w @ self.a.T
            f = first[:, t]
            if f.any():
                v[f] = (w[f] @ self.pi)[:, None]
            v = v / v.max(axis=1, keepdims=True)
        post = alpha * beta
        post /= post.sum(axis=2, keepdims=True)
        # a pair's chance is before[i] a[i, j] psi[j] beta[j], made to sum to one
        inner = ~first.reshape(-1)
        left, right = before.reshape(-1, k)[inner], (psi * beta).reshape(-1, k)[inner]
        total = np.einsum("ni,ij,nj->n", left, self.a, right)
        moves = self.a * ((left / total[:, None]).T @ right)
        post = post.reshape(-1, k)[:n]
        return post, moves, post[starts].sum(axis=0)


def code_switched(texts: list[tuple[list[str], int]], rng: np.random.Generator) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(words, languages, starts): the texts in runs of 5 to 40 words, some runs kept in place and some dealt among the texts."""
    words, langs, starts, loose = [], [], [], []
    for said, lang in texts:
        at, first = 0, True
        while at < len(said):
            n = int(rng.integers(5, 41))
            run = said[at:at + n]
            at += n
            if loose and rng.random() < 0.15:
                k = int(rng.integers(len(loose)))
                loose[k], (run, own) = (run, lang), loose[k]
            elif len(loose) < 50 and rng.random() < 0.15:
                loose.append((run, lang))
                continue
            else:
                own = lang
            words += run
            langs += [own] * len(run)
            starts += [first] + [False] * (len(run) - 1)
            first = False
    for run, lang in loose:
        words += run
        langs += [lang] * len(run)
        starts += [True] + [False] * (len(run) - 1)
    return words, np.array(langs, np.int64), np.array(starts, bool)


def lexicon(texts: list[tuple[list[str], int]], k: int) -> dict[str, int]:
    """Words that at least three texts of one language have and, for their number, others nearly never."""
    counts: dict[str, np.ndarray] = {}
    size = np.zeros(k)
    for said, lang in texts:
        size[lang] += 1
        for w in set(said):
            if w not in counts:
                counts[w] = np.zeros(k)
            counts[w][lang] += 1
    out = {}
    for w, c in counts.items():
        share = c / np.maximum(size, 1)
        if c.max() >= 3 and share.max() >= 0.9 * share.sum():
            out[w] = int(share.argmax())
    return out


class Words(dict):
    """Row of each known word in ``emissions``."""

    def __init__(self, theta: np.ndarray, members: dict[str, int]):
        self.theta, self.members, k = theta, members, theta.shape[1]
        self.emissions, self.new = np.zeros((1024, k), np.float64), []

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.new.append(word)
        return row

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self) > CACHED:
            self.clear()
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        while len(self) > len(self.emissions):
            self.emissions = np.concatenate([self.emissions, np.zeros_like(self.emissions)])
        if self.new:
            hashed = [word_features(w, self.members) for w in self.new]
            cuts = np.cumsum([0] + [len(h) for h in hashed[:-1]])
            self.emissions[len(self) - len(self.new):len(self)] = np.add.reduceat(self.theta[np.concatenate(hashed)], cuts)
            self.new = []
        return rows


def word_features(word: str, members: dict[str, int]) -> np.ndarray:
    """Features, and behind the hashed ones that of the lexicon the word is in."""
    lang = members.get(word)
    return np.array(features(word) + ([] if lang is None else [(1 << BITS) + lang]))


def train(texts: list[tuple[list[str], int]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
    """(feature weights, transitions, begins, lexicon) by adaptive gradient steps on the log likelihood."""
    rng = np.random.default_rng(5)
    members = lexicon(texts, k)
    theta = np.zeros(((1 << BITS) + k, k))
    moves, begin = np.zeros((k, k)), np.zeros(k)
    squares = [np.full_like(x, 1e-8) for x in (theta, moves, begin)]
    known: dict[str, np.ndarray] = {}
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        words, langs, starts = code_switched([texts[i] for i in order], rng)
        for at in range(0, len(words), STEP):
            part, y, first = words[at:at + STEP], langs[at:at + STEP], starts[at:at + STEP].copy()
            first[0] = True
            types: dict[str, int] = {}
            row = np.array([types.setdefault(w, len(types)) for w in part])
            for w in types:
                if w not in known:
                    known[w] = word_features(w, members)
            hashed = [known[w] for w in types]
            flat, sizes = np.concatenate(hashed), np.array([len(h) for h in hashed])
            cuts = np.concatenate([[0], np.cumsum(sizes[:-1])])
            emissions = np.add.reduceat(theta[flat], cuts)[row]
            post, pairs, begins = Chain(moves, begin).run(emissions, first)
            gold = np.zeros_like(post)
            gold[np.arange(len(y)), y] = 1
            diff = gold - post
            by_type = np.stack([np.bincount(row, diff[:, j], minlength=len(types)) for j in range(k)], axis=1)
            spread = np.repeat(by_type, sizes, axis=0)
            used, place = np.unique(flat, return_inverse=True)
            grad = np.stack([np.bincount(place, spread[:, j], minlength=len(used)) for j in range(k)], axis=1)
            inner = ~first
            inner[0] = False
            gold_pairs = np.zeros((k, k))
            np.add.at(gold_pairs, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
            gold_begins = np.bincount(y[first], minlength=k)
            squares[0][used] += grad * grad
            theta[used] += RATE * grad / np.sqrt(squares[0][used])
            for x, g, s in ((moves, gold_pairs - pairs, squares[1]), (begin, gold_begins - begins, squares[2])):
                s += g * g
                x += RATE * g / np.sqrt(s)
    return theta, moves, begin, members


_LOADED: dict[str, Words] = {}


@dataclass
class LanguageModel:
    languages: list[str]
    parts: object = None  # broadcast of the features' numbers and weights, transitions, begins and lexicon
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def words(self) -> tuple[Words, Chain]:
        used, weights, moves, begin, members = self.parts.value
        if self.name not in _LOADED:
            _LOADED.clear()
            theta = np.zeros(((1 << BITS) + len(self.languages), len(self.languages)))
            theta[used] = weights
            _LOADED[self.name] = Words(theta, members)
        return _LOADED[self.name], Chain(moves, begin)

    def word_chances(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray]:
        """(words of each text, chances of the languages for all words one after the other)."""
        words, chain = self.words()
        said = [WORDS.findall(t.lower()) if t and LETTER.search(t) else [] for t in texts]
        flat = [w for s in said for w in s]
        if not flat:
            return said, np.zeros((0, len(self.languages)))
        starts = np.zeros(len(flat), bool)
        starts[np.cumsum([0] + [len(s) for s in said if s][:-1])] = True
        rows = words.rows(flat)
        return said, chain.run(words.emissions[rows], starts)[0]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        said, chances = self.word_chances(texts)
        doc = np.repeat(np.arange(len(texts)), [len(s) for s in said])
        sums = np.stack([np.bincount(doc, chances[:, j], minlength=len(texts)) for j in range(len(self.languages))], axis=1)
        total = sums.sum(axis=1)
        score = np.clip(np.divide(sums.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0), 0, 1)
        best = sums.argmax(axis=1)
        return [self.languages[b] if t > 0 else "und" for b, t in zip(best, total)], score

    def label(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(id, lang_pred, score) per row."""
        kind = df.schema[id_col].dataType.simpleString()

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in pieces_of(batch, 1 << 20):
                    lang, score = self.predict(b.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                     names=["id", "lang_pred", "score"])

        return df.select(F.col(id_col).alias("id"), text_col).mapInArrow(
            mapped, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_ROWS) -> LanguageModel:
    """Learn from at most ``most`` texts of each language, those with the smallest hash of the id, whole. More than
    ``LANGUAGES`` languages are an error."""
    spark = docs.sparkSession
    ids = docs.where(quoted(lang_col).isNotNull() & quoted(text_col).isNotNull()).select(
        quoted(lang_col).alias("lang"), quoted(id_col).alias("id"), F.xxhash64(quoted(id_col)).alias("at"))
    ids = shared_table(ids, "ids")
    sizes = shared_table(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "sizes")
    languages = sorted(r["lang"] for r in sizes.select("lang").limit(LANGUAGES + 1).collect())
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: map rare ones to null or to a common name first")
    if not languages:
        return LanguageModel([], spark.sparkContext.broadcast(None))
    # a hash is even over its range, so four times as many rows as wanted lie below a known bound; the window then
    # holds no language whole
    below = (F.col("at") / F.lit(2.0 ** 64) + 0.5) * F.col("n") <= F.lit(4.0 * most + 100)
    first = Window.partitionBy("lang").orderBy("at", "id")
    chosen = ids.join(F.broadcast(sizes), "lang").where(below).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)
    chosen = F.broadcast(shared_table(chosen.select("lang", F.col("id").alias("chosen_id")).distinct(), "chosen"))
    rows = docs.join(chosen, (docs[lang_col] == chosen["lang"]) & docs[id_col].eqNullSafe(chosen["chosen_id"])).select(
        chosen["lang"].alias("lang"), F.col(text_col).alias("text"))
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("text"), "lang").limit(most * len(languages))
    number = {x: k for k, x in enumerate(languages)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = []
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                said = WORDS.findall(text.lower())
                if said:
                    texts.append((said, number[lang]))
        theta, moves, begin, members = train(texts, len(languages))
        used = np.flatnonzero(np.abs(theta).max(axis=1) > 0.02)
        part = lambda kind, names, at, values: pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(at), pa.string()), pa.array(names, pa.string()), pa.array(at, pa.int64()), pa.array(values, pa.list_(pa.float64()))],
            names=["kind", "name", "at", "values"])
        yield part("weight", [None] * len(used), used, list(theta[used]))
        yield part("move", [None] * len(moves), np.arange(len(moves)), list(moves))
        yield part("begin", [None], [0], [begin])
        yield part("lexicon", list(members), list(members.values()), [None] * len(members))

    got = rows.mapInArrow(task, "kind string, name string, at long, values array<double>").toArrow()  # bounded by the sample's words and 2**BITS
    got = {k: got.filter(pa.compute.equal(got["kind"], k)) for k in ("weight", "move", "begin", "lexicon")}
    matrix = lambda t: np.array(t["values"].to_pylist(), np.float64).reshape(-1, len(languages))
    members = dict(zip(got["lexicon"]["name"].to_pylist(), got["lexicon"]["at"].to_pylist()))
    order = np.argsort(got["move"]["at"].to_numpy())
    parts = got["weight"]["at"].to_numpy(), matrix(got["weight"]), matrix(got["move"])[order], matrix(got["begin"])[0], members
    return LanguageModel(languages, spark.sparkContext.broadcast(parts))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = crc32_text(F.col("doc_id")) % 5 == 0
    model = fit_languages(docs.where(~held_out))
    return model.label(docs, "doc_id", "text").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
