"""Logistic regression over hashed features by FTRL-proximal updates.

The learner sees examples one at a time. Each coordinate has a rate of its own
that falls with its gradients, and L1 holds coordinates with little evidence at
exactly zero, so a fitted model is a short list of weights. Fitting runs in one
task over a sample whose bounds, in rows and in bytes of text, are parameters; the
texts are split into features where they lie, and only these go to that task, as
flat arrays. Scoring maps Arrow batches.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.llm.bpe import pieces_of
from telvault.llm.common import give_back, hold, quoted, shared_table

MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
CACHED = 200_000  # words of a worker's cache
SLICE = 1 << 18  # bytes of text that a worker splits at a time
MOST_BYTES = 64 << 20  # of text that a model is fitted on
BLOCK = 1 << 18  # coordinates that are looked up at a time


class WordTable(dict):
    """Row of each known word in ``hashes``: 64-bit hashes of the forms that ``forms`` gives."""

    def __init__(self, forms: Callable[[str], tuple[str, ...]]):
        self.forms = forms
        self.hashes = np.zeros((1024, len(forms("a"))), np.uint64)

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        self.hashes[row] = [zlib.crc32(f"{k}{x}".encode()) for k, x in enumerate(self.forms(word))]
        self[word] = row
        return row

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self) > CACHED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def grams(hashes: np.ndarray, doc: np.ndarray, gaps: tuple[tuple[int, ...], ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, document) of each form of each word, and of the words at each tuple of distances in one document."""
    features, docs = [], []
    with np.errstate(over="ignore"):
        def put(x, d):
            x = (x ^ (x >> np.uint64(29))) * MIX[3]
            features.append((x >> np.uint64(64 - bits)).astype(np.int64))
            docs.append(d)
        for form in range(hashes.shape[1]):
            put(hashes[:, form] * MIX[0], doc)
        first = hashes[:, 0]
        for k, gap in enumerate(gaps):
            far = gap[-1]
            if len(first) <= far:
                continue
            n = len(first) - far
            x = first[:n] * MIX[1] + np.uint64(k + 1)
            for g in gap:
                x = (x ^ (x >> np.uint64(31))) * MIX[2] + first[g:g + n]
            near = doc[:n] == doc[far:]
            put(x[near], doc[:n][near])
            if gap == (1,):  # a word that follows itself, whichever it is
                near &= first[:n] == first[1:]
                put(np.full(int(near.sum()), MIX[2]), doc[:n][near])
    return np.concatenate(features), np.concatenate(docs)


@dataclass(frozen=True)
class Features:
    """What a model looks at. ``words`` splits a text, ``forms`` gives a word's spellings (the first one is also
    used in n-grams), ``gaps`` the distances of n-grams and skip-grams. ``share``: a feature's value is the root of
    its share of the text's features, else 1 for each that occurs."""

    words: Callable[[str], list[str]]
    forms: Callable[[str], tuple[str, ...]]
    gaps: tuple[tuple[int, ...], ...]
    share: bool
    bits: int = 20

    def split(self, texts: list[str | None], table: WordTable) -> tuple[np.ndarray, np.ndarray]:
        words, counts = [], []
        for t in texts:
            got = self.words(t) if t else []
            counts.append(len(got))
            words += got
        rows = table.rows(words)
        return grams(table.hashes[rows], np.repeat(np.arange(len(texts)), counts), self.gaps, self.bits)

    def values(self, features: np.ndarray, docs: np.ndarray, per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (document, feature) and its value."""
        key, n = np.unique(docs * (1 << self.bits) + features, return_counts=True)
        doc = key >> self.bits
        return doc, key & ((1 << self.bits) - 1), np.sqrt(n / per_doc[doc]) if self.share else np.ones(len(key))


@dataclass(frozen=True)
class Rates:
    alpha: float = 0.05
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 3  # at least
    steps: int = 25_000  # at least, as far as ``most_epochs`` allow
    least_texts: int = 5  # a feature that fewer examples have is not learned
    most_epochs: int = 12  # over a small sample


def fit(examples: list[tuple[np.ndarray, np.ndarray, float]], size: int, rates: Rates) -> tuple[np.ndarray, np.ndarray, float]:
    """``fit_parts`` of (coordinates, values, label) tuples."""
    parts = [(e[0].astype(np.int32), e[1].astype(np.float32)) for e in examples]
    return fit_parts(parts, [len(e[0]) for e in examples], np.array([e[2] for e in examples], np.float32), size, rates)


def frequent(parts: list[tuple[np.ndarray, np.ndarray | None]], sizes: list[int], size: int, least: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """The coordinates that at least ``least`` examples have (and ``size``, the bias) and their values, one after the other,
    and where each example ends. ``parts`` are emptied on the way, so that memory holds little more than the coordinates
    themselves: indexing by all of them at once would take eight bytes for each, several times over."""
    seen = np.zeros(size + 1, np.int64)
    for at, _ in parts:
        for k in range(0, len(at), BLOCK):
            seen += np.bincount(at[k:k + BLOCK], minlength=size + 1)
    often = seen >= least
    often[size] = True
    found, values = [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
    ends, counts = [0], iter(sizes)
    parts.reverse()
    while parts:
        at, x = parts.pop()
        kept = np.concatenate([often[at[k:k + BLOCK]] for k in range(0, max(1, len(at)), BLOCK)])
        first = 0
        while first < len(at):
            n = next(counts)
            ends.append(ends[-1] + int(np.count_nonzero(kept[first:first + n])))
            first += n
        found.append(at[kept])
        if x is not None:
            values.append(x[kept])
    return np.concatenate(found), np.concatenate(values) if len(values) > 1 else None, ends[1:]


def fit_parts(parts: list[tuple[np.ndarray, np.ndarray | None]], sizes: list[int], labels: np.ndarray, size: int, rates: Rates) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, bias) from ``parts``, which hold whole examples' coordinates and values (None: all 1) one after
    the other and are emptied, and the examples' ``sizes``. The bias is coordinate ``size``, without L1. Examples weigh so
    that both labels count alike, a rare one ten times at most. Passes: ``epochs``, or as many as ``steps`` examples take, within ``most_epochs``."""
    at, x, ends = frequent(parts, sizes, size, rates.least_texts)
    ones = float(labels.sum())
    weight = [min(10.0, len(labels) / (2 * max(1, c))) if len(labels) else 1.0 for c in (len(labels) - ones, ones)]
    epochs = max(rates.epochs, min(rates.most_epochs, -(-rates.steps // max(1, len(labels)))))
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    l1 = np.full(size + 1, rates.l1)
    l1[size] = 0.0

    def weights(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((rates.beta + np.sqrt(n)) / rates.alpha + rates.l2))

    spans = [slice(a, b) for a, b in zip([0, *ends[:-1]], ends)]
    for _ in range(epochs):
        for span, y in zip(spans, labels.tolist()):
            c = at[span]
            zc, nc = z[c], n[c]
            w = weights(zc, nc, l1[c])
            v = 1.0 if x is None else x[span]
            g = weight[int(y)] * (1 / (1 + np.exp(-np.clip((w * v).sum(), -30, 30))) - y) * v
            z[c] = zc + g - (np.sqrt(nc + g * g) - np.sqrt(nc)) / rates.alpha * w
            n[c] = nc + g * g
    w = weights(z, n, l1)
    found = np.flatnonzero(w[:size])
    return found, w[found], float(w[size])


_LOADED: dict[str, tuple[WordTable, np.ndarray]] = {}


@dataclass
class Model:
    features: Features
    weights: object = None  # broadcast of (coordinates, weights, bias)
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Chance of label 1: a sparse dot product per text."""
        at, w, bias = self.weights.value
        if self.name not in _LOADED:
            _LOADED.clear()
            dense = np.zeros(1 << self.features.bits, np.float32)
            dense[at] = w
            _LOADED[self.name] = WordTable(self.features.forms), dense
        table, dense = _LOADED[self.name]
        feature, doc = self.features.split(texts, table)
        per_doc = np.bincount(doc, minlength=len(texts))
        known = dense[feature] != 0
        doc, feature, x = self.features.values(feature[known], doc[known], per_doc)
        total = bias + np.bincount(doc, dense[feature] * x, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def score(self, df: DataFrame, keep: list[str], text_col: str, name: str = "score") -> DataFrame:
        """The columns ``keep`` and the score (0 to 1), called ``name``, per row. A text that is kept is sent once."""
        sent = [*keep, *([] if text_col in keep else [text_col])]
        where, kept = sent.index(text_col), len(keep)
        names = [*(f"c{k}" for k in range(kept)), "score"]

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hold("ftrl", _LOADED.clear)
            for batch in batches:
                for b in pieces_of(batch, SLICE):
                    score = pa.array(self.scores(b.column(where).to_pylist()), pa.float64())
                    yield pa.RecordBatch.from_arrays([*b.columns[:kept], score], names=names)
            give_back()

        schema = T.StructType([T.StructField(f"c{k}", df.schema[c].dataType) for k, c in enumerate(keep)] + [T.StructField("score", T.DoubleType())])
        rows = df.select(*[quoted(c).alias(f"c{k}") for k, c in enumerate(sent)])
        return rows.mapInArrow(mapped, schema).toDF(*keep, name)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int, most_bytes: int) -> DataFrame:
    """Written (id, label, text): of each label (0, 1) the ``most / 2`` rows with the smallest hash of the id, of these, in
    that order, as many whole texts as ``most_bytes / 2`` bytes hold. Of rows that repeat an id the greatest text counts."""
    known = labels.toDF("id", "label").where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    chosen = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(most // 2) for y in (0, 1)]
    # at most ``most`` pairs of an id and a label
    chosen = F.broadcast(shared_table(chosen[0].unionAll(chosen[1]), "sample"))
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).join(chosen, "id")
    rows = shared_table(rows.groupBy("id", "label").agg(F.max("text").alias("text")), "sampled")
    # the window is over ``most`` pairs of an id and a size at most
    so_far = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    sizes = rows.select("id", "label", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    within = sizes.withColumn("size", F.sum("size").over(so_far)).where(F.col("size") <= most_bytes // 2)
    return rows.join(F.broadcast(within.select("id")), "id", "left_semi")


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, features: Features, rates: Rates, most: int,
          most_bytes: int = MOST_BYTES) -> Model:
    """Fit on ``labels`` (id, label 0 or 1) joined with ``docs``, on the bounded ``sample`` of them.

    Rows with a null id or label are not learned from; with no rows all scores are 0.5.
    """
    spark, size = docs.sparkSession, 1 << features.bits
    rows = sample(docs, labels, id_col, text_col, most, most_bytes).select("label", F.xxhash64(F.lit("order"), "id").alias("at"), "text")
    packed_names = ["at", "label", "features", "shares"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row's distinct features and, if they are not all 1, their values, as bytes."""
        hold("ftrl", _LOADED.clear)
        table = WordTable(features.forms)
        for batch in batches:
            for b in pieces_of(batch, SLICE):
                texts = b.column(2).to_pylist()
                feature, doc = features.split(texts, table)
                doc, feature, x = features.values(feature, doc, np.bincount(doc, minlength=len(texts)))
                cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
                own = [slice(cuts[k], cuts[k + 1]) for k in range(len(texts))]
                # the bias is the coordinate after the last
                at = [np.append(feature[o], size).astype(np.int32).tobytes() for o in own]
                values = [np.append(x[o], 1.0).astype(np.float32).tobytes() if features.share else None for o in own]
                yield pa.RecordBatch.from_arrays([b.column(1), b.column(0).cast(pa.int32()), pa.array(at, pa.binary()), pa.array(values, pa.binary())], names=packed_names)
        del table
        give_back()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("fit")  # not what scoring left
        parts, sizes, labels = [], [], []
        flat = lambda c, kind: np.frombuffer(b"".join(c.to_pylist()), kind)
        for batch in batches:
            for b in pieces_of(batch, SLICE):
                parts.append((flat(b.column(2), np.int32), flat(b.column(3), np.float32) if features.share else None))
                sizes += [n // 4 for n in pc.binary_length(b.column(2)).to_pylist()]
                labels += b.column(1).to_pylist()
        batch = b = None  # the last one may be as large as all parts
        at, w, bias = fit_parts(parts, sizes, np.array(labels, np.float32), size, rates)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(w, bias), pa.float64())], names=["at", "weight"])
        give_back()

    packed = shared_table(rows.mapInArrow(pack, "at long, label int, features binary, shares binary"), "features")
    packed = packed.repartition(1).sortWithinPartitions("at", "features")
    fitted = packed.mapInArrow(task, "at long, weight double").toPandas()  # at most 2**bits weights
    own = fitted["at"] >= 0
    at, w = fitted["at"][own].to_numpy(), fitted["weight"][own].to_numpy()
    bias = float(fitted["weight"][~own].sum())
    return Model(features, spark.sparkContext.broadcast((at, w, bias)))


WORD = re.compile(r"\w+")
TOKEN = re.compile(r"\w+|[^\w\s]+")
