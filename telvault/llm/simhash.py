"""SimHash near-duplicates, linked by vantage-point trees over Hamming distance.

Fingerprints come from the 3-word shingles of whole texts. Equal fingerprints
are one class, so copies cost nothing further. Two fingerprints that differ in at
most ``bits`` bits agree in one of ``bits + 1`` blocks of theirs, where their
distance is 0. So the classes are dealt by one vantage-point tree for each block:
a node's inside holds those whose block lies within the radius of the vantage
block, and a ball of radius 0 reaches one side only. Each class thus goes to one
shard of each tree, whatever the number of classes. Where one block value alone
outgrows a shard, its classes are split further by whole fingerprints: a class is
then a member of one shard, and visits every other that its ball of ``bits``
reaches (triangle inequality). The trees are built from a bounded sample of
classes; all classes are dealt.

Inside a shard a tree of the same two kinds goes on, and what is left is compared.
So every pair within ``bits`` is met where the larger one is a member of a shard;
a shard gives a spanning forest of its links, and ``common.components`` joins the
forests.

Defined results: null text, empty text and text without words get fingerprint
zero and are linked like any other; a null id takes part in its component but
never names one unless it holds null ids only (then null); repeated rows give
repeated result rows; further columns are dropped (``near_duplicates``) or kept
(``one_of_each``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.llm.bpe import pieces_of
from telvault.llm.common import components, fresh, hold, quoted, shared_table

SHINGLE, SEED, BITS = 3, 42, 3
SHARD_CLASSES = 20_000  # members that a shard is planned to have
SAMPLE_CLASSES = 200_000  # bound of the sample that the dealing tree is built from
LEAF = 400  # members under which an inner tree compares all
BLOCK = 1 << 21  # comparisons at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z only, and the six ASCII white spaces
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[k:k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, keep: list[str], text_col: str, name: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and ``name``, the fingerprint as a signed bigint."""
    rows = df.select(*[quoted(c).alias(f"c{k}") for k, c in enumerate(keep)], quoted(text_col).alias("text"))
    schema = T.StructType([T.StructField(f"c{k}", df.schema[c].dataType) for k, c in enumerate(keep)] + [T.StructField("fp", T.LongType())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("simhash")
        for batch in batches:
            for b in pieces_of(batch, 2 << 20):
                fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(b.num_columns - 1)], np.uint64)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*b.schema.names[:-1], "fp"])

    return rows.mapInArrow(mapped, schema).toDF(*keep, name)


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int64)


def best_split(members: np.ndarray, visitors: np.ndarray, bits: int, rng: np.random.Generator, tries: int = 12) -> tuple[np.uint64, int] | None:
    """Vantage point and radius for which members times visitors, inside plus outside, is least; None if none separates."""
    m = members if len(members) <= 2000 else rng.choice(members, 2000, replace=False)
    q = visitors if len(visitors) <= 2000 else rng.choice(visitors, 2000, replace=False)
    best, least = None, math.inf
    for v in rng.choice(m, min(tries, len(m)), replace=False):
        inside = np.cumsum(np.bincount(distances(m, v), minlength=65))
        near = np.cumsum(np.bincount(distances(q, v), minlength=65))
        r = np.arange(65)
        reach_in = near[np.minimum(r + bits, 64)]
        reach_out = len(q) - np.where(r - bits >= 0, near[np.maximum(r - bits, 0)], 0)
        cost = inside * reach_in + (len(m) - inside) * reach_out
        ok = (inside >= 0.2 * len(m)) & (inside <= 0.8 * len(m)) & (inside < len(m)) & (inside > 0)
        if not ok.any():
            ok = (inside < len(m)) & (inside > 0)
        if ok.any() and cost[ok].min() < least:
            least, best = cost[ok].min(), (np.uint64(v), int(r[ok][cost[ok].argmin()]))
    return best


def block_of(points: np.ndarray, block: tuple[int, int]) -> np.ndarray:
    """Bits [low, high) of each point."""
    low, high = block
    return (points >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)


def blocks(bits: int) -> list[tuple[int, int]]:
    """``bits`` + 1 runs of bits that cover a fingerprint."""
    cuts = [64 * k // (bits + 1) for k in range(bits + 2)]
    return list(zip(cuts, cuts[1:]))


WHOLE = (0, 64)


@dataclass
class Dealer:
    """A tree that deals classes into shards: per node vantage point, radius, the two children (a negative child is the
    shard -1 - child), the bits compared and how far a class's ball reaches there."""

    nodes: list[tuple[int, int, int, int, tuple[int, int], int]]
    n_shards: int

    def shards(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, rows that reach it, whether at home)."""
        if not self.nodes:
            yield 0, np.arange(len(points)), np.ones(len(points), bool)
            return
        stack = [(0, np.arange(len(points)), np.ones(len(points), bool))]
        while stack:
            node, rows, home = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -1 - node, rows, home
                continue
            vantage, radius, inner, outer, block, ball = self.nodes[node]
            d = distances(block_of(points[rows], block), np.uint64(vantage))
            for child, reach, own in ((inner, d <= radius + ball, d <= radius), (outer, d > radius - ball, d > radius)):
                stack.append((child, rows[reach], (home & own)[reach]))


def build_dealer(sample: np.ndarray, n_shards: int, bits: int, block: tuple[int, int] = WHOLE) -> Dealer:
    """A tree of about ``n_shards`` shards, over ``block`` as far as that tells classes apart, then over all bits."""
    rng, nodes, shards = np.random.default_rng(7), [], 0

    def grow(points: np.ndarray, share: float) -> int:
        nonlocal shards
        split = None
        if share > 1 and len(points) > 1:
            for within, ball in ((block, bits if block == WHOLE else 0), (WHOLE, bits)):
                seen = block_of(points, within)
                split = best_split(seen, seen, ball, rng)
                if split is not None:
                    break
        if split is None:
            shards += 1
            return -shards
        at = len(nodes)
        nodes.append(None)
        inside = distances(seen, split[0]) <= split[1]
        inner = grow(points[inside], share * inside.mean())
        outer = grow(points[~inside], share * (~inside).mean())
        nodes[at] = (int(split[0]), split[1], inner, outer, within, ball)
        return at

    grow(sample, n_shards)
    return Dealer(nodes, shards)


class Forest:
    """Union-find over positions, joined a block of pairs at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while True:
            further = self.up[r]
            if (further == r).all():
                return r
            r = further

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))


def link_shard(points: np.ndarray, home: np.ndarray, bits: int, block: tuple[int, int] = WHOLE) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links of members (``home``) with smaller points among all that agree with them
    in ``block`` (in all points, for the whole)."""
    order = np.argsort(points)
    points, home = points[order], home[order]
    parts = block_of(points, block)
    forest, rng = Forest(len(points)), np.random.default_rng(11)
    stack = [(np.flatnonzero(home), np.arange(len(points)), block != WHOLE)]
    while stack:
        members, visitors, apart = stack.pop()
        if not len(members) or not len(visitors):
            continue
        seen, ball = (parts, 0) if apart else (points, bits)
        split = best_split(seen[members], seen[visitors], ball, rng, 6) if len(members) > LEAF else None
        if split is None and apart and len(members) > LEAF:  # one block value
            stack.append((members, visitors, False))
            continue
        if split is None:
            step = max(1, BLOCK // len(members))
            for k in range(0, len(visitors), step):
                v = visitors[k:k + step]
                near = np.bitwise_count(points[v][:, None] ^ points[members][None, :]) <= bits
                i, j = np.nonzero(near)
                a, b = v[i], members[j]
                smaller = a < b
                forest.join(a[smaller], b[smaller])
            continue
        d, e = distances(seen[members], split[0]), distances(seen[visitors], split[0])
        stack.append((members[d <= split[1]], visitors[e <= split[1] + ball], apart))
        stack.append((members[d > split[1]], visitors[e > split[1] - ball], apart))
    root = forest.roots(np.arange(len(points)))
    linked = np.flatnonzero(root != np.arange(len(points)))
    return points[linked].view(np.int64), points[root[linked]].view(np.int64)


def links(classes: DataFrame, bits: int = BITS, shard_classes: int = SHARD_CLASSES) -> DataFrame:
    """Edges (a, b) that connect all ``fp`` (distinct, bigint) within ``bits`` differing bits."""
    spark = classes.sparkSession
    n = classes.count()
    n_shards = max(1, math.ceil(n / shard_classes))
    most = min(SAMPLE_CLASSES, 64 * n_shards)
    # at most SAMPLE_CLASSES fingerprints, by the order of a hash
    sample = classes.orderBy(F.xxhash64("fp"), "fp").limit(most).toPandas()["fp"].to_numpy(np.int64).view(np.uint64) if n_shards > 1 else np.zeros(0, np.uint64)
    # with one shard nothing is to be dealt, and one tree does
    cuts = blocks(bits) if n_shards > 1 else [WHOLE]
    trees = [build_dealer(sample, n_shards, bits, block) for block in cuts]
    first = np.cumsum([0, *(t.n_shards for t in trees)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for k, tree in enumerate(trees):
                for shard, rows, home in tree.shards(points):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), first[k] + shard, np.int32)), pa.array(points[rows].view(np.int64)),
                                                      pa.array(home)], names=["shard", "fp", "home"])

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        block = cuts[int(np.searchsorted(first, pdf["shard"].iloc[0], side="right")) - 1]
        a, b = link_shard(pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["home"].to_numpy(bool), bits, block)
        return pd.DataFrame({"a": a, "b": b})

    width = max(int(first[-1]), spark.sparkContext.defaultParallelism)
    dealt = classes.select("fp").repartition(width, "fp").mapInArrow(deal, "shard int, fp bigint, home boolean")
    # a stated width: shards are heavy to work on and light in bytes, by which they would be put together
    return dealt.repartition(2 * width, "shard").groupBy("shard").applyInPandas(link, "a bigint, b bigint")


def _resolve(df: DataFrame, id_col: str, text_col: str, shingle: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Written tables (id, h, fp) per row, h being the text's hash, and (fp, label) per class."""
    rows = df.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("h"), quoted(text_col).alias("text"))
    rows = shared_table(fingerprints(rows, ["id", "h"], "text", shingle=shingle), "fingerprints")
    classes = shared_table(rows.select("fp").distinct(), "classes")
    nodes = components(shared_table(links(classes, bits), "links"))
    labelled = classes.join(nodes, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("label", "fp").alias("label"))
    return rows, shared_table(labelled, "labelled")


def near_duplicates(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(id, fp, component_id) per row: the component's smallest id."""
    rows, labelled = _resolve(df, id_col, text_col, shingle, bits)
    least = rows.groupBy("fp").agg(F.min("id").alias("least")).join(labelled, "fp")
    names = least.groupBy("label").agg(F.min("least").alias("component_id"))
    named = shared_table(labelled.join(names, "label").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def one_of_each(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row of each component, with the columns of ``df``: that with the smallest id (null ids last); of rows that
    repeat the id, that with the smallest hash of its text; of rows that repeat both, the smallest by all columns."""
    rows, labelled = _resolve(df, id_col, text_col, shingle, bits)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("first")
    keep = rows.join(labelled, "fp").groupBy("label").agg(first).select("first.id", "first.h").distinct()
    times = rows.groupBy("id", "h").agg((F.count(F.lit(1)) > 1).alias("again")).where("again")
    k, t = keep.alias("k"), times.alias("t")
    keep = shared_table(k.join(t, F.col("k.id").eqNullSafe(F.col("t.id")) & (F.col("k.h") == F.col("t.h")), "left")
                        .select("k.id", "k.h", F.coalesce("t.again", F.lit(False)).alias("again")), "keep")

    own_id, own_h = fresh("_id", df), fresh("_h", df)
    rows = df.select("*", quoted(id_col).alias(own_id), F.xxhash64(quoted(text_col)).alias(own_h))

    def among(which: DataFrame) -> DataFrame:
        w = which.select(F.col("id").alias("_w1"), F.col("h").alias("_w2")).alias("w")
        return rows.alias("d").join(w, F.col(f"d.{own_id}").eqNullSafe(F.col("w._w1")) & (F.col(f"d.{own_h}") == F.col("w._w2")), "left_semi")

    mine = [quoted(c) for c in df.columns]
    once = among(keep.where("not again")).select(*mine)
    if keep.where("again").isEmpty():
        return once
    # aggregated, so that rows that repeat by the million are never together
    order = [quoted(c.name) for c in df.schema if not isinstance(c.dataType, (T.MapType, T.VariantType))]
    first = among(keep.where("again")).groupBy(own_id, own_h).agg(F.min_by(F.struct(*mine), F.struct(*order)).alias("row"))
    return once.unionAll(first.select("row.*"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
