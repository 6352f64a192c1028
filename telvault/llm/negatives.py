"""Hard-negative mining by anchor-clustered shared lists.

Anchors are clustered by direction. For a cluster with centre c whose members
lie within an angle t of it, no member a has an inner product with a candidate v
above |a| |v| cos(max(0, angle(c, v) - t)). Each cluster sorts the candidates once
by the factor |v| cos(...), and all its members walk that one list. A member
stops when the bound of what is left can no longer matter to it: below its last
positive's score, or below what its negatives need. So results are exact.

A list holds (cluster, position, vec_id, bound) only, sorted by range and written
in slices that grow by ``GROWTH``. A round takes the next slice of the clusters
that still have members walking, joins it with the vectors, and multiplies blocks
of ``BLOCK`` candidates with groups of ``GROUP`` members: neither a cluster nor a
list comes into one task. What a round finds is merged into the members' best
rows, which are written, and the members whose end is certified leave the walk.
Positives are walked for first; the negatives' walk starts with their scores.

Collected or sent to tasks are the centres (``CLUSTERS`` at most, fitted on at
most ``SAMPLE`` anchors; all anchors are assigned), their angles and the bounds
at which slices begin; the anchors themselves move as rows.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component take no part; of rows that repeat an id the least by (label,
vector) counts; missing components of shorter vectors are zeros; an anchor with
no positive, or a positive without negatives, has no rows; no anchor or an empty
table gives no rows; vectors whose products could exceed 2^53 raise an error;
further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telvault.llm.common import gapless_position, quoted, shared_table

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score that a negative's lies between
SCALE = 256
CLUSTERS = 8  # lists, each as long as the table
SAMPLE = 4096  # anchors that the centres are fitted on
FIRST, GROWTH = 4096, 4  # length of the first slice, and how much longer each next one is
BLOCK, GROUP = 4096, 512  # candidates and members that are multiplied at a time


def vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """Written (id, label, v, norm) of the rows that take part; v: array<double> of the floored components."""
    x = quoted(vector_col)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = df.where(quoted(id_col).isNotNull() & quoted(label_col).isNotNull() & x.isNotNull() & fine).select(
        quoted(id_col).cast("bigint").alias("id"), quoted(label_col).cast("bigint").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("v"))
    rows = shared_table(rows, "vectors")
    twice = rows.groupBy("id").count().where("count > 1")
    if not twice.isEmpty():
        least = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
        rows = shared_table(least.select("id", "r.label", "r.v"), "vectors")
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))
    longest = rows.agg(F.max("norm")).first()[0] or 0.0
    if longest * longest >= 2.0 ** 53:
        raise ValueError(f"vectors of length {longest:g} have no exact scores")
    return rows


def matrix(cells: list | pd.Series, width: int = 0) -> np.ndarray:
    """Rows of equal length, the shorter ones filled up with zeros."""
    cells = list(cells)
    width = max([width, *map(len, cells)])
    out = np.zeros((len(cells), width))
    for k, c in enumerate(cells):
        out[k, :len(c)] = c
    return out


def unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def angles(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of each row with each centre; 0 for rows of zeros, which have no product with anything."""
    width = max(m.shape[1], centres.shape[1])
    wide = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1])))
    out = np.arccos(np.clip(unit(wide(m)) @ unit(wide(centres)).T, -1, 1))
    out[~m.any(axis=1)] = 0
    return out


def fit_centres(sample: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, begun from rows far apart."""
    points = unit(sample[sample.any(axis=1)])
    if not len(points):
        return np.zeros((1, sample.shape[1] if sample.size else 1))
    centres = points[:1]
    while len(centres) < min(k, len(points)):
        nearest = (points @ centres.T).max(axis=1)
        if nearest.min() > 1 - 1e-12:
            break
        centres = np.concatenate([centres, points[[nearest.argmin()]]])
    for _ in range(rounds):
        home = (points @ centres.T).argmax(axis=1)
        centres = unit(np.array([points[home == c].sum(axis=0) if (home == c).any() else centres[c] for c in range(len(centres))]))
    return centres


def assigned(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Written ``anchors`` (id, label, v, norm) with cluster, angle, and group: GROUP members of a cluster at most."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                a = angles(matrix(b.column(2).to_pylist()), centres)
                home = a.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home), pa.array(a[np.arange(len(a)), home])],
                                                 names=[*b.schema.names, "cluster", "angle"])

    rows = anchors.select("id", "label", "v", "norm").mapInArrow(assign, "id long, label long, v array<double>, norm double, cluster long, angle double")
    rows = gapless_position(rows, ["cluster"], ["id"], "at")
    return shared_table(rows.withColumn("group", F.floor(F.col("at") / GROUP)).drop("at"), "anchors")


def slice_of(position: Column) -> Column:
    """0, 1, 2, ...: slice k holds FIRST * GROWTH^k positions."""
    starts = [FIRST * (GROWTH ** k - 1) // (GROWTH - 1) for k in range(1, 24)]  # 24 slices hold more than 10^17 rows
    return sum(((position >= s).cast("int") for s in starts), F.lit(0))


def sorted_lists(rows: DataFrame, centres: np.ndarray, widest: dict[int, float]) -> DataFrame:
    """Written (cluster, at, id, bound), in a folder for each slice: every cluster's list of all rows, by falling bound."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            norm = b.column(2).to_numpy()
            a = angles(matrix(b.column(1).to_pylist()), centres)
            for c, t in widest.items():
                least = norm * np.cos(np.maximum(0, a[:, c] - t))
                least += 1e-6 * norm  # far more than rounding, of angles near 0 above all, may have taken off
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(norm), c)), b.column(0), pa.array(least), pa.array(-least)],
                                                 names=["cluster", "id", "bound", "falling"])

    lists = rows.select("id", "v", "norm").mapInArrow(bounds, "cluster long, id long, bound double, falling double")
    lists = gapless_position(lists, ["cluster"], ["falling", "id"], "at").drop("falling")
    return shared_table(lists.withColumn("slice", slice_of(F.col("at"))), "lists", "slice")


class Walk:
    """Rounds over the slices of the lists. ``best`` is written after each round."""

    def __init__(self, rows: DataFrame, lists: DataFrame, anchors: DataFrame):
        self.rows, self.lists, self.anchors = rows, lists, anchors
        begin = lists.groupBy("slice", "cluster").agg(F.max("bound").alias("bound")).collect()  # slices * CLUSTERS rows
        self.begin = {(r["slice"], r["cluster"]): r["bound"] for r in begin}
        self.slices = 1 + max((s for s, _ in self.begin), default=-1)

    def left(self, k: int) -> Column:
        """Bound, times the member's length, of what lies behind slice ``k``; null where nothing does."""
        out = F.lit(None).cast("double")
        for (s, c), bound in self.begin.items():
            if s == k + 1:
                out = F.when(F.col("cluster") == c, F.lit(bound)).otherwise(out)
        return out * F.col("norm") + 1e-6

    def scored(self, k: int, members: DataFrame, kernel, schema: str) -> DataFrame:
        """What ``kernel`` (members, candidates, scores) gives of slice ``k``, a block of candidates and a group of members
        at a time."""
        block = F.floor(F.col("at") / BLOCK).alias("block")
        groups = members.groupBy("cluster", "group").agg(F.count(F.lit(1)).alias("members")).drop("members")
        part = self.lists.where(F.col("slice") == k).select("cluster", block, "id")
        blocks = part.select("cluster", "block").distinct()
        # each block meets each group of its cluster: both sides are named by the pair
        pairs = shared_table(blocks.join(groups, "cluster"), "pairs")
        theirs = part.join(pairs, ["cluster", "block"]).join(self.rows, "id").select("cluster", "block", "group", "id", "label", "v")
        ours = members.join(pairs, ["cluster", "group"])

        def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return kernel(a.iloc[:0], b.iloc[:0], np.zeros((0, 0)))
            a, b = a.sort_values("id", ignore_index=True), b.sort_values("id", ignore_index=True)
            width = max(map(len, [*a["v"], *b["v"]]))
            return kernel(a, b, (matrix(a["v"], width) @ matrix(b["v"], width).T).astype(np.int64))

        keys = ["cluster", "block", "group"]
        return ours.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInPandas(run, schema)

    def best(self, kernel, schema: str, keys: list[str], most: int, members: DataFrame, done) -> DataFrame:
        """(keys, other, score): the ``most`` highest scores of each key, ties by the smaller id. ``done`` (members, best,
        left) gives the ids of members that need not walk on."""
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other")
        best = None
        for k in range(self.slices):
            found = self.scored(k, members, kernel, schema)
            best = found if best is None else best.unionAll(found)
            best = best.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most).drop("_rank")
            best = shared_table(best, "best")
            if k + 1 < self.slices:
                ended = done(members, best, self.left(k))
                members = shared_table(members.join(ended, "id", "left_anti"), "members")
                if members.isEmpty():
                    break
        return best


def top(scores: np.ndarray, allowed: np.ndarray, most: int) -> np.ndarray:
    """Positions of the highest allowed scores, of equal ones the first."""
    at = np.flatnonzero(allowed)
    if len(at) > most:
        edge = np.partition(scores[at], -most)[-most]
        at = at[scores[at] >= edge]
    return at[np.argsort(-scores[at], kind="stable")][:most]


def positives(walk: Walk, most: int = POSITIVES) -> DataFrame:
    """(id, other, score): each anchor's highest rows of its label."""

    def kernel(a: pd.DataFrame, b: pd.DataFrame, scores: np.ndarray) -> pd.DataFrame:
        ids, labels, out = b["id"].to_numpy(), b["label"].to_numpy(), []
        for k, (own, label) in enumerate(zip(a["id"], a["label"])):
            at = top(scores[k], (labels == label) & (ids != own), most)
            out.append(pd.DataFrame({"id": own, "other": ids[at], "score": scores[k][at]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "other": [], "score": []})

    def done(members: DataFrame, best: DataFrame, left: Column) -> DataFrame:
        last = best.groupBy("id").agg(F.min("score").alias("last"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= most)
        return members.join(last, "id").where(left.isNull() | (F.col("last") > left)).select("id")

    members = walk.anchors.select("id", "label", "v", "norm", "cluster", "group")
    return walk.best(kernel, "id long, other long, score long", ["id"], most, members, done)


def negatives(walk: Walk, found: DataFrame, most: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(id, positive, other, score): for each of the anchors' positives (``found``) the highest rows of other labels whose
    score lies between ``low`` and ``high`` per cent of the positive's."""
    pairs = found.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.col("other").alias("positive"), "score"))).alias("positives"))
    members = shared_table(walk.anchors.join(pairs, "id").select("id", "label", "v", "norm", "cluster", "group", "positives"), "members")

    def kernel(a: pd.DataFrame, b: pd.DataFrame, scores: np.ndarray) -> pd.DataFrame:
        ids, labels, out = b["id"].to_numpy(), b["label"].to_numpy(), []
        for k in range(len(a)):
            other, s = labels != a["label"][k], scores[k]
            for p in a["positives"][k]:
                at = top(s, other & (low * p["score"] <= 100 * s) & (100 * s <= high * p["score"]), most)
                out.append(pd.DataFrame({"id": a["id"][k], "positive": p["positive"], "other": ids[at], "score": s[at]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "positive": [], "other": [], "score": []})

    def done(members: DataFrame, best: DataFrame, left: Column) -> DataFrame:
        each = members.select("id", left.alias("left"), F.explode("positives").alias("p")).select(
            "id", "left", F.col("p.positive").alias("positive"), (F.col("p.score") * low).alias("least"))
        last = best.groupBy("id", "positive").agg(F.min("score").alias("last"), F.count(F.lit(1)).alias("n"))
        each = each.join(last, ["id", "positive"], "left")
        over = F.col("left").isNull() | (100 * F.col("left") < F.col("least")) | F.coalesce((F.col("n") >= most) & (F.col("last") > F.col("left")), F.lit(False))
        return each.groupBy("id").agg(F.bool_and(over).alias("over")).where("over").select("id")

    return walk.best(kernel, "id long, positive long, other long, score long", ["id", "positive"], most, members, done)


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, clusters: int = CLUSTERS,
         scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), rank from 1 for each pair of an anchor and
    a positive. ``is_anchor`` is a condition on the column ``id``."""
    spark = df.sparkSession
    names = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = vectors(df, id_col, vector_col, label_col, scale)
    anchors = rows.where(is_anchor)
    sample = anchors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()  # at most SAMPLE vectors
    if not sample:
        return spark.createDataFrame([], names)
    centres = fit_centres(matrix([r["v"] for r in sample]), clusters)
    anchors = assigned(anchors, centres)
    widest = {r["cluster"]: r["t"] for r in anchors.groupBy("cluster").agg(F.max("angle").alias("t")).collect()}  # at most CLUSTERS
    walk = Walk(rows, sorted_lists(rows, centres, widest), anchors)
    found = positives(walk, n_positives)
    hard = negatives(walk, found, n_negatives, low, high)
    order = Window.partitionBy("id", "positive").orderBy(F.col("score").desc(), "other")
    named = found.select("id", F.col("other").alias("positive"), F.col("score").alias("positive_score"))
    return hard.withColumn("rank", F.row_number().over(order)).join(named, ["id", "positive"]).select(
        F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return mine(rows, F.col("id") % 100 == 0)
