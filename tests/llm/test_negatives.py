"""Hard-negative mining against brute force over short slices, blocks and groups, and messy vectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from telvault.llm import negatives

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def want(rows, every, n_pos=5, n_neg=10):
    least = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        least[i] = min(least.get(i, (label, q)), (label, q))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, (label, q) in least.items():
        if a % every:
            continue
        ranked = sorted((-score(q, v), i, own == label) for i, (own, v) in least.items() if i != a)
        for p, i, _ in [r for r in ranked if r[2]][:n_pos]:
            hard = [(s, j) for s, j, same in ranked if not same and 30 * -p <= 100 * -s <= 90 * -p][:n_neg]
            out |= {(a, i, k + 1, j, -p, -s) for k, (s, j) in enumerate(hard)}
    return out


def mined(spark, rows, every, **more):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)
    # columns that the operator names itself, and one with a dot
    df = df.withColumns({c: F.lit("x") for c in ("id", "v", "norm", "cluster", "at", "meta.x")})
    return {tuple(r[c] for c in NAMES) for r in negatives.mine(df, F.col("id") % every == 0, **more).collect()}


@pytest.fixture
def short(monkeypatch):
    for name, n in (("FIRST", 16), ("GROWTH", 2), ("BLOCK", 10), ("GROUP", 3)):
        monkeypatch.setattr(negatives, name, n)


def points(seed, n, dims=6, labels=3, spread=0.4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(labels, dims))
    label = rng.integers(0, labels, n)
    return [(k, (middle[c] * 0.5 + rng.normal(size=dims) * spread).astype(np.float32).tolist(), int(c)) for k, c in enumerate(label)]


@pytest.mark.parametrize("seed, spread, clusters", [(0, 0.4, 4), (1, 0.02, 3), (2, 1.5, 1)])
def test_against_brute_force(spark, short, seed, spread, clusters):
    rows = points(seed, 150, spread=spread)
    got = mined(spark, rows, 10, clusters=clusters)
    assert got == want(rows, 10) and got


def test_messy_vectors(spark, short):
    nan, inf = math.nan, math.inf
    rows = points(3, 80, dims=4)
    rows += [(None, [1.0] * 4, 1), (200, None, 1), (210, [1.0, None, 0.0, 0.0], 1), (220, [nan] * 4, 1), (230, [inf] * 4, 0), (240, [-inf, 0.0, 0.0, 0.0], 0),
             (250, [1.0] * 4, None), (260, [], 1), (270, [0.0] * 4, 2), (280, [0.5], 1), (290, [0.5, 0.1, 0.0, 0.0, 0.3, -0.2], 1)]
    rows += [rows[10], rows[10], (20, [0.25, 0.5, 0.0, 0.0], 2)]  # repeated rows, and an id with two vectors
    assert mined(spark, rows, 10) == want(rows, 10)


def test_one_very_common_vector_and_ties(spark, short):
    rng = random.Random(4)
    rows = points(5, 60) + [(100 + k, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0], rng.randint(0, 2)) for k in range(60)]
    assert mined(spark, rows, 10) == want(rows, 10)


def test_none(spark):
    assert mined(spark, [], 10) == set() and mined(spark, points(0, 9)[1:], 10) == set()
    assert mined(spark, [(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [1.0, 0.0], 2)], 10) == want([(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [1.0, 0.0], 2)], 10)


def test_too_long_vectors_are_refused(spark):
    with pytest.raises(ValueError, match="no exact scores"):
        mined(spark, [(0, [1e30], 1), (1, [1.0], 1)], 10)


def test_members_stop_before_the_end_of_the_list(spark, short, monkeypatch):
    """Close clusters: the walk ends after few slices, and bounds hold for every member."""
    rows = points(1, 400, spread=0.02)
    seen = []
    scored = negatives.Walk.scored
    monkeypatch.setattr(negatives.Walk, "scored", lambda self, k, m, kernel, schema: seen.append(m.count()) or scored(self, k, m, kernel, schema))
    assert mined(spark, rows, 10, clusters=3) == want(rows, 10)
    assert min(seen) < max(seen)  # members leave before others


def test_bound_holds(spark):
    rng = np.random.default_rng(8)
    anchors, others = rng.normal(size=(40, 8)), rng.normal(size=(300, 8)) * rng.uniform(0, 3, (300, 1))
    centres = negatives.fit_centres(anchors, 5)
    a = negatives.angles(anchors, centres)
    home, norm = a.argmin(axis=1), np.linalg.norm(others, axis=1)
    for c in range(len(centres)):
        members = anchors[home == c]
        if len(members):
            bound = norm * np.cos(np.maximum(0, negatives.angles(others, centres)[:, c] - a[home == c, c].max())) + 1e-6 * norm
            assert (members @ others.T <= np.linalg.norm(members, axis=1)[:, None] * bound + 1e-6).all()


def test_slices():
    starts = [negatives.FIRST * (negatives.GROWTH ** k - 1) // (negatives.GROWTH - 1) for k in range(4)]
    assert starts[:3] == [0, 4096, 4096 + 4 * 4096]
