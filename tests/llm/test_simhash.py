from collections import Counter

import numpy as np
import pytest
import xxhash

from telvault.llm import simhash

SF = "/root/testdata/sf0.01"


def plain(text):
    """The definition, bit by bit."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(texts):
    for t in texts:
        if t is None or len(t) < 20_000:
            assert simhash.fingerprint(t) == plain(t)


def test_hash_is_that_of_spark(spark):
    row = spark.sql("select xxhash64('a b é') as h").first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest("a b é".encode(), 42)


def components(fps, bits=3):
    """Least index of each point's component, over all pairs."""
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    points = [rng.integers(0, 1 << 64, dtype=np.uint64)]
    while len(points) < n:
        if rng.random() < 0.4:
            points.append(rng.integers(0, 1 << 64, dtype=np.uint64))
        else:  # near one that is there, by 0 to 8 bits
            x = points[rng.integers(len(points))]
            for b in rng.integers(0, 64, rng.integers(0, 9)):
                x ^= np.uint64(1) << np.uint64(b)
            points.append(x)
    return sorted(set(int(p) for p in points))


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_lose_no_link(spark, seed, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 20)
    fps = clustered(1500, seed)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, shard_classes=150).collect()]
    assert all(int.bit_count(a ^ b) <= 64 for a, b in edges)
    at = {f: k for k, f in enumerate(fps)}
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(at[a]), root(at[b])
        up[max(a, b)] = min(a, b)
    assert [root(k) for k in range(len(fps))] == components(fps).tolist()


def test_dealing_covers_every_ball():
    fps = np.array(clustered(3000, 5), np.uint64)
    dealer = simhash.build_dealer(fps, 12, 3)
    homes, reach = {}, {}
    for shard, rows, home in dealer.shards(fps):
        for r, h in zip(rows.tolist(), home.tolist()):
            reach.setdefault(r, set()).add(shard)
            if h:
                assert r not in homes
                homes[r] = shard
    assert len(homes) == len(fps) and len(set(homes.values())) > 4
    near = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3, 1))
    assert len(near) and all(homes[b] in reach[a] and homes[a] in reach[b] for a, b in near.tolist())


def test_each_tree_deals_a_class_once():
    """Random classes: a shard in each tree, at any number of shards; a pair within 3 bits meets in one of the trees."""
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    near = fps.copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, len(fps)).astype(np.uint64)
    for n_shards in (8, 100):
        met = np.zeros(len(fps), bool)
        for block in simhash.blocks(3):
            tree = simhash.build_dealer(fps[:6400], n_shards, 3, block)
            at = []
            for points in (fps, near):
                homes = np.full(len(points), -1)
                for shard, rows, home in tree.shards(points):
                    assert home.all() and (homes[rows] == -1).all()
                    homes[rows] = shard
                assert (homes >= 0).all()
                at.append(homes)
            assert n_shards <= tree.n_shards <= 4 * n_shards and np.bincount(at[0]).max() < 5 * len(fps) / n_shards
            met |= at[0] == at[1]
        assert met.all()


def hot_block(n, seed):
    """Half the classes share their lowest 16 bits."""
    rng = np.random.default_rng(seed)
    points = np.array(clustered(n, seed), np.uint64)
    points[rng.random(len(points)) < 0.5] &= np.uint64(~0xFFFF & (1 << 64) - 1)
    return sorted(set(points.tolist()))


@pytest.mark.parametrize("bits", [0, 3, 5])
def test_a_hot_block_value_loses_no_link(spark, bits, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 20)
    fps = hot_block(1500, 8)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, bits, shard_classes=100).collect()]
    nodes = {r["node"]: r["label"] for r in simhash.components(
        spark.createDataFrame([(int(np.uint64(a).view(np.int64)), int(np.uint64(b).view(np.int64))) for a, b in edges], "a bigint, b bigint")).collect()} if edges else {}
    label = components(fps, bits)
    groups, found = {}, {}
    for k, f in enumerate(fps):
        signed = int(np.uint64(f).view(np.int64))
        groups.setdefault(label[k], set()).add(signed)
        found.setdefault(nodes.get(signed, signed), set()).add(signed)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_one_of_rows_that_repeat(spark):
    """Equal id and text: the smallest by all columns that have an order, whatever else the rows hold."""
    df = spark.createDataFrame([(1, "a b c d", 5, {"x": 1}), (1, "a b c d", 3, {"x": 2}), (2, "a b c d", 1, {}), (None, "zz", 4, {}), (None, "zz", 2, {})],
                               "doc_id int, text string, `meta.x` int, m map<string,int>")
    got = simhash.one_of_each(df, "doc_id", "text")
    assert got.columns == df.columns
    assert sorted(tuple(r)[:3] for r in got.collect() if r[0] is not None) == [(1, "a b c d", 3)] and got.count() == 2


def test_query_against_all_pairs(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    fps = [simhash.fingerprint(t) for _, t in docs]
    want = {d[0]: (f"{f:016x}", docs[c][0]) for d, f, c in zip(docs, fps, components(fps))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op7_simhash(spark, SF).collect()} == want


def test_messy_rows(spark, messy, empty):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    label = components([simhash.fingerprint(t) for _, t in rows])
    least = {}
    for (i, _), c in zip(rows, label):
        least[c] = i if least.get(c) is None else least[c] if i is None else min(least[c], i)
    got = simhash.near_duplicates(messy, "doc_id", "text").collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((i, least[c]) for (i, _), c in zip(rows, label))
    kept = simhash.one_of_each(messy, "doc_id", "text")
    assert kept.columns == messy.columns
    kept = kept.collect()
    labels = {(i, t): c for (i, t), c in zip(rows, label)}
    assert sorted(labels[r["doc_id"], r["text"]] for r in kept) == sorted(set(label.tolist()))
    assert all(r["doc_id"] == least[labels[r["doc_id"], r["text"]]] for r in kept)
    assert simhash.near_duplicates(empty, "doc_id", "text").count() == 0 and simhash.one_of_each(empty, "doc_id", "text").count() == 0
