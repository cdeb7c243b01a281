"""Clusters against plain loops over all vectors and centroids, in whole numbers."""

import hashlib
import math
import random

import numpy as np
from moodlake.llm import centroid_clusters as C
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
                      + [T.StructField(n, T.StringType()) for n in ("vector", "cluster", "distance", "e", "n", "sums", "_cluster")])


def brute_force(rows, components, clusters=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
            if e is not None and len(e) == components and all(x is not None and math.isfinite(x) for x in e)]
    ranked = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [e for _, e in ranked[:clusters]]

    def assigned():
        out = []
        for i, e in kept:
            d, c = min((sum((x - y) ** 2 for x, y in zip(e, c)), k) for k, c in enumerate(centroids))
            out.append((i, c, d, e))
        return out

    for _ in range(rounds):
        now = assigned()
        for c in range(len(centroids)):
            own = [e for _, k, _, e in now if k == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    last = assigned()
    inertia = {c: sum(d for _, k, d, _ in last if k == c) for c in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d, _ in last), key=str)


def f32(x):
    return float(np.float32(x))


def table(spark, rows):
    return spark.createDataFrame([(i, e, *["x"] * 7) for i, e in rows], SCHEMA).repartition(3)


def report(df):
    out = C.cluster_report(df)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_odd_vectors(spark):
    rng = random.Random(4)
    grid = lambda: [rng.choice([-0.5, 0.0, 0.25, f32(1 / 300)]) for _ in range(64)]  # noqa: E731  many equal distances
    rows = [(i, grid()) for i in range(150)]
    rows += [(500 + i, rows[3][1]) for i in range(60)] + [(7, rows[7][1]), (7, grid()), (None, grid()), (-9, grid())]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [1.0] * 63 + [None]), (905, [math.nan] + [1.0] * 63),
             (906, [1.0] * 63 + [-math.inf])]
    assert report(table(spark, rows)) == brute_force(rows, 64)


def test_few_and_no_vectors(spark):
    rows = [(3, [0.5] * 64), (1, [0.5] * 64), (2, [-0.25] * 64)]
    assert report(table(spark, rows)) == brute_force(rows, 64)
    assert report(table(spark, [])) == [] and report(table(spark, [(1, None)])) == []


def test_wide_numbers(spark):
    """Beyond what 64 bits hold of squares: exact, null where the answer is no long, left out where a component is no long."""
    rows = [(i, [f32(i * 1e7)] * 64) for i in range(50)] + [(60, [f32(1e16)] * 64), (61, [f32(1e30)] * 64)]
    want = [(i, c, d if d < 2**63 else None) for i, c, d, *_ in brute_force(rows[:-1], 64)]
    got = [r[:3] for r in report(table(spark, rows))]
    assert got == want


def test_tree_is_exact_with_ties():
    rng = np.random.default_rng(5)
    for k in (1, 2, 4, 5, 6, 17, 40, 130):
        centroids = rng.integers(-2, 3, (k, 3))
        vectors = rng.integers(-4, 5, (500, 3))
        cluster, distance = C.Tree(centroids.tolist()).nearest(vectors)
        every = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_search_leaves_nodes_out(monkeypatch):
    """On vectors in groups, most centroids are never compared."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-5000, 5000, (40, 64))
    vectors = centres[rng.integers(0, 40, 2000)] + rng.integers(-50, 51, (2000, 64))
    compared, plain = [], C.squared
    tree = C.Tree(centres.tolist())
    monkeypatch.setattr(C, "squared", lambda v, c: compared.append(len(v)) or plain(v, c))
    cluster, _ = tree.nearest(vectors)
    assert (cluster == ((vectors[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert sum(compared) < 0.8 * 2000 * 40


def test_other_parameters(spark):
    rng = random.Random(8)
    rows = [(i, [f32(rng.random()) for _ in range(3)]) for i in range(80)]
    got, centroids = C.cluster(table(spark, rows), clusters=5, rounds=2, components=3)
    want = brute_force(rows, 3, 5, 2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == [w[:3] for w in want] and len(centroids) == 5
