import math
import random

from moodlake.llm import topk as K
from pyspark.sql import functions as F


def brute_force(rows, k, is_query):
    part = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asks = {}
    for i, v in part:
        if is_query(i):
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, v in asks.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in part if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def vectors(seed, n, dim=6):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, [0.5] * dim) for i in range(30)]  # ties
    rows += [(None, [1.0] * dim), (n + 50, None), (n + 51, [None] * dim), (n + 52, [float("nan")] * dim), (n + 53, [float("inf")] * dim),
             (n + 54, [1.0]), (n + 60, []), (n + 70, [2.0] * dim), (n + 70, [3.0] * dim), (n + 70, [3.0] * dim), (n + 71, [0.0] * dim)]
    return rows


def test_equals_brute_force_over_several_shards(spark):
    rows = vectors(3, 700)
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, shard string, rows string")
    got = K.top_k(df.repartition(4), F.col("vec_id") % 10 == 0, 7, rows_per_shard=100).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_force(rows, 7, lambda i: i % 10 == 0)


def test_many_partitions_of_unequal_sizes(spark):
    """Shards and their much smaller query blocks meet however adaptive execution merges partitions."""
    rows = vectors(4, 3000, 16)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = K.top_k(df.repartition(6), F.col("vec_id") % 100 == 0, 5, rows_per_shard=250).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_force(rows, 5, lambda i: i % 100 == 0)


def test_fewer_rows_than_k_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, -4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = K.top_k(df, F.col("vec_id") == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == brute_force(rows, 10, lambda i: i == 0)
    assert K.top_k(df.limit(0), F.lit(True)).count() == 0


def test_huge_components_stay_exact(spark):
    rows = [(i, [1e6 * (i + 1), -3e5 * i, 1.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = K.top_k(df, F.col("vec_id") == 0, 2).collect()
    want = brute_force(rows, 2, lambda i: i == 0)
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [w[:3] for w in want]
    assert [r.score for r in got] == [w[3] for w in want] and min(w[3] for w in want) > 2**53
