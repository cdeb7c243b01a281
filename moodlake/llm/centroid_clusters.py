"""Clusters of integer vectors around k centroids, found with vantage-point trees.

Each round the driver builds a vantage-point tree over the k centroids and
broadcasts it.  Every vector walks it best first: it opens the node with the
smallest lower bound of distance (by the triangle inequality), until no bound is
within its best distance.  Nodes at exactly that distance are still opened, so
that of equally near centroids the smallest number wins.  Distances to
centroids are exact integers; bounds are floating and only ever too small.

A task sums its vectors by cluster; Spark adds the tasks' sums, and k rows go to
the driver.  What is broadcast and collected is bounded by k and the number of
components, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import ship_package, stored

CLUSTERS = 40
ROUNDS = 5
COMPONENTS = 64
SCALE = 256
SEED = 2
LEAF = 4  # centroids of a leaf at most
BLOCK = 2048  # vectors that walk the tree together
PLAIN = 1 << 27  # components below it have squared distances within 64 bits
WIDEST = 2.0**62  # scaled components from here on are no longs
SLACK = 1e-9  # by which a floating bound is lowered


@dataclass
class Node:
    """An inner node's vantage centroid and its children with the least and
    greatest distances of their centroids from it; or a leaf's centroids."""
    members: list[int]
    children: list[tuple[int, float, float]]


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances; the arrays hold 64-bit integers, or Python's where those are too narrow."""
    apart = vectors - centroid
    return (apart * apart).sum(axis=1)


class Tree:
    """A vantage-point tree over centroids (rows of integers)."""

    def __init__(self, centroids: list[list[int]]):
        self.wide = any(abs(x) >= PLAIN for c in centroids for x in c)
        self.centroids = np.array(centroids, object)
        self.nodes: list[Node] = []
        if len(centroids):
            self._grow(list(range(len(centroids))))

    def _grow(self, ids: list[int]) -> int:
        at = len(self.nodes)
        if len(ids) <= LEAF:
            self.nodes.append(Node(ids, []))
            return at
        vantage, rest = ids[0], np.array(ids[1:])
        self.nodes.append(Node([vantage], []))
        apart = np.sqrt(squared(self.centroids[rest], self.centroids[vantage]).astype(float))
        order = np.argsort(apart, kind="stable")
        for half in np.array_split(order, 2):
            child = self._grow([int(i) for i in rest[half]])
            self.nodes[at].children.append((child, float(apart[half].min()), float(apart[half].max())))
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector, the smallest number of equally
        near ones, and its squared distance."""
        kind = object if self.wide or (len(vectors) and max(-int(vectors.min()), int(vectors.max())) >= PLAIN) else np.int64
        vectors, centroids = vectors.astype(kind), self.centroids.astype(kind)
        rows = np.arange(len(vectors))
        found = np.full(len(vectors), len(centroids))
        best = np.full(len(vectors), 1 << 200 if kind is object else np.iinfo(np.int64).max, kind)
        bounds = np.full((len(vectors), len(self.nodes)), np.inf)
        bounds[:, 0] = 0
        while len(rows):
            chosen = bounds[rows].argmin(axis=1)
            open_ = bounds[rows, chosen] <= np.sqrt(best[rows].astype(float))
            rows, chosen = rows[open_], chosen[open_]
            for at in np.unique(chosen):
                own, node = rows[chosen == at], self.nodes[at]
                parent = bounds[own, at]
                bounds[own, at] = np.inf
                for centroid in node.members:
                    apart = squared(vectors[own], centroids[centroid])
                    nearer = (apart < best[own]) | ((apart == best[own]) & (centroid < found[own]))
                    best[own[nearer]], found[own[nearer]] = apart[nearer], centroid
                if node.children:
                    root = np.sqrt(apart.astype(float))  # an inner node has one member, its vantage centroid
                    for child, low, high in node.children:
                        bound = np.maximum(low - root, root - high) - SLACK * (1 + root + high)
                        bounds[own, child] = np.maximum(parent, bound)
        return found, best


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    """The second column's arrays, all of one size, as rows of a matrix."""
    column = batch.column(1)
    return column.flatten().to_numpy().reshape(len(column), -1)


def kept_vectors(df: DataFrame, vec_id: str, embedding: str, components: int, scale: int) -> DataFrame:
    """vec_id and the scaled, floored components of the vectors that take part."""
    scaled = F.transform(F.col("e"), lambda x: x.cast("double") * scale)
    fits = F.forall("s", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < WIDEST), F.lit(False)))
    return (df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("e"))
            .filter(F.size("e") == components).select("vec_id", scaled.alias("s")).filter(fits)
            .select("vec_id", F.transform("s", lambda x: F.floor(x).cast("long")).alias("vector")))


def _sums(kept: DataFrame, tree: Tree, components: int) -> list:
    """Of each non-empty cluster its number, the count of its vectors and their componentwise sums."""
    shared = kept.sparkSession.sparkContext.broadcast(tree)
    kind = pa.list_(pa.decimal128(38, 0))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        counts = np.zeros(len(tree.centroids), np.int64)
        sums = np.zeros((len(counts), components), object)
        for batch in batches:
            vectors = _vectors(batch)
            for at in range(0, len(vectors), BLOCK):
                part = vectors[at:at + BLOCK]
                cluster, _ = tree.nearest(part)
                for c in np.unique(cluster):
                    own = part[cluster == c]
                    counts[c] += len(own)
                    # 64-bit partial sums where a block cannot overflow them
                    sums[c] += (own if abs(own).max() < PLAIN else own.astype(object)).sum(axis=0).astype(object)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(counts[full], pa.int64()),
             pa.array([[Decimal(int(x)) for x in sums[c]] for c in full], kind)], ["cluster", "n", "sums"])

    rows = kept.select("vec_id", "vector").mapInArrow(add, "cluster int, n long, sums array<decimal(38,0)>")
    return rows.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(components)])
                                       .alias("sums")).collect()


def cluster(df: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE,
            seed: int = SEED, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """Rows (vec_id, cluster, distance) of all vectors that take part, and the final centroids.

    Vectors of exactly `components` numbers, none null or non-finite, take
    part, as integers floor(scale * x).  Centroids start as the vectors with
    the smallest SHA-256 of "<seed>:<vec_id>", in that order; rows repeated
    with one vec_id each count, in order of their components, and those
    without a vec_id come last.  With fewer vectors than `clusters` there are
    as many centroids as vectors; without any the result is empty.  Each round
    assigns every vector and moves every non-empty centroid to the floored mean.
    Numbers whose scaled value is no long (2^62 and beyond) take no part, and a
    squared distance that is no long is null.  Other columns are left out."""
    spark = df.sparkSession
    ship_package(spark)
    kept = stored(kept_vectors(df, vec_id, embedding, components, scale), "vectors")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(rank.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()
    centroids = [list(r["vector"]) for r in first]
    if not centroids:
        return kept.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), []
    for _ in range(rounds):
        for row in _sums(kept, Tree(centroids), components):
            centroids[row["cluster"]] = [int(s) // row["n"] for s in row["sums"]]
    shared = spark.sparkContext.broadcast(Tree(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch)
            for at in range(0, len(vectors), BLOCK):
                number, apart = shared.value.nearest(vectors[at:at + BLOCK])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, BLOCK), pa.array(number, pa.int32()),
                     pa.array([int(x) if x < 2**63 else None for x in apart], pa.int64())], ["vec_id", "cluster", "distance"])

    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    return stored(kept.mapInArrow(assign, schema), "assigned"), centroids


def cluster_report(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """cluster() with production parameters and, on each row, its cluster's and
    all clusters' inertia (sums of distances; null if no long) and the SHA-256
    of its centroid's components."""
    assigned, centroids = cluster(df, vec_id=vec_id, embedding=embedding)
    spark = df.sparkSession
    sums = {r["cluster"]: int(r["inertia"]) if r["inertia"] is not None else None for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    total = sum(x or 0 for x in sums.values())
    rows = [(c, x if x is None or x < 2**63 else None, total if total < 2**63 else None,
             hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, x in sums.items()]
    facts = spark.createDataFrame(rows, "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col("_cluster")).drop("_cluster")


def cluster_sql() -> str:
    """DuckDB SQL for the rows of cluster_report()."""
    steps = [f"""
with v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as e
  from embeddings where len(embedding) = {COMPONENTS}
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
c0 as materialized (
  select row_number() over (order by sha256('{SEED}:' || vec_id), e) - 1 as c, e from v
  order by sha256('{SEED}:' || vec_id), e limit {CLUSTERS})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} as materialized (
  select r, c, d from (
    select v.r, k.c, list_sum(list_transform(list_zip(v.e, k.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
    from v, c{i} k) qualify row_number() over (partition by r order by d, c) = 1)""")
        if i < ROUNDS:
            steps.append(f"""
c{i + 1} as materialized (
  with x as (select a.c, unnest(v.e) as x, generate_subscripts(v.e, 1) as place from a{i} a join v on a.r = v.r),
  s as (select c, place, sum(x)::hugeint as s, count(*)::hugeint as n from x group by c, place),
  m as (select c, list(((s - ((s % n) + n) % n) // n)::bigint order by place) as e from s group by c)
  select k.c, coalesce(m.e, k.e) as e from c{i} k left join m on k.c = m.c)""")
    return ",".join(steps) + f"""
select v.vec_id, a.c::int as cluster, a.d as distance, (sum(a.d) over (partition by a.c))::bigint as cluster_inertia,
       (sum(a.d) over ())::bigint as inertia, sha256(array_to_string(k.e, ',')) as centroid_sha256
from a{ROUNDS} a join v on a.r = v.r join c{ROUNDS} k on a.c = k.c"""
