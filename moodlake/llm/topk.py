"""Exact search for the largest inner products by ball trees.

Vectors are dealt by hash over shards; each shard builds a ball tree and
answers every query by branch and bound, taking nodes in the order of the
largest inner product that their ball allows and stopping when no node left
can beat the current k-th score.  A first round searches one shard for each
query; the k-th score it finds there is shared with all other shards, so they
start with a bound.

Queries come to the shards in blocks, which stream past a shard's tree, so a
task holds one shard and one block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moodlake.llm.common import ship_package, stored

SCALE = 1024
LEAF = 32
ROWS_PER_SHARD = 4096
QUERIES_PER_BLOCK = 512
LARGEST, SMALLEST = 2**63 - 1, -2**63


def whole_numbers(vector: Column) -> Column:
    """floor(SCALE * x) of each component as long (numbers beyond long become its ends)."""
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(F.lit(float(SCALE)) * x.cast("double"),
                                                                    F.lit(-9.2e18)), F.lit(9.2e18))).cast("long"))


def takes_part(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))


class BallTree:
    """A ball tree over whole-number vectors; leaves of at most LEAF rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, int]] = []  # start, end, left, right (-1: a leaf)
        centres, radii = [], []
        spread = vectors.astype(np.float64)

        def build(start: int, end: int) -> int:
            own = spread[order[start:end]]
            centre = own.mean(axis=0) if len(own) else np.zeros(vectors.shape[1])
            away = np.sqrt(((own - centre) ** 2).sum(axis=1)) if len(own) else np.zeros(0)
            at = len(self.nodes)
            self.nodes.append((start, end, -1, -1))
            centres.append(centre)
            radii.append(away.max() if len(away) else 0.0)
            if end - start > LEAF:
                one = own[away.argmax()]
                two = own[((own - one) ** 2).sum(axis=1).argmax()]
                middle = (end - start) // 2
                side = np.argpartition(own @ (two - one), middle)
                order[start:end] = order[start:end][side]
                self.nodes[at] = (start, end, build(start, start + middle), build(start + middle, end))
            return at

        build(0, len(ids))
        self.ids, self.vectors = ids[order], vectors[order]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.largest = max(int(np.abs(spread).max()), 1) if vectors.size else 1

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """For each node an upper bound of the inner products in its ball, rounding included."""
        q = query.astype(np.float64)
        length = np.sqrt(q @ q)
        bound = self.centres @ q + self.radii * length
        return bound + 1e-9 * (np.sqrt((self.centres**2).sum(axis=1)) + self.radii) * length + 1e-3

    def scores(self, start: int, end: int, query: np.ndarray) -> np.ndarray:
        """Exact inner products of a leaf: in doubles where every sum is exact, else in whole numbers of any size."""
        largest = max(int(np.abs(query.astype(np.float64)).max()), 1) if query.size else 1
        if self.largest * largest * max(1, len(query)) < 2**53:
            return (self.vectors[start:end].astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        exact = self.vectors[start:end].astype(object) @ query.astype(object)
        return np.array([min(max(int(s), SMALLEST), LARGEST) for s in np.atleast_1d(exact)], np.int64)

    def search(self, own: int, query: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """The k best (score, id) but for the id `own`, ties to smaller ids;
        only those that reach `least`, the k-th score found elsewhere."""
        if not len(self.ids):
            return []
        bounds = self.bounds(query)
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst first
        queue = [(-bounds[0], 0)]
        while queue:
            bound, at = heapq.heappop(queue)
            floor = best[0][0] if len(best) == k else None
            floor = least if floor is None or (least is not None and least > floor) else floor
            if floor is not None and -bound < floor:
                break
            start, end, left, right = self.nodes[at]
            if left >= 0:
                heapq.heappush(queue, (-bounds[left], left))
                heapq.heappush(queue, (-bounds[right], right))
                continue
            scores = self.scores(start, end, query)
            for i in np.flatnonzero(scores >= floor) if floor is not None else range(len(scores)):
                item = (int(scores[i]), -int(self.ids[start + i]))
                if -item[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(score, -negative) for score, negative in best]


def _search(shards: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """Each question (shard, query_id, vector, least) answered by its shard:
    rows query_id, vec_id, score.  Questions are packed into blocks; a shard's
    rows and then its blocks meet in one task, sorted that way."""
    size = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)).over(W.partitionBy("shard")) / QUERIES_PER_BLOCK))
    blocks = (questions.withColumn("block", F.pmod(F.xxhash64("query_id"), size) + 1)
              .groupBy("shard", "block").agg(F.collect_list(F.struct("query_id", "vector", "least")).alias("rows")))
    both = shards.select("shard", F.lit(0).cast("long").alias("block"), "rows").unionByName(
        blocks.select("shard", "block", "rows"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trees = None, None
        for batch in batches:
            out = [[], [], []]
            for shard, block, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if shard != at:
                    at, trees = shard, None
                rows = rows.values
                vectors = rows.field("vector")
                width = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
                ids, least = rows.field("query_id").to_numpy(zero_copy_only=False), rows.field("least").to_pylist()
                starts, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
                if block == 0:
                    trees = {}
                    for dim in np.unique(width):
                        mine = np.flatnonzero(width == dim)
                        trees[int(dim)] = BallTree(ids[mine], flat[starts[mine][:, None] + np.arange(dim)])
                    continue
                if trees is None:
                    raise RuntimeError(f"shard {shard} came without its rows")
                for i in range(len(ids)):
                    tree = trees.get(int(width[i]))
                    query = flat[starts[i]:starts[i] + width[i]]
                    for score, vec in tree.search(int(ids[i]), query, k, least[i]) if tree else ():
                        for column, value in zip(out, (int(ids[i]), vec, score)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    return (both.repartition("shard").sortWithinPartitions("shard", "block")
            .mapInArrow(answer, "query_id long, vec_id long, score long"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
          rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """For each query row the k rows of highest inner product: query_id, rank
    (from 1), vec_id, score; all, if fewer; ties to the smaller vec_id.

    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without vec_id; a query meets vectors of its own length only.
    Rows of the query's own vec_id are never its results.  Of query rows that
    repeat a vec_id the least vector asks; repeated candidates each count.
    Scores beyond long are its ends.  Other columns are ignored."""
    ship_package(vectors.sparkSession)
    rows = stored(vectors.filter(takes_part(F.col(f"`{embedding}`")) & F.col(f"`{vec_id}`").isNotNull())
                  .select(F.col(f"`{vec_id}`").cast("long").alias("query_id"),
                          whole_numbers(F.col(f"`{embedding}`")).alias("vector"), is_query.alias("asks")), "vectors")
    n_shards = max(1, -(-rows.count() // rows_per_shard))
    # repeated ids do not pile up in one shard: the vector counts too
    dealt = F.pmod(F.xxhash64("query_id", "vector"), F.lit(n_shards)).cast("long")
    filled = rows.select(dealt.alias("_shard"), F.struct("query_id", "vector", F.lit(None).cast("long").alias("least"))
                         .alias("row")).groupBy("_shard").agg(F.collect_list("row").alias("rows"))
    # every shard has a row, an empty one too; stored, as two rounds read it
    every = vectors.sparkSession.range(n_shards).select(F.col("id").alias("shard"))
    shards = stored(every.join(filled, F.col("shard") == F.col("_shard"), "left").select(
        "shard", F.coalesce("rows", F.array().cast(filled.schema["rows"].dataType)).alias("rows")), "shards")
    queries = rows.filter("asks").groupBy("query_id").agg(F.min("vector").alias("vector"))
    first_shard = F.pmod(F.xxhash64("query_id"), F.lit(n_shards)).cast("long")
    first = stored(_search(shards, queries.select(first_shard.alias("shard"), "query_id", "vector",
                                                  F.lit(None).cast("long").alias("least")), k), "first")
    reached = _ranked(first, k).filter(F.col("rank") == k).select(F.col("query_id").alias("_id"), F.col("score").alias("least"))
    others = (queries.join(reached, F.col("query_id") == F.col("_id"), "left")
              .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))))
              .filter(F.col("shard") != first_shard).select("shard", "query_id", "vector", "least"))
    found = first.unionByName(_search(shards, others, k)) if n_shards > 1 else first
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
