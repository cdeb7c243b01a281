"""Sharding by jump consistent hashing, in DataFrame expressions only.

A row's shard depends on its key and the number of shards alone; there is no
ring table.  With one more shard every row either keeps its shard or moves to
the new one, so 1/(n+1) of the rows move.  (Lamping and Veach, "A fast,
minimal memory, consistent hash algorithm", 2014.)
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
TWO_64 = 2**64
TWO_33 = 2**33
TWO_31 = 2**31

ROWS_PER_RANGE = 20_000  # rows that one numbering window holds, over all shards


def _unsigned(key: Column) -> Column:
    """A signed 64-bit key as the unsigned number of the same bits; null is 0."""
    wide = F.coalesce(key.cast("long"), F.lit(0)).cast("decimal(20,0)")
    return F.when(wide < 0, (wide + F.lit(Decimal(TWO_64))).cast("decimal(20,0)")).otherwise(wide)


def _step(key: Column) -> Column:
    """The next 64-bit state: key * MULTIPLIER + 1, modulo 2^64.  The product
    stays under 10^38, so decimal arithmetic is exact (long arithmetic would
    overflow, which is an error under ANSI rules)."""
    return ((key * F.lit(Decimal(MULTIPLIER)) + F.lit(Decimal(1))) % F.lit(Decimal(TWO_64))).cast("decimal(20,0)")


def _high_bits(key: Column) -> Column:
    """The upper 31 bits of a state, as long."""
    return F.floor(key / F.lit(Decimal(TWO_33))).cast("long")


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 .. shards-1 of a long key.  Every jump goes up by one shard at
    least, so `shards` rounds always suffice; rounds after the last jump keep
    the state."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    start = F.struct(_unsigned(key).alias("key"), F.lit(-1).cast("long").alias("at"),
                     F.lit(0).cast("long").alias("next"))

    def jump(state, _):
        after = _step(state["key"])
        ahead = ((state["next"] + 1).cast("double")
                 * (F.lit(float(TWO_31)) / (_high_bits(after) + 1).cast("double"))).cast("long")
        moved = F.struct(after.alias("key"), state["next"].alias("at"), ahead.alias("next"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda s: s["at"].cast("int"))


def with_shards(df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str | None = None) -> DataFrame:
    """df with the shard of each row and, if `grown` names a column, its shard
    among shards + 1.  A null key counts as 0.  Rows of equal keys share a
    shard.  An empty table stays empty."""
    out = df.withColumn(shard, jump_shard(F.col(f"`{key}`"), shards))
    return out.withColumn(grown, jump_shard(F.col(f"`{key}`"), shards + 1)) if grown else out


def with_slots(df: DataFrame, key: str, shard: str = "shard", slot: str = "slot", order: tuple[str, ...] = (),
               rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """df with a gapless number from 0 within each shard.

    Keys are dealt by hash over ranges of about rows_per_range rows; a window
    numbers the rows of one (shard, range) only, and the running total of the
    counts of the ranges before gives its start.  No window holds a shard.
    Ties in key and `order` are numbered in any order."""
    ranges = max(1, -(-df.count() // rows_per_range))
    place = F.floor(_high_bits(_step(_unsigned(F.col(f"`{key}`")))) * F.lit(ranges) / F.lit(TWO_31)).cast("long")
    placed = df.withColumn("_range", place)
    before = W.partitionBy("_s").orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    starts = (placed.groupBy(F.col(shard).alias("_s"), F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_s", "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    local = W.partitionBy(shard, "_range").orderBy(*[F.col(f"`{c}`") for c in (key, *order)])
    return (placed.withColumn("_row", F.row_number().over(local))
            .join(starts, (F.col(shard) == F.col("_s")) & (F.col("_range") == F.col("_r")))
            .withColumn(slot, (F.col("_start") + F.col("_row") - 1).cast("long"))
            .drop("_range", "_row", "_s", "_r", "_start"))


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes and 1; a null text has
    none), text_crc32 (null counts as empty), law, shard, slot and grown_shard.
    Extra columns of docs are left out, so their names cannot clash; repeated
    rows get a slot each; a null doc_id is sharded as key 0."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                       (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = with_shards(rows, "doc_id", shards, grown="grown_shard")
    return (with_slots(placed, "doc_id", order=("text_crc32", "size"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
