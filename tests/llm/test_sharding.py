from collections import Counter, defaultdict
import zlib

from moodlake.llm import sharding as S
from pyspark.sql import functions as F


def jump(key, shards):
    """The published loop."""
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_equal_the_published_loop(spark):
    keys = [*range(-50, 50), 2**63 - 1, -2**63, 10**12, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 100):
        got = {r.k: r.s for r in df.select("k", S.jump_shard(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k or 0, n) for k in keys}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    rows = S.with_shards(spark.range(20000), "id", 8, grown="grown").groupBy("shard", "grown").count().collect()
    assert all(r.grown in (r.shard, 8) for r in rows)
    moved = sum(r["count"] for r in rows if r.grown == 8)
    assert abs(moved - 20000 / 9) < 300
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["count"]
    assert min(sizes.values()) > 2200 and max(sizes.values()) < 2800


def test_documents(odd_docs, odd_rows, no_docs):
    got = S.shard_documents(odd_docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", jump(i or 0, 8), jump(i or 0, 9)) for i, t in odd_rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert S.shard_documents(no_docs).count() == 0


def test_slots_are_gapless_over_many_ranges(spark):
    df = S.with_shards(spark.range(5000).withColumn("id", F.col("id") - F.col("id") % 3), "id", 4)
    got = S.with_slots(df, "id", rows_per_range=100).groupBy("shard").agg(
        F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.min("slot").alias("lo"), F.max("slot").alias("hi")).collect()
    assert all(r.n == r.d and r.lo == 0 and r.hi == r.n - 1 for r in got)


def test_native(odd_docs):
    plan = S.shard_documents(odd_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
