import datetime as dt

from pyspark.sql import functions as F

from moodlake.operators import artists as A
from moodlake.operators import silver as S
from moodlake.plans import pipeline as PL
from moodlake.sources import fixture

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)


def test_dedup_latest_ties_and_null_keys(spark):
    rows = [("a", T0, 3, "old"), ("a", T1, 2, "new-2"), ("a", T1, 1, "new-1"),
            (None, T0, 1, "n1"), (None, T1, 2, "n2"), ("b", None, 1, "null-ts"), ("b", T0, 9, "b-ts")]
    df = spark.createDataFrame(rows, "k string, ts timestamp, tb int, v string")
    got = {r["k"]: r["v"] for r in S.dedup_latest(df, "k", "ts", ["tb"]).collect()}
    assert got == {"a": "new-1", None: "n2", "b": "b-ts"}


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("timestamp").alias("ts"))
    plan = S.dedup_latest(df, "k", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_conform_schema_try_cast_and_order(spark):
    df = spark.createDataFrame([("x", "12", "oops", "0.5", "extra")],
                               "track_id string, popularity string, duration_ms string, energy string, junk string")
    out = S.conform_schema(df)
    assert out.columns == ["track_id", "popularity", "duration_ms", "energy"]
    r = out.first()
    assert (r["popularity"], r["duration_ms"], r["energy"]) == (12, None, 0.5)
    fails = {r["column_name"]: r["failures"] for r in S.cast_failures(df).collect()}
    assert fails["duration_ms"] == 1 and fails["popularity"] == 0


def test_filter_ranges_nan_null_and_bounds(spark):
    rows = [(0.0, 1.0, 120.0), (float("nan"), 0.5, 120.0), (None, 0.5, 120.0), (0.5, 1.01, 120.0),
            (0.5, 0.5, None), (0.5, 0.5, float("nan"))]
    df = spark.createDataFrame(rows, "energy double, valence double, tempo double")
    assert S.filter_ranges(df).count() == 1


def test_explode_artists_trims_and_skips_blanks(spark):
    df = spark.createDataFrame([("t1", "A ;; \tB ; ;C"), ("t2", None), ("t3", "")], "track_id string, artists string")
    got = [(r["track_id"], r["position"], r["artist_name"]) for r in A.explode_artists(df).orderBy("track_id", "position").collect()]
    assert got == [("t1", 0, "A"), ("t1", 2, "B"), ("t1", 4, "C")]


def test_artist_snapshot_first_row_rule(spark):
    rows = [("t2", "X;Y", "rock", 10, T0), ("t1", "X", "pop", 20, T0), ("t3", "Y", "jazz", 30, T1)]
    df = spark.createDataFrame(rows, "track_id string, artists string, track_genre string, popularity bigint, "
                                     "ingestion_timestamp timestamp")
    got = {r["artist_name"]: (r["artist_genre"], r["artist_popularity"]) for r in A.artist_snapshot(df).collect()}
    # X: newest ingestion ties at T0 -> smallest track_id t1; Y: newest is t3 at T1
    assert got == {"X": ("pop", 20), "Y": ("jazz", 30)}


def test_build_silver_deals_wide_rows_before_it_sorts_them(spark):
    """The first sort is of parts that adaptive execution sizes, not of whole
    splits of the input; a hot and a null key leave one row each."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("T"), F.col("id").cast("string")))
    df = spark.range(3000).select(key.alias("track_id"), F.col("id").alias("popularity"), F.lit(0.5).alias("energy"),
                                  F.lit(100.0).alias("tempo"), F.lit(T0).alias("ingestion_timestamp"))
    out = S.build_silver(df, ["popularity"])
    got = {r["track_id"]: r["popularity"] for r in out.collect()}
    assert out.count() == len(got) == 1002 and (got["hot"], got["T4"], got[None]) == (0, 4, 2)
    plan = S.build_silver(df, ["popularity"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan[plan.rindex("Sort ["):]


def test_only_rows_that_may_be_latest_are_exchanged(spark, monkeypatch):
    """40 copies a key: few but the latest row of each pass the filter, with and
    without room in it, and silver keeps the rows that a plain dedup keeps."""
    n, copies = 500, 40
    day = F.timestamp_seconds(F.expr(f"id div {n} * 7 % {copies}") * 86400)
    key = F.when(F.col("id") % n > 0, F.concat(F.lit("T"), (F.col("id") % n).cast("string")))
    ts = F.when(F.col("id") % n == 1, F.lit(None)).when((F.col("id") % n == 2) & (F.col("id") % 3 == 0), F.lit(None)).when(
        F.col("id") % n == 3, F.lit(T0)).otherwise(day)  # a key without time, one with some, one with ties alone
    df = spark.range(n * copies).select(key.alias("track_id"), F.col("id").alias("popularity"), F.lit(0.5).alias("energy"),
                                        F.lit(100.0).alias("tempo"), ts.alias("ingestion_timestamp")).cache()
    want = {r.track_id: r.popularity for r in S.dedup_latest(df, "track_id", "ingestion_timestamp", ["popularity"]).collect()}
    assert len(want) == n
    assert S.maybe_latest(df, ["track_id"], "ingestion_timestamp").count() < 2 * n
    for words in (S.FILTER_WORDS_LOG2, 2):
        monkeypatch.setattr(S, "FILTER_WORDS_LOG2", words)
        out = S.build_silver(df, ["popularity"])
        assert {r.track_id: r.popularity for r in out.collect()} == want and out.count() == n
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan[plan.index("REBALANCE_PARTITIONS_BY_COL"):]


def test_latest_of_several_key_columns_and_odd_numbers(spark):
    nan = float("nan")
    rows = [(k, j, t) for k, j in ((0.0, "a"), (nan, None), (None, "b"), (1.0, None)) for t in (1.0, nan, None, -0.0)]
    rows += [(-0.0, "a", nan)]
    df = spark.createDataFrame(rows, "k double, j string, ts double")
    got = S.maybe_latest(df, ["k", "j"], "ts").collect()
    assert sum(r.ts is not None and r.ts != r.ts for r in got) == 5
    assert S.dedup_latest(S.maybe_latest(df, ["k", "j"], "ts"), ["k", "j"], "ts").count() == 4


def test_latest_times_come_without_the_join_of_bronze(spark, tmp_path):
    """Keys that bronze does not have (no part, no id) change nothing; part is read once, for the wide rows."""
    rows = [(o, k, 1, n, 1.0, 10.0, "R", T0 + dt.timedelta(days=o)) for n, (o, k) in enumerate([(1, 1), (9, 1), (3, 2), (3, 2), (7, 5), (4, None), (2, 6), (5, 6)])]
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                     "l_extendedprice double, l_returnflag string, l_shipdate timestamp")
    part = spark.createDataFrame([(1, "one", "b"), (2, "two", "b"), (2, "again", "b"), (6, "six", "b")],
                                 "p_partkey long, p_name string, p_brand string")
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    part.write.parquet(f"{tmp_path}/part.parquet")
    out = PL.silver(spark, str(tmp_path))
    bronze = PL.bronze(spark, str(tmp_path))
    want = S.filter_ranges(S.conform_schema(S.dedup_latest(bronze, "track_id", "ingestion_timestamp", fixture.BRONZE_TIEBREAK)))
    shape = ["track_id", "popularity", "ingestion_timestamp", "energy"]
    assert sorted(out.select(shape).collect()) == sorted(want.select(shape).collect()) and out.count() > 0
    times = {r.track_id: r.ingestion_timestamp for r in S.maybe_latest(
        bronze, ["track_id"], "ingestion_timestamp", fixture.bronze_stamps(spark, str(tmp_path))).collect()}
    assert {k: (t - T0).days for k, t in times.items()} == {"T1": 9, "T2": 3, "T6": 5}
    assert out._jdf.queryExecution().sparkPlan().toString().count("ReadSchema: struct<p_partkey") == 1
