import datetime as dt
import random

from pyspark.sql import functions as F

from moodlake.operators import asof
from moodlake.operators import features as FT


def test_as_of_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    feats = [(f"t{rnd.randint(0, 5)}", base + dt.timedelta(hours=rnd.randint(0, 24 * 40)), float(i)) for i in range(120)]
    reqs = [(f"t{rnd.randint(0, 6)}", base + dt.timedelta(hours=rnd.randint(0, 24 * 45))) for _ in range(200)]
    reqs += [(f, t) for f, t, _ in feats[:20]]  # exact-time hits are included (ts <= request)
    fdf = spark.createDataFrame(feats, "track_id string, event_timestamp timestamp, v double")
    rdf = spark.createDataFrame(reqs, "track_id string, request_ts timestamp")
    got = list((r["track_id"], r["request_ts"], r["v"]) for r in FT.features_as_of(fdf, rdf, ttl_days=7).collect())
    want = []
    for k, t in reqs:
        cands = [(ts, v) for kk, ts, v in feats if kk == k and t - dt.timedelta(days=7) < ts <= t]
        want.append((k, t, max(cands)[1] if cands else None))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_as_of_any_number_of_stretches_same_result(spark):
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    feats = [("hot", base + dt.timedelta(hours=rnd.randint(0, 24 * 20)), float(i)) for i in range(30)]
    reqs = [("hot", base + dt.timedelta(hours=rnd.randint(0, 24 * 20))) for _ in range(300)]
    fdf = spark.createDataFrame(feats, "track_id string, event_timestamp timestamp, v double")
    rdf = spark.createDataFrame(reqs, "track_id string, request_ts timestamp")
    want = sorted(_brute_as_of(feats, reqs, 7), key=str)
    for partitions in (1, 3, 8, 50):
        got = [(r["track_id"], r["request_ts"], r["v"]) for r in FT.features_as_of(fdf, rdf, ttl_days=7, partitions=partitions).collect()]
        assert sorted(got, key=str) == want


def test_latest_in_range(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("a", base, 1.0), ("a", base + dt.timedelta(days=3), 2.0), ("a", base + dt.timedelta(days=9), 3.0)]
    df = spark.createDataFrame(rows, "track_id string, event_timestamp timestamp, v double")
    r = FT.features_latest(df, "2024-01-01 00:00:00", "2024-01-05 00:00:00").collect()
    assert [x["v"] for x in r] == [2.0]


def test_lookup_found_flag_and_description(spark):
    base = dt.datetime(2024, 1, 1)
    feats = spark.createDataFrame(
        [("a", "Chill Pop", "Relaxed", "Pop", 0.123456, 0.5, 0.25, base),
         ("b", None, "Dark", None, 0.1, 0.2, 0.3, base)],
        "track_id string, mood_cluster string, mood string, genre_family string, danceability float, "
        "energy float, valence float, event_timestamp timestamp")
    req = spark.createDataFrame([("a",), ("b",), ("nonexistent_track_id",)], "track_id string")
    got = {r["track_id"]: r for r in FT.mood_lookup(FT.features_latest(feats), req).collect()}
    assert got["a"]["found"] and got["a"]["mood_description"] == "Relaxed, feel-good, and easy-going"
    assert got["a"]["danceability"] == 0.1235
    assert got["b"]["mood_label"] == "Unknown" and got["b"]["genre_family"] == "Unknown"
    assert got["b"]["mood_description"] == ""
    miss = got["nonexistent_track_id"]
    assert not miss["found"] and miss["mood_label"] is None and miss["danceability"] is None


def _brute_as_of(feats, reqs, ttl_days):
    want = []
    for k, t in reqs:
        cands = [(ts, v) for kk, ts, v in feats if kk == k and ts is not None and t is not None
                 and t - dt.timedelta(days=ttl_days) < ts <= t]
        want.append((k, t, min(c for c in cands if c[0] == max(cands)[0])[1] if cands else None))
    return want


def test_as_of_hot_feature_and_request_side_in_stretches(spark):
    """A third of the feature rows and of the requests on one key (many
    requests at one identical time, feature rows tied at equal times); the
    scan equals brute force in any number of stretches, and every row is sent once."""
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    feats = []
    for i in range(600):
        k = "hot" if i % 3 == 0 else f"t{rnd.randint(0, 9)}"
        feats.append((k, base + dt.timedelta(hours=rnd.randint(0, 24 * 30)), float(rnd.randint(0, 1000))))
    feats += [("hot", feats[0][1], -5.0), ("hot", feats[0][1], 7.0)]  # ties at one time: smallest value wins
    reqs = [("hot", base + dt.timedelta(days=12))] * 150
    reqs += [("hot" if i % 3 == 0 else f"t{rnd.randint(0, 10)}", base + dt.timedelta(hours=rnd.randint(0, 24 * 35)))
             for i in range(450)]
    reqs += [(None, base), ("hot", None)]
    fdf = spark.createDataFrame(feats, "track_id string, event_timestamp timestamp, v double")
    rdf = spark.createDataFrame(reqs, "track_id string, request_ts timestamp")
    want = sorted(_brute_as_of(feats, reqs, 7), key=str)
    for partitions in (None, 2, 40):
        got = [(r["track_id"], r["request_ts"], r["v"])
               for r in FT.features_as_of(fdf, rdf, ttl_days=7, partitions=partitions).collect()]
        assert len(got) == len(reqs) and sorted(got, key=str) == want


def test_as_of_sends_every_row_once(spark, monkeypatch):
    """One range exchange holds all rows; the read after it has no shuffle."""
    n = 3000
    feats = spark.range(n).select(F.lit("hot").alias("track_id"), F.timestamp_seconds(F.col("id") % 50).alias("event_timestamp"),
                                  F.col("id").cast("double").alias("v"))
    reqs = spark.range(n).select(F.lit("hot").alias("track_id"), F.timestamp_seconds(F.lit(20)).alias("request_ts"))
    plans, plain = [], asof.stored
    monkeypatch.setattr(asof, "stored", lambda df, name: plans.append(df) or plain(df, name))
    out = FT.features_as_of(feats, reqs, ttl_days=7)
    assert {r["v"] for r in out.collect()} == {20.0}
    assert _shuffle_records(plans[0]) == [2 * n]
    assert "Exchange " not in out._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")


def test_as_of_one_key_in_one_instant_leaves_several_tasks(spark):
    """All features of a key in one instant, and all its requests in the next:
    both are cut, and every stretch is answered by the smallest tied value."""
    n = 4000
    base = F.timestamp_seconds(F.lit(1_700_000_000))
    feats = spark.range(n).select(F.lit(7).alias("track_id"), base.alias("event_timestamp"), (n - F.col("id")).alias("v"))
    reqs = spark.range(n).select(F.lit(7).alias("track_id"), (base + F.expr("INTERVAL 1 SECOND")).alias("request_ts"), F.col("id").alias("r"))
    out = FT.features_as_of(feats, reqs, ttl_days=7, partitions=8)
    rows = out.withColumn("file", F.input_file_name()).groupBy("file", "v").count().collect()
    assert sum(r["count"] for r in rows) == n and {r["v"] for r in rows} == {1}
    assert len(rows) >= 3 and max(r["count"] for r in rows) < n / 2


def test_as_of_other_types_and_clashing_names(spark):
    """Keys and values of other types, nested values, request columns named like the scan's own."""
    when = dt.datetime(2024, 1, 1)
    feats = spark.createDataFrame([(dt.date(2020, 1, 1), when, [1, 2], {"a": 1}), (dt.date(2020, 1, 1), when, None, {"b": 2}),
                                   (dt.date(2020, 1, 2), when, [3], None)], "d date, ts timestamp, v array<int>, k map<string,int>")
    reqs = spark.createDataFrame([(dt.date(2020, 1, 1), when, "x", None), (dt.date(2020, 1, 2), when, "y", b"q"), (None, when, "z", None)],
                                 "d date, t timestamp, r string, kind binary")
    out = FT.features_as_of(feats, reqs, key="d", req_ts="t", ts="ts", values=["v"])
    assert out.columns == ["d", "t", "r", "kind", "v", "ts"]
    assert {r["r"]: r["v"] for r in out.collect()} == {"x": None, "y": [3], "z": None}
    none = feats.limit(0)
    assert {r["v"] for r in FT.features_as_of(none, reqs, key="d", req_ts="t", ts="ts", values=["v"]).collect()} == {None}
    assert FT.features_as_of(feats, reqs.limit(0), key="d", req_ts="t", ts="ts", values=["v"]).collect() == []


def _shuffle_records(df):
    """Records written by each shuffle of the DataFrame's executed plan."""
    df.collect()  # runs the DataFrame's own query execution, whose plan carries the metrics
    out = []

    def walk(node):
        cls = node.getClass().getSimpleName()
        if cls == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "QueryStage" in cls:
            return walk(node.plan())
        if cls == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    assert out
    return out


def test_as_of_identical_requests_leave_several_tasks(spark):
    """The scan of 20,000 identical requests is cut into several tasks, each of
    which writes a file; all request columns stay."""
    base = dt.datetime(2024, 1, 1)
    feats = spark.createDataFrame([("hot", base + dt.timedelta(hours=h), float(h)) for h in range(240)],
                                  "track_id string, event_timestamp timestamp, v double")
    n = 20_000
    reqs = spark.range(n).select(F.lit("hot").alias("track_id"), F.lit(base + dt.timedelta(days=5)).alias("request_ts"),
                                 F.lit("same").alias("note"))
    out = FT.features_as_of(feats, reqs, ttl_days=7, partitions=8)
    rows = out.withColumn("file", F.input_file_name()).groupBy("file", "v", "note").count().collect()
    assert sum(r["count"] for r in rows) == n and {(r["v"], r["note"]) for r in rows} == {(120.0, "same")}
    assert len(rows) > 3 and max(r["count"] for r in rows) < n / 2
