"""Property tests on random frames (hypothesis) and empty inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodlake.functions.expr import row_hash
from moodlake.functions.params import TRACK_SCHEMA
from moodlake.operators import artists as A
from moodlake.operators import gold as G
from moodlake.operators import mood as M
from moodlake.operators import quality as Q
from moodlake.operators import scd2 as S
from moodlake.operators.silver import build_silver, dedup_latest

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
T0 = dt.datetime(2024, 1, 1)

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.integers(0, 5),
                             st.integers(0, 100)), max_size=40)


@SETTINGS
@given(rows_st)
def test_dedup_unique_keys_and_latest(spark, rows):
    data = [(k, T0 + dt.timedelta(days=d), tb, v) for k, d, tb, v in rows]
    df = spark.createDataFrame(data, "k string, ts timestamp, tb int, v int")
    out = dedup_latest(df, "k", "ts", ["tb", "v"]).collect()
    keys = [r["k"] for r in out]
    assert len(keys) == len(set(keys)) == len({r[0] for r in data})
    for r in out:
        best = min((x for x in data if x[0] == r["k"]), key=lambda x: (-x[1].timestamp(), x[2], x[3]))
        assert (r["ts"], r["tb"], r["v"]) == best[1:]


snap_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 2)), max_size=6,
                   unique_by=lambda x: x[0])


@SETTINGS
@given(st.lists(snap_st, min_size=1, max_size=4))
def test_scd2_invariants(spark, snaps):
    v = None
    for i, snap in enumerate(snaps):
        df = spark.createDataFrame([(a, a.upper(), "g", p) for a, p in snap] or [("zz", "ZZ", "g", 0)][:0],
                                   "artist_id string, artist_name string, artist_genre string, "
                                   "artist_popularity bigint")
        df = df.withColumn("row_hash", row_hash("artist_id", "artist_name", "artist_genre", "artist_popularity"))
        v = S.scd2_merge(v, df, f"2024-01-0{i + 1} 00:00:00")
        again = S.scd2_merge(v, df, f"2024-02-0{i + 1} 00:00:00")
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, v.collect()))
    rows = v.collect()
    by = {}
    for r in rows:
        by.setdefault(r["artist_id"], []).append(r)
    for vs in by.values():
        assert sum(r["is_current"] for r in vs) == 1
        vs.sort(key=lambda r: r["valid_from"])
        for x, y in zip(vs, vs[1:]):
            assert x["valid_to"] == y["valid_from"] and not x["is_current"]


def test_empty_inputs(spark):
    schema = ", ".join(f"`{c}` {t}" for c, t in TRACK_SCHEMA)
    bronze = spark.createDataFrame([], schema)
    silver = build_silver(bronze)
    assert silver.count() == 0
    snap = A.artist_snapshot(silver)
    v = S.scd2_merge(None, snap, "2024-01-01 00:00:00")
    assert v.count() == 0
    gold = G.build_gold(silver, v, 6)
    assert all(df.count() == 0 for df in gold.values())
    assert M.classify_tracks(silver).count() == 0
    rep = {(r["check_name"], r["column_name"]): r for r in Q.dq_silver(silver, v).collect()}
    assert rep[("row_count", None)]["observed"] == 0 and not rep[("row_count", None)]["passed"]
    assert rep[("referential", "artists")]["passed"]
    assert Q.dq_gold(gold).filter(~F.col("passed")).count() == 0


as_of_st = st.tuples(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 30 * 24), st.integers(-3, 3)),
             max_size=40),
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                       st.one_of(st.none(), st.integers(0, 34 * 24), st.just(12 * 24))), max_size=60),
    st.integers(1, 9), st.integers(1, 9))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(as_of_st)
def test_as_of_equals_brute_force(spark, case):
    """Any number of stretches, a popular request time, tied feature times, null
    keys and times give the brute-force answer: the
    newest feature with request - ttl < ts <= request, ties to the smallest value."""
    from moodlake.operators.features import features_as_of
    feats, reqs, partitions, ttl = case
    f = [(k, T0 + dt.timedelta(hours=h), float(v)) for k, h, v in feats]
    r = [(k, None if h is None else T0 + dt.timedelta(hours=h)) for k, h in reqs]
    fdf = spark.createDataFrame(f, "track_id string, event_timestamp timestamp, v double")
    rdf = spark.createDataFrame(r, "track_id string, request_ts timestamp")
    out = features_as_of(fdf, rdf, ttl_days=ttl, partitions=partitions)
    got = sorted(((x["track_id"], x["request_ts"], x["v"], x["event_timestamp"]) for x in out.collect()), key=str)
    want = []
    for k, t in r:
        c = [(ts, v) for kk, ts, v in f if k is not None and t is not None and kk == k
             and t - dt.timedelta(days=ttl) < ts <= t]
        best = max(c)[0] if c else None
        want.append((k, t, min(v for ts, v in c if ts == best) if c else None, best))
    assert got == sorted(want, key=str)


lookup_st = st.tuples(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.sampled_from(["Chill Pop", None])),
             max_size=12),
    st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=40))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(lookup_st)
def test_lookup_returns_every_request_row(spark, case):
    """One output row per request row (duplicates and null ids kept, with
    all its columns); `found` and the label come from the newest feature row."""
    from moodlake.operators.features import features_latest, mood_lookup
    feats, reqs = case
    f = [(k, lab, 0.5, 0.5, 0.5, T0 + dt.timedelta(days=d)) for k, d, lab in feats]
    fdf = spark.createDataFrame(f, "track_id string, mood_cluster string, danceability float, energy float, "
                                   "valence float, event_timestamp timestamp").withColumn("genre_family", F.lit("Pop"))
    rdf = spark.createDataFrame(list(enumerate(reqs)), "request_id int, track_id string")
    out = mood_lookup(features_latest(fdf), rdf).collect()
    assert sorted((x["request_id"], x["track_id"]) for x in out) == list(enumerate(reqs))
    got = sorted(((x["track_id"], x["found"], x["mood_label"]) for x in out), key=str)
    latest = {}  # newest row per id; ties on time keep the smallest label, null first
    for k, lab, *_rest, ts in f:
        rank = (ts, lab is None, "" if lab is None else tuple(-ord(ch) for ch in lab))
        if k not in latest or rank > latest[k][0]:
            latest[k] = (rank, lab)
    want = []
    for r in reqs:
        hit = latest.get(r) if r is not None else None
        want.append((r, hit is not None, (hit[1] or "Unknown") if hit else None))
    assert got == sorted(want, key=str)
