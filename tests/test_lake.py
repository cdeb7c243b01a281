"""The stored layers: commits, retries, two writers, upserts and what they read and write."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from moodlake.operators import artists as A
from moodlake.operators import features as FT
from moodlake.operators import gold as G
from moodlake.operators import quality as Q
from moodlake.operators import scd2 as S
from moodlake.operators.silver import build_silver
from moodlake.plans import jobs as J
from moodlake.plans import pipeline as PL
from moodlake.sources import fixture
from moodlake.sources.manifest import LostCommit, Manifest

from places import SMOKE

TIES = fixture.BRONZE_TIEBREAK


def new_base():
    return tempfile.mkdtemp(prefix="lake-", dir="/tmp")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def files_under(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_start_reads_one_file_after_many_runs(spark):
    base = new_base()
    manifest = Manifest(spark, base)
    for i in range(60):
        manifest.commit({"layers": {"a": {"kind": "table", "path": f"p{i}", "rows": i, "schema": "{}"}}})
    read = []
    late = Manifest(spark, base)
    plain = late.files.read
    late.files.read = lambda p: read.append(p) or plain(p)
    assert late.load()["layers"]["a"]["rows"] == 59 and len(read) == 1 and late.version == 60
    assert len(late.versions()) == late.kept


def test_of_two_writers_one_loses(spark):
    base = new_base()
    first, second = J.Lake(spark, base), J.Lake(spark, base)
    first.write("x", "t", spark.range(3).toDF("id"), "r1")
    with pytest.raises(LostCommit):
        second.write("x", "t", spark.range(5).toDF("id"), "r1")
    assert "t" not in second.layers and J.Lake(spark, base).read("t").count() == 3
    again = J.Lake(spark, base)
    again.write("x", "t", spark.range(5).toDF("id"), "r1")
    assert J.Lake(spark, base).read("t").count() == 5


def test_writes_together_are_one_version_or_none(spark):
    lake = J.Lake(spark, new_base())
    lake.write("x", "a", spark.range(1).toDF("id"), "r1")
    version = lake.manifest.version
    with pytest.raises(ZeroDivisionError), lake.together():
        lake.write("x", "a", spark.range(2).toDF("id"), "r2")
        lake.write("x", "b", spark.range(2).toDF("id"), "r2")
        assert lake.read("a").count() == 2
        1 / 0  # noqa: B018
    assert lake.manifest.version == version and lake.read("a").count() == 1 and "b" not in lake.layers
    with lake.together():
        lake.write("x", "a", spark.range(4).toDF("id"), "r3")
        lake.write("x", "b", spark.range(4).toDF("id"), "r3")
    assert lake.manifest.version == version + 1 and J.Lake(spark, lake.base).counts == {"a": 4, "b": 4}


def test_retry_under_one_run_id_never_writes_where_it_reads(spark):
    base, raw = new_base(), PL.bronze(spark, SMOKE)
    lake = J.Lake(spark, base)
    for step in range(2):
        before = files_under(base)
        J.run_bronze(lake, raw, "r1")
        J.run_silver(lake, "r1", TIES)
        J.run_artists(lake, "r1", "2024-01-01 00:00:00")
        if not step:
            first, counts = rows_of(lake.read("artists")), dict(lake.counts)
        assert {f: t for f, t in files_under(base).items() if f in before} == before  # nothing rewritten or removed
    assert rows_of(lake.read("artists")) == first and lake.counts == counts
    # the attempts that are current no more go once no kept version names them
    assert lake.vacuum(older_than=0) == []
    lake.manifest.kept = 1
    lake.write("x", "t", spark.range(1).toDF("id"), "r2")
    gone = lake.vacuum(older_than=0)
    assert gone and not any(p in g for g in gone for p in lake.paths.values())
    assert rows_of(J.Lake(spark, base).read("artists")) == first


def test_death_between_data_and_commit_leaves_the_run_before(spark, monkeypatch):
    base = new_base()
    lake = J.Lake(spark, base)
    lake.write("x", "t", spark.range(3).toDF("id"), "r1")
    monkeypatch.setattr(lake.manifest, "commit", lambda state: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        lake.write("x", "t", spark.range(9).toDF("id"), "r1")
    assert lake.read("t").count() == 3 and J.Lake(spark, base).read("t").count() == 3


def days(spark):
    """Bronze rows of three days, by ingestion time: the later ones few, the last with an out-of-range newest row."""
    raw = PL.bronze(spark, SMOKE).cache()
    at = raw.select(F.percentile_approx("ingestion_timestamp", [0.9, 0.99])).first()[0]
    ts = F.col("ingestion_timestamp")
    late = raw.filter(ts > F.lit(at[1]))
    some = late.limit(3).withColumn("ingestion_timestamp", F.lit(dt.datetime(2030, 1, 1))).withColumn("danceability", F.lit(7.5).cast(raw.schema["danceability"].dataType))
    return [raw.filter(ts <= F.lit(at[0])), raw.filter((ts > F.lit(at[0])) & (ts <= F.lit(at[1]))), late.unionByName(some)]


def test_upsert_equals_a_rebuild(spark):
    """Silver, its quality counts and the aggregates after three days equal those built from all rows."""
    lake, landed = J.Lake(spark, new_base()), None
    for i, day in enumerate(days(spark)):
        landed = day if landed is None else landed.unionByName(day)
        J.run_bronze(lake, day, f"r{i}")
        touched = J.run_silver_upsert(lake, f"r{i}", TIES)
        J.run_artists(lake, f"r{i}", f"2024-01-0{i + 1} 00:00:00")
        want = build_silver(landed, TIES).cache()
        assert rows_of(lake.read("silver")) == rows_of(want)
        report = J.run_silver_quality(lake, f"r{i}", minimum=1, enforce=False)
        assert rows_of(report) == rows_of(Q.dq_silver(want, lake.read("artists"), 1))
        J.run_trends(lake, f"r{i}", touched)
        assert rows_of(lake.read("agg_genre_trends")) == rows_of(G.agg_genre_trends(want, 6))
        assert rows_of(lake.read("agg_artist_profiles")) == rows_of(G.agg_artist_profiles(want, lake.read("artists"), 6))


def test_upsert_reads_and_writes_only_touched_buckets(spark):
    lake = J.Lake(spark, new_base())
    day = PL.bronze(spark, SMOKE)
    J.run_bronze(lake, day, "r1")
    J.run_silver_upsert(lake, "r1", TIES)
    before = {n: dict(lake.layers[n]["parts"]) for n in ("latest", "silver")}
    one = day.select("track_id").first()[0]
    J.run_bronze(lake, day.filter(F.col("track_id") == one).withColumn("ingestion_timestamp", F.lit(dt.datetime(2030, 1, 1))), "r2")
    touched = J.run_silver_upsert(lake, "r2", TIES)
    assert len(touched) == 1
    for name in before:
        now = lake.layers[name]["parts"]
        assert {k for k in now if now[k] != before[name].get(k)} <= set(touched)
    read = lake.read_parts("latest", touched).inputFiles()
    assert 0 < len(read) < len(lake.read("latest").inputFiles()) / 8
    written = files_under(lake.paths["silver"])
    assert written and all(f"_bucket={touched[0]}/" in f for f in written)
    row = lake.read("silver").filter(F.col("track_id") == one).first()
    assert row is None or row["ingestion_timestamp"] == dt.datetime(2030, 1, 1)


def test_silver_report_scans_silver_only_for_the_referential_check(spark):
    lake = J.Lake(spark, new_base())
    J.run_bronze(lake, PL.bronze(spark, SMOKE), "r1")
    J.run_silver(lake, "r1", TIES)
    J.run_artists(lake, "r1", "2024-01-01 00:00:00")
    report = Q.dq_silver_observed(lake.observed("silver"), lake.read("silver"), lake.read("artists"), 1)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    scans = [x for x in plan.splitlines() if "Relation" in x and "track_id" in x]
    assert len(scans) == 1 and rows_of(report) == rows_of(Q.dq_silver(lake.read("silver"), lake.read("artists"), 1))


def snapshots(spark):
    tracks = PL.silver(spark, SMOKE).cache()
    return [PL.snapshot_at(tracks, cutoff) for cutoff, _ in fixture.SNAPSHOTS], [ts for _, ts in fixture.SNAPSHOTS]


def test_stored_versions_equal_the_merge(spark, monkeypatch):
    """Three merges through buckets of open versions and segments of closed ones; only the snapshot is exchanged."""
    shots, times = snapshots(spark)
    lake, want = J.Lake(spark, new_base()), None
    current = {}
    monkeypatch.setattr(A, "artist_snapshot", lambda df: current["shot"])
    lake.write("silver", "silver", spark.range(1).toDF("id"), "r0")
    segments = 0
    for i, (shot, ts) in enumerate(zip(shots, times)):
        current["shot"] = shot
        before = files_under(lake.base)
        J.run_artists(lake, f"r{i}", ts)
        want = S.scd2_merge(want, shot, ts)
        assert rows_of(lake.read("artists")) == rows_of(want)
        assert lake.counts["artists"] == want.count()
        assert {f: t for f, t in files_under(lake.base).items() if f in before} == before
        segments = len(lake.layers["artists"]["segments"])
    assert segments >= 1
    assert rows_of(lake.read("artists").filter("is_current")) == rows_of(want.filter("is_current"))
    plan = S.merge_open(lake.open_versions("artists"), spark.createDataFrame(shots[-1].collect(), shots[-1].schema), times[-1], null_keys=False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount" in text and text.count("Exchange hashpartitioning") == 1 and "FullOuter" in text


def test_closed_versions_are_compacted(spark, monkeypatch):
    lake = J.Lake(spark, new_base())
    monkeypatch.setattr(J, "SEGMENTS", 3)
    for i in range(6):
        rows = [(k, f"n{k}", "g", i, f"h{k}-{i}", dt.datetime(2024, 1, 1), None if cur else dt.datetime(2024, 2, 1), cur)
                for k in range(5) for cur in ((True, False) if i else (True,))]
        schema = ("artist_id long, artist_name string, artist_genre string, artist_popularity int, row_hash string, "
                  "valid_from timestamp, valid_to timestamp, is_current boolean")
        lake.write_versions("silver", "v", spark.createDataFrame(rows, schema).repartition(4, "artist_id"), f"r{i}", "artist_id", 4)
    assert len(lake.layers["v"]["segments"]) < 3 and lake.counts["v"] == 5 + 25 and lake.read("v").count() == 30


def test_null_keys_merge_as_before(spark):
    schema = "artist_id string, row_hash string"
    had = S.first_load(spark.createDataFrame([(None, "a"), ("x", "a")], schema), "2024-01-01 00:00:00")
    out = S.scd2_merge(had, spark.createDataFrame([(None, "b"), ("x", "a")], schema), "2024-01-02 00:00:00")
    assert sorted((r["artist_id"], r["row_hash"], r["is_current"]) for r in out.collect() if r["artist_id"] is None) == [(None, "a", False), (None, "b", True)]
    assert out.count() == 3


def test_labels_are_written_only_on_dates_that_change(spark):
    lake = J.Lake(spark, new_base())
    J.daily(lake, PL.bronze(spark, SMOKE), "r1", "2024-01-01 00:00:00", TIES, minimum=1)
    J.run_mood(lake, "r1", "2024-01-01 00:00:00")
    first = rows_of(lake.read("fact_streams"))
    labelled = {d: p["root"] for d, p in lake.layers["fact_streams"]["parts"].items()}
    J.run_mood(lake, "r2", "2024-01-02 00:00:00")  # no label changes
    assert {d: p["root"] for d, p in lake.layers["fact_streams"]["parts"].items()} == labelled
    # one track loses its label in the stored fact; the job puts it right, on its date alone
    row = lake.read("fact_streams").filter("mood_cluster is not null").first()
    day = str(row["ingestion_date"])
    wrong = lake.read_parts("fact_streams", [day]).withColumn("mood_cluster", F.when(F.col("track_id") != row["track_id"], F.col("mood_cluster")))
    lake.write_parts("gold", "fact_streams", wrong, "r3", "ingestion_date", [day])
    J.run_mood(lake, "r4", "2024-01-03 00:00:00")
    now = {d: p["root"] for d, p in lake.layers["fact_streams"]["parts"].items()}
    assert {d for d in now if now[d] != labelled[d]} == {day} and rows_of(lake.read("fact_streams")) == first


def _scanned_rows(df):
    """Rows that the Parquet scans of the executed plan gave out: those of row groups not excluded."""
    df.collect()
    found = []

    def walk(node):
        cls = node.getClass().getSimpleName()
        if cls == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "QueryStage" in cls:
            return walk(node.plan())
        if cls == "FileSourceScanExec":
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_point_lookup_reads_few_row_groups(spark):
    """Of 400,000 ids in many row groups, 1,000 neighbouring ones (and some
    unknown) read a few groups; scattered unknown ids none at all; the answers
    are those of a join with the whole table."""
    n = 400_000
    feats = spark.range(n).select(
        F.format_string("T%07d", "id").alias("track_id"), F.lit("Chill Pop").alias("mood_cluster"), F.lit("Relaxed").alias("mood"),
        F.lit("Pop").alias("genre_family"), *[(F.rand(1) + i).cast("float").alias(c) for i, c in enumerate(("danceability", "energy", "valence"))],
        F.lit(dt.datetime(2024, 1, 1)).alias("event_timestamp"))
    lake = J.Lake(spark, new_base())
    ordered, options = FT.lookup_layout(feats, rows=n, row_group_bytes=100_000)
    lake.write("features", "lookup", ordered, "r1", options=options)
    near = spark.range(990).select(F.format_string("T%07d", F.col("id") + 123_000).alias("track_id"), "id")
    unknown = spark.range(10).select(F.format_string("T%07dx", F.col("id") * 39_000).alias("track_id"), "id")
    requests = near.unionByName(unknown)
    got, want = J.lookup(lake, requests), FT.mood_lookup(lake.read("lookup"), requests)
    assert rows_of(got) == rows_of(want) and got.filter("found").count() == 990
    few = FT.named_ids(lake.read("lookup"), requests)
    assert 990 <= _scanned_rows(few) < n / 10
    assert _scanned_rows(FT.named_ids(lake.read("lookup"), unknown)) < n / 20  # Bloom filters: statistics cannot tell
    many = spark.range(3000).select(F.format_string("T%07d", F.col("id") * 100).alias("track_id"), "id")
    assert J.lookup(lake, many).filter("found").count() == 3000 and J.lookup(lake, many.limit(0)).count() == 0


def test_lookup_job(spark):
    lake = J.Lake(spark, new_base())
    J.daily(lake, PL.bronze(spark, SMOKE), "r1", "2024-01-01 00:00:00", TIES, minimum=1)
    J.run_mood(lake, "r1", "2024-01-01 00:00:00")
    J.run_lookup(lake, "r1")
    ids = lake.read("silver").select("track_id").limit(5)
    assert J.lookup(lake, ids.unionByName(spark.createDataFrame([("none",)], "track_id string"))).filter("found").count() == 5


def test_incremental_days_give_the_gold_of_a_rebuild(spark):
    """Three incremental days, each a whole daily run, against gold built from all rows."""
    lake, landed = J.Lake(spark, new_base()), None
    for i, day in enumerate(days(spark)):
        landed = day if landed is None else landed.unionByName(day)
        J.daily(lake, day, f"r{i}", f"2024-01-0{i + 1} 00:00:00", TIES, minimum=1, incremental=True)
    want = G.build_gold(build_silver(landed, TIES), lake.read("artists"), 6)
    for name in J.GOLD_TABLES:
        assert rows_of(lake.read(name)) == rows_of(want[name]), name


def test_key_check_finds_a_duplicate_across_runs(spark):
    """A day's check reads old days only for keys that the stored filter may hold."""
    lake = J.Lake(spark, new_base())
    day = lambda d, ids: spark.createDataFrame([(f"k{i}" if i is not None else None, d) for i in ids], "stream_id string, day string")

    def land(d, ids, run):
        lake.write_parts("gold", "fact", day(d, ids), run, "day", [d])
        return {r["check_name"]: r["observed"] for r in J.run_key_check(lake, "fact", "stream_id", run, [d], enforce=False).collect()}

    assert land("d1", range(500), "r1") == {"not_null": 0, "unique": 0}
    assert land("d2", range(500, 900), "r2") == {"not_null": 0, "unique": 0}
    words = lake.read_parts("fact_keys", ["d1", "d2"]).select("word", "mask")
    assert Q.maybe_known(day("d3", range(5000, 9000)), words, "stream_id").count() == 0  # no old row is read for these
    assert land("d3", [*range(2000, 2100), 7, 650], "r3") == {"not_null": 0, "unique": 2}  # planted: keys of days 1 and 2
    assert land("d3", range(2000, 2100), "r4") == {"not_null": 0, "unique": 0}  # the day written again, mended
    assert land("d4", [9000, 9000, None, 2001], "r5") == {"not_null": 1, "unique": 2}
    with pytest.raises(ValueError, match="unique"):
        J.run_key_check(lake, "fact", "stream_id", "r6", ["d4"])


def test_key_check_of_parts_older_than_the_filter(spark):
    lake = J.Lake(spark, new_base())
    rows = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 4).cast("string").alias("p"))
    lake.write_parts("gold", "t", rows, "r1", "p")
    lake.write_parts("gold", "t", spark.createDataFrame([(5, "9")], "k long, p string"), "r2", "p", ["9"])
    got = {r["check_name"]: r["observed"] for r in J.run_key_check(lake, "t", "k", "r2", ["9"], enforce=False).collect()}
    assert got == {"not_null": 0, "unique": 1} and set(lake.layers["t_keys"]["parts"]) == {"0", "1", "2", "3", "9"}
