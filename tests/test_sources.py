import json
import os
import tempfile

from pyspark.sql import functions as F

from moodlake.functions.params import TRACK_SCHEMA
from moodlake.plans import pipeline as PL
from moodlake.sources import albums as AL
from moodlake.sources import catalog, csv, jdbc, tables

from places import SMOKE


def scratch():
    return tempfile.mkdtemp(prefix="moodlake-test-", dir="/tmp")


def test_csv_ingest_roundtrip_drops_index_column(spark):
    d = scratch()
    bronze = PL.bronze(spark, SMOKE).drop("ingestion_timestamp", "source", "src_orderkey", "src_linenumber",
                                          "src_suppkey")
    n = bronze.count()
    bronze.withColumn("_c0", F.monotonically_increasing_id()).select("_c0", *bronze.columns) \
        .write.option("header", True).csv(os.path.join(d, "tracks"))
    raw = csv.read_tracks_csv(spark, os.path.join(d, "tracks"))
    assert "_c0" not in raw.columns and raw.count() == n
    out = csv.add_ingest_metadata(raw, "2024-01-01 00:00:00", "kaggle")
    r = out.select("ingestion_timestamp", "source").distinct().collect()
    assert len(r) == 1 and r[0]["source"] == "kaggle"
    # types line up with the canonical schema after conform
    from moodlake.operators.silver import conform_schema
    assert [c for c, _ in TRACK_SCHEMA if c in out.columns] == conform_schema(out).columns


def test_write_table_counts_and_reads_back(spark):
    d = scratch()
    path = tables.run_path(d, "silver", "tracks", "r1")
    silver = PL.silver(spark, SMOKE)
    n = tables.write_table(silver, path)
    assert n == silver.count() == tables.read_table(spark, path).count()
    # a run-scoped path never collides with the one being read
    assert tables.run_path(d, "silver", "tracks") != path


def test_album_json_with_missing_track_list(spark):
    d = scratch()
    recs = [{"id": "a1", "name": "One", "tracks": [
                {"id": "x", "name": "X", "artists": [{"name": "P"}, {"name": "Q"}], "duration_ms": 5, "explicit": True},
                {"id": "y", "artists": []}]},
            {"id": "a2", "name": "Two"},
            {"id": "a3", "name": "Three", "tracks": []}]
    with open(os.path.join(d, "albums.json"), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")
    flat = AL.flatten_albums(AL.read_albums(spark, d), "2024-01-01 00:00:00").orderBy("track_id").collect()
    assert [(r["track_id"], r["track_name"], r["artists"], r["duration_ms"], r["explicit"], r["popularity"])
            for r in flat] == [("x", "X", "P;Q", 5, True, 0), ("y", "", "", 0, False, 0)]
    assert all(r["energy"] is None and r["source"] == "spotify" and r["track_genre"] == "" for r in flat)


def test_union_sources_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "k")], "x int, source string")
    b = spark.createDataFrame([("s", 2.0)], "source string, y double")
    u = AL.union_sources(a, b)
    assert set(u.columns) == {"x", "source", "y"} and u.count() == 2


def test_jdbc_export_to_embedded_database(spark):
    url = "jdbc:derby:memory:moodlake_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    g = PL.gold(spark, SMOKE)
    small = {"dim_genre": g["dim_genre"], "agg_genre_trends": g["agg_genre_trends"]}
    counts = jdbc.export_jdbc(small, url, props)
    assert counts == {"gold_dim_genre": g["dim_genre"].count(), "gold_agg_genre_trends": g["agg_genre_trends"].count()}
    back = spark.read.jdbc(url, "gold_dim_genre", properties=props)
    assert back.count() == counts["gold_dim_genre"]
    # replace, not append
    jdbc.export_jdbc(small, url, props)
    assert spark.read.jdbc(url, "gold_dim_genre", properties=props).count() == counts["gold_dim_genre"]


def test_register_gold_views(spark):
    g = PL.gold(spark, SMOKE)
    catalog.register_gold(spark, g, mode="view")
    n = spark.sql("select count(*) as n from fact_streams f join dim_track d using (track_id)").first()["n"]
    assert n == g["fact_streams"].count()


def test_register_gold_as_tables(spark):
    """mode='table' writes managed tables that SQL reads."""
    spark.sql("create database if not exists moodlake_test")
    try:
        tables_ = {"dim_genre": PL.G.dim_genre(PL.silver(spark, SMOKE))}
        assert catalog.register_gold(spark, tables_, mode="table", database="moodlake_test") == ["moodlake_test.dim_genre"]
        assert spark.sql("select * from moodlake_test.dim_genre").count() == tables_["dim_genre"].count()
    finally:
        spark.sql("drop database moodlake_test cascade")
