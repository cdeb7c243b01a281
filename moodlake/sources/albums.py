"""New-release records (album -> tracks -> artists) shaped into bronze rows,
and the union of sources into one bronze table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.functions.params import TRACK_SCHEMA

ALBUM_SCHEMA = ("id string, name string, "
                "tracks array<struct<id: string, name: string, artists: array<struct<name: string>>, "
                "duration_ms: bigint, explicit: boolean>>")

# Audio features the release feed does not carry: typed nulls.
FEED_NULL_COLUMNS = ["danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
                     "instrumentalness", "liveness", "valence", "tempo", "time_signature"]


def read_albums(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON album records with a fixed schema (no inference pass)."""
    return spark.read.schema(ALBUM_SCHEMA).json(path)


def flatten_albums(albums: DataFrame, run_ts: str | Column, source: str = "spotify") -> DataFrame:
    """One bronze row per album track: artist names joined with ';', empty
    genre, popularity 0, absent duration 0 / explicit false, features null.
    Albums without a track list contribute nothing."""
    ts = F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts.cast("timestamp")
    t = albums.select(F.col("name").alias("_album"), F.explode("tracks").alias("t"))
    types = dict(TRACK_SCHEMA)
    cols = {
        "track_id": F.col("t.id"),
        "track_name": F.coalesce(F.col("t.name"), F.lit("")),
        "artists": F.array_join(F.transform(F.coalesce(F.col("t.artists"), F.array()), lambda a: a["name"]), ";"),
        "album_name": F.coalesce(F.col("_album"), F.lit("")),
        "track_genre": F.lit(""),
        "popularity": F.lit(0).cast("bigint"),
        "duration_ms": F.coalesce(F.col("t.duration_ms"), F.lit(0)).cast("bigint"),
        "explicit": F.coalesce(F.col("t.explicit"), F.lit(False)),
    }
    for c in FEED_NULL_COLUMNS:
        cols[c] = F.lit(None).cast(types[c])
    cols["ingestion_timestamp"] = ts
    cols["source"] = F.lit(source)
    return t.select(*[cols[c].alias(c) for c, _ in TRACK_SCHEMA])


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
