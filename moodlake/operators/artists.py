"""Artist extraction from the multi-valued `artists` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.functions.expr import row_hash, split_artists, strip_ws


def explode_artists(tracks: DataFrame, keep: list[str] | None = None, artists_col: str = "artists") -> DataFrame:
    """One row per (track, listed artist): `position` is the place in the list,
    `artist_name` is trimmed, blank names are skipped.  Null lists give no rows."""
    keep = keep if keep is not None else [c for c in tracks.columns if c != artists_col]
    exploded = tracks.select(*keep, F.posexplode(split_artists(artists_col)).alias("position", "_raw"))
    return (exploded.withColumn("artist_name", strip_ws("_raw")).drop("_raw")
            .filter(F.length("artist_name") > 0))


def artist_snapshot(tracks: DataFrame) -> DataFrame:
    """Current view of every artist named in the tracks:
    artist_id = md5(name); genre and popularity come from the artist's first
    track row, ordered newest ingestion first, then track_id, then list
    position; row_hash fingerprints the tracked attributes.

    `row_number() = 1` gets a partial WindowGroupLimit before the shuffle, so an
    artist on a third of all tracks still ships one row per map task.
    """
    rows = explode_artists(tracks, keep=["track_id", "track_genre", "popularity", "ingestion_timestamp"])
    rows = rows.withColumn("artist_id", F.md5("artist_name"))
    w = Window.partitionBy("artist_id").orderBy(F.col("ingestion_timestamp").desc_nulls_last(),
                                                F.col("track_id").asc_nulls_first(), F.col("position"))
    first = rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return first.select(
        "artist_id", "artist_name",
        F.col("track_genre").alias("artist_genre"),
        F.col("popularity").alias("artist_popularity"),
        row_hash("artist_id", "artist_name", "track_genre", "popularity").alias("row_hash"),
    )


def distinct_track_artists(tracks: DataFrame) -> DataFrame:
    """Distinct trimmed, non-blank artist names across tracks (partial
    aggregation before the shuffle)."""
    return explode_artists(tracks, keep=[]).select("artist_name").distinct()
