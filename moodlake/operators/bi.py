"""Dashboard queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.operators.mood import mood_catalog


def bi_top_genres(genre_trends: DataFrame, n: int = 10) -> DataFrame:
    """Top genres by average popularity (name breaks ties).  The limit is the
    feature: Spark plans it as a per-partition top-n, then a final one."""
    return (genre_trends.select("genre_name", "avg_popularity", "track_count")
            .orderBy(F.col("avg_popularity").desc(), F.col("genre_name").asc()).limit(n))


def bi_genre_scatter(genre_trends: DataFrame) -> DataFrame:
    """Danceability vs energy, one point per genre."""
    return genre_trends.select("genre_name", "avg_danceability", "avg_energy")


def bi_mood_share(classified: DataFrame, col: str = "mood", digits: int = 4) -> DataFrame:
    """Tracks per mood and share of all tracks.  The grand total is a window
    over the already-aggregated rows (at most one row per label)."""
    counts = classified.groupBy(col).agg(F.count(F.lit(1)).alias("track_count"))
    total = F.sum("track_count").over(Window.partitionBy())
    return counts.select(col, "track_count",
                         F.round(F.col("track_count") / total, digits).alias("share"))


def bi_mood_catalog(share: DataFrame) -> DataFrame:
    """All ten moods of the catalog with rank, description, tracks and share;
    a mood without tracks has 0."""
    moods = mood_catalog(share.sparkSession)
    return (moods.join(share, "mood", "left")
            .select("mood_rank", "mood", "description", F.coalesce("track_count", F.lit(0)).alias("track_count"),
                    F.coalesce("share", F.lit(0.0)).alias("share")))


def bi_release_trend(fact: DataFrame) -> DataFrame:
    """Tracks per ingestion date."""
    return fact.groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("track_count"))


def bi_top_artists(artist_profiles: DataFrame, n: int = 10) -> DataFrame:
    return (artist_profiles.select("artist_name", "artist_id", "track_count")
            .orderBy(F.col("track_count").desc(), F.col("artist_name").asc()).limit(n))
