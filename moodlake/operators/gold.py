"""Gold star schema: three dimensions, one fact, aggregates in two forms
(track-table form and star-join form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.functions.expr import first_artist, surrogate_key, ts_text
from moodlake.operators.scd2 import current_versions

DIM_TRACK_COLUMNS = ["track_id", "track_name", "duration_ms", "danceability", "energy", "valence",
                     "tempo", "acousticness", "instrumentalness"]


def _null_label() -> F.Column:
    return F.lit(None).cast("string").alias("mood_cluster")


def dim_track(tracks: DataFrame) -> DataFrame:
    return tracks.select(*DIM_TRACK_COLUMNS, _null_label())


def dim_artist(versions: DataFrame) -> DataFrame:
    """Versions with a surrogate key md5(artist_id + '_' + valid_from text)."""
    return versions.select(
        surrogate_key(F.col("artist_id"), ts_text("valid_from")).alias("artist_sk"),
        "artist_id", "artist_name", "artist_genre", "artist_popularity",
        "valid_from", "valid_to", "is_current",
    )


def dim_genre(tracks: DataFrame) -> DataFrame:
    """Distinct non-null genres; md5 of the name is the key."""
    g = tracks.select(F.col("track_genre").alias("genre_name")).filter(F.col("genre_name").isNotNull()).distinct()
    return g.select(F.md5("genre_name").alias("genre_id"), "genre_name")


def _artist_lookup(tracks: DataFrame, versions: DataFrame) -> DataFrame:
    """Tracks with `first_artist` and the current artist_id of that name (null
    when the name has no open version).  Artist ids are md5(name) and an artist
    has exactly one open version (an SCD2 invariant, property-tested), so the
    lookup is a plain equi-join on the id: no de-duplicating aggregate sits
    between the shuffle and the join, which keeps the join eligible for
    adaptive skew splitting when one artist fronts a large share of tracks."""
    cur = current_versions(versions).select(F.col("artist_id").alias("_aid"))
    t = tracks.withColumn("first_artist", first_artist("artists")).withColumn("_probe", F.md5("first_artist"))
    j = t.join(cur, t["_probe"] == cur["_aid"], "left")
    return j.withColumn("artist_id", F.col("_aid")).drop("_probe", "_aid")


def fact_streams(tracks: DataFrame, versions: DataFrame) -> DataFrame:
    """One row per silver track: keys to the artist (first listed, current
    version) and genre dimensions, ingestion date, popularity, label column.
    The genre dimension holds every genre of these tracks under the md5 of its
    name, so the key is computed in place; there is nothing to look up."""
    t = _artist_lookup(tracks, versions)
    d = F.to_date("ingestion_timestamp")
    return t.select(
        F.md5(F.concat_ws("_", F.col("track_id"), d.cast("string"))).alias("stream_id"),
        "track_id", "artist_id", F.md5("track_genre").alias("genre_id"),
        d.alias("ingestion_date"), "popularity", _null_label(),
    )


def mean(c: str, digits: int | None = None) -> F.Column:
    """Mean of a column.  With `digits`, the mean is exact and independent of
    summation order (values as decimal(38,9), exact decimal sum, half-up
    rounding), so published averages do not change with the partitioning;
    without, the plain double average (fastest path)."""
    if digits is None:
        return F.avg(c)
    return F.round(F.avg(F.col(c).cast("decimal(38,9)")), digits).cast("double")


def _means(digits: int | None) -> list[F.Column]:
    return [mean("popularity", digits).alias("avg_popularity"),
            mean("danceability", digits).alias("avg_danceability"),
            mean("energy", digits).alias("avg_energy")]


def agg_genre_trends(tracks: DataFrame, digits: int | None = None) -> DataFrame:
    """Per genre (null genre dropped): mean popularity, danceability, energy
    and the count of track ids.  Partial aggregation happens map-side."""
    t = tracks.filter(F.col("track_genre").isNotNull())
    m = _means(digits)
    return t.groupBy(F.col("track_genre").alias("genre_name")).agg(
        m[0], m[1], m[2], F.count("track_id").alias("track_count"))


def agg_artist_profiles(tracks: DataFrame, versions: DataFrame, digits: int | None = None) -> DataFrame:
    """Per first-listed artist with a current version: track count and means.
    Tracks whose first artist is unknown drop out (inner-join semantics)."""
    t = _artist_lookup(tracks, versions).filter(F.col("artist_id").isNotNull() & F.col("first_artist").isNotNull())
    return t.groupBy(F.col("first_artist").alias("artist_name"), "artist_id").agg(
        F.count("track_id").alias("track_count"), *_means(digits))


MEASURES = ["popularity", "danceability", "energy"]
STATE_KEYS = {"genre": lambda: F.col("track_genre"), "artist": lambda: first_artist("artists")}


def trend_state(tracks: DataFrame, by: str, parts: list[str] | None = None) -> DataFrame:
    """Partial sums behind the aggregates, per genre or first-listed artist (and
    the columns `parts`): exact sums and counts of each measure and the count of
    track ids.  States of disjoint sets of tracks add up (`merge_states`)."""
    key = STATE_KEYS[by]()
    out = tracks.filter(key.isNotNull()).groupBy(*(parts or []), key.alias("name"))
    sums = [F.sum(F.col(m).cast("decimal(38,9)")).alias(f"sum_{m}") for m in MEASURES]
    return out.agg(*sums, *[F.count(m).alias(f"n_{m}") for m in MEASURES], F.count("track_id").alias("track_count"))


def _state_mean(measure: str, digits: int) -> F.Column:
    """Exactly what mean() gives: the quotient of the exact sum at the scale of a decimal average, rounded half up."""
    quotient = F.expr(f"cast(sum_{measure} as decimal(26,9)) / cast(n_{measure} as decimal(11,0))")
    return F.round(F.when(F.col(f"n_{measure}") > 0, quotient).cast("decimal(38,13)"), digits).cast("double").alias(f"avg_{measure}")


def merge_states(states: DataFrame) -> DataFrame:
    return states.groupBy("name").agg(*[F.sum(c).cast(states.schema[c].dataType).alias(c) for c in states.columns
                                        if c.startswith(("sum_", "n_")) or c == "track_count"])


def genre_trends_of(states: DataFrame, digits: int) -> DataFrame:
    """agg_genre_trends from partial states."""
    return merge_states(states).select(F.col("name").alias("genre_name"), *[_state_mean(m, digits) for m in MEASURES], "track_count")


def artist_profiles_of(states: DataFrame, versions: DataFrame, digits: int) -> DataFrame:
    """agg_artist_profiles from partial states: artists with a current version."""
    known = current_versions(versions).select("artist_id")
    merged = merge_states(states).withColumn("artist_id", F.md5("name")).join(known, "artist_id", "left_semi")
    return merged.select(F.col("name").alias("artist_name"), "artist_id", "track_count", *[_state_mean(m, digits) for m in MEASURES])


def _star(fact: DataFrame, dim_t: DataFrame) -> DataFrame:
    return fact.select("track_id", "genre_id", "artist_id", "ingestion_date", "popularity").join(
        dim_t.select("track_id", "danceability", "energy"), "track_id")


def agg_genre_trends_by_date(fact: DataFrame, dim_t: DataFrame, digits: int | None = None) -> DataFrame:
    """Star form: fact x dim_track, per (genre_id, ingestion_date)."""
    return _star(fact, dim_t).groupBy("genre_id", "ingestion_date").agg(*_means(digits))


def agg_artist_profiles_star(fact: DataFrame, dim_t: DataFrame, digits: int | None = None) -> DataFrame:
    """Star form: fact x dim_track, per artist_id, distinct track count."""
    return _star(fact, dim_t).groupBy("artist_id").agg(
        F.count_distinct("track_id").alias("track_count"), *_means(digits))


def build_gold(tracks: DataFrame, versions: DataFrame, digits: int | None = None) -> dict[str, DataFrame]:
    """All six gold tables from silver tracks and the artist versions."""
    return {
        "dim_track": dim_track(tracks),
        "dim_artist": dim_artist(versions),
        "dim_genre": dim_genre(tracks),
        "fact_streams": fact_streams(tracks, versions),
        "agg_genre_trends": agg_genre_trends(tracks, digits),
        "agg_artist_profiles": agg_artist_profiles(tracks, versions, digits),
    }


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table: one small aggregate per table,
    unioned, so counts come back in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
