"""Layer compositions over the driver tables: each function returns a lazy
DataFrame plan; nothing is collected.  Jobs that persist layers live in
`moodlake.plans.jobs`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.operators import artists as A
from moodlake.operators import gold as G
from moodlake.operators import mood as M
from moodlake.operators import scd2 as S
from moodlake.operators.features import build_features
from moodlake.operators.silver import build_silver
from moodlake.session import stored
from moodlake.sources import fixture

DIGITS = 6  # averages are reported to 6 decimals (double sums are order dependent)


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.bronze_tracks(spark, sf)


def silver(spark: SparkSession, sf: str, materialize: bool = False) -> DataFrame:
    """Silver plan.  With `materialize`, the layer is written once to the
    shared checkpoint folder and read back (lineage cut): compositions that
    consume silver in several branches then do not repeat the bronze dedup
    shuffle per branch (column pruning makes those branches' exchanges
    differ, so exchange reuse cannot merge them)."""
    df = build_silver(bronze(spark, sf), tiebreak=fixture.BRONZE_TIEBREAK, stamps=fixture.bronze_stamps(spark, sf))
    if materialize:
        df = stored(df, "silver")
    return df


def snapshot_at(tracks: DataFrame, cutoff: str | None) -> DataFrame:
    t = tracks if cutoff is None else tracks.filter(F.col("ingestion_timestamp") < F.lit(cutoff).cast("timestamp"))
    return A.artist_snapshot(t)


def artist_versions(spark: SparkSession, sf: str, steps: int = 3, tracks: DataFrame | None = None) -> DataFrame:
    """Artist SCD2 table after `steps` successive snapshots of silver.  Every
    merge but the last is stored, as the job stores it: a merge reads the version
    table twice, and what is not stored would be computed twice at each step."""
    tracks = tracks if tracks is not None else silver(spark, sf, materialize=True)
    versions = None
    for cutoff, run_ts in fixture.SNAPSHOTS[:steps]:
        versions = S.scd2_merge(versions if versions is None else stored(versions, "versions"), snapshot_at(tracks, cutoff), run_ts)
    return versions


def gold(spark: SparkSession, sf: str, digits: int | None = DIGITS) -> dict[str, DataFrame]:
    """Six gold tables.  Silver and the artist version table are each
    stored once (as the persisted jobs store them): several tables
    read them, and a stored version table keeps the first-artist join
    eligible for adaptive skew splitting (no window between its shuffle and
    the join)."""
    tracks = silver(spark, sf, materialize=True)
    versions = stored(artist_versions(spark, sf, tracks=tracks), "artists")
    return G.build_gold(tracks, versions, digits)


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return M.classify_tracks(silver(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return build_features(classified(spark, sf), fixture.RUN_TS)


def feature_history(spark: SparkSession, sf: str, materialize: bool = False) -> DataFrame:
    """Feature rows of three successive runs, run i over the silver rows
    ingested before its cut-off.  Classification is row-wise, so silver is
    classified once and each row is fanned out (a generator, not a union of
    three re-computations) to the runs that saw it.  With `materialize` the
    table is stored (it stands for the stored feature table) for
    readers that scan it more than once."""
    cls = classified(spark, sf)
    runs = F.array(*[F.struct(F.lit(cut).cast("timestamp").alias("cutoff"), F.lit(ts).cast("timestamp").alias("ts"))
                     for cut, ts in fixture.SNAPSHOTS])
    seen = F.filter(runs, lambda r: r["cutoff"].isNull() | (F.col("ingestion_timestamp") < r["cutoff"]))
    fanned = cls.withColumn("_run", F.explode(seen))
    history = build_features(fanned, F.col("_run.ts"))
    if materialize:
        history = stored(history, "history")
    return history
