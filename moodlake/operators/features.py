"""Feature table and its reads: latest value per entity, point-in-time
(as-of) read within a time to live, and batch lookup with a found flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.functions.params import FEATURE_TTL_DAYS, UNKNOWN_LABEL
from moodlake.operators.asof import last_before
from moodlake.operators.mood import sub_label_catalog
from moodlake.operators.silver import dedup_latest


def _ts(x: str | Column) -> Column:
    return F.lit(x).cast("timestamp") if isinstance(x, str) else x.cast("timestamp")


def build_features(classified: DataFrame, run_ts: str | Column) -> DataFrame:
    """Entity track_id, labels, three float features, event time = run time."""
    return classified.select(
        "track_id", "mood_cluster", "mood", "genre_family",
        F.col("danceability").cast("float").alias("danceability"),
        F.col("energy").cast("float").alias("energy"),
        F.col("valence").cast("float").alias("valence"),
        _ts(run_ts).alias("event_timestamp"),
    )


def features_latest(features: DataFrame, start: str | Column | None = None, end: str | Column | None = None,
                    key: str = "track_id", ts: str = "event_timestamp",
                    tiebreak: list[str] | None = None) -> DataFrame:
    """Latest row per entity with start <= ts <= end (materialisation read).
    Rows tied on time keep the smallest `tiebreak` values (nulls first;
    default: the other columns in order).  row_number() = 1 is pre-limited
    per map task before the shuffle."""
    f = features
    if start is not None:
        f = f.filter(F.col(ts) >= _ts(start))
    if end is not None:
        f = f.filter(F.col(ts) <= _ts(end))
    tiebreak = tiebreak if tiebreak is not None else [c for c in features.columns if c not in (key, ts)]
    return dedup_latest(f, key, ts, tiebreak)


def features_as_of(features: DataFrame, requests: DataFrame, ttl_days: int = FEATURE_TTL_DAYS,
                   key: str = "track_id", req_ts: str = "request_ts", ts: str = "event_timestamp",
                   values: list[str] | None = None, tiebreak: list[str] | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Point-in-time read: for every request (key, request_ts) the latest
    feature row with request_ts - ttl < event_timestamp <= request_ts, else
    nulls.  Feature rows tied on key and time: the smallest `tiebreak` values
    (default: the value columns; nulls first) win.

    The same plan at every size (`asof.last_before`): features and requests go
    through one range exchange on (key, time), in as many stretches as there
    are partitions (default: the session's), a running last value answers inside
    a stretch, and one row a stretch carries the last feature on.  Each row is
    sent once, and a key is cut into several tasks wherever its rows are many,
    be they in one instant.  The scan is stored as it runs.

    Requests with a null key or time stay, unanswered; all request columns stay.
    """
    values = values or [c for c in features.columns if c not in (key, ts)]
    feat = features.select(F.col(key).alias("k"), F.col(ts).cast("timestamp").alias("t"),
                           F.struct(*(tiebreak or values)).alias("tie"), F.struct(*values).alias("v"))
    asking = requests.select(F.col(key).alias("k"), F.col(req_ts).cast("timestamp").alias("t"), F.struct(*requests.columns).alias("r"))
    fresh = F.col("vt") > (F.col("t") - F.expr(f"INTERVAL {int(ttl_days)} DAYS"))
    return last_before(feat, asking, partitions).select(
        "r.*", *[F.when(fresh, F.col(f"v.{v}")).alias(v) for v in values], F.when(fresh, F.col("vt")).alias(ts))


POINT_IDS = 1000  # up to so many distinct ids a lookup names them to the scan
IDS_PUSHED = 10  # ids of one IN that the Parquet reader tests one by one


def lookup_layout(latest: DataFrame, key: str = "track_id", rows: int | None = None,
                  row_group_bytes: int = 8 << 20) -> tuple[DataFrame, dict[str, str]]:
    """The latest-value table in the order, and the write options, that suit
    point lookups: ids in one order over all files, so that the statistics of
    most row groups exclude an id, and a Bloom filter of the ids of each row
    group for the rest."""
    options = {"parquet.block.size": str(row_group_bytes), f"parquet.bloom.filter.enabled#{key}": "true"}
    if rows:
        options[f"parquet.bloom.filter.expected.ndv#{key}"] = str(rows)
    return latest.repartitionByRange(key).sortWithinPartitions(key), options


def named_ids(latest: DataFrame, requests: DataFrame, key: str = "track_id", most: int = POINT_IDS) -> DataFrame:
    """The rows of `latest` that a few requests can ask for: up to `most`
    distinct ids are named to the scan, in groups small enough for the reader to
    test each id against a row group's statistics and Bloom filter.  With more
    ids `latest` stays whole."""
    ids = sorted(r[0] for r in requests.select(key).filter(F.col(key).isNotNull()).distinct().limit(most + 1).collect())
    if len(ids) > most:
        return latest
    wanted = F.lit(False)
    for at in range(0, len(ids), IDS_PUSHED):
        wanted = F.col(key).isin(ids[at:at + IDS_PUSHED]) if not at else wanted | F.col(key).isin(ids[at:at + IDS_PUSHED])
    return latest.filter(wanted)


def mood_lookup(latest: DataFrame, requests: DataFrame, key: str = "track_id", digits: int = 4) -> DataFrame:
    """Batch form of the per-id lookup: every request row with all its
    columns, `found` false when the id has no feature row, and the label's
    description from the 50-row catalog.

    `latest` holds one row per id (features_latest).  Pass it as a stored
    table: the join then reads plain shuffles on both sides, which adaptive
    execution splits where one id has many requests."""
    cat = F.broadcast(sub_label_catalog(latest.sparkSession).select("mood_label", "mood_description"))
    answers = (latest.withColumn("mood_label", F.coalesce("mood_cluster", F.lit(UNKNOWN_LABEL)))
               .join(cat, "mood_label", "left")
               .select(F.col(key).alias("_k"), F.lit(True).alias("_found"),
                       F.coalesce("genre_family", F.lit(UNKNOWN_LABEL)).alias("genre_family"), "mood_label",
                       F.coalesce("mood_description", F.lit("")).alias("mood_description"),
                       *[F.round(F.col(c).cast("double"), digits).alias(c) for c in ("danceability", "energy", "valence")]))
    return (requests.join(answers, requests[key] == answers["_k"], "left")
            .select(*[requests[c] for c in requests.columns], F.coalesce("_found", F.lit(False)).alias("found"),
                    "genre_family", "mood_label", "mood_description", "danceability", "energy", "valence"))
