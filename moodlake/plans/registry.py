"""Registered queries: name -> (Spark plan builder, SQL oracle or None).

Every query reads the driver tables (or layers Spark derives from them) in
full; no subsets, caps or samples.  Averages are rounded to 6 decimals in both
forms because double sums depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.functions import params as P
from moodlake.operators import artists as A
from moodlake.operators import bi as B
from moodlake.operators import features as FT
from moodlake.operators import gold as G
from moodlake.operators import kmeans as K
from moodlake.operators import mood as M
from moodlake.operators import quality as Q
from moodlake.operators import scd2 as S
from moodlake.operators.silver import build_silver, cast_failures, dedup_latest
from moodlake.plans import oracle as O
from moodlake.plans import pipeline as PL
from moodlake.session import stored
from moodlake.sources import albums as AL
from moodlake.sources import csv as CSV
from moodlake.sources import fixture
from moodlake.sources.catalog import register_gold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


W = O.with_
BASE = O.BASE

# ---------------------------------------------------------------------------
# silver and artists
# ---------------------------------------------------------------------------


@register("silver_tracks", W(O.cte_silver()) + "select * from silver")
def q_silver(spark, sf):
    return PL.silver(spark, sf)


_FLOAT_COLS = ", ".join(f"cast({c} as {t}) as {c}" for c, t in P.FLOAT_TRACK_SCHEMA)
_FLOAT_RANGES = " and ".join(f"{c} between 0 and 1" for c in P.FLOAT_RANGE_COLUMNS)


@register("silver_tracks_float", W(O.cte_ranked()) + f"""
select * from (select {_FLOAT_COLS} from ranked where rn = 1)
where {_FLOAT_RANGES} and tempo is not null and not isnan(tempo)""")
def q_silver_float(spark, sf):
    return build_silver(PL.bronze(spark, sf), fixture.BRONZE_TIEBREAK, schema=P.FLOAT_TRACK_SCHEMA,
                        range_cols=P.FLOAT_RANGE_COLUMNS, stamps=fixture.bronze_stamps(spark, sf))


@register("bronze_cast_failures", W(f"bronze as ({fixture.BRONZE_SQL})") + " union all ".join(
    f"select '{c}' as column_name, cast(count(*) filter (where {c} is not null and try_cast({c} as "
    f"{'timestamp' if t == 'timestamp' else t}) is null) as bigint) as failures from bronze"
    for c, t in P.TRACK_SCHEMA))
def q_cast_failures(spark, sf):
    return cast_failures(PL.bronze(spark, sf))


@register("dedup_latest_events", """
select event_id, ts, user_id, event_type, value, props from (
  select *, row_number() over (partition by user_id order by ts desc nulls last, event_id asc nulls first) as rn
  from events) where rn = 1""")
def q_dedup_events(spark, sf):
    return dedup_latest(fixture.read(spark, sf, "events"), "user_id", "ts", ["event_id"])


@register("artist_snapshot", W(O.cte_silver(), O.cte_snapshot("snap", None)) + "select * from snap")
def q_artist_snapshot(spark, sf):
    return A.artist_snapshot(PL.silver(spark, sf))


@register("scd2_first_load", W(O.cte_silver(), O.cte_versions(1)) + "select * from versions")
def q_scd2_first(spark, sf):
    return PL.artist_versions(spark, sf, steps=1)


@register("scd2_merge", W(O.cte_silver(), O.cte_versions(3)) + "select * from versions")
def q_scd2_merge(spark, sf):
    return PL.artist_versions(spark, sf, steps=3)


@register("scd2_merge_stats", W(O.cte_silver(), O.cte_versions(2), O.cte_snapshot("snapn", None)) + """
select count(o.artist_id) as open_before,
       count(*) filter (where o.artist_id is not null and n.artist_id is not null and o.row_hash <> n.row_hash)
         as expired,
       count(*) filter (where o.artist_id is not null and (n.artist_id is null or o.row_hash = n.row_hash))
         as unchanged,
       count(*) filter (where n.artist_id is not null and (o.artist_id is null or o.row_hash <> n.row_hash))
         as inserted
from (select artist_id, row_hash from versions where is_current) o
full join snapn n on o.artist_id = n.artist_id""")
def q_scd2_stats(spark, sf):
    tracks = PL.silver(spark, sf, materialize=True)
    return S.merge_stats(PL.artist_versions(spark, sf, steps=2, tracks=tracks), PL.snapshot_at(tracks, None))


_LAST_TS = fixture.SNAPSHOTS[2][1]
_CHANGED = """chg as (select o.artist_id from versions o join snapn n on o.artist_id = n.artist_id
                where o.is_current and o.row_hash is distinct from n.row_hash)"""


@register("scd2_expired", W(O.cte_silver(), O.cte_versions(2), O.cte_snapshot("snapn", None), _CHANGED) + f"""
select artist_id, artist_name, artist_genre, artist_popularity, row_hash, valid_from,
       timestamp '{_LAST_TS}' as valid_to, false as is_current
from versions where is_current and artist_id in (select artist_id from chg)""")
def q_scd2_expired(spark, sf):
    """Open versions after two merges that the third snapshot closes."""
    tracks = PL.silver(spark, sf, materialize=True)
    return S.scd2_expire(PL.artist_versions(spark, sf, steps=2, tracks=tracks), PL.snapshot_at(tracks, None),
                         _LAST_TS)


@register("scd2_unchanged", W(O.cte_silver(), O.cte_versions(2), O.cte_snapshot("snapn", None), _CHANGED) + """
select * from versions where not is_current or artist_id not in (select artist_id from chg)""")
def q_scd2_unchanged(spark, sf):
    """Versions after two merges that the third snapshot leaves untouched."""
    tracks = PL.silver(spark, sf, materialize=True)
    return S.scd2_unchanged(PL.artist_versions(spark, sf, steps=2, tracks=tracks), PL.snapshot_at(tracks, None))


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------
@register("dim_track", W(*BASE) + "select * from dim_track")
def q_dim_track(spark, sf):
    return G.dim_track(PL.silver(spark, sf))


@register("dim_genre", W(*BASE) + "select * from dim_genre")
def q_dim_genre(spark, sf):
    return G.dim_genre(PL.silver(spark, sf))


@register("agg_genre_trends", W(*BASE) + "select * from agg_genre_trends")
def q_agg_genre_trends(spark, sf):
    return G.agg_genre_trends(PL.silver(spark, sf), PL.DIGITS)


for _name in ["dim_artist", "fact_streams", "agg_artist_profiles"]:
    def _mk(n):
        def fn(spark, sf):
            return PL.gold(spark, sf)[n]
        fn.__name__ = f"q_{n}"
        return fn
    register(_name, W(*BASE) + f"select * from {_name}")(_mk(_name))


@register("agg_genre_trends_by_date", W(*BASE) + f"""
select f.genre_id, f.ingestion_date, {O.r6('avg(f.popularity)')} as avg_popularity,
       {O.r6('avg(d.danceability)')} as avg_danceability, {O.r6('avg(d.energy)')} as avg_energy
from fact_streams f join dim_track d using (track_id)
group by f.genre_id, f.ingestion_date""")
def q_agg_genre_date(spark, sf):
    g = PL.gold(spark, sf)
    return G.agg_genre_trends_by_date(g["fact_streams"], g["dim_track"], PL.DIGITS)


@register("agg_artist_profiles_star", W(*BASE) + f"""
select f.artist_id, count(distinct f.track_id) as track_count, {O.r6('avg(f.popularity)')} as avg_popularity,
       {O.r6('avg(d.danceability)')} as avg_danceability, {O.r6('avg(d.energy)')} as avg_energy
from fact_streams f join dim_track d using (track_id)
group by f.artist_id""")
def q_agg_artist_star(spark, sf):
    g = PL.gold(spark, sf)
    return G.agg_artist_profiles_star(g["fact_streams"], g["dim_track"], PL.DIGITS)


@register("layer_counts", W(*BASE) + " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count from {t}"
    for t in ["dim_track", "dim_artist", "dim_genre", "fact_streams", "agg_genre_trends", "agg_artist_profiles"]))
def q_layer_counts(spark, sf):
    return G.layer_counts(PL.gold(spark, sf))


# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------
def _dq_rows_sql(table: str, label: str, checks: list[tuple[str, str, str]]) -> str:
    return " union all ".join(
        f"select '{chk}' as check_name, '{label}' as table_name, '{col}' as column_name, "
        f"cast({expr} as bigint) as observed, cast({expr} as bigint) = 0 as passed from {table}"
        for chk, col, expr in checks)


_SILVER_DQ = (
    f"select 'row_count' as check_name, 'tracks' as table_name, cast(null as varchar) as column_name, "
    f"count(*) as observed, count(*) >= {P.MIN_SILVER_ROWS} as passed from silver union all "
    + _dq_rows_sql("silver", "tracks",
                   [("not_null", c, f"count(*) filter (where {c} is null)") for c in ["track_id", "track_name", "artists"]]
                   + [("in_range", c, f"count(*) filter (where {c} < 0 or {c} > 1)") for c in P.RANGE_COLUMNS])
    + " union all select 'referential', 'tracks', 'artists', count(*), count(*) = 0 from "
      "(select distinct artist_name from ta where length(artist_name) > 0) n "
      "where not exists (select 1 from versions v where v.artist_name = n.artist_name)")


@register("dq_silver", W(*BASE, O.cte_track_artists("ta")) + _SILVER_DQ)
def q_dq_silver(spark, sf):
    tracks = PL.silver(spark, sf, materialize=True)
    return Q.dq_silver(tracks, PL.artist_versions(spark, sf, tracks=tracks))


def _pk_sql(table: str, pk: str) -> str:
    dups = f"count(*) - count(distinct {pk}) - (case when count(*) filter (where {pk} is null) > 0 then 1 else 0 end)"
    return _dq_rows_sql(table, table, [("not_null", pk, f"count(*) filter (where {pk} is null)"),
                                       ("unique", pk, dups)])


@register("dq_gold", W(*BASE) + " union all ".join(_pk_sql(t, k) for t, k in Q.GOLD_KEYS.items()))
def q_dq_gold(spark, sf):
    return Q.dq_gold(PL.gold(spark, sf))


@register("dq_orders", _pk_sql("orders", "o_orderkey") + " union all "
          + _dq_rows_sql("orders", "orders", [
              ("not_null", "o_custkey", "count(*) filter (where o_custkey is null)"),
              ("accepted_values", "o_orderstatus",
               "count(*) filter (where o_orderstatus is not null and o_orderstatus not in ('F', 'O'))")])
          + " union all select 'referential', 'orders', 'o_custkey', count(*), count(*) = 0 from "
            "(select distinct o_custkey from orders where o_custkey is not null) o "
            "where not exists (select 1 from customer c where c.c_custkey = o.o_custkey)")
def q_dq_orders(spark, sf):
    orders = fixture.read(spark, sf, "orders")
    customer = fixture.read(spark, sf, "customer")
    keys = orders.select("o_custkey").filter(F.col("o_custkey").isNotNull()).distinct()
    orphans = keys.join(customer, keys["o_custkey"] == customer["c_custkey"], "left_anti")
    ref = (orphans.agg(F.count(F.lit(1)).alias("observed"))
           .select(F.lit("referential").alias("check_name"), F.lit("orders").alias("table_name"),
                   F.lit("o_custkey").alias("column_name"), "observed", (F.col("observed") == 0).alias("passed")))
    checks = Q.dq_table(orders, "orders", pk="o_orderkey", not_null=["o_custkey"],
                        accepted={"o_orderstatus": ["F", "O"]})
    return Q.dq_report(checks, ref)


# ---------------------------------------------------------------------------
# mood
# ---------------------------------------------------------------------------
_CLS = W(O.cte_silver(), O.cte_classified())


@register("genre_family", _CLS + "select track_id, track_genre, genre_family from classified")
def q_genre_family(spark, sf):
    return M.genre_family(PL.silver(spark, sf)).select("track_id", "track_genre", "genre_family")


@register("normalize_features", _CLS + "select track_id, loudness_norm, tempo_norm, tempo, mode from classified")
def q_normalize(spark, sf):
    return M.normalize_features(PL.silver(spark, sf)).select("track_id", "loudness_norm", "tempo_norm", "tempo",
                                                             "mode")


@register("universal_mood", _CLS + "select track_id, genre_family, mood from classified")
def q_universal(spark, sf):
    df = M.genre_family(M.normalize_features(PL.silver(spark, sf)))
    return M.universal_mood(df).select("track_id", "genre_family", "mood")


_SCORE_COLS = [f"score_{m.lower()}" for m in P.MOOD_NAMES]


@register("universal_mood_scores", _CLS + "select track_id, genre_family, " + ", ".join(
    f"s_{m.lower()} as score_{m.lower()}" for m in P.MOOD_NAMES) + " from classified")
def q_universal_scores(spark, sf):
    """The ten rule scores with the family bonus (M4, M5) behind the mood pick."""
    df = M.genre_family(M.normalize_features(PL.silver(spark, sf)))
    return M.universal_mood(df, keep_scores=True).select("track_id", "genre_family", *_SCORE_COLS)


@register("sub_label", _CLS + "select track_id, genre_family, mood_cluster from classified")
def q_sub_label(spark, sf):
    df = M.genre_family(M.normalize_features(PL.silver(spark, sf)))
    return M.sub_label(df).select("track_id", "genre_family", "mood_cluster")


@register("sub_label_exact", _CLS + "select track_id, genre_family, mood_cluster_exact as mood_cluster from classified")
def q_sub_label_exact(spark, sf):
    df = M.genre_family(M.normalize_features(PL.silver(spark, sf)))
    return M.sub_label_exact(df).select("track_id", "genre_family", "mood_cluster")


@register("classify_tracks", _CLS + "select track_id, genre_family, mood, mood_cluster from classified")
def q_classify(spark, sf):
    return PL.classified(spark, sf).select("track_id", "genre_family", "mood", "mood_cluster")


@register("apply_mood_labels", W(*BASE, O.cte_classified()) + """
select d.* replace (c.mood_cluster as mood_cluster) from dim_track d left join classified c using (track_id)""")
def q_apply_labels(spark, sf):
    tracks = PL.silver(spark, sf, materialize=True)
    return M.apply_mood_labels(G.dim_track(tracks), M.classify_tracks(tracks))


@register("fact_mood_labels", W(*BASE, O.cte_classified()) + """
select f.* replace (c.mood_cluster as mood_cluster) from fact_streams f left join classified c using (track_id)""")
def q_fact_labels(spark, sf):
    tracks = PL.silver(spark, sf, materialize=True)
    g = G.build_gold(tracks, PL.artist_versions(spark, sf, tracks=tracks))
    return M.apply_mood_labels(g["fact_streams"], M.classify_tracks(tracks))


_ALL_SUB = ", ".join(f"'{n}'" for f, i, n, d in P.sub_label_rows())


@register("dq_accepted_labels", W(*BASE, O.cte_classified()) + f"""
select 'accepted_values' as check_name, 'fact_streams' as table_name, 'mood_cluster' as column_name,
       count(*) filter (where c.mood_cluster is not null and c.mood_cluster not in ({_ALL_SUB})) as observed,
       count(*) filter (where c.mood_cluster is not null and c.mood_cluster not in ({_ALL_SUB})) = 0 as passed
from fact_streams f left join classified c using (track_id)""")
def q_dq_labels(spark, sf):
    fact = q_fact_labels(spark, sf)
    return Q.dq_accepted_values(fact, "mood_cluster", [n for _, _, n, _ in P.sub_label_rows()], "fact_streams")


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------
def _history(spark, sf, materialize: bool = False) -> DataFrame:
    return PL.feature_history(spark, sf, materialize)


_HIST = W(O.cte_silver(), O.cte_feature_history())


@register("build_features", W(O.cte_silver(), O.cte_classified()) + f"""
select track_id, mood_cluster, mood, genre_family, cast(danceability as float) as danceability,
       cast(energy as float) as energy, cast(valence as float) as valence,
       timestamp '{fixture.RUN_TS}' as event_timestamp from classified""")
def q_build_features(spark, sf):
    return PL.features(spark, sf)


_START, _END = fixture.SNAPSHOTS[0][1], fixture.SNAPSHOTS[1][1]


@register("features_latest", _HIST + f"""
select track_id, mood_cluster, mood, genre_family, danceability, energy, valence, event_timestamp from (
  select *, row_number() over (partition by track_id order by event_timestamp desc) as rn from history
  where event_timestamp >= timestamp '{_START}' and event_timestamp <= timestamp '{_END}') where rn = 1""")
def q_features_latest(spark, sf):
    return FT.features_latest(_history(spark, sf), _START, _END)


# Requests: every line item asks for its part's features at a time spread
# over 70 days around the feature runs.
_REQ_SQL = ("select concat('T', cast(l_partkey as string)) as track_id, "
            "cast(timestamp '2023-12-30 00:00:00' + to_days(cast(l_orderkey % 70 as integer)) as timestamp) "
            "as request_ts from lineitem")


def _requests(spark, sf) -> DataFrame:
    li = fixture.read(spark, sf, "lineitem")
    return li.select(F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("track_id"),
                     (F.lit("2023-12-30 00:00:00").cast("timestamp")
                      + F.make_interval(days=(F.col("l_orderkey") % 70).cast("int"))).alias("request_ts"))


@register("features_as_of", _HIST + f""", req as (select *, row_number() over () as rid from ({_REQ_SQL}))
select track_id, request_ts, mood_cluster, mood, genre_family, danceability, energy, valence, event_timestamp from (
  select r.rid, r.track_id, r.request_ts, h.mood_cluster, h.mood, h.genre_family, h.danceability, h.energy,
         h.valence, h.event_timestamp,
         row_number() over (partition by r.rid order by h.event_timestamp desc nulls last) as rn
  from req r left join history h
    on h.track_id = r.track_id and h.event_timestamp <= r.request_ts
   and h.event_timestamp > r.request_ts - interval {P.FEATURE_TTL_DAYS} day) where rn = 1""")
def q_features_as_of(spark, sf):
    return FT.features_as_of(_history(spark, sf, materialize=True), _requests(spark, sf))


@register("mood_lookup", _HIST + f""",
lat as (select * from (select *, row_number() over (partition by track_id order by event_timestamp desc) rn
                       from history) where rn = 1),
req as (select p_partkey as request_id, concat('T', cast(p_partkey as string)) as track_id from part)
select r.request_id, r.track_id, l.track_id is not null as found,
       case when l.track_id is not null then coalesce(l.genre_family, 'Unknown') end as genre_family,
       case when l.track_id is not null then coalesce(l.mood_cluster, 'Unknown') end as mood_label,
       case when l.track_id is not null then coalesce(sl.mood_description, '') end as mood_description,
       round(cast(l.danceability as double), 4) as danceability, round(cast(l.energy as double), 4) as energy,
       round(cast(l.valence as double), 4) as valence
from req r left join lat l on r.track_id = l.track_id
left join {O.sub_label_values()} on sl.mood_label = l.mood_cluster""")
def q_mood_lookup(spark, sf):
    """Parts ask for their track; the request keeps its own id column."""
    part = fixture.read(spark, sf, "part")
    req = part.select(F.col("p_partkey").alias("request_id"),
                      F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("track_id"))
    return FT.mood_lookup(stored(FT.features_latest(_history(spark, sf)), "latest"), req)


@register("features_as_of_events", f"""
with req as (select event_id, user_id, ts as request_ts, row_number() over () as rid
             from events where event_type = 'purchase'),
f as (select user_id, ts as event_timestamp, event_type, value from events where event_type <> 'purchase')
select event_id, user_id, request_ts, event_type, value, event_timestamp from (
  select r.rid, r.event_id, r.user_id, r.request_ts, f.event_type, f.value, f.event_timestamp,
         row_number() over (partition by r.rid order by f.event_timestamp desc nulls last) as rn
  from req r left join f
    on f.user_id = r.user_id and f.event_timestamp <= r.request_ts
   and f.event_timestamp > r.request_ts - interval {P.FEATURE_TTL_DAYS} day) where rn = 1""")
def q_features_as_of_events(spark, sf):
    """Latest other event of the same user within the time to live before
    each purchase: the point-in-time read on the event stream table."""
    ev = fixture.read(spark, sf, "events")
    req = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", F.col("ts").alias("request_ts"))
    feats = ev.filter(F.col("event_type") != "purchase").select("user_id", F.col("ts").alias("event_timestamp"),
                                                               "event_type", "value")
    return FT.features_as_of(feats, req, key="user_id")


# ---------------------------------------------------------------------------
# BI
# ---------------------------------------------------------------------------
@register("bi_top_genres", W(*BASE) + """
select genre_name, avg_popularity, track_count from agg_genre_trends
order by avg_popularity desc, genre_name asc limit 10""")
def q_bi_top_genres(spark, sf):
    return B.bi_top_genres(q_agg_genre_trends(spark, sf))


@register("bi_genre_scatter", W(*BASE) + "select genre_name, avg_danceability, avg_energy from agg_genre_trends")
def q_bi_scatter(spark, sf):
    return B.bi_genre_scatter(q_agg_genre_trends(spark, sf))


@register("bi_mood_share", _CLS + """
select mood, count(*) as track_count, round(count(*) / sum(count(*)) over (), 4) as share
from classified group by mood""")
def q_bi_mood_share(spark, sf):
    return B.bi_mood_share(PL.classified(spark, sf))


@register("bi_mood_catalog", _CLS + ", share as (select mood, count(*) as n, round(count(*) / sum(count(*)) over (), 4) as share "
          "from classified group by mood) select m.mood_rank, m.mood, m.description, coalesce(s.n, 0) as track_count, "
          "coalesce(s.share, 0.0)::double as share from (values "
          + ", ".join(f"({i}, '{m}', '" + d.replace("'", "''") + "')" for i, (m, d) in enumerate(P.UNIVERSAL_MOODS))
          + ") m(mood_rank, mood, description) left join share s using (mood)")
def q_bi_mood_catalog(spark, sf):
    return B.bi_mood_catalog(B.bi_mood_share(PL.classified(spark, sf)))


@register("gold_by_sql", W(*BASE) + """
select g.genre_name, count(*) as tracks, max(f.popularity) as top_popularity
from fact_streams f join dim_genre g using (genre_id) join dim_track d using (track_id)
where d.energy > 0.5 group by g.genre_name""")
def q_gold_by_sql(spark, sf):
    """Gold registered in the session's catalog and read by SQL."""
    tables = PL.gold(spark, sf)
    register_gold(spark, {f"moodlake_{n}": tables[n] for n in ("fact_streams", "dim_genre", "dim_track")})
    return spark.sql("""
select g.genre_name, count(*) as tracks, max(f.popularity) as top_popularity
from moodlake_fact_streams f join moodlake_dim_genre g using (genre_id) join moodlake_dim_track d using (track_id)
where d.energy > 0.5 group by g.genre_name""")


@register("ingest_metadata", f"""
select o_orderkey, o_custkey, o_orderstatus, timestamp '{fixture.RUN_TS}' as ingestion_timestamp, 'orders' as source
from orders""")
def q_ingest_metadata(spark, sf):
    """Load time and source stamped on every raw row (here orders, less a stray index column)."""
    orders = fixture.read(spark, sf, "orders").select(F.col("o_custkey").alias("Unnamed: 0"), "o_orderkey", "o_custkey",
                                                      "o_orderstatus")
    return CSV.add_ingest_metadata(CSV.drop_index_columns(orders), fixture.RUN_TS, "orders")


@register("bi_release_trend", W(*BASE) + """
select ingestion_date, count(*) as track_count from fact_streams group by ingestion_date""")
def q_bi_release(spark, sf):
    return B.bi_release_trend(PL.gold(spark, sf)["fact_streams"])


@register("bi_top_artists", W(*BASE) + """
select artist_name, artist_id, track_count from agg_artist_profiles
order by track_count desc, artist_name asc limit 10""")
def q_bi_top_artists(spark, sf):
    return B.bi_top_artists(PL.gold(spark, sf)["agg_artist_profiles"])


# ---------------------------------------------------------------------------
# new-release feed and source union
# ---------------------------------------------------------------------------
def _feed_nulls() -> str:
    types = dict(P.TRACK_SCHEMA)
    return ", ".join(f"cast(null as {types[c]}) as {c}" for c in AL.FEED_NULL_COLUMNS)


_FLAT_SQL = f"""
select concat('T', cast(l.l_partkey as string)) as track_id, coalesce(p.p_name, '') as track_name,
       concat_ws(';', s.s_name, case when l.l_linenumber % 3 = 0
                                     then concat('Artist ', cast(l.l_orderkey % 50 as string)) end) as artists,
       concat('Album ', cast(o.o_orderkey as string)) as album_name, '' as track_genre,
       cast(0 as bigint) as popularity, cast(floor(l.l_extendedprice) as bigint) as duration_ms,
       l.l_returnflag = 'R' as explicit, {_feed_nulls()},
       timestamp '{fixture.RUN_TS}' as ingestion_timestamp, 'spotify' as source
from orders o join lineitem l on l.l_orderkey = o.o_orderkey
left join part p on l.l_partkey = p.p_partkey
left join supplier s on l.l_suppkey = s.s_suppkey"""


@register("flatten_albums", _FLAT_SQL)
def q_flatten_albums(spark, sf):
    return AL.flatten_albums(fixture.albums(spark, sf), fixture.RUN_TS)


@register("union_sources", f"select * from ({fixture.BRONZE_SQL}) union all by name select * from ({_FLAT_SQL})")
def q_union_sources(spark, sf):
    return AL.union_sources(PL.bronze(spark, sf), AL.flatten_albums(fixture.albums(spark, sf), fixture.RUN_TS))


# ---------------------------------------------------------------------------
# k-means
# ---------------------------------------------------------------------------
_ZCOLS = [f"{c}_z" for c in P.KMEANS_FEATURES]


def _standardized(spark, sf) -> DataFrame:
    data = K.kmeans_features(stored(PL.silver(spark, sf).select("track_id", *P.KMEANS_FEATURES), "kmeans"))
    return K.standardize(data, K.fit_standardizer(data))


@register("standardize", W(O.cte_silver(), O.cte_kmeans()) + "select track_id, " + ", ".join(
    f"round(z{i}, 6) as {c}" for i, c in enumerate(_ZCOLS)) + " from kz")
def q_standardize(spark, sf):
    return _standardized(spark, sf).select("track_id", *[F.round(c, 6).alias(c) for c in _ZCOLS])


@register("kmeans_assign", W(O.cte_silver(), O.cte_kmeans()) + "select * from kmeans_out")
def q_kmeans_assign(spark, sf):
    z = _standardized(spark, sf)
    cents = K.dominant_init_centroids(z, _ZCOLS)
    assigned = K.kmeans_assign(z, cents, _ZCOLS)
    return K.with_cluster_labels(assigned, K.label_clusters(cents)).select("track_id", "cluster", "mood_label")


@register("dq_accepted_kmeans", W(O.cte_silver(), O.cte_kmeans()) + f"""
select 'accepted_values' as check_name, 'mood_predictions' as table_name, 'mood_label' as column_name,
       count(*) filter (where mood_label is not null and mood_label not in ({", ".join(repr(x) for x in P.KMEANS_LABELS)}))
         as observed,
       count(*) filter (where mood_label is not null and mood_label not in ({", ".join(repr(x) for x in P.KMEANS_LABELS)}))
         = 0 as passed
from kmeans_out""")
def q_dq_accepted_kmeans(spark, sf):
    return Q.dq_accepted_values(q_kmeans_assign(spark, sf), "mood_label", P.KMEANS_LABELS, "mood_predictions")


_COMPLETE = " and ".join(f"{c} is not null" for c in P.KMEANS_FEATURES)


def _facts(spark, facts: list[tuple[str, DataFrame]]) -> DataFrame:
    parts = [df.select(F.lit(name).alias("fact"), F.col("observed").cast("bigint").alias("observed")) for name, df in facts]
    return reduce(DataFrame.unionByName, parts)


@register("train_kmeans", W(O.cte_silver()) + f"""
select 'predicted_rows' as fact, count(*) as observed from silver where {_COMPLETE}
union all select 'label_not_of_nearest_centroid', 0 union all select 'empty_clusters', 0""")
def q_train_kmeans(spark, sf):
    """What must hold of any fit: each complete track is predicted once, its
    label is that of the nearest fitted centroid, and no cluster is empty."""
    tracks = stored(PL.silver(spark, sf).select("track_id", *P.KMEANS_FEATURES), "kmeans")
    model = K.train_kmeans(tracks)
    predicted = K.kmeans_predictions(model, tracks)
    centres = [list(map(float, c)) for c in model.stages[-1].clusterCenters()]
    data = K.kmeans_features(tracks)
    nearest = K.kmeans_assign(K.standardize(data, K.fit_standardizer(data)), centres, _ZCOLS)
    expected = K.with_cluster_labels(nearest, K.label_clusters(centres), out="expected")
    both = predicted.select("track_id", "mood_label").join(expected.select("track_id", "cluster", "expected"), "track_id")
    return _facts(spark, [
        ("predicted_rows", predicted.agg(F.count(F.lit(1)).alias("observed"))),
        ("label_not_of_nearest_centroid", both.agg(F.count_if(F.col("mood_label") != F.col("expected")).alias("observed"))),
        ("empty_clusters", both.agg((F.lit(len(centres)) - F.count_distinct("cluster")).alias("observed")))])


@register("kmeans_labels", f"""
select 'clusters' as fact, {P.KMEANS_K}::bigint as observed union all select 'distinct_labels', {P.KMEANS_K}
union all select 'labels_outside_catalog', 0""")
def q_kmeans_labels(spark, sf):
    """What must hold of the labels of any fit over all complete tracks."""
    tracks = stored(PL.silver(spark, sf).select("track_id", *P.KMEANS_FEATURES), "kmeans")
    predicted = K.kmeans_predictions(K.train_kmeans(tracks), tracks).groupBy("mood_label").agg(F.count(F.lit(1)).alias("n"))
    return _facts(spark, [
        ("clusters", predicted.agg(F.count(F.lit(1)).alias("observed"))),
        ("distinct_labels", predicted.agg(F.count_distinct("mood_label").alias("observed"))),
        ("labels_outside_catalog", predicted.agg(F.count_if(~F.col("mood_label").isin(P.KMEANS_LABELS)).alias("observed")))])


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
