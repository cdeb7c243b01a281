"""Independent SQL formulations (DuckDB dialect) of the registered queries.

They run on the same parquet tables, registered as views.  The SQL is written
the way a warehouse user would write each step (window dedup, semi/anti joins,
CASE expressions), separately from the DataFrame code it checks.
"""

from __future__ import annotations

from moodlake.functions import params as P
from moodlake.functions.expr import WHITESPACE
from moodlake.sources import fixture

DIGITS = 6


def trim_ws(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def nn(x: str) -> str:
    """NaN -> null for a double expression."""
    return f"(case when isnan({x}) then null else {x} end)"


def dbl(v: float) -> str:
    return f"cast({float(v)!r} as double)"


def r6(x: str) -> str:
    """Exact half-up mean to 6 decimals of `avg(<col>)`, in integer arithmetic
    over the value scaled by 1e9 (mirrors a decimal(38,9) average)."""
    assert x.startswith("avg(") and x.endswith(")")
    c = x[4:-1]
    s = f"cast(sum(cast({c} as decimal(38,9))) * 1000000000 as hugeint)"
    n = f"count({c})"
    return f"(cast((2 * {s} + 1000 * {n}) // (2000 * {n}) as double) / cast(1000000 as double))"


# ---------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------
def cte_ranked() -> str:
    """Bronze rows numbered newest-first within each track id."""
    order = ", ".join(f"{c} asc nulls first" for c in fixture.BRONZE_TIEBREAK)
    return f"""bronze as ({fixture.BRONZE_SQL}),
ranked as (
  select *, row_number() over (partition by track_id
                               order by ingestion_timestamp desc nulls last, {order}) as rn
  from bronze)"""


def cte_silver() -> str:
    cols = ", ".join("cast(ingestion_timestamp as timestamp) as ingestion_timestamp" if c == "ingestion_timestamp"
                     else c for c, _ in P.TRACK_SCHEMA)
    ranges = " and ".join(f"{c} between 0 and 1" for c in P.RANGE_COLUMNS)
    return f"""{cte_ranked()},
silver as (
  select {cols} from ranked
  where rn = 1 and {ranges} and tempo is not null and not isnan(tempo))"""


# ---------------------------------------------------------------------------
# artists and SCD2
# ---------------------------------------------------------------------------
def cte_track_artists(name: str, where: str = "") -> str:
    return f"""{name} as (
  select track_id, track_genre, popularity, ingestion_timestamp, pos, {trim_ws('parts[pos]')} as artist_name
  from (select track_id, track_genre, popularity, ingestion_timestamp, string_split(artists, ';') as parts,
               unnest(generate_series(1, len(string_split(artists, ';')))) as pos
        from silver {where}))"""


def hash_sql(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '<null>')" for c in cols)
    return f"md5(concat_ws('||', {parts}))"


def cte_snapshot(name: str, cutoff: str | None) -> str:
    where = f"where ingestion_timestamp < timestamp '{cutoff}'" if cutoff else ""
    return f"""{cte_track_artists(name + '_x', where)},
{name}_r as (
  select *, md5(artist_name) as artist_id,
         row_number() over (partition by md5(artist_name)
                            order by ingestion_timestamp desc nulls last, track_id asc nulls first, pos asc) as rn
  from {name}_x where length(artist_name) > 0),
{name} as (
  select artist_id, artist_name, track_genre as artist_genre, popularity as artist_popularity,
         {hash_sql('artist_id', 'artist_name', 'track_genre', 'popularity')} as row_hash
  from {name}_r where rn = 1)"""


def cte_versions(steps: int = 3) -> str:
    parts = []
    for i, (cutoff, run_ts) in enumerate(fixture.SNAPSHOTS[:steps], 1):
        parts.append(cte_snapshot(f"snap{i}", cutoff))
        ts = f"timestamp '{run_ts}'"
        if i == 1:
            parts.append(f"""v1 as (
  select *, {ts} as valid_from, cast(null as timestamp) as valid_to, true as is_current from snap1)""")
            continue
        p = f"v{i - 1}"
        parts.append(f"""chg{i} as (
  select s.* from snap{i} s
  left join (select artist_id, row_hash from {p} where is_current) o on s.artist_id = o.artist_id
  where o.row_hash is distinct from s.row_hash),
v{i} as (
  select artist_id, artist_name, artist_genre, artist_popularity, row_hash, valid_from,
         case when is_current and artist_id in (select artist_id from chg{i}) then {ts} else valid_to end as valid_to,
         case when is_current and artist_id in (select artist_id from chg{i}) then false else is_current end
           as is_current
  from {p}
  union all
  select artist_id, artist_name, artist_genre, artist_popularity, row_hash, {ts}, cast(null as timestamp), true
  from chg{i})""")
    parts.append(f"versions as (select * from v{steps})")
    return ",\n".join(parts)


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------
def cte_gold() -> str:
    return f"""dim_track as (
  select track_id, track_name, duration_ms, danceability, energy, valence, tempo, acousticness,
         instrumentalness, cast(null as varchar) as mood_cluster from silver),
dim_artist as (
  select md5(concat_ws('_', artist_id, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f'))) as artist_sk,
         artist_id, artist_name, artist_genre, artist_popularity, valid_from, valid_to, is_current
  from versions),
dim_genre as (
  select md5(genre_name) as genre_id, genre_name
  from (select distinct track_genre as genre_name from silver where track_genre is not null)),
tf as (select s.*, {trim_ws("string_split(artists, ';')[1]")} as first_artist from silver s),
cur as (select distinct artist_id from versions where is_current),
fact_streams as (
  select md5(concat_ws('_', tf.track_id, cast(cast(tf.ingestion_timestamp as date) as varchar))) as stream_id,
         tf.track_id, cur.artist_id, g.genre_id, cast(tf.ingestion_timestamp as date) as ingestion_date,
         tf.popularity, cast(null as varchar) as mood_cluster
  from tf
  left join cur on md5(tf.first_artist) = cur.artist_id
  left join dim_genre g on tf.track_genre = g.genre_name),
agg_genre_trends as (
  select track_genre as genre_name, {r6('avg(popularity)')} as avg_popularity,
         {r6('avg(danceability)')} as avg_danceability, {r6('avg(energy)')} as avg_energy,
         count(track_id) as track_count
  from silver where track_genre is not null group by track_genre),
agg_artist_profiles as (
  select tf.first_artist as artist_name, cur.artist_id, count(tf.track_id) as track_count,
         {r6('avg(popularity)')} as avg_popularity, {r6('avg(danceability)')} as avg_danceability,
         {r6('avg(energy)')} as avg_energy
  from tf join cur on md5(tf.first_artist) = cur.artist_id
  where tf.first_artist is not null
  group by tf.first_artist, cur.artist_id)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


BASE = [cte_silver(), cte_versions(3), cte_gold()]


# ---------------------------------------------------------------------------
# mood
# ---------------------------------------------------------------------------
def genre_values() -> str:
    rows = ", ".join(f"('{g}', '{f}')" for g, f in P.genre_family_pairs())
    return f"(values {rows}) as gf(genre, genre_family)"


def sub_label_values() -> str:
    rows = ", ".join(f"('{f}', {i}, '{n}', '{d}')" for f, i, n, d in P.sub_label_rows())
    return f"(values {rows}) as sl(genre_family, ordinal, mood_label, mood_description)"


def cte_classified(src: str = "silver", name: str = "classified") -> str:
    loud = f"least(greatest((coalesce({nn('loudness')}, {dbl(P.LOUDNESS_FILL)}) + {dbl(P.LOUDNESS_SHIFT)}) / {dbl(P.LOUDNESS_SCALE)}, {dbl(0)}), {dbl(1)})"
    tempo = f"coalesce({nn('tempo')}, {dbl(P.TEMPO_FILL)})"
    norm = f"""{name}_n as (
  select * replace ({tempo} as tempo, coalesce(cast(mode as double), {dbl(P.MODE_FILL)}) as mode),
         {loud} as loudness_norm,
         least(greatest(({tempo} - {dbl(P.TEMPO_SHIFT)}) / {dbl(P.TEMPO_SCALE)}, {dbl(0)}), {dbl(1)}) as tempo_norm
  from {src}),
{name}_f as (
  select n.*, coalesce(gf.genre_family, '{P.DEFAULT_FAMILY}') as genre_family
  from {name}_n n left join {genre_values()} on lower(n.track_genre) = gf.genre)"""
    # universal mood scores
    def cond(c):
        if c[0] == "any":
            return "(" + " or ".join(cond(x) for x in c[1]) + ")"
        f, op, thr = c
        return f"{nn(f)} {op} {dbl(thr)}"
    scores = []
    for mood in P.MOOD_NAMES:
        (p1, c1), (p2, c2) = P.MOOD_RULES[mood]
        rule = (f"(case when {' and '.join(cond(c) for c in c1)} then {p1} "
                f"when {' and '.join(cond(c) for c in c2)} then {p2} else 0 end)")
        bonus = [f"when '{fam}' then {b[mood]}" for fam, b in P.GENRE_BIAS.items() if mood in b]
        if bonus:
            rule += f" + (case genre_family {' '.join(bonus)} else 0 end)"
        scores.append((mood, f"s_{mood.lower()}", rule))
    score_sel = ",\n         ".join(f"{r} as {a}" for _, a, r in scores)
    greatest = "greatest(" + ", ".join(a for _, a, _ in scores) + ")"
    pick = " ".join(f"when {a} = {greatest} then '{m}'" for m, a, _ in scores)
    # sub-label
    clean = ", ".join(f"coalesce({nn(f)}, {dbl(P.SUB_LABEL_NULL_VALUE)}) as v_{f}"
                      for f in ["danceability", "energy", "valence", "acousticness", "instrumentalness",
                                "tempo_norm", "loudness_norm", "speechiness", "liveness", "mode"])
    fam_cases = []
    fam_cases_exact = []
    for fam, labels in P.SUB_LABELS.items():
        sums, pmax = [], []
        for name_, _, weights in labels:
            terms = []
            for f, w in weights:
                v = f"v_{P.WEIGHT_COLUMN.get(f, f)}"
                terms.append(f"{dbl(w)} * {v}" if w >= 0 else f"{dbl(abs(w))} * ({dbl(1)} - {v})")
            acc, prefixes = None, []
            for t in terms:
                acc = t if acc is None else f"({acc} + {t})"
                prefixes.append(acc)
            sums.append((name_, acc))
            pmax.append((name_, "greatest(" + ", ".join(prefixes) + ")"))
        for target, lst in ((fam_cases, sums), (fam_cases_exact, pmax)):
            g = "greatest(" + ", ".join(s for _, s in lst) + ")"
            inner = " ".join(f"when {s} = {g} then '{n}'" for n, s in lst)
            target.append(f"when '{fam}' then (case {inner} end)")
    return f"""{norm},
{name}_v as (select *, {clean} from {name}_f),
{name}_s as (
  select *, {score_sel},
         (case genre_family {' '.join(fam_cases)} else '{P.UNKNOWN_LABEL}' end) as mood_cluster,
         (case genre_family {' '.join(fam_cases_exact)} else '{P.UNKNOWN_LABEL}' end) as mood_cluster_exact
  from {name}_v),
{name} as (select *, (case {pick} end) as mood from {name}_s)"""


def cte_feature_history() -> str:
    """Features from three successive runs over growing silver snapshots."""
    parts, unions = [], []
    for i, (cutoff, run_ts) in enumerate(fixture.SNAPSHOTS, 1):
        where = f"where ingestion_timestamp < timestamp '{cutoff}'" if cutoff else ""
        parts.append(f"silver_s{i} as (select * from silver {where})")
        parts.append(cte_classified(f"silver_s{i}", f"cls{i}"))
        unions.append(f"""select track_id, mood_cluster, mood, genre_family, cast(danceability as float) as danceability,
         cast(energy as float) as energy, cast(valence as float) as valence,
         timestamp '{run_ts}' as event_timestamp from cls{i}""")
    parts.append("history as (" + "\n  union all\n  ".join(unions) + ")")
    return ",\n".join(parts)


# ---------------------------------------------------------------------------
# k-means (standardise, dominant-coordinate seeding, nearest centroid, labels)
# ---------------------------------------------------------------------------
def cte_kmeans() -> str:
    feats = P.KMEANS_FEATURES
    k = len(feats)
    zs = ", ".join(f"({f} - (select avg({f}) from km_in)) / (select stddev_samp({f}) from km_in) as z{i}"
                   for i, f in enumerate(feats))
    notnull = " and ".join(f"{f} is not null" for f in feats)

    def first_max(cols):
        g = "greatest(" + ", ".join(cols) + ")"
        return "case " + " ".join(f"when {c} = {g} then {i}" for i, c in enumerate(cols)) + " end"

    zcols = [f"z{i}" for i in range(k)]
    means = ", ".join(f"avg(z{i}) as c{i}" for i in range(k))
    pivot = ", ".join(f"max(case when cidx = {j} then c{i} end) as c{j}_{i}" for j in range(P.KMEANS_K)
                      for i in range(k))
    dists = []
    for j in range(P.KMEANS_K):
        terms = " + ".join(f"(z{i} - c{j}_{i}) * (z{i} - c{j}_{i})" for i in range(k))
        dists.append(f"({terms})")
    best = "least(" + ", ".join(dists) + ")"
    assign = "case " + " ".join(f"when {d} = {best} then {j}" for j, d in enumerate(dists)) + " end"
    # wishes are granted in cluster order from the labels still free; a wish that is gone gets the first free one
    wish = f"[{', '.join(repr(P.KMEANS_DOMINANT_LABEL[i]) for i in range(k))}][{first_max([f'c{i}' for i in range(k)])} + 1]"
    granted = "case when list_contains(s.free, w.wish) then w.wish else s.free[1] end"
    none = "[]::varchar[]"
    return f"""km_in as (select * from silver where {notnull}),
kz as (select track_id, {zs} from km_in),
kinit as (select *, {first_max(zcols)} as init from kz),
kcent as (select row_number() over (order by init) - 1 as cidx, {means} from kinit group by init),
cp as (select {pivot} from kcent),
kwish as (select list({wish} order by cidx) as wishes from kcent),
kgrant as (select list_reduce(
    list_prepend({{'wish': null::varchar, 'free': {list(P.KMEANS_LABELS)}, 'given': {none}}},
                 list_transform(wishes, lambda x: {{'wish': x, 'free': {none}, 'given': {none}}})),
    lambda s, w: {{'wish': w.wish, 'free': list_filter(s.free, lambda x: x <> {granted}), 'given': list_append(s.given, {granted})}}).given
  as given from kwish),
kassign as (select kz.*, {assign} as cluster from kz cross join cp),
kmeans_out as (select a.track_id, a.cluster, coalesce(g.given[a.cluster + 1], 'unknown') as mood_label from kassign a cross join kgrant g)"""
