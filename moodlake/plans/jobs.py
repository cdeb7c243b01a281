"""Jobs that persist layers: the daily pipeline and the weekly mood job.

Each job reads the previous layer from storage, runs one Catalyst plan and
writes its output to a folder that no other attempt uses, returning the path.
The written layer cuts the lineage (a lost executor re-runs only the tasks of the
current job; nothing is recomputed from raw files), and no job overwrites a
path it reads, a retry under the same run id neither.  Storage lives under
`base`, a durable folder that the cluster shares.  Which folders make up each
layer is kept in the lake's manifest (`sources/manifest.py`), so the next process
continues where this one ended, and of two writers one loses with an error.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moodlake.functions.params import MIN_SILVER_ROWS, TRACK_SCHEMA
from moodlake.operators import artists as A
from moodlake.operators import gold as G
from moodlake.operators import kmeans as K
from moodlake.operators import mood as M
from moodlake.operators import quality as Q
from moodlake.operators import scd2 as S
from moodlake.operators.features import build_features, features_latest, lookup_layout, mood_lookup, named_ids
from moodlake.operators.silver import conform_schema, dedup_latest, filter_ranges
from moodlake.sources.manifest import Manifest
from moodlake.sources.tables import read_bucketed, read_table, run_path, write_bucketed, write_measured

GOLD_TABLES = ["dim_track", "dim_artist", "dim_genre", "fact_streams", "agg_genre_trends", "agg_artist_profiles"]
ARTIST_BUCKETS = 16  # at least the session's shuffle partitions, or the stored side is dealt anew
TRACK_BUCKETS = 64
SEGMENTS = 30  # of closed versions; from here on they are written together anew


@dataclass
class Lake:
    """Where the layers of one pipeline live and which folders are current.

    Every write of a layer commits a version of the manifest, after the data;
    `together()` makes one version of several writes.  A layer is one folder
    (`write`), folders of its parts that are replaced one by one
    (`write_parts`), or a version table (`write_versions`).  Folders that no kept
    version names are removed by `vacuum`."""
    spark: SparkSession
    base: str
    fmt: str = "parquet"
    layers: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self):
        self.base = self.base.rstrip("/")
        self.manifest = Manifest(self.spark, self.base)
        self.layers = self.manifest.load().get("layers", {})
        self._waiting: dict[str, dict] | None = None
        if not self.manifest.version and self.manifest.files.glob(f"{self.base}/*/artists/run=*"):
            raise ValueError(f"{self.base} holds artist versions but no manifest: their history would be lost")

    @property
    def paths(self) -> dict[str, str]:
        return {n: e["path"] for n, e in self.layers.items()}

    @property
    def counts(self) -> dict[str, int]:
        return {n: e["rows"] for n, e in self.layers.items()}

    @contextlib.contextmanager
    def together(self):
        """All writes inside become current as one version, or none does."""
        if self._waiting is not None:
            yield self
            return
        before, self._waiting = dict(self.layers), {}
        try:
            yield self
            waiting, self._waiting = self._waiting, None
            if waiting:
                self.manifest.commit({"layers": self.layers})
        except BaseException:
            self.layers = before
            raise
        finally:
            self._waiting = None

    def _put(self, name: str, entry: dict) -> None:
        with self.together():
            self.layers = self.layers | {name: entry}
            self._waiting[name] = entry

    def attempt(self, layer: str, name: str, run_id: str) -> str:
        """A folder of its own for this attempt of a run."""
        run = run_path(self.base, layer, name, run_id)
        return f"{run}/attempt={len(self.manifest.files.glob(f'{run}/attempt=*')) + 1:03d}-{uuid.uuid4().hex[:8]}"

    def _schema(self, name: str) -> StructType:
        return StructType.fromJson(json.loads(self.layers[name]["schema"]))

    def read(self, name: str) -> DataFrame:
        """Read a layer with the schema it was written with: no inference
        pass, and partition columns keep their types (booleans, dates)."""
        entry = self.layers[name]
        if entry["kind"] == "versions":
            return self._versions(name)
        schema = self._schema(name)
        if entry["kind"] == "parts":
            return self.read_parts(name).drop(*[entry["column"]] * entry["column"].startswith("_"))  # a part column of its own
        return self.spark.read.schema(schema).format(self.fmt).load(entry["path"]).select(*schema.fieldNames())

    def write(self, layer: str, name: str, df: DataFrame, run_id: str, partition_by: list[str] | None = None,
              metrics: dict[str, Column] | None = None, options: dict[str, str] | None = None) -> str:
        """Write a layer whole; `metrics` of its rows are observed meanwhile and kept (`observed`)."""
        path = self.attempt(layer, name, run_id)
        found = write_measured(df, path, self.fmt, "errorifexists", partition_by, metrics, options)
        self._put(name, {"kind": "table", "path": path, "run": run_id, "schema": df.schema.json(), "rows": found["rows"],
                         "observed": found})
        return path

    def observed(self, name: str) -> dict[str, int] | None:
        """`rows` and the metrics of the layer's current rows, or None if it was written without."""
        entry = self.layers[name]
        if entry["kind"] == "parts":
            out: dict[str, int] = {}
            for part in entry["parts"].values():
                out = {k: out.get(k, 0) + v for k, v in part["observed"].items()}
            return out or {"rows": 0} | dict.fromkeys(entry["metrics"], 0)
        return entry.get("observed")

    def write_parts(self, layer: str, name: str, df: DataFrame, run_id: str, column: str, replaced: list[str] | None = None,
                    metrics: dict[str, Column] | None = None, note: dict | None = None) -> str:
        """Write the rows of some values of `column`, a folder each.  They take
        the place of the parts `replaced` (None: of all), given as the values'
        text; a replaced part without new rows goes.  All other parts stay where
        they are.  Rows and metrics of the new parts are counted by one
        aggregation of them."""
        path, metrics = self.attempt(layer, name, run_id), metrics or {}
        write_measured(df, path, self.fmt, "errorifexists", [column])
        written = self._parts_at(path, column, df.schema, None)
        counted = written.groupBy(F.col(column).cast("string").alias("part")).agg(
            F.count(F.lit(1)).alias("rows"), *[e.alias(n) for n, e in metrics.items()]).collect()  # a row a part
        new = {str(r["part"]): {"root": path, "observed": {k: int(r[k]) for k in ("rows", *metrics)}} for r in counted}
        had = self.layers.get(name, {}).get("parts", {}) if replaced is not None else {}
        if stray := set(new) - set(replaced or new):
            raise ValueError(f"{name}: rows of parts that are not replaced: {sorted(stray)[:5]}")
        parts = {k: v for k, v in had.items() if k not in set(replaced or [])} | new
        self._put(name, {"kind": "parts", "path": path, "run": run_id, "schema": df.schema.json(), "column": column, "parts": parts,
                         "metrics": list(metrics), **(note or {}), "rows": sum(p["observed"]["rows"] for p in parts.values())})
        return path

    def _parts_at(self, root: str, column: str, schema: StructType, values: list[str] | None) -> DataFrame:
        reader = self.spark.read.schema(schema).format(self.fmt).option("basePath", root)
        folders = [root] if values is None else [f"{root}/{column}={'__HIVE_DEFAULT_PARTITION__' if v == 'None' else v}" for v in values]
        return reader.load(folders).select(*schema.fieldNames())

    def read_parts(self, name: str, values: list[str] | None = None) -> DataFrame:
        """The layer's rows of some parts (None: all), its part column with
        them: one scan for each attempt that current parts come from."""
        entry, schema = self.layers[name], self._schema(name)
        roots: dict[str, list[str]] = {}
        for value in entry["parts"] if values is None else [v for v in values if v in entry["parts"]]:
            roots.setdefault(entry["parts"][value]["root"], []).append(value)
        out = self.spark.createDataFrame([], schema)
        for i, (root, own) in enumerate(sorted(roots.items())):
            scan = self._parts_at(root, entry["column"], schema, sorted(own))
            out = out.unionByName(scan) if i else scan
        return out

    def _versions(self, name: str) -> DataFrame:
        schema, entry = self._schema(name), self.layers[name]
        opened = self.open_versions(name)
        closed = StructType([f for f in schema.fields if f.name != "is_current"])
        if not entry["segments"]:
            return opened
        history = self.spark.read.schema(closed).format(self.fmt).load(entry["segments"])
        return opened.unionByName(history.withColumn("is_current", F.lit(False)).select(*schema.fieldNames()))

    def open_versions(self, name: str) -> DataFrame:
        """The open versions, clustered by the key they are stored in buckets of."""
        schema, entry = self._schema(name), self.layers[name]
        stored = StructType([f for f in schema.fields if f.name != "is_current"])
        opened = read_bucketed(self.spark, f"{entry['path']}/is_current=true", stored, entry["key"], entry["buckets"], self.fmt)
        return opened.withColumn("is_current", F.lit(True)).select(*schema.fieldNames())

    def write_versions(self, layer: str, name: str, df: DataFrame, run_id: str, key: str, buckets: int) -> str:
        """Write what a merge made of the open versions.  Rows that are current
        take the place of the open versions, in buckets of `key`; the others are
        added to the closed ones, which are never written again one by one."""
        path, files = self.attempt(layer, name, run_id), self.manifest.files
        found = write_bucketed(df, path, key, buckets, self.fmt, ["is_current"], {"closed": F.count_if(~F.col("is_current"))})
        had = self.layers.get(name, {"segments": [], "closed": 0})
        segments = had["segments"] + [f"{path}/is_current=false"] * bool(found["closed"])
        closed = had["closed"] + found["closed"]
        if len(segments) >= SEGMENTS:
            whole = f"{path}/closed"
            schema = StructType([f for f in df.schema.fields if f.name != "is_current"])
            self.spark.read.schema(schema).format(self.fmt).load(segments).write.format(self.fmt).save(whole)
            segments = [whole]
        if not files.glob(f"{path}/is_current=true"):  # no version is open: an empty folder to read
            df.limit(0).drop("is_current").write.format(self.fmt).save(f"{path}/is_current=true")
        self._put(name, {"kind": "versions", "path": path, "run": run_id, "schema": df.schema.json(), "key": key, "buckets": buckets,
                         "segments": segments, "closed": closed, "rows": found["rows"] - found["closed"] + closed})
        return path

    def vacuum(self, older_than: float = 7 * 86400) -> list[str]:
        """Remove the attempts that no kept version of the manifest names and
        that were last written so many seconds ago (a run may be writing)."""
        states = [Manifest(self.spark, self.base).load(v) for v in self.manifest.versions()]
        named = json.dumps(states)
        gone = [p for p in self.manifest.files.glob(f"{self.base}/*/*/run=*/attempt=*")
                if p[p.index("/run="):] not in named and self.manifest.files.age(p) >= older_than]
        for path in gone:
            self.manifest.files.delete(path)
        return gone


def run_bronze(lake: Lake, raw: DataFrame, run_id: str) -> str:
    """Land raw records (already stamped with ingest metadata) as bronze."""
    return lake.write("bronze", "bronze", raw, run_id)


def _in_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("_bucket", F.pmod(F.xxhash64("track_id"), F.lit(buckets)).cast("int"))


def _write_silver(lake: Lake, rows: DataFrame, run_id: str, tiebreak: list[str] | None, buckets: int, touched: list[str] | None) -> None:
    with lake.together():
        lake.write_parts("silver", "latest", dedup_latest(rows, "track_id", "ingestion_timestamp", tiebreak), run_id, "_bucket",
                         touched, note={"buckets": buckets})
        tracks = filter_ranges(conform_schema(lake.read_parts("latest", touched), [*TRACK_SCHEMA, ("_bucket", "int")]))
        lake.write_parts("silver", "silver", tracks, run_id, "_bucket", touched, Q.silver_counters(tracks.columns))


def run_silver(lake: Lake, run_id: str, tiebreak: list[str] | None = None, buckets: int = TRACK_BUCKETS) -> str:
    """Silver from the whole current bronze.  Tracks are dealt into buckets by
    a hash of their id, and the counts behind the quality checks are kept for
    each bucket, so that run_silver_upsert can go on from here."""
    _write_silver(lake, _in_buckets(lake.read("bronze"), buckets), run_id, tiebreak, buckets, None)
    return lake.paths["silver"]


def run_silver_upsert(lake: Lake, run_id: str, tiebreak: list[str] | None = None, buckets: int = TRACK_BUCKETS) -> list[str]:
    """Upsert the current bronze, the rows landed since, into silver: the
    latest row wins per track.

    The layer `latest` holds the newest bronze row of every track, also of
    those that the range filter keeps out of silver, so that an out-of-range
    latest row removes its track.  Only the buckets that the new rows fall into
    are read and written again, in both layers; the result is that of building
    silver from all rows ever landed.  Returns the buckets written."""
    buckets = lake.layers.get("latest", {}).get("buckets", buckets)
    rows = _in_buckets(lake.read("bronze"), buckets)
    touched = [str(r[0]) for r in rows.select("_bucket").distinct().collect()]  # at most `buckets` numbers
    if "latest" in lake.layers:
        rows = lake.read_parts("latest", touched).unionByName(rows, allowMissingColumns=True)
    _write_silver(lake, rows, run_id, tiebreak, buckets, touched)
    return touched


def run_artists(lake: Lake, run_id: str, run_ts: str, buckets: int = ARTIST_BUCKETS) -> str:
    """SCD2 merge of today's snapshot into the open versions (none on the
    first run).  Open versions are stored in buckets of the artist id, so only the
    snapshot is exchanged; closed versions are neither read nor written."""
    snapshot = A.artist_snapshot(lake.read("silver"))
    if "artists" not in lake.layers:
        merged = S.first_load(snapshot, run_ts).repartition(buckets, "artist_id")
    else:
        buckets = lake.layers["artists"]["buckets"]
        merged = S.merge_open(lake.open_versions("artists"), snapshot, run_ts, null_keys=False)  # ids are digests
    return lake.write_versions("silver", "artists", merged, run_id, "artist_id", buckets)


def run_silver_quality(lake: Lake, run_id: str, minimum: int = MIN_SILVER_ROWS, enforce: bool = True) -> DataFrame:
    """Silver checks; the report is stored per run, then enforced.  Counts come
    from those kept when silver was written; only the referential check scans it."""
    report = Q.dq_silver_observed(lake.observed("silver"), lake.read("silver"), lake.read("artists"), minimum)
    lake.write("quality", "silver_report", report, run_id)
    stored = lake.read("silver_report")
    if enforce:
        Q.assert_quality(stored)
    return stored


def run_gold(lake: Lake, run_id: str, digits: int = 6, enforce: bool = True, touched: list[str] | None = None) -> dict[str, str]:
    """Six gold tables from the stored silver layers, as one version of the
    lake, then key checks.  The two aggregates come from partial sums
    (run_trends), of which only those of the `touched` buckets are made anew."""
    tables = G.build_gold(lake.read("silver"), lake.read("artists"), digits)
    with lake.together():
        for name in ("dim_track", "dim_artist", "dim_genre"):
            lake.write("gold", name, tables[name], run_id)
        lake.write_parts("gold", "fact_streams", tables["fact_streams"], run_id, "ingestion_date")
        run_trends(lake, run_id, touched, digits)
    report = Q.dq_gold({n: lake.read(n) for n in Q.GOLD_KEYS})
    lake.write("quality", "gold_report", report, run_id)
    if enforce:
        Q.assert_quality(lake.read("gold_report"))
    return {n: lake.paths[n] for n in GOLD_TABLES}


def run_key_check(lake: Lake, name: str, key: str, run_id: str, touched: list[str], enforce: bool = True) -> DataFrame:
    """Key checks of the parts of a layer that a run has written, against all
    others: a filter of the keys is stored for every part, so the other parts'
    rows are read only where the filter says that a key may be there."""
    entry, stored = lake.layers[name], f"{name}_keys"
    known = [v for v in lake.layers.get(stored, {}).get("parts", {}) if v not in touched and v in entry["parts"]]
    missing = [v for v in entry["parts"] if v not in touched and v not in known]
    new = lake.read_parts(name, touched)
    old = lake.read_parts(name, known)
    column = entry["column"]
    with lake.together():
        if missing:  # parts written before there was a filter
            lake.write_parts("quality", stored, Q.key_words(lake.read_parts(name, missing), key, [column]), run_id, column, missing)
            old = lake.read_parts(name, known + missing)
        words = lake.read_parts(stored, known + missing) if known or missing else Q.key_words(new.limit(0), key)
        report = Q.dq_new_keys(new, old, words.select("word", "mask"), key, name)
        lake.write("quality", f"{name}_key_report", report, run_id)
        lake.write_parts("quality", stored, Q.key_words(new, key, [column]), run_id, column, touched)
    if enforce:
        Q.assert_quality(lake.read(f"{name}_key_report"))
    return lake.read(f"{name}_key_report")


def run_trends(lake: Lake, run_id: str, touched: list[str] | None = None, digits: int = 6) -> None:
    """The genre and artist aggregates from stored partial sums: those of the
    buckets that silver was written in (None: all) are summed again, then the
    partial sums of all buckets are merged.  Equal to a rebuild from silver."""
    if any(f"{by}_state" not in lake.layers for by in G.STATE_KEYS):
        touched = None
    with lake.together():
        tracks = lake.read_parts("silver", touched)
        for by in G.STATE_KEYS:
            lake.write_parts("gold", f"{by}_state", G.trend_state(tracks, by, ["_bucket"]), run_id, "_bucket", touched)
        lake.write("gold", "agg_genre_trends", G.genre_trends_of(lake.read("genre_state"), digits), run_id)
        lake.write("gold", "agg_artist_profiles", G.artist_profiles_of(lake.read("artist_state"), lake.read("artists"), digits), run_id)


def run_mood(lake: Lake, run_id: str, run_ts: str) -> str:
    """Classify silver, write the feature table, and write the sub-label into
    `mood_cluster` of dim_track and fact_streams.  Of the fact only the dates on
    which a label changes are written again."""
    with lake.together():
        classified = M.classify_tracks(lake.read("silver"))
        lake.write("features", "track_features", build_features(classified, run_ts), run_id)
        labels = lake.read("track_features").select("track_id", "mood_cluster")
        lake.write("gold", "dim_track", M.apply_mood_labels(lake.read("dim_track"), labels), run_id)
        new = labels.select("track_id", F.col("mood_cluster").alias("_new"))
        fact = lake.read("fact_streams").select("track_id", "mood_cluster", "ingestion_date").join(new, "track_id", "left")
        changed = fact.filter(~F.col("mood_cluster").eqNullSafe(F.col("_new"))).select(F.col("ingestion_date").cast("string")).distinct()
        dates = [str(r[0]) for r in changed.collect()]  # at most as many as there are dates
        if dates:
            lake.write_parts("gold", "fact_streams", M.apply_mood_labels(lake.read_parts("fact_streams", dates), labels), run_id,
                             "ingestion_date", dates)
    return lake.paths["track_features"]


def run_lookup(lake: Lake, run_id: str) -> str:
    """The newest feature row of every track, laid out for point lookups."""
    ordered, options = lookup_layout(features_latest(lake.read("track_features")), rows=lake.counts["track_features"])
    return lake.write("features", "lookup", ordered, run_id, options=options)


def lookup(lake: Lake, requests: DataFrame) -> DataFrame:
    """Batch lookup of the stored features: few ids read few row groups, many ids one scan."""
    return mood_lookup(named_ids(lake.read("lookup"), requests), requests)


def run_kmeans(lake: Lake, run_id: str, version: str | int) -> str:
    """Train k = 6 on silver, publish labelled predictions, save the model."""
    silver = lake.read("silver")
    model = K.train_kmeans(silver)
    lake.write("gold", "mood_predictions", K.kmeans_predictions(model, silver), run_id)
    return K.save_model(model, f"{lake.base}/models/kmeans", version)


def daily(lake: Lake, raw: DataFrame, run_id: str, run_ts: str, tiebreak: list[str] | None = None,
          minimum: int = MIN_SILVER_ROWS, incremental: bool = False) -> dict[str, int]:
    """bronze -> silver -> artists -> checks -> gold -> checks.  `raw` is the
    whole bronze, or with `incremental` the rows landed since the run before."""
    run_bronze(lake, raw, run_id)
    touched = run_silver_upsert(lake, run_id, tiebreak) if incremental else None
    if not incremental:
        run_silver(lake, run_id, tiebreak)
    run_artists(lake, run_id, run_ts)
    run_silver_quality(lake, run_id, minimum)
    run_gold(lake, run_id, touched=touched)
    return dict(lake.counts)
