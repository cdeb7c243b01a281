"""Data-quality checks as report DataFrames.

Every check yields rows (check_name, table_name, column_name, observed, passed).  Checks
over one table are computed in a single aggregate pass; `assert_quality`
collects only the report (a handful of rows) and raises on failures.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.functions.params import MIN_SILVER_ROWS, RANGE_COLUMNS
from moodlake.operators.artists import distinct_track_artists

REPORT_COLUMNS = ["check_name", "table_name", "column_name", "observed", "passed"]


def _rows(wide: DataFrame, specs: list[tuple[str, str, str, str]]) -> DataFrame:
    """Unpivot a one-row aggregate into report rows.
    specs: (check, table, column, field) with `field` a column of `wide`;
    a check passes when its observed count is zero (the caller decides row_count)."""
    stacked = F.stack(F.lit(len(specs)),
                      *[x for chk, tbl, col, fld in specs
                        for x in (F.lit(chk), F.lit(tbl), F.lit(col).cast("string"), F.col(fld).cast("bigint"))])
    out = wide.select(stacked.alias("check_name", "table_name", "column_name", "observed"))
    return out.withColumn("passed", F.col("observed") == 0)


def dq_nulls(df: DataFrame, cols: list[str], table: str = "") -> DataFrame:
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(cols)])
    return _rows(wide, [("not_null", table, c, f"n_{i}") for i, c in enumerate(cols)])


def dq_ranges(df: DataFrame, cols: list[str] | None = None, table: str = "",
              lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Values outside [lo, hi]; null passes (it is the null check's business)."""
    cols = cols or RANGE_COLUMNS
    wide = df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"r_{i}") for i, c in enumerate(cols)])
    return _rows(wide, [("in_range", table, c, f"r_{i}") for i, c in enumerate(cols)])


def dq_row_count(df: DataFrame, minimum: int = MIN_SILVER_ROWS, table: str = "") -> DataFrame:
    return (df.agg(F.count(F.lit(1)).alias("observed"))
            .select(F.lit("row_count").alias("check_name"), F.lit(table).alias("table_name"),
                    F.lit(None).cast("string").alias("column_name"), F.col("observed"),
                    (F.col("observed") >= minimum).alias("passed")))


def dq_primary_key(df: DataFrame, pk: str, table: str = "") -> DataFrame:
    """Nulls in the key, and duplicates = rows past the first per key value
    (null equal to null).  One partial-aggregated shuffle on the key."""
    per_key = df.groupBy(pk).agg(F.count(F.lit(1)).alias("_n"))
    dup = per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dups"),
                      F.coalesce(F.sum(F.when(F.col(pk).isNull(), F.col("_n"))), F.lit(0)).alias("nulls"))
    return _rows(dup, [("not_null", table, pk, "nulls"), ("unique", table, pk, "dups")])


def dq_table(df: DataFrame, table: str, pk: str | None = None, not_null: list[str] | None = None,
             accepted: dict[str, list[str]] | None = None) -> DataFrame:
    """Key (nulls, duplicates), not-null and accepted-value checks of one table
    in ONE scan: the per-row counters are summed inside the key aggregation,
    whose partial step runs map-side, so the table is read once and the key
    shuffle carries a few extra counters instead of a second pass."""
    not_null = not_null or []
    accepted = accepted or {}
    counters = ([(f"n_{i}", F.count_if(F.col(c).isNull())) for i, c in enumerate(not_null)]
                + [(f"a_{i}", F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*vals)))
                   for i, (c, vals) in enumerate(accepted.items())])
    specs = ([("not_null", table, c, f"n_{i}") for i, c in enumerate(not_null)]
             + [("accepted_values", table, c, f"a_{i}") for i, c in enumerate(accepted)])
    if pk is None:
        wide = df.agg(*[e.alias(n) for n, e in counters]) if counters else None
    else:
        per_key = df.groupBy(pk).agg(F.count(F.lit(1)).alias("_n"), *[e.alias(n) for n, e in counters])
        wide = per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_dups"),
                           F.coalesce(F.sum(F.when(F.col(pk).isNull(), F.col("_n"))), F.lit(0)).alias("_nulls"),
                           *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n, _ in counters])
        specs = [("not_null", table, pk, "_nulls"), ("unique", table, pk, "_dups")] + specs
    if wide is None:
        raise ValueError("dq_table needs a key or at least one column check")
    return _rows(wide, specs)


def dq_accepted_values(df: DataFrame, col: str, values: list[str], table: str = "") -> DataFrame:
    """Non-null values outside the accepted set (nulls pass)."""
    wide = df.agg(F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(*values)).alias("bad"))
    return _rows(wide, [("accepted_values", table, col, "bad")])


def dq_referential(tracks: DataFrame, artists: DataFrame, table: str = "tracks") -> DataFrame:
    """Distinct track artist names (trimmed, blanks skipped) with no row in the
    artist dimension: an anti join of two distinct sets."""
    names = distinct_track_artists(tracks)
    known = artists.select("artist_name").distinct()
    missing = names.join(known, "artist_name", "left_anti")
    wide = missing.agg(F.count(F.lit(1)).alias("missing"))
    return _rows(wide, [("referential", table, "artists", "missing")])


SILVER_KEY_COLUMNS = ["track_id", "track_name", "artists"]


def silver_counters(columns: list[str]) -> dict[str, Column]:
    """The counts behind the silver checks, as aggregates of the track rows:
    computed by a scan, or observed while the rows are written."""
    nulls = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in SILVER_KEY_COLUMNS}
    return nulls | {f"out_{c}": F.count_if((F.col(c) < 0.0) | (F.col(c) > 1.0)) for c in RANGE_COLUMNS if c in columns}


def _silver_specs(columns: list[str]) -> list[tuple[str, str, str | None, str]]:
    return ([("row_count", "tracks", None, "rows")] + [("not_null", "tracks", c, f"null_{c}") for c in SILVER_KEY_COLUMNS]
            + [("in_range", "tracks", c, f"out_{c}") for c in RANGE_COLUMNS if c in columns])


def _silver_rows(wide: DataFrame, columns: list[str], minimum: int) -> DataFrame:
    # one unpivot holds all rows, so no pruning can make two different scans of it
    return _rows(wide, _silver_specs(columns)).withColumn(
        "passed", F.when(F.col("check_name") == "row_count", F.col("observed") >= minimum).otherwise(F.col("passed")))


def dq_silver(tracks: DataFrame, artists: DataFrame, minimum: int = MIN_SILVER_ROWS) -> DataFrame:
    """Silver checks: row count, nulls in key columns, ranges (one scan), and
    track -> artist referential integrity."""
    wide = tracks.agg(F.count(F.lit(1)).alias("rows"), *[e.alias(n) for n, e in silver_counters(tracks.columns).items()])
    return _silver_rows(wide, tracks.columns, minimum).unionByName(dq_referential(tracks, artists))


def dq_silver_observed(observed: dict[str, int], tracks: DataFrame, artists: DataFrame,
                       minimum: int = MIN_SILVER_ROWS) -> DataFrame:
    """The same report from counts observed when the tracks were written
    (`rows` and silver_counters()); only the referential check reads them."""
    wide = tracks.sparkSession.createDataFrame([tuple(observed.values())], ", ".join(f"`{n}` bigint" for n in observed))
    return _silver_rows(wide, tracks.columns, minimum).unionByName(dq_referential(tracks, artists))


KEY_CELLS = 1 << 36  # of a key filter; only words with a key in them are stored


def key_words(df: DataFrame, key: str, by: list[str] | None = None, cells: int = KEY_CELLS) -> DataFrame:
    """A filter of the keys, per value of `by`: (word, mask), a bit for each of
    64 cells into which a key falls.  Filters of several values add up."""
    return (_cells(df.filter(F.col(key).isNotNull()), key, cells).groupBy(*(by or []), "word")
            .agg(F.bit_or("bit").alias("mask")))


def _cells(df: DataFrame, key: str, cells: int) -> DataFrame:
    cell = F.pmod(F.xxhash64(key), F.lit(cells))
    return df.withColumns({"word": F.shiftright(cell, 6), "bit": F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{key}`), 64) as int))")})


def maybe_known(new: DataFrame, words: DataFrame, key: str, cells: int = KEY_CELLS) -> DataFrame:
    """The distinct keys of `new` that the filter may hold: all that it holds, and few others."""
    seen = words.select(F.col("word").alias("_word"), "mask")
    return (_cells(new.select(key).filter(F.col(key).isNotNull()), key, cells)
            .join(seen, (F.col("word") == F.col("_word")) & (F.col("mask").bitwiseAND(F.col("bit")) != 0), "left_semi")
            .select(key).distinct())


def dq_new_keys(new: DataFrame, old: DataFrame, words: DataFrame, key: str, table: str = "", cells: int = KEY_CELLS) -> DataFrame:
    """Null and duplicate keys that new rows bring into a table whose old rows
    were checked before: duplicates among the new rows, and new keys that old
    rows have.  `words` is the stored filter of the old keys; the old rows are
    read only for the keys it may hold, and not at all if there are none."""
    maybe = maybe_known(new, words, key, cells)
    own = dq_primary_key(new, key, table)
    if not maybe.limit(1).count():
        return own
    known = old.select(key).join(maybe, key, "left_semi").agg(F.count(F.lit(1)).alias("known"))
    found = known.select(F.lit("unique").alias("check_name"), F.col("known"))
    return (own.join(F.broadcast(found), "check_name", "left")  # one row
            .select("check_name", "table_name", "column_name", (F.col("observed") + F.coalesce("known", F.lit(0))).alias("observed"))
            .withColumn("passed", F.col("observed") == 0))


GOLD_KEYS = {"dim_track": "track_id", "dim_artist": "artist_sk", "dim_genre": "genre_id",
             "fact_streams": "stream_id"}


def dq_gold(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    keys = keys or GOLD_KEYS
    parts = [dq_primary_key(tables[t], pk, t) for t, pk in keys.items() if t in tables]
    return reduce(DataFrame.unionByName, parts)


def dq_report(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [r.select(*REPORT_COLUMNS) for r in reports])


def assert_quality(report: DataFrame) -> None:
    """Raise with every failed check listed (the report is a few rows)."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        msg = "; ".join(f"{r['check_name']} {r['table_name']}.{r['column_name']}: {r['observed']}" for r in failed)
        raise ValueError(f"Data quality failed: {msg}")
