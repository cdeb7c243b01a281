"""Slowly changing dimension, type 2, for artists.

A version row carries (valid_from, valid_to, is_current).  A merge of a new
snapshot closes the open version of every artist whose row_hash changed and
appends a new open version for changed and new artists; artists absent from
the snapshot keep their open version.  Only the open version is closed: an
older version's valid_to is never re-stamped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ts(run_ts: str | Column) -> Column:
    return F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts.cast("timestamp")


def first_load(snapshot: DataFrame, run_ts: str | Column) -> DataFrame:
    """Bootstrap: every snapshot row becomes an open version."""
    return snapshot.select(
        *[c for c in snapshot.columns],
        _ts(run_ts).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_merge(existing: DataFrame | None, snapshot: DataFrame, run_ts: str | Column,
               key: str = "artist_id", hash_col: str = "row_hash") -> DataFrame:
    """Merge a snapshot into the version table.

    Only the open versions meet the snapshot (`merge_open`); closed versions
    never change and pass straight through, so a run costs what is open, not
    what has ever been."""
    if existing is None:
        return first_load(snapshot, run_ts)
    history = existing.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    return history.unionByName(merge_open(current_versions(existing), snapshot, run_ts, key, hash_col))


def merge_open(opened: DataFrame, snapshot: DataFrame, run_ts: str | Column, key: str = "artist_id",
               hash_col: str = "row_hash", null_keys: bool = True) -> DataFrame:
    """What a merge makes of the open versions: those that stay open, those
    closed now, and the new open versions of changed and new keys.

    A full outer join on the key; both sides are unique per key, so no key is
    hot.  Without null keys on either side (`null_keys` false) the join is a plain
    equi-join, so open versions stored in buckets of the key are not
    exchanged: only the snapshot is."""
    ts = _ts(run_ts)
    cols = opened.columns
    types = {f.name: f.dataType for f in opened.schema}
    # plain renamed columns: a struct would hide how the side is clustered
    had_side = opened.select(*[F.col(c).alias(f"_o_{c}") for c in cols], F.lit(True).alias("_had"))
    has_side = snapshot.select(*[F.col(c).alias(f"_n_{c}") for c in snapshot.columns], F.lit(True).alias("_has"))
    one, two = F.col(f"_o_{key}"), F.col(f"_n_{key}")
    both = had_side.join(has_side, one.eqNullSafe(two) if null_keys else one == two, "full")
    had, has = F.col("_had").isNotNull(), F.col("_has").isNotNull()
    changed = has & (~had | ~F.col(f"_n_{hash_col}").eqNullSafe(F.col(f"_o_{hash_col}")))
    old = {c: F.col(f"_o_{c}") for c in cols} | {"valid_to": F.when(changed, ts).otherwise(F.col("_o_valid_to")),
                                                 "is_current": ~changed}
    new = {c: F.col(f"_n_{c}") if c in snapshot.columns else F.lit(None) for c in cols} | {
        "valid_from": ts, "valid_to": F.lit(None), "is_current": F.lit(True)}
    rows = [F.when(when, F.struct(*[row[c].cast(types[c]).alias(c) for c in cols])) for when, row in ((had, old), (changed, new))]
    return both.select(F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("_r")).select("_r.*")


def _changed_keys(existing: DataFrame, snapshot: DataFrame, key: str, hash_col: str) -> DataFrame:
    """Keys whose open version differs from the snapshot row (one row per key:
    the snapshot and the open versions are both unique per key)."""
    opened = current_versions(existing).select(key, F.col(hash_col).alias("_old"))
    snap = snapshot.select(key, F.col(hash_col).alias("_new"))
    return opened.join(snap, key).filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(key)


def scd2_expire(existing: DataFrame, snapshot: DataFrame, run_ts: str | Column, key: str = "artist_id",
                hash_col: str = "row_hash") -> DataFrame:
    """The open versions a merge closes (semi join on changed keys), with
    valid_to = run time and is_current = false."""
    cols = existing.columns
    closed = current_versions(existing).join(_changed_keys(existing, snapshot, key, hash_col), key, "left_semi")
    return closed.withColumns({"valid_to": _ts(run_ts), "is_current": F.lit(False)}).select(*cols)


def scd2_unchanged(existing: DataFrame, snapshot: DataFrame, key: str = "artist_id",
                   hash_col: str = "row_hash") -> DataFrame:
    """The versions a merge leaves as they are: all closed history, and the
    open versions of keys that are absent from the snapshot or unchanged
    (anti join on changed keys)."""
    history = existing.filter(~F.col("is_current"))
    kept = current_versions(existing).join(_changed_keys(existing, snapshot, key, hash_col), key, "left_anti")
    return history.unionByName(kept.select(*existing.columns))


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col("is_current"))


def merge_stats(existing: DataFrame, snapshot: DataFrame, key: str = "artist_id",
                hash_col: str = "row_hash") -> DataFrame:
    """Counts a merge would produce: artists in the open set, expired,
    unchanged (open and same hash), inserted (new or changed)."""
    open_v = current_versions(existing).select(key, F.col(hash_col).alias("_old"))
    j = open_v.join(snapshot.select(key, F.col(hash_col).alias("_new")), key, "full")
    return j.agg(
        F.count_if(F.col("_old").isNotNull()).alias("open_before"),
        F.count_if(F.col("_old").isNotNull() & F.col("_new").isNotNull()
                   & (F.col("_old") != F.col("_new"))).alias("expired"),
        F.count_if(F.col("_old").isNotNull() & (F.col("_new").isNull() | (F.col("_old") == F.col("_new"))))
         .alias("unchanged"),
        F.count_if(F.col("_new").isNotNull() & (F.col("_old").isNull() | (F.col("_old") != F.col("_new"))))
         .alias("inserted"),
    )
