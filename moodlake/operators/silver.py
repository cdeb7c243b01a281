"""Silver layer: latest-wins dedup, schema conform, range filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.functions.expr import nan_to_null
from moodlake.functions.params import RANGE_COLUMNS, TRACK_SCHEMA

# The filter of the latest rows: words of 64 bits, and bits that a row sets in its word.
FILTER_WORDS_LOG2 = 20
FILTER_PROBES = 3


def latest_order(ts: str, tiebreak: list[str] | None = None) -> list[Column]:
    """Total order for 'latest wins': newest timestamp first (nulls last), then
    the tie-break columns ascending."""
    return [F.col(ts).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak or []]


def dedup_latest(df: DataFrame, key: str | list[str], ts: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the latest by `ts`, ties broken by `tiebreak`.

    `row_number() = 1` lets the optimizer insert a partial WindowGroupLimit
    before the shuffle, so every map task forwards at most one row per key: a
    key holding a third of all rows costs no more shuffle than any other.
    Null keys form one group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*latest_order(ts, tiebreak))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def conform_schema(df: DataFrame, schema: list[tuple[str, str]] | None = None) -> DataFrame:
    """Keep the canonical columns that exist, in canonical order, each cast to
    its type per value (`try_cast`: a bad value becomes null instead of failing
    the job).  Doubles get NaN -> null so range checks treat NaN as missing."""
    schema = schema or TRACK_SCHEMA
    present = set(df.columns)
    out = []
    for name, typ in schema:
        if name not in present:
            continue
        c = F.col(name).try_cast(typ)
        if typ in ("double", "float"):
            c = nan_to_null(c)
        out.append(c.alias(name))
    return df.select(*out)


def cast_failures(df: DataFrame, schema: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per column: values present in the input that the canonical cast rejects.
    One pass, one row per column: (column_name, failures)."""
    schema = schema or TRACK_SCHEMA
    present = [(n, t) for n, t in schema if n in df.columns]
    aggs = [F.count_if(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull()).alias(n) for n, t in present]
    wide = df.agg(*aggs)
    stacked = F.stack(F.lit(len(present)), *[x for n, _ in present for x in (F.lit(n), F.col(n))])
    return wide.select(stacked.alias("column_name", "failures"))


def range_predicate(cols: list[str] | None = None, not_null: list[str] | None = None) -> Column:
    cols = RANGE_COLUMNS if cols is None else cols
    not_null = ["tempo"] if not_null is None else not_null
    preds = [F.col(c).between(F.lit(0.0), F.lit(1.0)) for c in cols]
    preds += [F.col(c).isNotNull() & ~F.isnan(F.col(c)) for c in not_null]
    return reduce(lambda a, b: a & b, preds)


def filter_ranges(df: DataFrame, cols: list[str] | None = None, not_null: list[str] | None = None) -> DataFrame:
    """Rows whose range columns lie in [0, 1] (null or NaN fails) and whose
    `not_null` columns are present; one AND-folded predicate, pushed to the scan
    when the input is a table."""
    cols = [c for c in (RANGE_COLUMNS if cols is None else cols) if c in df.columns]
    not_null = [c for c in (["tempo"] if not_null is None else not_null) if c in df.columns]
    return df.filter(range_predicate(cols, not_null))


def maybe_latest(df: DataFrame, key: list[str], ts: str, stamps: DataFrame | None = None) -> DataFrame:
    """df without most rows that are not at the latest `ts` of their key; no
    row at it is lost (nulls count as oldest).

    The latest `ts` of every key is an aggregate of two narrow columns, of df or
    of `stamps`.  Its (key, ts) pairs set FILTER_PROBES bits each in one of at most
    2 ** FILTER_WORDS_LOG2 words, which are broadcast: what is sent is bounded, and with many more keys
    than words the filter lets more rows through.  It is a semi join, which the
    optimizer moves below other joins of df: what those exchange is filtered
    too.  It never decides: a dedup has to follow."""
    pair = F.xxhash64(*key, ts)

    def word(c: Column) -> Column:
        return F.shiftrightunsigned(c, 64 - FILTER_WORDS_LOG2)

    newest = (df if stamps is None else stamps).groupBy(*key).agg(F.max(ts).alias(ts)).select(pair.alias("_pair"))
    bits = reduce(lambda a, b: a.bitwiseOR(b),
                  [F.expr(f"shiftleft(1L, cast(shiftright(_pair, {6 * i}) & 63 as int))") for i in range(FILTER_PROBES)])
    held = newest.groupBy(word(F.col("_pair")).alias("_word")).agg(F.bit_or(bits).alias("_held"))
    places = [F.shiftright(pair, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(FILTER_PROBES)]
    # one bit after the other: most rows that go are ruled out by the first
    found = [F.call_function("shiftright", F.col("_held"), at).bitwiseAND(F.lit(1)) == 1 for at in places]
    return df.join(F.broadcast(held), reduce(lambda a, b: a & b, found, word(pair) == F.col("_word")), "left_semi")


def build_silver(bronze: DataFrame, tiebreak: list[str] | None = None, key: str = "track_id",
                 ts: str = "ingestion_timestamp", schema: list[tuple[str, str]] | None = None,
                 range_cols: list[str] | None = None, not_null: list[str] | None = None,
                 stamps: DataFrame | None = None) -> DataFrame:
    """bronze -> silver: dedup (before filtering: an out-of-range latest row
    removes the track rather than resurrecting an older copy), conform, filter.
    The canonical schema, range columns and required columns are parameters
    (e.g. a single-precision variant with five range checks).

    Of the wide rows only those that may be the latest of their key are
    exchanged (`maybe_latest`: keys and timestamps are read once more for it, of
    bronze or of `stamps`: rows of key and `ts` with the same latest `ts` of
    every key in bronze, and maybe more keys, from where they cost less).
    What is left is rebalanced by key before it is sorted, as it may still be
    most of the input: a split holds more wide rows than a task can sort in
    memory.  Adaptive execution sizes the parts and splits that of a hot key;
    the limit inside them leaves one row per key and part for the second
    exchange."""
    keys = [key] if isinstance(key, str) else list(key)
    dealt = maybe_latest(bronze, keys, ts, stamps).withColumn("_deal", F.xxhash64(*keys)).hint("rebalance", "_deal").drop("_deal")
    return filter_ranges(conform_schema(dedup_latest(dealt, key, ts, tiebreak), schema), range_cols, not_null)
