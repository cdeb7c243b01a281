"""Exact deduplication with a two-pass Bloom filter.

Pass one marks, in arrays of cells, which cells are hit by two or more rows;
a row whose cells are all marked is possibly repeated.  The marked cells make a
bit filter of a fixed largest size, which is broadcast.  Pass two tests every row
against it: only possibly repeated rows are shuffled, grouped and joined, and
all others pass straight through as their own group.  The filter has no false
negatives, so the result is exact whatever its size; false positives only
shuffle a few rows more.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import renamed, stored

CELLS_PER_ROW = 16
MAX_FILTER_BITS = 1 << 28  # 32 MB: the largest filter that is broadcast
HASHES = 2


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty.  Runs that are one
    space already need no replacement and are not matched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x09-\x0D\x20]*|\x20[\x09-\x0D\x20]+", " ")


def _hash64(digest: Column, half: int) -> Column:
    """60 bits of a hexadecimal digest as long."""
    return F.conv(F.substring(digest, 1 + 16 * half, 15), 16, 10).cast("long")


def filter_bits(rows: int) -> int:
    """Bits of each hash's array: a power of two, CELLS_PER_ROW times the rows
    at least, up to MAX_FILTER_BITS over all hashes."""
    bits = 1 << 16
    while bits < rows * CELLS_PER_ROW and bits * 2 * HASHES <= MAX_FILTER_BITS:
        bits *= 2
    return bits


def repeated_filter(rows: DataFrame, digest: str) -> tuple[np.ndarray, int]:
    """The words of the bit filter of cells hit at least twice, and the bits of
    one hash's array.  Counting is an aggregation with partial sums in each
    task, so a text that holds a third of all rows is summed where it is read;
    what reaches the driver is the filter, MAX_FILTER_BITS / 8 bytes at most."""
    bits = filter_bits(rows.count())
    cells = F.explode(F.array(*[(_hash64(F.col(digest), h) % bits + bits * h) for h in range(HASHES)]))
    hit = rows.select(cells.alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    words = (hit.select(F.shiftright("cell", 5).alias("word"), F.expr("shiftleft(1L, cast(cell % 32 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("mask")).toArrow())
    out = np.zeros(bits * HASHES // 32, np.uint32)
    out[words["word"].to_numpy()] = words["mask"].to_numpy().astype(np.uint32)
    return out, bits


def _tested(rows: DataFrame, words: np.ndarray, bits: int) -> DataFrame:
    """rows (with text_sha256) and _again: whether the filter holds all cells of the digest."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def maybe_repeated(first: pd.Series, second: pd.Series) -> pd.Series:
        found = np.ones(len(first), bool)
        for h, hashed in enumerate((first, second)):
            cell = hashed.to_numpy() % bits + bits * h
            found &= (shared.value[cell >> 5] >> (cell & 31).astype(np.uint32)) & 1 == 1
        return pd.Series(found)

    return rows.withColumn("_again", maybe_repeated(_hash64(F.col("text_sha256"), 0), _hash64(F.col("text_sha256"), 1)))


def _digests(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return stored(renamed(docs, [doc_id, text]).select(
        F.col("c0").alias("doc_id"), F.sha2(normalised(F.col("c1")), 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row")), "digests")  # stored, so a row's number stays its own


def _groups(again: DataFrame) -> DataFrame:
    """Smallest doc_id, size and first row (of the smallest doc_id, none before
    null) of each text among the possibly repeated rows; stored, so that joins with it read plain shuffles on both sides, which
    adaptive execution splits when one text holds many rows."""
    return stored(again.groupBy(F.col("text_sha256").alias("_sha"))
                  .agg(F.min("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_size"),
                       F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("_first"))
                  .select("_sha", "_keep", "_size", F.col("_first.row").alias("_row")), "groups")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each white-space run became one
    space; a null text is empty.  One row of a group stays: the one with the
    smallest doc_id (a null doc_id only if no other is there), of rows repeated
    with that doc_id any one.  Columns beside doc_id and text are ignored,
    whatever their names; an empty table gives none."""
    rows = _digests(docs, doc_id, text)
    tested = stored(_tested(rows, *repeated_filter(rows, "text_sha256")), "tested")
    single = tested.filter("not _again").select("doc_id", F.col("doc_id").alias("keep_id"),
                                                F.lit(1).cast("long").alias("group_size"),
                                                F.lit(True).alias("kept"), "text_sha256")
    again = tested.filter("_again").select("doc_id", "text_sha256", "row")
    many = again.join(_groups(again), F.col("text_sha256") == F.col("_sha")).select(
        "doc_id", F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        (F.col("row") == F.col("_row")).alias("kept"), "text_sha256")
    return single.unionByName(many)


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each group of equal texts, all columns kept: rows
    that the filter clears pass straight through with their texts; only the
    possibly repeated ones are shuffled.  Rows repeated with one doc_id and
    text are reduced to one (any of them).  An empty table stays empty."""
    digests = _digests(docs, doc_id, text)
    words, bits = repeated_filter(digests, "text_sha256")
    full = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{doc_id}`").alias("id"), F.sha2(normalised(F.col(f"`{text}`")), 256).alias("text_sha256"))
    tested = _tested(full, words, bits)
    groups = _groups(_tested(digests, words, bits).filter("_again"))
    many = (tested.filter("_again")
            .join(groups, (F.col("text_sha256") == F.col("_sha")) & F.col("id").eqNullSafe(F.col("_keep")))
            .dropDuplicates(["text_sha256"]))
    return tested.filter("not _again").select("row").unionByName(many.select("row")).select("row.*")
