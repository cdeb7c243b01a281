"""Forward fill along one order of all rows, as a two-level scan.

Features and requests travel together through one range exchange on (key,
time): every task holds a stretch of the whole order, so a key is cut wherever
its rows are many, also inside one instant.  Level one walks each task's
stretch and answers its requests with the last feature before them.  Level
two walks the tasks: what a stretch ends with (one row a task) is carried into
the stretches that begin with the same key.  No feature or request is sent twice,
and a task keeps one feature, whatever the length of a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.session import stored

FEATURE, REQUEST, END = 0, 1, 2  # kinds of rows; END: what a stretch ends with


def last_before(features: DataFrame, requests: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every request with the last feature at or before it.

    `features` has columns k, t, tie, v; `requests` k, t, r.  The result has k,
    t, r, and v and vt, the value and time of the last feature of the key with
    vt <= t (of features tied on time the one of smallest `tie`, nulls
    first), null if there is none.  Null keys and times meet nothing."""
    kinds = {"tie": features.schema["tie"].dataType, "v": features.schema["v"].dataType, "r": requests.schema["r"].dataType}

    def row(df: DataFrame, kind: int) -> DataFrame:
        held = [F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in ("tie", "v", "r")]
        # the number tells identical requests apart, so that many of them are cut too
        return df.select("k", "t", F.lit(kind).alias("kind"), *held, F.monotonically_increasing_id().alias("n"))

    both = row(features.filter(F.col("k").isNotNull() & F.col("t").isNotNull()), FEATURE).unionByName(row(requests, REQUEST))
    order = [F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first(), F.col("kind").asc(), F.col("tie").desc_nulls_last(),
             F.col("n").asc()]
    dealt = both.repartitionByRange(partitions, *order) if partitions else both.repartitionByRange(*order)
    ordered = dealt.sortWithinPartitions(*order).select("k", "t", "kind", "v", "r")
    scanned = stored(ordered.mapInArrow(_scan(), _scanned_schema(ordered)), "asof")
    carried = _carried(scanned.filter(F.col("kind") == END).select("task", "first", "k", "v", "vt").toArrow(), scanned)
    asked = scanned.filter(F.col("kind") == REQUEST)
    # one row a task at most: the size of the broadcast is bounded by the number of partitions
    answered = asked.join(F.broadcast(carried), F.col("open") & (F.col("task") == F.col("_task")), "left")
    return answered.select("k", "t", "r", F.when(F.col("vt").isNotNull(), F.col("v")).otherwise(F.col("_v")).alias("v"),
                           F.coalesce("vt", "_vt").alias("vt"))


def _scanned_schema(ordered: DataFrame) -> T.StructType:
    """Requests with their answers so far, and a row for the end of each
    stretch: first is its first key; open tells a request before the first
    feature of a stretch's first key, which may be answered by earlier tasks."""
    fields = {f.name: f.dataType for f in ordered.schema}
    return (T.StructType().add("kind", "integer").add("task", "integer").add("first", fields["k"]).add("k", fields["k"])
            .add("t", fields["t"]).add("r", fields["r"]).add("v", fields["v"]).add("vt", fields["t"]).add("open", "boolean"))


def _scan():
    """The walk along one stretch, batch by batch."""
    feature, request, end = FEATURE, REQUEST, END
    names = ["kind", "task", "first", "k", "t", "r", "v", "vt", "open"]

    def differs(column: pa.Array) -> np.ndarray:
        """For each value whether it differs from the one before (false for the first)."""
        out = np.zeros(len(column), bool)
        if len(column) > 1:
            one, two = column.slice(0, len(column) - 1), column.slice(1)
            both = pc.fill_null(pc.equal(one, two), False).to_numpy(zero_copy_only=False)
            none = pc.and_(pc.is_null(one), pc.is_null(two)).to_numpy(zero_copy_only=False)
            out[1:] = ~(both | none)
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, held, first, only_first = TaskContext.get().partitionId(), None, None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.column(0).slice(0, 1) if first is None else first
            # before the batch's own rows: the last row and the feature held for its key (maybe none)
            before = [x for x in (held, last) if x is not None]
            rows = pa.Table.from_batches([*before, batch]).combine_chunks().to_batches()[0] if before else batch
            kind = rows.column(2).to_numpy()
            at = np.arange(rows.num_rows)
            new = differs(rows.column(0))
            start = np.maximum.accumulate(np.where(new, at, 0))
            filled = np.maximum.accumulate(np.where(kind == feature, at, -1))
            has = (filled >= start) & (filled >= 0)
            in_first = only_first & (np.cumsum(new) == 0)
            wanted = np.flatnonzero((kind == request) & (at >= len(before)))
            asked = rows.take(pa.array(wanted))
            source = pa.array(filled[wanted], mask=~has[wanted])
            n = len(wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, request, np.int32)), pa.array(np.full(n, task, np.int32)), pa.nulls(n, first.type),
                 asked.column(0), asked.column(1), asked.column(4), rows.column(3).take(source), rows.column(1).take(source),
                 pa.array(in_first[wanted] & ~has[wanted])], names)
            only_first = bool(in_first[-1])
            held = rows.slice(int(filled[-1]), 1) if has[-1] else None
            last = rows.slice(rows.num_rows - 1, 1) if not has[-1] or filled[-1] != rows.num_rows - 1 else None
        if first is not None:
            key = (last or held).column(0)
            value, time = (held.column(3), held.column(1)) if held is not None else (None, None)
            kinds = [batch.schema.field(i).type for i in (1, 4, 3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([end], pa.int32()), pa.array([task], pa.int32()), first, key, pa.nulls(1, kinds[0]), pa.nulls(1, kinds[1]),
                 pa.nulls(1, kinds[2]) if value is None else value, pa.nulls(1, kinds[0]) if time is None else time,
                 pa.array([False])], names)

    return scan


def _carried(ends: pa.Table, scanned: DataFrame) -> DataFrame:
    """(_task, _v, _vt): for each stretch the last feature that earlier
    stretches hold of its first key.  `ends` has one row a task."""
    out, held = [], None
    rows = ends.combine_chunks()
    for i in np.argsort(rows["task"].to_numpy()) if len(rows) else []:
        first, key = rows["first"][i].as_py(), rows["k"][i].as_py()
        if held is not None and first == held[0]:
            out.append((rows["task"][i].as_py(), held[1]))
        if rows["vt"][i].is_valid:
            held = (key, int(i))
        elif held is not None and key != held[0]:
            held = None
    fields = T.StructType().add("_task", "integer").add("_v", scanned.schema["v"].dataType).add("_vt", scanned.schema["vt"].dataType)
    taken = rows.take(pa.array([i for _, i in out], pa.int64()))
    table = pa.table({"_task": pa.array([t for t, _ in out], pa.int32()), "_v": taken["v"], "_vt": taken["vt"]})
    return scanned.sparkSession.createDataFrame(table, fields)
