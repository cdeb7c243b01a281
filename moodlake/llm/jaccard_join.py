"""Near duplicates by an n-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of word shingles, as 64-bit hashes.  All sets are put in
one order, estimated rarest shingles first.  If two sets are similar enough,
their first n - ceil(t n) + l shingles share at least l, for any l.  Each
document picks its own l by estimated cost: a longer prefix sends more
shingles, but candidates must then share l of them before they are verified.
A pair must share the smaller of its two numbers.  (Wang, Li and Feng, "Can
we beat the prefix filtering?", 2012.)

Documents with equal sets are one class and joined once.  Groups of near
copies are never expanded into all pairs: first each shingle's hub, the class
of which the least is its own, is compared with the shingle's other classes;
only classes that this leaves in different components are then counted and
compared pair by pair.  Components therefore are exact, while pairs inside a
component may be left uncompared; near_links() compares those too.  Shingles of a prefix that no other prefix
has bound what a class can share; a pair is left out where that is too few.
Shingle and class hashes have 64 bits; equal hashes count as equal shingles
and classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import begin, give_back, id_filter, ship_package, shuffle_partitions, spent, step_done, stored

WORDS = 5
PERCENT = 80
CELLS = 1 << 21  # of the table of estimated document counts; its size is fixed, its counts cover all documents
SEGMENTS = 64
MOST_SHARED = 4  # the largest l
ENTRIES_PER_BUCKET = 1 << 20
HOT_COUNT = 100_000  # a shingle with more documents, as estimated, is dealt over several buckets
SEND_AT = 1 << 19  # entries a task gathers before it sends them
SEND_BYTES = 1 << 23  # of sets that a task holds before it sends them
BITS_PER_SET = 64  # of the filter of rows whose sets are made again: what it lets through in vain is sent
SKETCH_BITS = 512
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]

ENTRY = np.dtype([("token", "<i8"), ("key", "<i8"), ("size", "<i4"), ("last", "<i4"), ("least", "i1")])


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the word shingles of a text; all words as
    one shingle if there are fewer; none without words."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    total = np.full(len(found) - width + 1, width, np.uint64)
    for i in range(width):
        factor = np.uint64(xxhash.xxh3_64_intdigest(b"place", i) | 1)
        total += hashed[i:len(found) - width + 1 + i] * factor
    total ^= total >> np.uint64(32)
    total *= np.uint64(0x9E3779B97F4A7C15)
    total ^= total >> np.uint64(29)
    return np.unique(total)


def class_key(own: np.ndarray) -> int | None:
    """The key of the class of a set; an empty set is of no class."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - 2**63 if len(own) else None


def sketch(own: np.ndarray) -> np.ndarray:
    """For each of SKETCH_BITS cells whether an odd number of shingles fall into
    it, 64 to a long: two sets differ in as many shingles at least as their
    sketches in cells."""
    cells = (own >> np.uint64(12) & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=SKETCH_BITS) & 1).astype(np.uint8), bitorder="little").view(np.int64)


def least_overlap(size: int, percent: int) -> int:
    """Shingles that a set of this size shares at least with any set similar to it."""
    return -(-percent * size // 100)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) & (CELLS - 1)


def _bodies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))


def _signatures(bodies: DataFrame, words: int) -> DataFrame:
    """For each document doc_id, n_shingles, the key of its class and the sketch
    of its set; and, as rows with a segment, the task's document counts of the
    segment's cells."""
    kind = bodies.schema["doc_id"].dataType
    schema = (T.StructType().add("doc_id", kind).add("n_shingles", "long").add("key", "long").add("sketch", T.ArrayType(T.LongType()))
              .add("segment", "integer").add("counts", "binary"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard signatures")
        counts, held, size, arrow = np.zeros(CELLS, np.uint32), [], 0, None
        for batch in batches:
            arrow = batch.schema.field("doc_id").type
            sizes, keys, sketches = [], [], []
            for body in batch.column(1):
                own = shingles(body.as_py(), words)
                sizes.append(len(own))
                keys.append(class_key(own))
                sketches.append(sketch(own) if len(own) else None)
                held.append(_cells(own))
                size += len(own)
                if size > SEND_AT:
                    counts += np.bincount(np.concatenate(held), minlength=CELLS).astype(np.uint32)
                    held, size = [], 0
            none = pa.nulls(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                                              pa.array(sketches, pa.list_(pa.int64())), none.cast(pa.int32()),
                                              none.cast(pa.binary())], schema.names)
        if held:
            counts += np.bincount(np.concatenate(held), minlength=CELLS).astype(np.uint32)
        if arrow is not None:
            parts = [zstandard.compress(p.tobytes()) for p in np.split(counts, SEGMENTS)]
            none = pa.nulls(SEGMENTS)
            yield pa.RecordBatch.from_arrays([none.cast(arrow), none.cast(pa.int64()), none.cast(pa.int64()),
                                              none.cast(pa.list_(pa.int64())), pa.array(range(SEGMENTS), pa.int32()), pa.array(parts, pa.binary())], schema.names)
        held = []
        give_back()

    return stored(bodies.mapInArrow(sign, schema), "signatures")


def _document_counts(signatures: DataFrame) -> np.ndarray:
    """The estimated document counts of all cells: summed by segment on Spark;
    the driver gets the CELLS numbers."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(zstandard.decompress(counts.as_py()), np.uint32).astype(np.uint64)
                totals[segment] = totals[segment] + own if segment in totals else own
        parts = [np.minimum(t, 2**31 - 1).astype(np.uint32).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(parts, pa.binary())],
                                         ["segment", "counts"])

    sums = (signatures.filter("segment is not null").select("segment", "counts").repartition(SEGMENTS, "segment")
            .mapInArrow(add, "segment int, counts binary").toArrow())
    table = np.zeros((SEGMENTS, CELLS // SEGMENTS), np.uint32)
    for segment, counts in zip(sums["segment"].to_pylist(), sums["counts"].to_pylist()):
        table[segment] = np.frombuffer(counts, np.uint32)
    return table.reshape(-1)


def prefix(own: np.ndarray, counts: np.ndarray, usual: float, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The prefix of a set, the estimated counts of its shingles, and the
    number of shared prefix shingles that it asks of a candidate."""
    estimate = counts[_cells(own)]
    base = len(own) - least_overlap(len(own), percent)
    longest = min(MOST_SHARED, len(own) - base)
    order = np.lexsort((own, estimate))[:base + longest]
    own, estimate = own[order], estimate[order]
    others = np.maximum(estimate - usual - 1, 0)
    # sending a shingle costs 1; a candidate, which shares l of them, costs a comparison of two sets
    lists = np.cumsum(others)
    wanted = np.arange(1, longest + 1)
    cost = base + wanted + lists[base:base + longest] / wanted * (len(own) / 8 + 1)
    least = int(np.argmin(cost)) + 1
    return own[:base + least], estimate[:base + least], least


def _entries(bodies: DataFrame, counts: np.ndarray, buckets: int, words: int, percent: int) -> DataFrame:
    """Rows (bucket, entries): the prefix shingles of all classes, packed by
    bucket; a task sends those of a class once, however many copies it reads."""
    shared = bodies.sparkSession.sparkContext.broadcast(counts)
    usual = 2 * float(counts.mean())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard entries")
        table, held, size = shared.value, [], 0
        sent: set[int] = set()

        def packed() -> Iterator[pa.RecordBatch]:
            own = np.concatenate([h for h, _ in held])
            place = np.concatenate([b for _, b in held])
            order = np.argsort(place, kind="stable")
            place, own = place[order], own[order]
            cuts = np.flatnonzero(np.diff(place)) + 1
            data = [part.tobytes() for part in np.split(own, cuts)]
            yield pa.RecordBatch.from_arrays([pa.array(place[np.concatenate([[0], cuts])], pa.int32()),
                                              pa.array(data, pa.binary())], ["bucket", "entries"])

        for batch in batches:
            for body in batch.column(1):
                all_own = shingles(body.as_py(), words)
                key = class_key(all_own)
                if key is None or key in sent:
                    continue
                sent.add(key)
                own, estimate, least = prefix(all_own, table, usual, percent)
                rows = np.empty(len(own), ENTRY)
                rows["token"], rows["key"], rows["size"], rows["least"] = own.view(np.int64), key, len(all_own), least
                rows["last"] = min(int(estimate[-1]), 2**31 - 1)
                salts = 1 + (np.maximum(estimate - usual, 0) // HOT_COUNT).astype(np.uint64)
                held.append((rows, ((own + np.uint64(key % 2**64) % salts) % np.uint64(buckets)).astype(np.int64)))
                size += len(own)
                if size > SEND_AT:
                    yield from packed()
                    held, size = [], 0
        if held:
            yield from packed()
        held = []
        give_back()

    return bodies.mapInArrow(send, "bucket int, entries binary")


def _meetings(entries: DataFrame, counts: np.ndarray, buckets: int) -> DataFrame:
    """The shingles that two classes or more have in their prefixes: rows
    (token, key, size, least, last), the last being the estimated count of
    the last shingle of the prefix."""
    shared = entries.sparkSession.sparkContext.broadcast(counts)
    usual = 2 * float(counts.mean())
    names = ["token", "key", "size", "least", "last"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard meetings")
        at, held, size, most = None, [], 0, ENTRIES_PER_BUCKET

        def merged() -> np.ndarray:
            own = np.concatenate(held)
            own = own[np.lexsort((own["key"], own["token"]))]
            new = np.concatenate([[True], (own["token"][1:] != own["token"][:-1]) | (own["key"][1:] != own["key"][:-1])])
            return own[new]  # copies of a class are one

        def met() -> Iterator[pa.RecordBatch]:
            own = merged()
            first = np.concatenate([[True], own["token"][1:] != own["token"][:-1]])
            starts = np.flatnonzero(first)
            sizes = np.diff(np.concatenate([starts, [len(own)]]))
            split = shared.value[_cells(own["token"][starts].view(np.uint64))] - usual >= HOT_COUNT
            rows = own[np.repeat((sizes > 1) | split, sizes)]
            for piece in range(0, len(rows), 100_000):
                part = slice(piece, piece + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in
                      (rows["token"][part], rows["key"][part], rows["size"][part], rows["least"][part].astype(np.int32),
                      rows["last"][part])], names)

        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != at and held:
                    yield from met()
                    held, size, most = [], 0, ENTRIES_PER_BUCKET
                at = bucket
                held.append(np.frombuffer(data.as_py(), ENTRY))
                size += len(held[-1])
                if size > most:
                    held = [merged()]
                    size = len(held[0])
                    most = max(ENTRIES_PER_BUCKET, 2 * size)
        if held:
            yield from met()

    return stored(entries.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        meet, "token long, key long, size int, least int, last int"), "meetings")


def _rated(meetings: DataFrame, percent: int) -> DataFrame:
    """The meetings with `reach`, the shingles of a class without those of its
    prefix that no other class has in its prefix."""
    met = F.count(F.lit(1)).over(W.partitionBy("key"))
    prefix_size = F.expr(f"size - (size * {percent}L + 99) div 100 + least")
    return meetings.withColumn("reach", F.col("size") - (prefix_size - met))


def _possible(percent: int, other: str) -> Column:
    """Whether the sizes of two sets and what they can share at most allow the
    similarity; the other set's columns end in `other`.

    Of two prefixes take the one that ends earlier in the order of shingles:
    what the sets share of it lies in the other prefix too, so its set shares
    its reach at most.  Which one that is, the last counts tell unless equal."""
    needed = F.expr(f"(({percent}L * (size + size{other})) + {100 + percent - 1}) div {100 + percent}")
    most = (F.when(F.col("last") < F.col(f"last{other}"), F.col("reach"))
            .when(F.col("last") > F.col(f"last{other}"), F.col(f"reach{other}")).otherwise(F.greatest("reach", f"reach{other}")))
    return _close("size", f"size{other}", percent) & (most >= needed)


def _near_enough(percent: int) -> Column:
    """Whether the sketches differ in no more cells than similar sets of these sizes can in shingles."""
    cells = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_2"))) for c in SKETCH), start=F.lit(0))
    return (100 + percent) * cells <= (100 - percent) * (F.col("size") + F.col("size_2"))


def _close(one: str, two: str, percent: int) -> Column:
    """Whether the sizes of two sets allow the similarity."""
    return (100 * F.least(one, two).cast("long")) >= (percent * F.greatest(one, two).cast("long"))


def _verified(pairs: DataFrame, bodies: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the candidate pairs of classes (a, b), those whose sets are similar."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("_key")).distinct()
    reps = stored(asked.join(classes, F.col("_key") == F.col("key")).select("key", "doc_id"), "asked")
    maybe = id_filter(reps, "doc_id", BITS_PER_SET)
    nameless = bool(reps.filter("doc_id is null").limit(1).count())

    def packed(keys: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), sets], ["class", "own"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard sets")
        sent: set[int] = set()  # a class goes once from a task
        for batch in batches:
            keys, found, size = [], [], 0
            for body in batch.column(1):
                own = shingles(body.as_py(), words)
                key = class_key(own)
                if key is None or key in sent:
                    continue
                sent.add(key)
                keys.append(key)
                found.append(own)
                size += own.nbytes
                if size > SEND_BYTES:
                    yield packed(keys, found)
                    keys, found, size = [], [], 0
            if keys:
                yield packed(keys, found)
        give_back()

    wanted = F.col("doc_id").isNotNull() & maybe("doc_id")
    own = bodies.filter(wanted | F.col("doc_id").isNull() if nameless else wanted).mapInArrow(sets, "class long, own array<long>")
    if nameless:  # of the rows without doc_id only those of a class that is asked for
        own = own.filter(id_filter(reps, "key")("class"))
    made = stored(own.withColumn("row", F.monotonically_increasing_id()), "sets")
    spent(reps)
    # several tasks may have made the set of a class: pairs ask for one row each, so sets move once and need not be made distinct first
    row = stored(made.groupBy("class").agg(F.min("row").alias("row")), "rows")
    numbered = (pairs.join(row.select(F.col("class").alias("a"), F.col("row").alias("row_a")), "a")
                .join(row.select(F.col("class").alias("b"), F.col("row").alias("row_b")), "b"))
    both = (numbered.join(made.select(F.col("row").alias("row_a"), F.col("own").alias("own_a")), "row_a")
            .join(made.select(F.col("row").alias("row_b"), F.col("own").alias("own_b")), "row_b"))
    shared = F.size(F.array_intersect("own_a", "own_b"))
    similar = 100 * shared >= percent * (F.size("own_a") + F.size("own_b") - shared)
    links = stored(both.filter(similar).select("a", "b").distinct(), "links")
    step_done(bodies.sparkSession, made, row)
    return links


def components(links: DataFrame) -> DataFrame:
    """key, component: the smallest key that each key of a link reaches.

    Every round, each key takes the smallest component of its neighbours and
    then that component's own; rounds are stored, and end when nothing changes."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stored(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    spare = labels
    while True:
        near = (both.join(labels, F.col("b") == F.col("key")).groupBy(F.col("a").alias("_a"))
                .agg(F.min("component").alias("near")))
        taken = stored(labels.join(near, F.col("key") == F.col("_a")).select(
            "key", "component", F.least("component", "near").alias("next")), "near")
        ahead = taken.select(F.col("key").alias("_k"), F.col("next").alias("ahead"))
        after = stored(taken.join(ahead, F.col("next") == F.col("_k"), "left").select(
            "key", F.coalesce(F.least("next", "ahead"), F.col("next")).alias("after"), "component"), "labels")
        changed = after.filter(F.col("after") < F.col("component")).limit(1).count()
        spent(taken, spare)
        labels, spare = after.select("key", F.col("after").alias("component")), after
        if not changed:
            spent(both)
            return labels


def _rated_classes(docs: DataFrame, doc_id: str, text: str, words: int,
                   percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The texts, the documents with the keys of their classes, the classes
    with their smallest doc_ids, and the rated meetings."""
    spark = docs.sparkSession
    ship_package(spark)
    bodies = _bodies(docs, doc_id, text)
    signatures = _signatures(bodies, words)
    signed = stored(signatures.filter("segment is null").select("doc_id", "n_shingles", "key"), "signed")
    classes = stored(signatures.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"))
                     .select("key", "doc_id", *[F.col("sketch")[i].alias(c) for i, c in enumerate(SKETCH)]), "classes")
    counts = _document_counts(signatures)
    spent(signatures)
    total = signed.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(shuffle_partitions(spark), -(-total * (100 - percent) // 100 // ENTRIES_PER_BUCKET))
    meetings = _meetings(_entries(bodies, counts, buckets, words, percent), counts, buckets)
    rated = stored(_rated(meetings, percent), "rated")
    step_done(spark, meetings)
    return bodies, signed, classes, rated


def _grouped(docs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, and
    the keys of its class and of its component."""
    bodies, signed, classes, rated = _rated_classes(docs, doc_id, text, words, percent)
    # a shingle's hub is the class of which the least is its own: the centre of its group, if there is one
    hubs = stored(rated.groupBy(F.col("token").alias("_token")).agg(F.min(F.struct(
        (1 - F.col("reach") / F.col("size")).alias("own"), F.col("key").alias("key_2"), F.col("size").alias("size_2"),
        F.col("reach").alias("reach_2"), F.col("least").alias("least_2"), F.col("last").alias("last_2"))).alias("hub"))
        .select("_token", "hub.*"), "hubs")
    first = stored(rated.join(hubs, (F.col("token") == F.col("_token")) & (F.col("key") != F.col("key_2"))
                              & _possible(percent, "_2"))
                   .groupBy(F.least("key", "key_2").alias("a"), F.greatest("key", "key_2").alias("b"))
                   .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("least", "least_2")).alias("least"))
                   .filter(F.col("shared") >= F.col("least")).select("a", "b"), "first")
    links = _verified(first, bodies, classes, words, percent)
    found = components(links)
    # what the first comparisons left in different components
    label = found.select(F.col("key").alias("_key"), "component")
    placed = stored(rated.join(label, F.col("key") == F.col("_key"), "left").select(
        "token", "key", "size", "least", "last", "reach", F.coalesce("component", "key").alias("component")), "placed")
    mixed = stored(placed.groupBy(F.col("token").alias("_token")).agg(F.min("component").alias("low"), F.max("component").alias("high"))
                   .filter("low < high").select("_token"), "mixed")
    sketched = classes.select(F.col("key").alias("_key"), *SKETCH)
    open_rows = stored(placed.join(mixed, F.col("token") == F.col("_token"), "left_semi").join(sketched, F.col("key") == F.col("_key"))
                       .select(*placed.columns, *SKETCH), "open")
    step_done(docs.sparkSession, placed, mixed, hubs)
    # both sides of the join are one exchange: columns are renamed after it
    met = open_rows.alias("one").join(open_rows.alias("two"), F.col("one.token") == F.col("two.token")).select(
        *[F.col(f"one.{c}").alias(c) for c in open_rows.columns], *[F.col(f"two.{c}").alias(f"{c}_2") for c in open_rows.columns])
    second = stored(met.filter((F.col("key") < F.col("key_2")) & (F.col("component") != F.col("component_2"))
                               & _near_enough(percent) & _possible(percent, "_2"))
                    .groupBy(F.col("key").alias("a"), F.col("key_2").alias("b"))
                    .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("least", "least_2")).alias("least"))
                    .filter(F.col("shared") >= F.col("least")).select("a", "b").join(first, ["a", "b"], "left_anti"), "second")
    step_done(docs.sparkSession, open_rows, rated, first)
    more = _verified(second, bodies, classes, words, percent)
    if more.limit(1).count():
        found = components(links.unionByName(more))
    roots = (found.join(classes.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"))
             .groupBy(F.col("component").alias("_component")).agg(F.min("doc_id").alias("root")))
    ends = stored(classes.join(found.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left")
                  .join(roots, F.col("component") == F.col("_component"), "left")
                  .select(F.col("key").alias("_key"), F.col("doc_id").alias("class_id"), F.coalesce("component", "key").alias("component"),
                          F.coalesce("root", "doc_id").alias("component_id")), "ends")
    return signed.join(ends, F.col("key") == F.col("_key"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"), "key", "component")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links) and class_id (the smallest doc_id of the same set).

    Words are what stands between white space, A-Z in lower case.  A null or
    empty text, or one without words, has no shingle and no link.  Rows
    repeated with one doc_id have their own sets; a null doc_id is linked but
    never a smallest one.  Other columns are left out, whatever their names;
    an empty table gives none."""
    return _grouped(docs, doc_id, text, words, percent).select("doc_id", "n_shingles", "component_id", "class_id")


def near_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
               percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links, as pairs of classes with membership: rows (a, b) of the
    similar classes a < b, and one row per document: doc_id, n_shingles, key
    (of its class; null without words) and n_links, the number of other rows
    that are similar to it, those of its own class included.

    Classes meet by shared prefix shingles, also inside a component, so a
    group of n near copies of different sets costs and gives up to n (n - 1) / 2
    pairs; copies of equal sets are never paired."""
    bodies, signed, classes, rated = _rated_classes(docs, doc_id, text, words, percent)
    other = rated.select(*[F.col(c).alias(f"{c}_2") for c in rated.columns])
    candidates = stored(rated.join(other, (F.col("token") == F.col("token_2")) & (F.col("key") < F.col("key_2")) & _possible(percent, "_2"))
                        .groupBy(F.col("key").alias("a"), F.col("key_2").alias("b"))
                        .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("least", "least_2")).alias("least"))
                        .filter(F.col("shared") >= F.col("least")).select("a", "b"), "candidates")
    pairs = _verified(candidates, bodies, classes, words, percent)
    sizes = stored(signed.filter("key is not null").groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("rows")), "sizes")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(sizes, F.col("b") == F.col("_key")).groupBy(F.col("a").alias("_a")).agg(F.sum("rows").alias("others"))
    numbers = stored(sizes.join(linked, F.col("_key") == F.col("_a"), "left").select(
        "_key", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("links")), "numbers")
    members = signed.join(numbers, F.col("key") == F.col("_key"), "left").select(
        "doc_id", "n_shingles", "key", F.coalesce("links", F.lit(0)).alias("n_links"))
    return pairs, members


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component, one of smallest doc_id (without a
    doc_id only if no row of the component has one); all columns stay.  Rows
    without words stay.  Rows are told by doc_id and class; only those that may
    have to go are shuffled."""
    placed = stored(_grouped(docs, doc_id, text, WORDS, PERCENT).filter("key is not null").select("doc_id", "key", "component"), "placed")
    keepers = stored(placed.groupBy(F.col("component").alias("_component")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")).alias("keeper"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1").select("_component", "keeper"), "keepers")
    marks = stored(placed.join(keepers, F.col("component") == F.col("_component"))
                   .groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
                   .agg(F.count(F.lit(1)).alias("rows"),
                        F.max((F.col("key") == F.col("keeper.key")) & F.col("doc_id").eqNullSafe(F.col("keeper.doc_id"))).alias("stays"))
                   .filter("not stays or rows > 1").select("_id", "_key", "stays"), "marks")
    nameless, repeated = (bool(marks.filter(c).limit(1).count()) for c in ("_id is null", "stays"))
    maybe = id_filter(marks, "_id")

    @F.pandas_udf("long")
    def key_of(bodies):
        import pandas as pd

        return pd.Series([class_key(shingles(body)) for body in bodies], dtype="Int64")

    tested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").alias("id"),
                         F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    tested = tested.withColumn("maybe", F.when(F.col("id").isNull(), F.lit(nameless)).otherwise(maybe("id")))
    asked = tested.filter("maybe").select("row", "id", key_of("body").alias("key"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    kept = tested.filter("not maybe").select("row").unionByName(asked.join(marks, same, "left_anti").select("row"))
    if repeated:
        kept = kept.unionByName(asked.join(marks.filter("stays"), same).dropDuplicates(["_id", "_key"]).select("row"))
    return kept.select("row.*")
