"""Near duplicates by MinHash, joined over an inverted list of signature coordinates.

A document is its set of word shingles; its signature has COORDINATES minima of
the set under as many hash functions.  Two sets of similarity s agree in each
coordinate with probability s, so pairs that agree in MATCHES coordinates or
more are candidates, and candidates are confirmed on their full sets.  (With 64
coordinates and 34 matches a pair of similarity 0.8 is missed with probability
3e-7, one of 0.85 with 3e-10.)

Every document is posted under its (coordinate, value) pairs, and collisions
are counted over these lists with two savings:

* Prefix: only values that two classes or more share can collide.  A class with
  fewer than MATCHES of them has no partner.  Of the others' m shared values,
  from rarest to most frequent, two partners have one of the first
  m - MATCHES + 1 in common; only these lists are merged.
* Skip: the values after the prefix, those with the longest lists, are never
  merged.  What two classes share of them is counted on their signatures, by one
  byte of each coordinate kept beside the posting: equal values have equal
  bytes, so no pair is lost.

Documents with equal sets are one class, posted once.  A list is not expanded
into all its pairs: first every class meets the lists' hubs (the member whose
values most others share, the centre of a group and the same for most of its
lists), and only the members of lists that this leaves in different components
meet each other.  These are compared by sketches first: a sketch holds, for
each of SKETCH_BITS cells, whether an odd number of the set's shingles fall into
it, so two sets differ in as many shingles at least as their sketches in cells,
and no pair that is similar enough is lost.  Components are
exact for what the signatures find; pairs inside a component may stay
unconfirmed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import begin, id_filter, ship_package, spent, step_done, stored
from moodlake.llm.jaccard_join import components, shingles

WORDS = 2
PERCENT = 80
COORDINATES = 64  # the bits of a long
MATCHES = 34
TOKEN_BITS = 48  # of the hash of a coordinate and its value
CHUNK = 2048  # shingles hashed at once
BITS_PER_SET = 64  # of the filter of rows whose sets are made again: what it lets through in vain is sent
SEND_BYTES = 1 << 23  # of sets that a task holds before it sends them
PLANES = 6  # bits of each coordinate that are kept beside a posting
SKETCH_BITS = 512
MARKS = [f"m{i}" for i in range(PLANES)]
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]

FACTORS = np.array([xxhash.xxh3_64_intdigest(b"factor", i) | 1 for i in range(COORDINATES)], np.uint64)
PLACES = np.array([xxhash.xxh3_64_intdigest(b"coordinate", i) for i in range(COORDINATES)], np.uint64)


def signature(own: np.ndarray) -> np.ndarray:
    """One number of TOKEN_BITS for each coordinate: the hash of its place and its minimum over the set."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), CHUNK):
        least = np.minimum(least, (own[at:at + CHUNK, None] * FACTORS).min(axis=0))
    least = (least ^ PLACES) * np.uint64(0x9E3779B97F4A7C15)
    least = (least ^ (least >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return least >> np.uint64(64 - TOKEN_BITS)


def _packed(bits: np.ndarray) -> np.ndarray:
    """0s and 1s, 64 to a long."""
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def marks(tokens: np.ndarray) -> np.ndarray:
    """PLANES longs: the i-th has the i-th bit of every coordinate."""
    return np.concatenate([_packed(tokens >> np.uint64(i) & np.uint64(1)) for i in range(PLANES)])


def sketch(own: np.ndarray) -> np.ndarray:
    """The cells into which an odd number of shingles fall."""
    return _packed(np.bincount((own >> np.uint64(20) & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1)


def set_key(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set from all others."""
    whole = xxhash.xxh3_128_intdigest(own.tobytes())
    return (whole >> 64) - 2**63, (whole & (2**64 - 1)) - 2**63


def _bodies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))


def _signed(bodies: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, the 128-bit key of the set (null if empty), its tokens, and marks and sketch."""
    schema = T.StructType([T.StructField("doc_id", bodies.schema["doc_id"].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                           T.StructField("tokens", T.ArrayType(T.LongType())), T.StructField("beside", T.ArrayType(T.LongType()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("minhash signatures")
        for batch in batches:
            sizes, high, low, tokens, beside = [], [], [], [], []
            for body in batch.column(1):
                own = shingles(body.as_py(), words)
                one, two = set_key(own) if len(own) else (None, None)
                found = signature(own) if len(own) else None
                sizes.append(len(own))
                high.append(one)
                low.append(two)
                tokens.append(None if found is None else found.astype(np.int64))
                beside.append(None if found is None else np.concatenate([marks(found), sketch(own)]))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(tokens, longs), pa.array(beside, longs)], schema.names)

    return stored(bodies.mapInArrow(sign, schema), "signed")


def _classes(signed: DataFrame) -> DataFrame:
    """One row for each set: id, k1, k2, root (its smallest doc_id), size, tokens, marks and sketch."""
    one = signed.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("root"), F.first("n_shingles").alias("size"), F.first("tokens").alias("tokens"),
        F.first("beside").alias("beside"))
    return stored(one.select(F.monotonically_increasing_id().alias("id"), "k1", "k2", "root", "size", "tokens",
                             *[F.col("beside")[i].alias(m) for i, m in enumerate(MARKS + SKETCH)]), "classes")


def _prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """Of each class that can have a partner (prefix, id, size, marks): the tokens
    it is posted under, rarest first; and its rank: the less, the more its
    values are those of many others."""
    posted = classes.select("id", F.explode("tokens").alias("token"))
    lists = stored(posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "lists")
    met = posted.join(lists.withColumnRenamed("token", "_token"), F.col("token") == F.col("_token"))
    rare = (met.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("met"))
            .filter(F.size("met") >= matches)
            .select(F.col("id").alias("_id"), F.slice("met", 1, F.size("met") - matches + 1)["token"].alias("prefix"),
                    (-F.aggregate("met", F.lit(0.0), lambda sum_, x: sum_ + F.log2(x["n"]))).alias("rank")))
    out = stored(rare.join(classes.select("id", "size", *MARKS), F.col("_id") == F.col("id"))
                 .select("prefix", "rank", "id", "size", *MARKS), "prefixes")
    step_done(classes.sparkSession, lists)
    return out


def _matches(one: list[Column], two: list[Column]) -> Column:
    """Coordinates of which no kept bit differs."""
    differ = one[0].bitwiseXOR(two[0])
    for a, b in zip(one[1:], two[1:]):
        differ = differ.bitwiseOR(a.bitwiseXOR(b))
    return COORDINATES - F.bit_count(differ)


def _near_enough(percent: int) -> Column:
    """Whether the sketches differ in no more cells than similar sets of these sizes can in shingles."""
    cells = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_2"))) for c in SKETCH), start=F.lit(0))
    return (100 + percent) * cells <= (100 - percent) * (F.col("size") + F.col("size_2"))


def _alike(percent: int, matches: int) -> Column:
    """Whether sizes and signatures of two postings, the second's columns ending in _2, let them be partners."""
    small, large = F.least("size", "size_2"), F.greatest("size", "size_2")
    return (100 * small >= percent * large) & (_matches([F.col(m) for m in MARKS], [F.col(f"{m}_2") for m in MARKS]) >= matches)


def _other(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{c}_2") for c in df.columns])


def _sets(asked: DataFrame, classes: DataFrame, bodies: DataFrame, words: int) -> DataFrame:
    """(id, own): the sets of the asked classes, made again from the texts of the rows with their smallest doc_ids."""
    reps = stored(asked.join(classes.select("id", "k1", "k2", "root"), "id"), "asked")
    nameless = bool(reps.filter("root is null").limit(1).count())
    maybe = id_filter(reps, "root", BITS_PER_SET)
    wanted = F.col("doc_id").isNotNull() & maybe("doc_id")
    schema = "_k1 long, _k2 long, own array<long>"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("minhash sets")
        sent: set[tuple[int, int]] = set()  # classes met in rows without doc_id, of which there may be many copies
        for batch in batches:
            keys, sets, size = [], [], 0
            for doc, body in zip(batch.column(0), batch.column(1)):
                own = shingles(body.as_py(), words)
                if not len(own):
                    continue
                key = set_key(own)
                if not doc.is_valid:
                    if key in sent:
                        continue
                    sent.add(key)
                keys.append(key)
                sets.append(own.view(np.int64))
                size += own.nbytes
                if size > SEND_BYTES:
                    yield _set_batch(keys, sets)
                    keys, sets, size = [], [], 0
            if keys:
                yield _set_batch(keys, sets)

    made = bodies.filter(wanted | F.col("doc_id").isNull() if nameless else wanted).mapInArrow(make, schema)
    # a doc_id may stand on several rows; the set must be that of the class
    same = (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2"))
    out = stored(made.join(reps, same).dropDuplicates(["k1", "k2"]).select("id", "own"), "sets")
    spent(reps)
    return out


def _set_batch(keys: list[tuple[int, int]], sets: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets), pa.int64()))], ["_k1", "_k2", "own"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the candidate pairs (a, b) those whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("own").alias("own_a"))
    two = sets.select(F.col("id").alias("b"), F.col("own").alias("own_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("own_a", "own_b"))
    return stored(both.filter(100 * shared >= percent * (F.size("own_a") + F.size("own_b") - shared)).select("a", "b"), "links")


def _sketched(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of classes those whose sketches allow the similarity."""
    one = classes.select(F.col("id").alias("a"), "size", *SKETCH)
    two = _other(classes.select("size", *SKETCH, F.col("id").alias("b"))).withColumnRenamed("b_2", "b")
    return pairs.join(one, "a").join(two, "b").filter(_near_enough(percent)).select("a", "b")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def _labelled(links: DataFrame) -> DataFrame:
    """(_id, component) of the classes that have a link."""
    return components(links).select(F.col("key").alias("_id"), "component")


def _components(prefixes: DataFrame, classes: DataFrame, bodies: DataFrame, words: int, percent: int, matches: int) -> DataFrame:
    """(_id, component) of every class that has a link."""
    postings = F.struct("rank", "id", "size", *MARKS)
    posted = prefixes.select(F.explode("prefix").alias("token"), "rank", "id", "size", *MARKS)
    hubs = (posted.groupBy(F.col("token").alias("_token")).agg(F.min(postings).alias("hub"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select("_token", "hub.*"))
    hubs = stored(hubs.select("_token", *[F.col(c).alias(f"{c}_2") for c in ("id", "size", *MARKS)]), "hubs")
    # each class and its lists' hubs
    near = stored(posted.join(hubs, (F.col("token") == F.col("_token")) & (F.col("id") != F.col("id_2")) & _alike(percent, matches))
                  .select(F.least("id", "id_2").alias("a"), F.greatest("id", "id_2").alias("b")).distinct(), "near")
    near, all_near = stored(_sketched(near, classes, percent), "near"), near
    step_done(classes.sparkSession, hubs, all_near)
    sets = _sets(_ids(near), classes, bodies, words)
    step_done(classes.sparkSession)
    links = _confirmed(near, sets, percent)
    step_done(classes.sparkSession)
    labels = _labelled(links)
    # lists whose members are still in different components: these meet each other
    sketched = classes.select(F.col("id").alias("_sketched"), *SKETCH)
    placed = stored(prefixes.join(labels, F.col("id") == F.col("_id"), "left").join(sketched, F.col("id") == F.col("_sketched"))
                    .select("prefix", "id", "size", *MARKS, *SKETCH, F.coalesce("component", "id").alias("component")), "placed")
    mixed = stored(placed.select(F.explode("prefix").alias("_token"), "component").groupBy("_token")
                   .agg(F.min("component").alias("low"), F.max("component").alias("high"))
                   .filter("low < high").select("_token"), "mixed")
    # ids alone meet these lists; what belongs to them is fetched by id
    opened = (placed.select(F.explode("prefix").alias("token"), F.col("id").alias("_open"))
              .join(mixed, F.col("token") == F.col("_token"), "left_semi").groupBy("_open").agg(F.collect_list("token").alias("open")))
    rated = stored(placed.join(opened, F.col("id") == F.col("_open")).drop("_open"), "open")
    spent(placed, mixed)
    # both sides of the join are one exchange: columns are renamed after it
    columns = ["token", "prefix", "id", "size", "component", *MARKS, *SKETCH]
    met = rated.withColumn("token", F.explode("open")).select(*columns)
    both = met.alias("one").join(met.alias("two"), F.col("one.token") == F.col("two.token")).select(
        *[F.col(f"one.{c}").alias(c) for c in columns], *[F.col(f"two.{c}").alias(f"{c}_2") for c in columns])
    # a pair is made once, at the first token that both prefixes have
    first = F.element_at(F.array_intersect("prefix", "prefix_2"), 1) == F.col("token")
    across = both.filter((F.col("id") < F.col("id_2")) & (F.col("component") != F.col("component_2")) & _near_enough(percent)
                         & _alike(percent, matches) & first).select(F.col("id").alias("a"), F.col("id_2").alias("b"))
    across = stored(across.join(near, ["a", "b"], "left_anti"), "across")
    step_done(classes.sparkSession, rated)
    if across.limit(1).count():
        fresh = _ids(across).join(sets.select("id"), "id", "left_anti")
        asked = sets.join(_ids(across), "id", "left_semi").unionByName(_sets(fresh, classes, bodies, words))
        more = _confirmed(across, asked, percent)
        if more.limit(1).count():
            labels = _labelled(links.unionByName(more))
    step_done(classes.sparkSession, sets, near, across)
    return labels


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT,
                matches: int = MATCHES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links), kept (doc_id is component_id) and class_id (the
    smallest doc_id of the same set).

    Words are what stands between white space, A-Z in lower case; whole texts
    count.  A null or empty text, or one without words, has no shingle and no
    link, and is kept.  Rows repeated with one doc_id have their own sets; a
    null doc_id is linked but never a smallest one unless no other is there.
    Other columns are left out, whatever their names; an empty table gives none."""
    ship_package(docs.sparkSession)
    bodies = _bodies(docs, doc_id, text)
    signed = _signed(bodies, words)
    members = stored(signed.select("doc_id", "n_shingles", "k1", "k2"), "members")
    classes = _classes(signed)
    step_done(docs.sparkSession, signed)
    prefixes = _prefixes(classes, matches)
    labels = _components(prefixes, classes, bodies, words, percent, matches)
    labels = stored(classes.select("id", "k1", "k2", "root").join(labels, F.col("id") == F.col("_id"), "left")
                    .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "root", "component"), "labels")
    roots = stored(labels.filter("component is not null").groupBy(F.col("component").alias("_component"))
                   .agg(F.min("root").alias("least")), "roots")
    ends = stored(labels.join(roots, F.col("component") == F.col("_component"), "left")
                  .select("_k1", "_k2", "root", F.coalesce("least", "root").alias("least")), "ends")
    spent(prefixes, labels, roots, classes)
    out = members.join(ends, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    component = F.coalesce("least", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
                      F.coalesce("root", "doc_id").alias("class_id"))
