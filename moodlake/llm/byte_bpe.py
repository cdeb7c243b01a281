"""Byte-level BPE over a global set of distinct words.

Texts are cut into pre-tokens, which stay in place as numbers: a chunk of
documents keeps, for each document, the positions of its pre-tokens in the
chunk's list of distinct words.  The words themselves are dealt out by hash
over all chunks, so one task meets every occurrence of a word and encodes it
once; the ids go back to the chunks that asked, where documents are put
together again by position.  What is shuffled are distinct words of a chunk,
their ids, and compressed positions, never one row per occurrence; a word
that fills a third of the corpus is one entry in each chunk.

Decoding looks each id up in the token-byte table of the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import ship_package, shuffle_partitions, stored

CHUNK_BYTES = 32 << 20  # text that one chunk holds at most, but for a single longer document
DOCUMENT_ROW = 2**31 - 1  # the bucket of rows that are documents; after all word buckets
ROW_WORDS = 1 << 17  # a row of documents ends after so many words


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: base64 token, space, rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def splitter(pattern: str) -> regex.Pattern:
    """The compiled pre-token pattern, white space being Unicode's property
    (the regex module's own class holds four control characters more)."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the adjacent pair of lowest rank, leftmost
    first, until none is in the vocabulary."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return _merge_short(word, ranks) if len(word) <= 100 else _merge_long(word, ranks)


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i:i + 2]) for i in range(len(word) - 1)]
    while found := [r for r in pairs if r is not None]:
        at = pairs.index(min(found))
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs and linked parts."""
    n = len(word)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # part at i is word[i:ends[i]]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, at, end = heapq.heappop(heap)
        mid = ends[at]
        if not alive[at] or mid >= n or not alive[mid] or ends[mid] != end:
            continue
        ends[at], alive[mid] = end, False
        if end < n:
            before[end] = at
            if (r := ranks.get(word[at:ends[end]])) is not None:
                heapq.heappush(heap, (r, at, ends[end]))
        left = before[at]
        if left >= 0 and (r := ranks.get(word[left:end])) is not None:
            heapq.heappush(heap, (r, left, end))
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at:ends[at]]])
        at = ends[at]
    return out


def _packed(*arrays: np.ndarray) -> bytes:
    """Unsigned 32-bit arrays as one compressed value; each array's bytes are
    grouped by significance, which compresses small numbers well."""
    head = np.array([len(arrays), *map(len, arrays)], np.uint32).tobytes()
    body = b"".join(np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays)
    return zstandard.compress(head + body)


def _unpacked(data: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    sizes = raw[4:4 + 4 * int(raw[:4].view("<u4")[0])].view("<u4").tolist()
    at, out = 4 + 4 * len(sizes), []
    for n in sizes:
        out.append(np.ascontiguousarray(raw[at:at + 4 * n].reshape(4, n).T).reshape(-1).view("<u4"))
        at += 4 * n
    return out


def by_digits(codes: np.ndarray) -> list[np.ndarray]:
    """Numbers as their counts of binary digits, and for each count from 2 the
    numbers without their first digit: small ones are not mixed with large ones, so both compress better."""
    digits = np.frexp(codes.astype(np.float64))[1]
    return [digits, *[codes[digits == k] - (1 << k - 1) for k in range(2, int(digits.max(initial=0)) + 1)]]


def from_digits(digits: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    codes = digits.astype(np.int64)
    for k, own in enumerate(rest, 2):
        codes[digits == k] = own.astype(np.int64) + (1 << k - 1)
    return codes


def gather(starts: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The runs flat[starts[i] : starts[i] + lengths[i]], one after another."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def _chunk_rows(chunk: int, ids: list, codes: list[np.ndarray], words: dict[str, int], buckets: int) -> Iterator[tuple]:
    """A chunk's rows (chunk, bucket, doc_ids, places, data): its distinct words
    by bucket, then its documents, so many to a row that they compress well.
    Words are renumbered, the most frequent first, so that positions compress."""
    seen = np.zeros(len(words), np.int64)
    for c in codes:
        np.add.at(seen, c, 1) if len(c) < 1000 else np.add(seen, np.bincount(c, minlength=len(words)), out=seen)
    order = np.argsort(-seen, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    listed = list(words)
    byte_words = [listed[i].encode() for i in order.tolist()]
    bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in byte_words), np.int64, len(byte_words))
    by_bucket = np.argsort(bucket, kind="stable")
    for part in np.split(by_bucket, np.flatnonzero(np.diff(bucket[by_bucket])) + 1) if len(by_bucket) else []:
        own = [byte_words[i] for i in part.tolist()]
        data = _packed(np.array(list(map(len, own)), np.uint32))
        yield (chunk, int(bucket[part[0]]), None, _packed(np.diff(part, prepend=0)),
               len(data).to_bytes(4, "little") + data + zstandard.compress(b"".join(own)))
    first, size = 0, 0
    for last, c in enumerate(codes, 1):
        size += len(c)
        if size >= ROW_WORDS or last == len(codes):
            own = codes[first:last]
            yield (chunk, DOCUMENT_ROW, ids[first:last], None,
                   _packed(np.array(list(map(len, own)), np.uint32), *by_digits(place[np.concatenate(own)])))
            first, size = last, 0


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 500) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def split_words(docs: DataFrame, pattern: str, buckets: int, doc_id: str, text: str) -> DataFrame:
    """Chunks of documents: one row per (chunk, word bucket) and per document."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"),
                       F.spark_partition_id().alias("part"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = splitter(pattern).findall

        def chunks() -> Iterator[tuple]:
            number, size, ids, codes, words = 0, 0, [], [], {}
            part = 0
            for batch in batches:
                if batch.num_rows:
                    part = batch.column(2)[0].as_py()
                for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                    body = body.as_py()
                    if ids and size + len(body) > CHUNK_BYTES:
                        yield from _chunk_rows(part << 32 | number, ids, codes, words, buckets)
                        number, size, ids, codes, words = number + 1, 0, [], [], {}
                    found = cut(body)
                    ids.append(doc)
                    codes.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.int64, len(found)))
                    size += len(body)
            if ids:
                yield from _chunk_rows(part << 32 | number, ids, codes, words, buckets)

        schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("doc_ids", pa.list_(kind)), ("places", pa.binary()),
                            ("data", pa.binary())])
        yield from _batches(chunks(), schema)

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(rows.schema["doc_id"].dataType)
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("bucket", T.IntegerType()),
                           T.StructField("doc_ids", T.ArrayType(rows.schema["doc_id"].dataType)),
                           T.StructField("places", T.BinaryType()), T.StructField("data", T.BinaryType())])
    return rows.mapInArrow(split, schema)


def encode_words(words: DataFrame, ranks_path: str, buckets: int) -> DataFrame:
    """The word rows with their data replaced by token counts and ids; all rows
    of a bucket meet in one task, which encodes each distinct word once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, known = read_ranks(ranks_path), {}
        for batch in batches:
            out = []
            for data in batch.column(4):
                data = data.as_py()
                head = int.from_bytes(data[:4], "little")
                (lengths,) = _unpacked(data[4:4 + head])
                flat, at, counts, ids = zstandard.decompress(data[4 + head:]), 0, [], []
                for n in lengths.tolist():
                    word = flat[at:at + n]
                    at += n
                    found = known.get(word)
                    if found is None:
                        found = known[word] = np.array(encode_word(word, ranks), np.uint32).tobytes()
                    counts.append(len(found) // 4)
                    ids.append(found)
                out.append(_packed(np.array(counts, np.uint32), np.frombuffer(b"".join(ids), np.uint32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.binary())], schema=batch.schema)

    return words.repartition(buckets, "bucket").mapInArrow(encode, words.schema)


class TokenBytes:
    """The token-byte table: the bytes of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        self.lengths = np.array(list(map(len, table)), np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.starts[ids], self.lengths[ids], self.flat).tobytes()


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
           digests: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens and ids (array<int>); with
    digests instead of ids ids_sha256 (of the ids as little-endian unsigned
    32-bit integers) and decoded_sha256 (of the bytes that the ids decode to).

    A null text is empty and has no ids; whole texts are encoded, however
    long; repeated rows and null doc_ids give a row each; other columns are
    left out, whatever their names; an empty table gives none."""
    ship_package(docs.sparkSession)
    buckets = shuffle_partitions(docs.sparkSession)
    cut = stored(split_words(docs, pattern, buckets, doc_id, text), "chunks")
    encoded = encode_words(cut.filter(F.col("bucket") != DOCUMENT_ROW), ranks_path, buckets)
    together = (encoded.unionByName(cut.filter(F.col("bucket") == DOCUMENT_ROW))
                .repartition("chunk").sortWithinPartitions("chunk", "bucket"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenBytes(read_ranks(ranks_path)) if digests else None
        chunk, parts, ready = None, [], None
        for batch in batches:
            docs_out, n_out, first, second = [], [], [], []
            for at, bucket, doc_ids, places, data in zip(*(batch.column(i) for i in range(5))):
                if at.as_py() != chunk:
                    chunk, parts, ready = at.as_py(), [], None
                if bucket.as_py() != DOCUMENT_ROW:
                    parts.append((np.cumsum(_unpacked(places.as_py())[0]), *_unpacked(data.as_py())))
                    continue
                if ready is None:
                    ready, parts = _dictionary(parts), []
                starts, lengths, flat = ready
                words, *digits = _unpacked(data.as_py())
                codes = from_digits(*digits)
                ids = gather(starts[codes], lengths[codes], flat)
                ends = np.concatenate([[0], np.cumsum(lengths[codes])])[np.cumsum(words, dtype=np.int64)]
                for doc, end, start in zip(doc_ids.as_py(), ends.tolist(), [0, *ends.tolist()]):
                    own = ids[start:end]
                    docs_out.append(doc)
                    n_out.append(len(own))
                    if digests:
                        first.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                        second.append(hashlib.sha256(table.decode(own)).hexdigest())
                    else:
                        first.append(own.astype(np.int32))
            out = [pa.array(docs_out, batch.schema.field("doc_ids").type.value_type), pa.array(n_out, pa.int64())]
            if digests:
                yield pa.RecordBatch.from_arrays([*out, pa.array(first, pa.string()), pa.array(second, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([*out, pa.array(first, pa.list_(pa.int32()))],
                                                 ["doc_id", "n_tokens", "ids"])

    schema = T.StructType([T.StructField("doc_id", cut.schema["doc_ids"].dataType.elementType), T.StructField("n_tokens", T.LongType())])
    if digests:
        schema = schema.add("ids_sha256", "string").add("decoded_sha256", "string")
    else:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return together.mapInArrow(assemble, schema)


def _dictionary(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and number of the ids of each word of a chunk by its place, and all ids."""
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint32)
    places = np.concatenate([p for p, _, _ in parts])
    counts = np.concatenate([c for _, c, _ in parts]).astype(np.int64)
    lengths, starts = np.empty_like(counts), np.empty_like(counts)
    lengths[places] = counts
    starts[places] = np.cumsum(counts) - counts
    return starts, lengths, np.concatenate([i for _, _, i in parts])


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with a binary column of the bytes that their ids stand for; null ids give null."""
    ship_package(encoded.sparkSession)

    @F.pandas_udf("binary")
    def bytes_of(series):
        table = TokenBytes(read_ranks(ranks_path))
        return series.map(lambda x: None if x is None else table.decode(np.asarray(x, np.int64)))

    return encoded.withColumn(out, bytes_of(F.col(f"`{ids}`")))
