"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Items are whole numbers from 1 to the capacity, so the corpus is described by
how many pieces have each length.  The packing is planned on that histogram
alone (at most `capacity` numbers, whatever the size of the corpus) as rules
such as "these 800 pieces of length 300 go four to a bin into bins 9000 ...";
every piece then finds its bin from its length and its rank among the pieces
of that length, on Spark.

Plan: pieces above a third of the capacity fit at most twice in a bin; taken
from the longest on, each is matched with the longest partner that fits.
Smaller pieces, again from the longest, go each into the fullest bin that
still has room (best fit), and open a new bin only if none has.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import begin, give_back, kept_by_worker, ship_package, stored

CAPACITY = 4096
END_OF_DOCUMENT = 1
KEPT_WORDS = 300_000  # encoded words a Python worker remembers for speed; a full memory starts anew
TOGETHER = 4096  # words, of about one length, encoded at once
NONE = 1 << 40  # the rank of a pair without a merge
GATHERED = 4 << 20  # characters whose new words are gathered


class BinPlan:
    """Rules that place the pieces of each length, by rank, and the number of
    bins.  A rule (length, first rank, pieces, first bin, pieces a bin, offset)
    puts consecutive ranks into consecutive bins, side by side from the offset.

    Each rule moves a group of equal bins to less than half its room or splits
    one off, so there are at most about 12 times as many rules as lengths."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.bins = 0
        self.rules: list[tuple[int, int, int, int, int, int]] = []
        self._ranks = dict.fromkeys(counts, 0)
        self._groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first bin, bins)
        self._rooms: list[int] = []  # sorted keys of _groups
        large = {n: c for n, c in counts.items() if 3 * n > capacity}
        self._match(large)
        for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
            self._best_fit(length, counts[length])

    def _place(self, length: int, pieces: int, first_bin: int, per_bin: int, offset: int) -> None:
        self.rules.append((length, self._ranks[length], pieces, first_bin, per_bin, offset))
        self._ranks[length] += pieces

    def _leave(self, room: int, first_bin: int, bins: int) -> None:
        if room and bins:
            if room not in self._groups:
                self._groups[room] = []
                bisect.insort(self._rooms, room)
            self._groups[room].append((first_bin, bins))

    def _open(self, bins: int) -> int:
        self.bins += bins
        return self.bins - bins

    def _match(self, left: dict[int, int]) -> None:
        lengths = sorted(left)
        for longest in reversed(lengths):
            at = bisect.bisect_right(lengths, min(longest, self.capacity - longest)) - 1
            while left[longest]:
                while at >= 0 and left[lengths[at]] < 1 + (lengths[at] == longest):
                    at -= 1
                partner = lengths[at] if at >= 0 else None
                if partner is None:
                    bins = left[longest]
                    first = self._open(bins)
                    self._place(longest, bins, first, 1, 0)
                    self._leave(self.capacity - longest, first, bins)
                    left[longest] = 0
                elif partner == longest:
                    bins = left[longest] // 2
                    first = self._open(bins)
                    self._place(longest, 2 * bins, first, 2, 0)
                    self._leave(self.capacity - 2 * longest, first, bins)
                    left[longest] -= 2 * bins
                else:
                    bins = min(left[longest], left[partner])
                    first = self._open(bins)
                    self._place(longest, bins, first, 1, 0)
                    self._place(partner, bins, first, 1, longest)
                    self._leave(self.capacity - longest - partner, first, bins)
                    left[longest] -= bins
                    left[partner] -= bins

    def _best_fit(self, length: int, pieces: int) -> None:
        while pieces:
            at = bisect.bisect_left(self._rooms, length)
            if at == len(self._rooms):
                per_bin = self.capacity // length
                bins = -(-pieces // per_bin)
                self._leave(self.capacity, self._open(bins), bins)
                continue
            room = self._rooms[at]
            first, bins = self._groups[room].pop()
            if not self._groups[room]:
                del self._groups[room]
                del self._rooms[at]
            per_bin = room // length
            used = min(bins, pieces // per_bin)
            if not used:
                per_bin, used = pieces, 1
            self._place(length, used * per_bin, first, per_bin, self.capacity - room)
            self._leave(room, first + used, bins - used)
            self._leave(room - per_bin * length, first, used)
            pieces -= used * per_bin


@kept_by_worker  # one for all tasks of a worker
def text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


# Characters up to U+017F, but for U+0130, are their own normal form and are lowered one by one; their letters,
# numbers and white space can be written down.
_odd = re.compile("[^\x00-\u012f\u0131-\u017f]|<\\|")
_letters = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_numbers = "0-9\xb2\xb3\xb9\xbc-\xbe"
_blank = "\t-\r \x85\xa0"


class TextEncoder:
    """Token ids of whole texts under a byte-level BPE with word ends that
    drops white space and lowers case.

    Words are cut as the tokenizer's own pattern does, and each distinct word
    is encoded once and remembered.  New words are encoded together: all of
    them take their merge of lowest rank, the leftmost first, until none has
    one left.  Units between blanks that hold other characters than plain
    ones (or a special token), and long words, are left to the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, vocabulary = whole["model"], whole["model"]["vocab"]
        pattern = whole["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        plain = pattern.replace("[^\\s\\p{L}\\p{N}]", f"[^{_blank}{_letters}{_numbers}]").replace(
            "[\\p{L}]", f"[{_letters}]").replace("[\\p{N}]", f"[{_numbers}]")
        if "\\p" in plain or "\\s" in plain:
            raise ValueError(f"unknown pattern {pattern}")
        self.words = re.compile(plain).findall
        self.units = re.compile("[^ \n\r\t]+").findall
        # byte-level letters: printable bytes stand for themselves, the others for letters from U+0100 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in shown]
        letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        end = model["end_of_word_suffix"]
        self.inner = np.array([vocabulary[letter[b]] for b in range(256)], np.int64)
        self.last = np.array([vocabulary[letter[b] + end] for b in range(256)], np.int64)
        self.size = len(vocabulary)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        key = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)[order]

    def _merge(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE without a merge) and id of the merge of each pair of ids."""
        pair = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], NONE), self.merged[at]

    def many_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words at once, as little-endian unsigned 32-bit integers.
        A merge changes the pairs on its two sides; all others only move up."""
        count = np.array(list(map(len, words)))
        width = int(count.max())
        codes = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(len(words), width)
        ids = self.inner[codes]
        number = rows = np.arange(len(words))
        ids[rows, count - 1] = self.last[codes[rows, count - 1]]
        rank, merged = self._merge(ids[:, :-1], ids[:, 1:])
        rank[np.arange(1, width) >= count[:, None]] = NONE
        result = [b""] * len(words)
        while len(rows):
            first = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(ids), np.int64)
            more = rank[rows, first] < NONE if rank.shape[1] else np.zeros(len(ids), bool)
            done = ids[~more].astype("<u4").tobytes()
            for i, (place, n) in enumerate(zip(number[~more].tolist(), count[~more].tolist())):
                result[place] = done[4 * i * ids.shape[1]:4 * (i * ids.shape[1] + n)]
            ids, rank, merged, count, number, first = (x[more] for x in (ids, rank, merged, count, number, first))
            rows = np.arange(len(ids))
            if len(rows):
                count = count - 1
                new = merged[rows, first]
                later = np.arange(ids.shape[1] - 1) > first[:, None]
                ids = np.where(later, ids[:, 1:], ids[:, :-1])
                ids[rows, first] = new
                rank = np.where(later[:, :-1], rank[:, 1:], rank[:, :-1])
                merged = np.where(later[:, :-1], merged[:, 1:], merged[:, :-1])
                if rank.shape[1]:
                    after = first < count - 1
                    at = first[after]
                    rank[rows[after], at], merged[rows[after], at] = self._merge(new[after], ids[rows[after], at + 1])
                    end = ~after & (first < rank.shape[1])
                    rank[rows[end], first[end]] = NONE
                    before = first > 0
                    at = first[before] - 1
                    rank[rows[before], at], merged[rows[before], at] = self._merge(ids[rows[before], at], new[before])
        return result

    def cut(self, text: str) -> list[str]:
        """The words of a text; a unit that the library has to encode is one word, marked by a blank before it."""
        if not _odd.search(text):
            return self.words(text.lower())
        out = []
        for unit in self.units(text):
            out += [" " + unit] if _odd.search(unit) else self.words(unit.lower())
        return out

    def learn(self, asked: set[str]) -> None:
        """Remember the ids of all these words."""
        new = [w for w in asked if w not in self.kept]
        if len(self.kept) + len(new) > KEPT_WORDS:
            self.kept.clear()
            new = list(asked)
        plain, other = [], []
        for w in new:
            (other if w[0] == " " or len(w) > 24 else plain).append(w)
        plain.sort(key=len)
        for at in range(0, len(plain), TOGETHER):
            part = plain[at:at + TOGETHER]
            self.kept.update(zip(part, self.many_words([w.encode() for w in part])))
        for w, found in zip(other, self.tokenizer.encode_batch_fast([w.strip(" ") for w in other], add_special_tokens=False)):
            self.kept[w] = np.array(found.ids, "<u4").tobytes()

    def ids(self, bodies: pa.Array) -> Iterator[bytes]:
        """The ids of each text; new words are gathered from several texts."""
        def joined(held: list[list[str]]) -> Iterator[bytes]:
            self.learn(set().union(*held))
            for words in held:
                yield b"".join(map(self.kept.__getitem__, words))

        held, size = [], 0
        for body in bodies:
            body = body.as_py()
            held.append(self.cut(body))
            size += len(body)
            if size > GATHERED:
                yield from joined(held)
                held, size = [], 0
        yield from joined(held)


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int, doc_id: str, text: str, with_ids: bool) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids),
    and the task (part) and the count of earlier pieces of the same length in
    that task (turn)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"),
                       F.spark_partition_id().cast("long").alias("part"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)])
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("part", "long"),
                       ("turn", "long")):
        schema = schema.add(name, kind)
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("packing")
        encoder, turns = text_encoder(tokenizer_path), [0] * (capacity + 1)
        end = np.array([END_OF_DOCUMENT], "<u4").tobytes()
        for batch in batches:
            out = [[] for _ in schema.names]
            for doc, ids, part in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1)), batch.column(2).to_pylist()):
                ids = ids + end
                for piece in range(-(-len(ids) // (4 * capacity))):
                    own = ids[4 * capacity * piece:4 * capacity * (piece + 1)]
                    length = len(own) // 4
                    row = (doc, piece, capacity * piece, length, zlib.crc32(own), part, turns[length])
                    turns[length] += 1
                    for column, value in zip(out, row):
                        column.append(value)
                    if with_ids:
                        out[-1].append(np.frombuffer(own, "<i4"))
            types = [batch.schema.field("doc_id").type, pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], schema.names)
        give_back()

    return rows.mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
         with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length,
    ids_crc32, sequence_id and offset; with_ids adds the token ids.

    A document is its ids and one closing id; only longer ones are cut.  A
    null or empty text is the closing id alone; repeated rows and null
    doc_ids are packed like any other; other columns are left out, whatever
    their names; an empty table gives none."""
    pieces = stored(pieces_of(docs, tokenizer_path, capacity, doc_id, text, with_ids), "pieces")
    turns = pieces.groupBy(F.col("part").alias("_part"), F.col("length").alias("_length")).agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("_length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    firsts = stored(turns.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "firsts")
    counts = {r["_length"]: r["n"] for r in firsts.groupBy("_length").agg(F.sum("n").alias("n")).collect()}
    plan = BinPlan(counts, capacity)
    order = sorted(counts)
    base = np.zeros(capacity + 1, np.int64)  # number of the first piece of each length, over all pieces by length
    base[order] = np.cumsum([0, *[counts[n] for n in order]])[:-1] if order else 0
    rules = np.array(sorted((base[n] + rank, first, per, offset) for n, rank, _, first, per, offset in plan.rules),
                     np.int64).reshape(-1, 4)
    shared = docs.sparkSession.sparkContext.broadcast((base, rules))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        base, rules = shared.value
        number = base[length.to_numpy()] + rank.to_numpy()
        start, first, per, offset = rules[np.searchsorted(rules[:, 0], number, "right") - 1].T
        turn = number - start
        return pd.DataFrame({"sequence_id": first + turn // per, "offset": offset + turn % per * length.to_numpy()})

    # firsts grows with the tasks; its files are small for their rows, so its size would be misjudged for a broadcast
    ranked = pieces.join(firsts.hint("merge"), (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
    out = ranked.withColumn("place", place(F.col("length"), F.col("first") + F.col("turn")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset",
                      *["ids"] * with_ids)
