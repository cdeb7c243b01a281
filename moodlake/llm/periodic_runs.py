"""Periodic runs of words, by an online sparse diagonal dynamic programme.

A cell (i, lag) of the diagonal `lag` matches if word i equals word i - lag; its
match length is one more than that of (i - 1, lag).  A diagonal that ends after
3 * lag matches or more is a run of period lag.  Only few cells are kept:

* For lags up to DENSE all cells of a diagonal are computed.
* A longer lag is opened by a word's *nearest* earlier occurrence in its
  context.  Lags are cut into bands from `low` to `high` <= 1.5 * low, and the
  context of a band is the phrase of 2 * high words that starts at the word.
  In a run of smallest period q in the band, each such phrase whose earlier
  copy lies in the run has that copy at lag q and none nearer: a nearer one at
  lag d would give the phrase, of q + d words at least, the period
  gcd(q, d), a divisor of q, and the run a smaller period (Fine and Wilf).  A run
  of 4 q words holds at least one such phrase.  So one lag a word and band is
  active, and consecutive phrases with one lag are exactly a diagonal's matches.

A diagonal that ends long enough emits its run at once; whether its lag is the
smallest period follows from the same argument.  Phrases are told apart by
64-bit hashes; an emitted run is compared word by word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import ship_package

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
DENSE = 16  # lags whose diagonals are computed whole
FIRST_PHRASE = 32  # words, at most the context of the first band after DENSE

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")


def _long_enough(starts: np.ndarray, ends: np.ndarray, lag: int) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of the diagonals' stretches of matches [start, end)."""
    length = ends - starts + lag
    wanted = length >= max(LEAST_LENGTH, LEAST_EXPONENT * lag)
    return [(int(s) - lag, int(n), lag) for s, n in zip(starts[wanted], length[wanted])]


def _dense(ids: np.ndarray, lag: int) -> list[tuple[int, int, int]]:
    """Runs of one diagonal, of which all cells are computed."""
    same = np.flatnonzero(ids[lag:] == ids[:-lag]) + lag
    if len(same) < max(LEAST_LENGTH - lag, (LEAST_EXPONENT - 1) * lag):
        return []
    cuts = np.flatnonzero(np.diff(same) != 1)
    return _long_enough(same[np.concatenate([[0], cuts + 1])], same[np.concatenate([cuts, [len(same) - 1]])] + 1, lag)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of concatenations, from hashes of their two parts."""
    out = left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _nearest(phrase: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the phrases at ascending positions, those with an earlier copy, and the lag to the nearest one."""
    order = np.argsort(phrase, kind="stable")
    copy = np.flatnonzero(phrase[order][1:] == phrase[order][:-1])
    place, lag = at[order[copy + 1]], at[order[copy + 1]] - at[order[copy]]
    order = np.argsort(place)
    return place[order], lag[order]


def _repeated(phrase: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The positions of phrases that occur twice or more."""
    order = np.argsort(phrase)
    new = np.concatenate([[True], phrase[order][1:] != phrase[order][:-1]])
    sizes = np.diff(np.concatenate([np.flatnonzero(new), [len(new)]]))
    return np.sort(at[order[np.repeat(sizes > 1, sizes)]])


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, smallest period) of a sequence of numbers, by start, then period."""
    n = len(ids)
    # a long stretch of period q also matches at lags 2 q, 3 q, ...; the smallest lag comes first and counts
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, min(DENSE, n // LEAST_EXPONENT) + 1):
        for start, length, _ in _dense(ids, lag):
            found.setdefault((start, length), lag)
    runs = [(s, k, q) for (s, k), q in found.items()]
    low = DENSE + 1
    if n // LEAST_EXPONENT >= low:
        hashed, size = _mixed(ids.astype(np.uint64) + np.uint64(1), np.zeros(n, np.uint64)), 1
        while size < FIRST_PHRASE:
            hashed, size = _mixed(hashed[:len(hashed) - size], hashed[size:]), 2 * size
        at = _repeated(hashed, np.arange(len(hashed)))  # words in a phrase that occurs again; all others open no lag
        while low <= n // LEAST_EXPONENT and len(at):
            high = low * 3 // 2
            context = 2 * high
            while 2 * size <= context and len(at):
                hashed, size = _mixed(hashed[:max(0, len(hashed) - size)], hashed[size:]), 2 * size
                at = at[at < len(hashed)]
                if len(at):
                    at = _repeated(hashed[at], at)
            own = at[at + context - size < len(hashed)]
            if len(own):
                place, lag = _nearest(_mixed(hashed[own], hashed[own + context - size]), own)
                active = (lag >= low) & (lag <= high)
                place, lag = place[active], lag[active]
                if len(place):
                    cuts = np.flatnonzero((np.diff(place) != 1) | (np.diff(lag) != 0))
                    firsts, lasts = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(place) - 1]])
                    for first, last in zip(firsts, lasts):
                        q = int(lag[first])
                        for start, length, _ in _long_enough(place[first:first + 1], place[last:last + 1] + context, q):
                            if np.array_equal(ids[start:start + length - q], ids[start + q:start + length]):
                                runs.append((start, length, q))
            low = high + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8: what stands between \\x20 and \\x09-\\x0D."""
    return text.split() if text else []


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the periodic tail that the contract plants in a tenth of the documents, told by doc_id."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def run_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """One row per document: doc_id; n_runs; start, length, period and
    exponent_milli of the longest run (ties: smallest start, then period; nulls
    without a run); runs_sha256 of all runs and collapsed_sha256 of the words
    left when each run is reduced to its first period.

    Whole texts are searched, each in the task that reads it: nothing is
    shuffled, and a very long text costs in proportion to its words times the
    number of bands (about 2.5 ln n).  A null or empty text has no words and no
    runs.  With `plant`, a tenth of the documents, told by doc_id, get a
    periodic tail first; a row without doc_id gets none.  Rows repeated are
    answered each; other columns are left out, whatever their names; an empty
    table gives none."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("body"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for one, body in zip(batch.column(0), batch.column(1)):
                words = words_of(body.as_py())
                if plant:
                    words = planted(words, one.as_py())
                runs = find_runs(numbered(words)) if len(words) >= LEAST_LENGTH else []
                best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
                listed = hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
                left = hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()
                for column, value in zip(out, (one.as_py(), len(runs), *best, 1000 * best[1] // best[2] if runs else None, listed, left)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out[:6]] + [pa.array(c, pa.string()) for c in out[6:]],
                                             ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                              "collapsed_sha256"])

    return rows.mapInArrow(search, SCHEMA)


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with each text's runs reduced to their first period.  Texts without
    a run stay as they are, byte by byte, nulls too; in a text with runs the
    words left are joined by one space.  All columns and rows stay."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def reduced(bodies):
        def one(body):
            words = words_of(body.encode()) if body else []
            runs = find_runs(numbered(words)) if len(words) >= LEAST_LENGTH else []
            return b" ".join(collapsed(words, runs)).decode() if runs else body

        return bodies.map(one)

    return docs.withColumn(text, reduced(F.col(f"`{text}`")))
