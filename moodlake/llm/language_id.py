"""Language identification by bit-sliced Bloom filters over character n-grams.

A cell of the filter holds one bit for each language; the bits of all
languages that may contain an n-gram are the AND of the n-gram's cells, so one
lookup answers for every language at once.  A text's n-grams are counted per
language (popcounts by bit); the expected number of false positives of each
language's slice is taken off, and the language with the largest corrected
share decides.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import begin, give_back, renamed, ship_package, stored

NGRAMS = (3, 4)  # lengths, over lower-case words with a blank at each end
LEAST_SHARE = 2e-5  # an n-gram enters a language's slice with this share of its n-grams at least
CELLS_PER_NGRAM = 16
HASHES = 2
KEPT_WORDS = 100_000  # words whose counts a Python worker keeps, about; then it starts anew
WORDS_AT_ONCE = 20_000  # words whose n-grams are held in arrays at a time, about
UNKNOWN = "und"

_any_words = regex.compile(r"\p{L}+").findall
# up to U+024F the same letters for the faster module
_is_latin = re.compile("[\x00-\u024f]*").fullmatch
_latin_words = re.compile("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+").findall


def _words(text: str) -> list[str]:
    """The runs of letters (\\p{L}+)."""
    return _latin_words(text) if _is_latin(text) else _any_words(text)


def _ngrams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + n] for n in NGRAMS for i in range(len(padded) - n + 1)]


def _gram_places(words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct n-grams of words, and for every n-gram of every word its
    place among them and the word's place: _ngrams of all words at once.  The
    words stand in one row of characters with a blank between two; an n-gram is
    a window without a blank but at its ends.  A window's number is made of that
    of the window shorter by one and of the next character."""
    joined = f" {' '.join(words)} "
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    blank = chars == 32
    word = np.cumsum(blank) - 1
    grams: list[str] = []
    places, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    number, inside = chars, np.ones(len(chars), bool)
    for n in range(2, max(NGRAMS) + 1):
        number = number[:-1] << np.uint64(21) | chars[n - 1:]
        inside = inside[:-1] if n == 2 else inside[:-1] & ~blank[n - 2:-1]
        if n == 2 and n not in NGRAMS:  # three characters fit a number as they are
            continue
        at = np.flatnonzero(inside)
        found = pa.array(number[at]).dictionary_encode()
        place = found.indices.to_numpy().astype(np.int64)
        number = np.zeros(len(number), np.uint64)
        number[at] = place
        if n in NGRAMS:
            first = np.zeros(len(found.dictionary), np.int64)
            first[place[::-1]] = at[::-1]
            places.append(place + len(grams))
            owners.append(word[at])
            grams += [joined[i:i + n] for i in first.tolist()]
    return grams, np.concatenate(places), np.concatenate(owners)


@dataclass
class LanguageFilter:
    """cells[c, b // 64] holds in bit b % 64 whether some n-gram of language b fell into cell c."""

    languages: list[str]
    cells: np.ndarray
    false_rate: np.ndarray  # of each language's slice, for all hashes together
    prior: np.ndarray  # training rows of each language; breaks ties

    @classmethod
    def build(cls, languages: list[str], prior: list[int], grams: dict[str, int]) -> LanguageFilter:
        """grams: the set of languages of each n-gram, as the bits of a number."""
        size = 1 << max(10, int(len(grams) * CELLS_PER_NGRAM).bit_length())
        cells = np.zeros((size, -(-max(1, len(languages)) // 64)), np.uint64)
        for at in range(cells.shape[1]):
            masks = np.array([m >> 64 * at & (2**64 - 1) for m in grams.values()], np.uint64)
            for places in cls._places(list(grams), size):
                np.bitwise_or.at(cells[:, at], places, masks)
        made = cls(languages, cells, np.zeros(len(languages)), np.array(prior, float))
        filled = np.array([made._bits(cells, b).mean() for b in range(len(languages))])
        made.false_rate = filled ** HASHES
        return made

    @staticmethod
    def _places(grams: list[str], size: int) -> Iterator[np.ndarray]:
        hashed = np.fromiter((xxhash.xxh3_64_intdigest(g) for g in grams), np.uint64, len(grams))
        for h in range(HASHES):
            yield ((hashed >> np.uint64(32 * h)) & np.uint64(size - 1)).astype(np.int64)

    @staticmethod
    def _bits(masks: np.ndarray, b: int) -> np.ndarray:
        return (masks[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)

    def hits(self, words: list[str]) -> np.ndarray:
        """For each word: n-grams found in each language's slice, and n-grams."""
        out = np.zeros((len(words), len(self.languages) + 1))
        for start in range(0, len(words), WORDS_AT_ONCE):
            some = words[start:start + WORDS_AT_ONCE]
            grams, at, owner = _gram_places(some)
            masks = None
            for places in self._places(grams, len(self.cells)):
                masks = self.cells[places] if masks is None else masks & self.cells[places]
            rows = out[start:start + len(some)]
            for b in range(len(self.languages)):
                rows[:, b] = np.bincount(owner, self._bits(masks, b).astype(float)[at], len(some))
            rows[:, -1] = np.bincount(owner, minlength=len(some))
        return out

    def decide(self, found: np.ndarray) -> tuple[str, float]:
        """The language and its corrected share of the n-grams, from the sums of hits."""
        total = found[-1]
        if not self.languages or not total:
            return (self.languages[int(np.argmax(self.prior))] if self.languages else UNKNOWN), 0.0
        share = np.clip((found[:-1] / total - self.false_rate) / (1 - np.minimum(self.false_rate, 0.999)), 0, 1)
        best = np.lexsort((-self.prior, -share))[0]
        return self.languages[best], float(share[best])


def held_out(doc_id: F.Column) -> F.Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _gram_counts(words: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    """Each language's counted words as counted n-grams; the words are let go."""
    for name, counted in words.items():
        grams: dict[str, float] = {}
        listed, times = list(counted), np.fromiter(counted.values(), float, len(counted))
        for start in range(0, len(listed), WORDS_AT_ONCE):
            found, at, owner = _gram_places(listed[start:start + WORDS_AT_ONCE])
            for gram, n in zip(found, np.bincount(at, times[start + owner], len(found)).tolist()):
                grams[gram] = grams.get(gram, 0.0) + n
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(list(grams), pa.string()),
                                          pa.array(list(grams.values()), pa.float64())], ["lang", "gram", "n"])
    words.clear()


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageFilter:
    """The filter of all labelled rows (null text or lang: left out).

    Every text of a language is read whole and counts once, however many copies
    there are: each of n copies adds an nth of its counts.  What reaches the
    driver are the n-grams with LEAST_SHARE of a language's at least, so at
    most 1 / LEAST_SHARE for each language."""
    ship_package(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{text}`").alias("body"), F.col(f"`{lang}`").alias("lang")).filter(
        F.col("body").isNotNull() & F.col("lang").isNotNull()).withColumn("digest", F.xxhash64("body"))
    groups = stored(rows.groupBy("lang", "digest").agg(F.count(F.lit(1)).alias("copies")), "language_groups")
    sizes = {r["lang"]: r["n"] for r in groups.groupBy("lang").agg(F.sum("copies").alias("n")).collect()}
    if not sizes:
        return LanguageFilter.build([], [], {})
    languages = sorted(sizes)
    # stored, so that Spark knows how few they are and need not move the texts to join them
    copied = stored(groups.filter("copies > 1"), "language_copies")
    weighed = rows.join(copied, ["lang", "digest"], "left").select(
        "body", "lang", F.coalesce(F.lit(1.0) / F.col("copies"), F.lit(1.0)).alias("weight"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language fit")
        words: dict[str, Counter] = {}
        for batch in batches:
            for body, name, weight in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = words.setdefault(name, Counter())
                found = _words(body.as_py().lower())
                if weight == 1:
                    own.update(found)
                else:
                    for word, n in Counter(found).items():
                        own[word] += n * weight
            if sum(map(len, words.values())) > KEPT_WORDS:
                yield from _gram_counts(words)
        yield from _gram_counts(words)
        give_back()

    # the copies' parts of a text add up to whole numbers
    grams = (weighed.mapInArrow(count, "lang string, gram string, n double").groupBy("lang", "gram")
             .agg(F.round(F.sum("n")).cast("long").alias("n")))
    totals = grams.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("total"))
    frequent = grams.join(F.broadcast(totals), F.col("lang") == F.col("_lang")).filter(
        F.col("n") >= F.greatest(F.lit(2), F.col("total") * LEAST_SHARE))
    bit = {name: b for b, name in enumerate(languages)}
    masks: dict[str, int] = {}
    kept = frequent.select("lang", "gram").toArrow()
    for name, gram in zip(kept["lang"].to_pylist(), kept["gram"].to_pylist()):
        masks[gram] = masks.get(gram, 0) | 1 << bit[name]
    return LanguageFilter.build(languages, [sizes[name] for name in languages], masks)


def predict(docs: DataFrame, model: LanguageFilter, text: str = "text", lang_pred: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """docs with the predicted language of each whole text and its score from
    0 to 1 (the corrected share of its n-grams that the language has).  A null
    text, or one without a letter, is `und` with score 0.  Equal shares go to
    the language with more training rows, then to the first by name."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([f for f in docs.schema if f.name not in (lang_pred, score)]).add(lang_pred, "string").add(
        score, "double")
    rows = docs.select(*[F.col(f"`{f.name}`") for f in schema.fields[:-2]])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language prediction")
        model = shared.value
        known: dict[str, int] = {}
        table = np.zeros((KEPT_WORDS, len(model.languages) + 1))

        def found(group: list[list[str]]) -> Iterator[np.ndarray]:
            """The sums of hits of each text, of which group holds the words."""
            distinct = set().union(*group)
            new = [w for w in distinct if w not in known]
            if len(known) + len(new) > KEPT_WORDS:
                known.clear()
                new = list(distinct)
            if len(new) > KEPT_WORDS:  # texts with more words than the memory holds
                for words in group:
                    counted = Counter(words)
                    yield np.fromiter(counted.values(), float, len(counted)) @ model.hits(list(counted))
                return
            if new:
                at = len(known)
                known.update(zip(new, range(at, at + len(new))))
                table[at:at + len(new)] = model.hits(new)
            for words in group:
                yield table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(axis=0)

        for batch in batches:
            bodies = batch.column(batch.schema.get_field_index(text))
            names, scores = [UNKNOWN] * len(bodies), [0.0] * len(bodies)
            group: dict[int, list[str]] = {}
            held = 0
            for i, body in enumerate(bodies):
                body = body.as_py()
                words = _words(body.lower()) if body and model.languages else []
                if words:
                    group[i] = words
                    held += len(words)
                if held > WORDS_AT_ONCE or i == len(bodies) - 1:
                    for j, hits in zip(group, found(list(group.values()))):
                        names[j], scores[j] = model.decide(hits)
                    group, held = {}, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             schema.names)
        known.clear()
        give_back()

    return rows.mapInArrow(decide, schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.  Fitted on the
    rows that are not held out, from text and lang alone; whole texts are
    scored.  Repeated rows and null doc_ids give a row each; other columns are
    left out; an empty table gives none, and without a labelled row every
    document is `und`."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       F.col(f"`{lang}`").alias("lang"), held_out(F.col(f"`{doc_id}`")).alias("held_out"))
    model = fit(rows.filter("not held_out"))
    return predict(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def known_share(judged: DataFrame) -> float:
    """The least score that a text of a learned language has, but for one in a
    thousand, halved: what texts of other languages share with it stays below
    that more often than not, and its own texts do not.  judged: predict()'s
    rows of texts whose language is known."""
    found = judged.filter(F.col("lang_pred") != UNKNOWN).agg(F.percentile_approx("score", 0.001, 100_000).alias("least")).first()["least"]
    return 0.0 if found is None else found / 2


def keep_identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """docs without those whose text has no language: null, without a letter, or
    with fewer of its n-grams in any language than known_share() of all
    labelled texts says.  The labelled texts are scored for that threshold
    first, and all texts again for the choice: scores stored with the documents
    would be a second copy of them, which lasts as long as the result is read.
    Without labelled rows to learn from nothing can be judged, and all texts
    with a letter stay.  The columns stay as they are, whatever their names; an
    empty table stays empty."""
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    labelled = ~held_out(F.col(f"`{doc_id}`")) & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull()
    known = docs.filter(labelled)
    model = fit(known, text, lang)
    if not model.cells.any():
        return docs.filter(F.col(f"`{text}`").rlike(r"\p{L}"))
    least = known_share(predict(renamed(known, [text]), model, "c0"))
    judged = predict(renamed(docs, docs.columns), model, at[text])
    return judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0) & (F.col("score") >= least)).select(
        *[F.col(c).alias(name) for name, c in at.items()])
