"""Exact token counts of every prefix of a text by dynamic programming.

A byte-pair encoding is the only token sequence in which every pair of
neighbours encodes to itself.  So the last token of a prefix is the one
vocabulary token that ends there and is compatible with the last token of the
prefix before it; its count is that prefix's count and one.  One pass over
the text gives the count at every prefix, and a truncation or budget question
is answered from these counts without encoding again.

Tokens never hold a space after another character, so counts restart at each
word and the counts of a word are kept for its next occurrence.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import ship_package

SPACE = "▁"  # how the vocabulary writes a space
# What a Python worker remembers for speed alone; a full memory starts anew.
KEPT_WORDS = 500_000
KEPT_PAIRS = 400_000
KEPT_LENGTH = 40  # longer words are computed each time, one by one
TOGETHER = 4096  # words, of about one length, computed at once
GATHERED = 4 << 20  # characters whose new words are gathered
MULTIPLIER = 0x9E3779B97F4A7C15 | 1  # of the running hash


class PrefixCounter:
    """Prefix counts under one piece vocabulary: `scores` by piece, higher
    merges first, and the leftmost of equals."""

    def __init__(self, scores: dict[str, float]):
        self.rank = {p: -s for p, s in scores.items()}
        self.longest = max(map(len, scores), default=1)
        inner = {p[i:i + 2] for p in scores for i in range(len(p) - 1)}
        if any(pair[1] == SPACE and pair[0] != SPACE for pair in inner):
            self.words = None  # a piece spans words: the text is one word
        else:
            alone = "".join(c for c in "\n\t\r" if not any(c in pair for pair in inner))
            single = f"[{alone}]|" if alone else ""
            self.words = re.compile(f"{single}{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.kept: dict[str, bytes] = {}
        # pieces by hash, and which lengths of pieces end in a pair of characters
        self.pieces = list(scores)
        self.powers = np.cumprod(np.full(self.longest + 1, MULTIPLIER, np.uint64)) * np.uint64(pow(MULTIPLIER, -1, 2**64))
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        endings: dict[int, int] = {}
        for p in self.pieces:
            if len(p) > 1:
                pair = ord(p[-2]) << 21 | ord(p[-1])
                endings[pair] = endings.get(pair, 0) | 1 << len(p)
        self.ending_pairs = np.array(sorted(endings), np.int64)
        self.ending_lengths = np.array([endings[p] for p in sorted(endings)], np.int64)
        # remembered compatible pairs of token numbers, by hash of the pair
        self.pair_keys = np.full(1 << 20, -1, np.int64)
        self.pair_fits = np.zeros(1 << 20, bool)

    @classmethod
    @functools.cache  # one for all tasks of a worker
    def from_model(cls, path: str) -> PrefixCounter:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls({model.id_to_piece(i): model.get_score(i) for i in plain})

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by repeated best merges."""
        parts, rank = list(text), self.rank
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(left + right) == [part for part in key if part]
        return found

    def word_steps(self, word: str) -> bytes:
        """For each character of a word, the change of the prefix's token
        count that it brings, as signed bytes.  A character outside the
        vocabulary is a token of its own that costs its UTF-8 bytes."""
        last, count = [""], [0]
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - self.longest), end):
                token = word[start:end]
                if (end - start == 1 or token in self.rank) and self._compatible(last[start], token):
                    last.append(token)
                    count.append(count[start] + (1 if token in self.rank else len(token.encode())))
                    break
        return bytes([(b - a) & 255 for a, b in pairwise(count)])

    @staticmethod
    def _hash(text: str) -> int:
        out = 0
        for c in text:
            out = (out * MULTIPLIER + ord(c) + 1) % 2**64
        return out

    def _token(self, number: int) -> str:
        """The token of a number: a piece, or past them a character; -1 is none."""
        return "" if number < 0 else self.pieces[number] if number < len(self.pieces) else chr(number - len(self.pieces))

    def _all_compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """_compatible of pairs of token numbers."""
        span = len(self.pieces) + 0x110000
        key = (left + 1) * span + right
        slot = ((key.astype(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(44)).astype(np.int64)
        fits, known = self.pair_fits[slot], self.pair_keys[slot] == key
        if not known.all():
            asked, at, back = np.unique(key[~known], return_index=True, return_inverse=True)
            found = np.array([self._compatible(self._token(k // span - 1), self._token(k % span)) for k in asked.tolist()])
            fits[~known] = found[back]
            places = slot[~known][at]
            self.pair_keys[places], self.pair_fits[places] = asked, found
        return fits

    def many_word_steps(self, words: list[str]) -> list[bytes]:
        """word_steps of many words at once: each position of all words is
        decided together, trying the tokens that end there by length."""
        lengths = np.array(list(map(len, words)))
        by_length = np.argsort(-lengths, kind="stable")
        width, sizes = int(lengths.max()), lengths[by_length]
        codes = np.array(words)[by_length].view(np.uint32).reshape(len(words), -1)[:, :width].astype(np.int64)
        hashed = np.zeros((width + 1, len(words)), np.uint64)
        for i in range(width):
            hashed[i + 1] = hashed[i] * np.uint64(MULTIPLIER) + codes[:, i].astype(np.uint64) + np.uint64(1)
        last = np.full((width + 1, len(words)), -1, np.int64)
        count = np.zeros((width + 1, len(words)), np.int32)
        for end in range(1, width + 1):
            rows = np.arange(int(np.searchsorted(-sizes, -end, "right")))  # words that reach this position
            possible = np.full(len(rows), 2)
            if end > 1:
                pair = codes[rows, end - 2] << 21 | codes[rows, end - 1]
                at = np.minimum(np.searchsorted(self.ending_pairs, pair), len(self.ending_pairs) - 1)
                possible |= np.where(self.ending_pairs[at] == pair, self.ending_lengths[at], 0)
            for length in range(min(end, self.longest), 0, -1):
                trying = possible >> length & 1 == 1
                if not trying.any():
                    continue
                own, start = rows[trying], end - length
                wanted = hashed[end, own] - hashed[start, own] * self.powers[length]
                at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
                there = self.hashes[at] == wanted
                token = self.order[at]
                cost = 1
                if length == 1:
                    letter = codes[own, end - 1]
                    token = np.where(there, token, letter + len(self.pieces))
                    cost = np.where(there, 1, 1 + (letter > 0x7F) + (letter > 0x7FF) + (letter > 0xFFFF))
                    there = np.ones(len(own), bool)
                own, token = own[there], token[there]
                cost = cost[there] if length == 1 else cost
                fits = self._all_compatible(last[start, own], token)
                last[end, own[fits]] = token[fits]
                count[end, own[fits]] = (count[start, own] + cost)[fits]
                open_rows = np.ones(len(rows), bool)
                open_rows[np.searchsorted(rows, own[fits])] = False
                rows, possible = rows[open_rows], possible[open_rows]
                if not len(rows):
                    break
        steps = np.diff(count, axis=0).T.astype(np.int8)
        out = [b""] * len(words)
        for place, n, row in zip(by_length.tolist(), sizes.tolist(), steps):
            out[place] = row[:n].tobytes()
        return out

    def learn(self, words: set[str]) -> None:
        """Remember the steps of all short words among these."""
        new = [w for w in words if w not in self.kept and len(w) <= KEPT_LENGTH]
        if len(self.kept) + len(new) > KEPT_WORDS:
            self.kept.clear()
            new = [w for w in words if len(w) <= KEPT_LENGTH]
        new.sort(key=len)
        for at in range(0, len(new), TOGETHER):
            part = new[at:at + TOGETHER]
            self.kept.update(zip(part, self.many_word_steps(part)))

    def cut(self, text: str) -> list[str]:
        """The words of a text, the mark of the leading space before the first."""
        marked = SPACE + text.replace(" ", SPACE)
        return self.words.findall(marked) if self.words else [marked]

    def steps(self, text: str) -> np.ndarray:
        """Signed steps whose running sum at k >= 1 is the exact token count of
        the first k characters; at 0 it is what the leading space mark costs
        (the empty prefix has no token)."""
        if not text:
            return np.zeros(1, np.int8)
        return self.joined(self.cut(text))

    def joined(self, words: list[str]) -> np.ndarray:
        """The steps of words one after another; those not remembered are computed."""
        found = list(map(self.kept.get, words))
        if None in found:
            found = [self.word_steps(w) if s is None else s for w, s in zip(words, found)]
        return np.frombuffer(b"".join(found), np.int8)


def tokens_at(steps: np.ndarray, chars: int) -> int:
    """Tokens of the first `chars` characters, from the stored steps."""
    return int(steps[:chars + 1].sum(dtype=np.int64)) if chars > 0 else 0


def longest_prefix(steps: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most `budget` tokens."""
    counts = np.cumsum(steps, dtype=np.int64)
    counts[0] = 0
    return int(np.flatnonzero(counts <= budget)[-1])


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text",
                 with_steps: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit and
    keep_chars (the longest prefix, in characters, of at most `limit` tokens);
    with_steps adds prefix_steps, one signed byte for each character, from
    which tokens_at and longest_prefix answer any other question.

    Whole texts are counted, however long.  A null or empty text has 0 tokens;
    repeated rows and null doc_ids give a row each; other columns are left
    out, whatever their names; an empty table gives none."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(bodies: pa.Array, counter: PrefixCounter) -> Iterator[tuple[list[str], str]]:
        held, size = [], 0
        for body in bodies:
            body = body.as_py()
            held.append((counter.cut(body) if body else [], body))
            size += len(body)
            if size > GATHERED:
                counter.learn(set().union(*[words for words, _ in held]))
                yield from held
                held, size = [], 0
        counter.learn(set().union(*[words for words, _ in held]))
        yield from held

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter.from_model(model_path)
        for batch in batches:
            n_bytes, n_tokens, keep, stores = [], [], [], []
            for words, body in cut(batch.column(1), counter):
                steps = counter.joined(words) if body else np.zeros(1, np.int8)
                total = int(steps.sum(dtype=np.int64))
                n_bytes.append(len(body.encode()))
                n_tokens.append(total)
                keep.append(len(body) if total <= limit else longest_prefix(steps, limit))
                if with_steps:
                    stores.append(steps.tobytes())
            n_tokens = pa.array(n_tokens, pa.int64())
            out = [batch.column(0), pa.array(n_bytes, pa.int64()), n_tokens,
                   pa.compute.greater(n_tokens, limit), pa.array(keep, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "keep_chars"]
            if with_steps:
                out, names = [*out, pa.array(stores, pa.binary())], [*names, "prefix_steps"]
            yield pa.RecordBatch.from_arrays(out, names)

    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, keep_chars long"
    return rows.mapInArrow(count, schema + (", prefix_steps binary" if with_steps else ""))
