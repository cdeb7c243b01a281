"""Secret scanning: fixed patterns, and a linear-chain conditional random field.

Three patterns give the base spans.  The random field tags white-space tokens
as the begin of a secret, inside one, or outside (B, I, O) from the token's
shape, the neighbouring words and features of the file, and is decoded by
Viterbi; secrets that it finds beside the base spans are added as kind `crf`.
It is trained here on a bounded sample whose labels are the base spans.

A token's feature weights depend on the words alone, so they are summed once
for each distinct word and looked up for its next occurrence.  Viterbi runs
only between tokens that are certainly outside: where O leads B and I by more
than any two transitions can make up, every best path passes through O, so
decoding the stretches between such tokens is decoding the whole text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.llm.common import begin, give_back, ship_package

# The patterns of the base spans, in the order of their kinds.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

_keywords = ("password", "passwd", "secret", "token", "apikey", "api_key")
# a run that is long enough starts where the whole run starts, so these find the same matches without the short ones
_access_long = re.compile(r"AKIA[A-Z0-9]{%d,}" % (ACCESS_LEAST - 4))
_hex_long = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)
_token = re.compile(r"\S+")

SAMPLE_DOCUMENTS = 20_000  # documents, chosen by hash, that the training sample is taken from, about
POSITIVE_WINDOWS, NEGATIVE_WINDOWS = 2000, 4000  # windows of tokens that training reads at most
REACH = 4  # tokens on each side of a window's centre
NEGATIVE_EVERY = 307  # of the tokens without a secret near by, one in so many is the centre of a window
LEAST_SEEN = 3  # a neighbouring word is a feature if so many windows have it
ROWS_SENT = 500
KEPT_WORDS = 60_000  # words whose row a Python worker remembers; a full memory starts anew
MASK = "[SECRET]"
BEGIN, INSIDE, OUTSIDE = 0, 1, 2


def base_matches(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret's value) of the base matches, sorted."""
    out = []
    low = text.lower()
    if any(word in low for word in _keywords):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in _access_long.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start()) for m in _hex_long.finditer(text)]
    return sorted(out)


# -- features ---------------------------------------------------------------

_classes = str.maketrans({**dict.fromkeys("abcdef", "h"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "x"),
                          **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "X"), **dict.fromkeys("0123456789", "9")})
_runs = re.compile(r"(.)\1+")
_edges = "\"'`,;:.()[]{}<>"


def _entropy(word: str) -> float:
    n = len(word)
    return -sum(c / n * math.log2(c / n) for c in Counter(word).values())


def shape_features(word: str) -> list[str]:
    """Features of a token by itself."""
    core = word.strip(_edges)
    length = f"length:{min(len(core).bit_length(), 8)}"
    if core.isalpha():
        case = "lower" if core.islower() else "upper" if core.isupper() else "mixed"
        return [length, f"alpha:{case}", f"alpha:{case}:{min(len(core) // 8, 6)}"]
    shape = _runs.sub(r"\1", core[:64].translate(_classes).replace("h", "x"))
    digits = sum(c in "0123456789" for c in core)
    plain = sum(c.isascii() and c.isalnum() for c in core)
    out = [length, f"shape:{shape[:10]}", f"digits:{min(9, 10 * digits // max(1, len(core)))}",
           f"plain:{min(9, 10 * plain // max(1, len(core)))}", f"entropy:{int(2 * _entropy(core[:256])) if core else 0}"]
    if 0 < digits < plain and plain == len(core):
        out.append(f"code:{min(len(core) // 8, 8)}")
        if not core.translate(_classes).strip("h9"):
            out.append(f"hex:{min(len(core) // 8, 8)}")
    for sign in "=:":
        if sign in core[1:-1]:
            left, right = core.split(sign, 1)
            key = "key" if left.strip("\"' ").lower().endswith(_keywords) else "other"
            out.append(f"pair:{key}:{min(len(right) // 8, 4)}")
    if word[:1] in "\"'":
        out.append("quoted")
    return out


def context_word(word: str) -> str:
    """A neighbouring word as it counts for features."""
    core = word.strip(_edges).lower()
    if not core:
        return word[:3]
    return core if core.isalpha() else "#" if core[:1].isdigit() else core[:12]


def file_features(tokens: int, with_digits: int, with_signs: int) -> list[str]:
    """Features of a whole text: its length and the shares of tokens with digits, and with = or :."""
    share = lambda n: 0 if not n else 1 + min(3, int(math.log10(max(1e-3, n / tokens)) + 3))
    return [f"file:{min(len(str(tokens)), 5)}", f"file digits:{share(with_digits)}", f"file signs:{share(with_signs)}"]


def window_features(words: list[str], i: int, of_file: list[str]) -> list[str]:
    out = shape_features(words[i]) + of_file
    for name, at in (("before", i - 1), ("before 2", i - 2), ("after", i + 1)):
        if 0 <= at < len(words):
            out.append(f"{name}:{context_word(words[at])}")
    return out


# -- the random field ----------------------------------------------------------

@dataclass
class RandomField:
    """weights: of each feature for B, I, O; transitions[a, b]: from tag a to tag b (a text starts after O)."""

    weights: dict[str, np.ndarray]
    transitions: np.ndarray
    kept: dict[str, int] = field(default_factory=dict)  # row of the table, by word; plain words share rows
    shared: dict[tuple, int] = field(default_factory=dict)
    table: np.ndarray | None = None
    leads: np.ndarray | None = None

    def _sum(self, features: list[str]) -> np.ndarray:
        total = np.zeros(3)
        for f in features:
            found = self.weights.get(f)
            if found is not None:
                total += found
        return total

    def _new_row(self, word: str, core: str) -> int:
        """A row of what a word adds to its own tags, to the next token's, to the one after, to the one before; then
        whether it has a digit, and = or :."""
        at = len(self.shared) + len(self.kept)  # at most one row for each entry of the two
        row = np.concatenate([self._sum(shape_features(word)), self._sum([f"before:{core}"]), self._sum([f"before 2:{core}"]),
                              self._sum([f"after:{core}"]), [any(c in "0123456789" for c in word), "=" in word or ":" in word]])
        self.table[at] = row
        # the lead of O over B and over I that the word gives to itself and to its neighbours
        parts = row[:12].reshape(4, 3)
        self.leads[at] = (parts[:, OUTSIDE, None] - parts[:, :OUTSIDE]).ravel()
        return at

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.kept]
        if self.table is None or 2 * (len(self.kept) + len(new)) > len(self.table):
            self.table = np.zeros((2 * max(KEPT_WORDS, len(words)), 14))
            self.leads = np.zeros((len(self.table), 8), np.float32)
            self.kept, self.shared, new = {}, {}, words
        for word in new:
            core = context_word(word)
            bare = word.strip(_edges)
            if bare.isalpha():
                # such a word is its features: length, case, marks, and itself where some weight knows it as a neighbour
                known = core if (f"before:{core}" in self.weights or f"before 2:{core}" in self.weights
                                 or f"after:{core}" in self.weights) else ""
                key = (min(len(bare).bit_length(), 8), bare.islower(), bare.isupper(), min(len(bare) // 8, 6), known, ":" in word)
                row = self.shared.get(key)
                if row is None:
                    row = self.shared[key] = self._new_row(word, core)
            else:
                row = self._new_row(word, core)
            self.kept[word] = row

    def _open(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows of the words, the file's part of the emissions, and the
        tokens where O does not lead by more than two transitions can make up."""
        try:
            rows = np.fromiter(map(self.kept.__getitem__, words), np.int64, len(words))
        except KeyError:
            self._learn(set(words))
            rows = np.fromiter(map(self.kept.__getitem__, words), np.int64, len(words))
        flags = self.table[:, 12:][rows].sum(axis=0)
        of_file = self._sum(file_features(len(words), int(flags[0]), int(flags[1])))
        leads = self.leads[:, :2][rows] + (of_file[OUTSIDE] - of_file[:OUTSIDE])
        leads[1:] += self.leads[:, 2:4][rows[:-1]]
        leads[2:] += self.leads[:, 4:6][rows[:-2]]
        leads[:-1] += self.leads[:, 6:][rows[1:]]
        reach = 2 * (self.transitions.max() - self.transitions.min()) + 1e-3  # and what single precision rounds off
        return rows, of_file, np.flatnonzero((leads <= reach).any(axis=1))

    def _emissions(self, rows: np.ndarray, of_file: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Emissions of the tokens at the given places."""
        out = self.table[rows[at], :3] + of_file
        for back, part in ((1, slice(3, 6)), (2, slice(6, 9)), (-1, slice(9, 12))):
            there = (at - back >= 0) & (at - back < len(rows))
            out[there] += self.table[rows[at[there] - back], part]
        return out

    def emissions(self, words: list[str]) -> np.ndarray:
        rows, of_file, _ = self._open(words)
        return self._emissions(rows, of_file, np.arange(len(rows)))

    def viterbi(self, emissions: np.ndarray) -> np.ndarray:
        """The best tags of a stretch that stands between tokens tagged O."""
        score, back = emissions[0] + self.transitions[OUTSIDE], []
        for e in emissions[1:]:
            steps = score[:, None] + self.transitions
            back.append(steps.argmax(axis=0))
            score = steps.max(axis=0) + e
        tags = [int((score + self.transitions[:, OUTSIDE]).argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return np.array(tags[::-1])

    def tags(self, words: list[str]) -> dict[int, int]:
        """The tokens that the best path of the whole text tags B or I."""
        if not words:
            return {}
        rows, of_file, open_at = self._open(words)
        if not len(open_at):
            return {}
        out = {}
        for run in np.split(open_at, np.flatnonzero(np.diff(open_at) > 1) + 1):
            for i, tag in zip(run.tolist(), self.viterbi(self._emissions(rows, of_file, run)).tolist()):
                if tag != OUTSIDE:
                    out[i] = tag
        return out

    def found(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the secrets that the field tags, without the marks around them."""
        tagged = self.tags(text.split())  # white space as _token's
        if not tagged:
            return []
        out, last = [], max(tagged)
        for i, m in enumerate(_token.finditer(text)):
            if i > last:
                break
            if i in tagged:
                word = m.group()
                core = word.strip(_edges)
                start = m.start() + word.index(core) if core else m.start()
                if tagged[i] == INSIDE and i - 1 in tagged and out:
                    out[-1] = (out[-1][0], start + len(core))
                elif core:
                    out.append((start, start + len(core)))
        return out


def train(windows: list[tuple[list[list[str]], list[int]]], rounds: int = 60, rate: float = 0.5,
          penalty: float = 1e-4) -> RandomField:
    """The field of largest penalised likelihood of the windows (features and
    tag of each token), by full-batch gradient steps of adaptive size."""
    seen = Counter(f for window, _ in windows for token in window for f in token)
    names = [f for f, n in sorted(seen.items()) if n >= LEAST_SEEN]
    if not windows or not any(tag != OUTSIDE for _, tags in windows for tag in tags):
        return RandomField({f"length:{i}": np.array([-20.0, -20.0, 0.0]) for i in range(9)}, np.zeros((3, 3)))
    number = {f: i for i, f in enumerate(names)}
    longest, width = max(len(t) for _, t in windows), max(len(f) for w, _ in windows for f in w)
    features = np.full((len(windows), longest, width), len(names))
    tags = np.full((len(windows), longest), OUTSIDE)
    present = np.zeros((len(windows), longest), bool)
    for i, (window, labels) in enumerate(windows):
        tags[i, :len(labels)], present[i, :len(labels)] = labels, True
        for j, token in enumerate(window):
            known = [number[f] for f in token if f in number]
            features[i, j, :len(known)] = known
    weights, moves = np.zeros((len(names) + 1, 3)), np.zeros((3, 3))
    size_w, size_m = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
    truth = np.eye(3)[tags] * present[..., None]
    before = np.concatenate([np.full((len(windows), 1), OUTSIDE), tags[:, :-1]], axis=1)
    true_moves = np.zeros((3, 3))
    np.add.at(true_moves, (before[present], tags[present]), 1)
    for _ in range(rounds):
        e = weights[features].sum(axis=2)
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0] + moves[OUTSIDE]
        for t in range(1, longest):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + e[:, t]
            forward[:, t] = np.where(present[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (e[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(present[:, t + 1, None], step, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - total[:, None, None]) * present[..., None]
        expected = np.exp(moves[OUTSIDE] + (e[:, 0] + backward[:, 0] - total[:, None]))
        grad_m = true_moves.copy()
        grad_m[OUTSIDE] -= expected.sum(axis=0)
        for t in range(1, longest):
            pair = (forward[:, t - 1, :, None] + moves + (e[:, t] + backward[:, t])[:, None, :] - total[:, None, None])
            grad_m -= (np.exp(pair) * present[:, t, None, None]).sum(axis=0)
        grad_w = np.zeros_like(weights)
        for tag in range(3):
            error = np.broadcast_to((truth - chance)[..., tag, None], features.shape)
            grad_w[:, tag] = np.bincount(features.ravel(), error.ravel(), len(weights))
        grad_w, grad_m = grad_w / len(windows) - penalty * weights, grad_m / len(windows) - penalty * moves
        grad_w[-1] = 0
        size_w += grad_w**2
        size_m += grad_m**2
        weights += rate * grad_w / np.sqrt(size_w)
        moves += rate * grad_m / np.sqrt(size_m)
    return RandomField({f: weights[i] for f, i in number.items()}, moves)


def _windows(text: str, doc: int) -> Iterator[tuple[bool, list[str], list[int], list[str]]]:
    """(has a secret, words, tags, file features) of the training windows of a text."""
    values = [(value, end) for _, _, end, value in base_matches(text)]
    spans = [m.span() for m in _token.finditer(text)]
    words = [text[a:b] for a, b in spans]
    tags = [OUTSIDE] * len(words)
    starts = np.array([a for a, _ in spans], np.int64)
    for value, end in values:
        first = int(np.searchsorted(starts, value, "right")) - 1
        at = max(0, first)
        while at < len(spans) and spans[at][0] < end:
            tags[at] = BEGIN if at == max(0, first) else INSIDE
            at += 1
    of_file = file_features(max(1, len(words)), sum(any(c in "0123456789" for c in w) for w in words),
                            sum("=" in w or ":" in w for w in words))
    centres = [i for i, tag in enumerate(tags) if tag == BEGIN]
    plain = [i for i in range(doc % NEGATIVE_EVERY, len(words), NEGATIVE_EVERY)
             if all(tag == OUTSIDE for tag in tags[max(0, i - REACH):i + REACH + 1])]
    for i in centres + plain:
        part = slice(max(0, i - REACH), i + REACH + 1)
        yield tags[i] == BEGIN, words[part], tags[part], of_file


def fit(docs: DataFrame, text: str = "text") -> RandomField:
    """The random field trained on a bounded sample: windows around tokens of
    about SAMPLE_DOCUMENTS documents, chosen by a hash of their text,
    POSITIVE_WINDOWS with and NEGATIVE_WINDOWS without a base secret at most."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{text}`").alias("body")).filter(F.col("body").isNotNull())
    part = int(min(1.0, SAMPLE_DOCUMENTS / max(1, rows.count())) * 2**30)
    chosen = rows.select("body", F.pmod(F.xxhash64("body"), F.lit(2**30)).alias("key")).filter(F.col("key") < part)
    schema = "secret boolean, key long, words array<string>, tags array<int>, of_file array<string>"

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("secret windows")
        for batch in batches:
            out = [[] for _ in range(5)]
            for body, key in zip(batch.column(0), batch.column(1).to_pylist()):
                for secret, words, tags, of_file in _windows(body.as_py(), key):
                    for column, value in zip(out, (secret, key, words, tags, of_file)):
                        column.append(value)
            types = [pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             ["secret", "key", "words", "tags", "of_file"])

    found = chosen.mapInArrow(windows, schema)
    kept = []
    for secret, most in ((True, POSITIVE_WINDOWS), (False, NEGATIVE_WINDOWS)):
        kept += (found.filter(F.col("secret") == secret).orderBy(F.xxhash64("key", "words"), "words").limit(most).collect())
    return train([([window_features(r["words"], i, r["of_file"]) for i in range(len(r["words"]))], r["tags"])
                  for r in kept])


# -- the scan ----------------------------------------------------------------------

def all_spans(text: str, model: RandomField) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans and of those that the field adds where no base span is."""
    base = [(start, kind, end) for start, kind, end, _ in base_matches(text)]
    added = [(start, 3, end) for start, end in model.found(text)
             if not any(start < b_end and b_start < end for b_start, _, b_end in base)]
    return sorted(base + added)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by MASK."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        elif end <= at:
            continue
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, model: RandomField | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans (all, by start, then kind) and n_crf.

    Offsets are code points, ends exclusive; a span of an assignment is the
    whole match.  A null text is empty and has no spans; whole texts are
    scanned; repeated rows and null doc_ids give a row each; other columns
    are left out, whatever their names; an empty table gives none."""
    model = model or fit(docs, text)
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)])
    for name, kind in (("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base_sha256", "string"),
                       ("spans", "string"), ("n_crf", "long")):
        schema = schema.add(name, kind)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("secret scan")
        for batch in batches:
            counts, digests, texts = [[], [], [], []], [], []
            for body in batch.column(1):
                spans = all_spans(body.as_py(), shared.value)
                for kind in range(4):
                    counts[kind].append(sum(s[1] == kind for s in spans))
                digests.append(hashlib.sha256(written([s for s in spans if s[1] < 3]).encode()).hexdigest())
                texts.append(written(spans))
            numbers = [pa.array(c, pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers[:3], pa.array(digests, pa.string()),
                                              pa.array(texts, pa.string()), numbers[3]], schema.names)

    return rows.mapInArrow(find, schema)


def mask_secrets(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """docs with each found secret in the text replaced by MASK, and n_chars
    (if there is such a column) the new length; texts without one stay as they
    are, null stays null, and no row is dropped."""
    model = fit(docs, text)
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("secret masks")
        at = names.index(text)
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_SENT):  # few texts at a time are Python's
                batch = whole.slice(first, ROWS_SENT)
                bodies = (body.as_py() for body in batch.column(at))
                new = [None if body is None else masked(body, all_spans(body, shared.value)) for body in bodies]
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(new, batch.column(at).type), *batch.columns[at + 1:]], names)
        give_back()

    out = docs.mapInArrow(clean, docs.schema)
    if n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(f"`{text}`").isNotNull(), F.char_length(F.col(f"`{text}`")))
                             .otherwise(F.col(f"`{n_chars}`")).cast(docs.schema[n_chars].dataType))
    return out
