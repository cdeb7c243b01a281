"""Runs against their definition, and the query's columns against a plain calculation over every document."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from moodlake.llm import periodic_runs as P
from moodlake.llm import queries as Q


def brute_force(w):
    """(start, length, period) of every run, from the definition."""
    n, out = len(w), []
    for s in range(n):
        for q in range(1, (n - s) // 4 + 1):
            if s and w[s - 1] == w[s - 1 + q]:
                continue
            e = s + q
            while e < n and w[e] == w[e - q]:
                e += 1
            if e - s >= max(6, 4 * q) and not any(all(w[i] == w[i - r] for i in range(s + r, e)) for r in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, plant=True, runs_of=brute_force):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = runs_of(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    s, k, q = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), s, k, q, 1000 * k // q if runs else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_runs_of_few_words(data):
    letters = data.draw(st.sampled_from([1, 2, 3, 9]))
    w = data.draw(st.lists(st.integers(0, letters - 1), max_size=90))
    for _ in range(data.draw(st.integers(0, 3))):
        if len(w) > 8:
            s, q = data.draw(st.integers(0, len(w) - 5)), data.draw(st.integers(1, len(w) // 4))
            for i in range(s + q, data.draw(st.integers(s, len(w)))):
                w[i] = w[i - q]
    assert P.find_runs(np.array(w, np.int32)) == brute_force(w)


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_long_periods(seed):
    rng = random.Random(seed)
    w = [rng.randrange(rng.choice([2, 50, 5000])) for _ in range(rng.randint(300, 700))]
    for _ in range(rng.randint(1, 4)):
        s = rng.randrange(len(w) // 2)
        q = rng.randint(17, (len(w) - s) // 4 + 3)
        for i in range(s + q, min(len(w), s + q * rng.randint(3, 7) + rng.randrange(q))):
            w[i] = w[i - q]
    assert P.find_runs(np.array(w, np.int32)) == brute_force(w)


def test_long_sequences():
    n = 200_000
    assert P.find_runs(np.zeros(n, np.int32)) == [(0, n, 1)]
    assert P.find_runs((np.arange(n) % 40_000).astype(np.int32)) == [(0, n, 40_000)]
    assert P.find_runs(np.arange(n).astype(np.int32)) == []
    thue = np.array([bin(i).count("1") % 2 for i in range(4096)], np.int32)  # free of cubes
    assert P.find_runs(thue) == []


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(spark, odd_docs, odd_rows):
    short = [(i, t) for i, t in odd_rows if not t or len(t) < 5000]
    rows = odd_docs.filter("text is null or length(text) < 5000")
    assert as_rows(P.run_digests(rows, plant=True)) == sorted((expected(i, t) for i, t in short), key=str)
    assert as_rows(P.run_digests(rows)) == sorted((expected(i, t, False) for i, t in short), key=str)
    assert P.run_digests(odd_docs, plant=True).count() == len(odd_rows)


def test_no_rows(spark, no_docs):
    assert P.run_digests(no_docs).count() == 0 and P.collapse(no_docs).columns == no_docs.columns


def test_collapse(spark):
    docs = spark.createDataFrame([(1, "a b a b  a b a b c"), (2, "a  b\tc"), (3, None), (4, "")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in P.collapse(docs).collect()} == {1: "a b c", 2: "a  b\tc", 3: None, 4: ""}


def test_query_on_every_document(spark):
    """All documents; runs of texts too long for the definition's cubic search are checked for what they are."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}

    def runs_of(words):
        return brute_force(words) if len(words) < 900 else P.find_runs(P.numbered([w.encode() for w in words]))

    got = Q.QUERIES["op11_periodic_runs"](spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = as_rows(got)
    assert rows == sorted((expected(i, t, runs_of=runs_of) for i, t in docs.items()), key=str)
    assert sum(r[1] for r in rows) > 5
