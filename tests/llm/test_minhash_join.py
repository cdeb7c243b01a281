"""MinHash near duplicates against a comparison of all pairs."""

import random

import numpy as np
import pytest
from moodlake.llm import minhash_join as M
from moodlake.llm.common import stored


def brute_force(rows, words=2, percent=80):
    """(doc_id, n_shingles, component_id, kept, class_id) of each row, every pair compared."""
    sets = []
    for _, t in rows:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        sets.append(frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)

    def least(members):
        return min((rows[j][0] for j in members if rows[j][0] is not None), default=None)

    out = []
    for i, (doc, _) in enumerate(rows):
        group = [j for j in range(len(rows)) if find(j) == find(i)] if sets[i] else [i]
        same = [j for j in group if sets[j] == sets[i]] if sets[i] else [i]
        out.append((doc, len(sets[i]), least(group), doc == least(group), least(same)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies_of(rng, words, n):
    """Texts with a few of the words changed."""
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, max(1, len(w) // 20))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_groups(spark, seed):
    """Groups of near copies, chains of them, and texts that share common words and passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocabulary[:rng.choice([4, 30, 300])]) for _ in range(rng.randint(1, 80))) for _ in range(150)]
    for size in (40, 12, 3):
        texts += near_copies_of(rng, [rng.choice(vocabulary) for _ in range(rng.randint(15, 90))], size)
    chain = [rng.choice(vocabulary) for _ in range(60)]
    for step in range(25):
        chain = chain[1:] + [f"c{step}"]
        texts.append(" ".join(chain))
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts += [f"{passage} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 30))) for _ in range(40)]
    rng.shuffle(texts)
    rows = [(1000 + 7 * i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_force(rows)
    assert rows_of(M.near_copies(df)) == want
    assert 20 < sum(not r[3] for r in want)


def test_odd_rows(spark, odd_docs, odd_rows):
    assert rows_of(M.near_copies(odd_docs)) == brute_force(odd_rows)


def test_null_ids_and_repeated_ids(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = near_copies_of(rng, words, 12)
    rows = [(None, t) for t in texts[:6]] + [(5, t) for t in texts[6:9]] + [(5, "other words here"), (9, texts[9]), (9, texts[9])]
    rows += [(None, " ".join(f"v{i}" for i in range(40))), (None, " ".join(f"v{i}" for i in range(41)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(M.near_copies(df)) == brute_force(rows)


def test_no_rows(spark, no_docs):
    assert M.near_copies(no_docs).collect() == []


def test_only_texts_without_words(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "")]
    assert rows_of(M.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_force(rows)


def test_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(1)
    agreed = []
    for _ in range(200):
        every = rng.integers(0, 2**63, 125).astype(np.uint64)  # 100 of the 125 in common: similarity 0.8
        one, two = np.sort(every[:112]), np.sort(np.concatenate([every[:100], every[112:]]))
        agreed.append(int((M.signature(one) == M.signature(two)).sum()))
    assert abs(np.mean(agreed) - 0.8 * 64) < 1.2 and min(agreed) >= M.MATCHES


def test_marks_count_coordinates(spark):
    rng = np.random.default_rng(2)
    one = rng.integers(0, 2**48, (50, 64)).astype(np.uint64)
    two = np.where(rng.random((50, 64)) < 0.6, one, rng.integers(0, 2**48, (50, 64)).astype(np.uint64))
    n = M.PLANES
    rows = [tuple(M.marks(a).tolist() + M.marks(b).tolist()) for a, b in zip(one, two)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} long" for i in range(2 * n)))
    got = [r[0] for r in df.select(M._matches([df[f"c{i}"] for i in range(n)], [df[f"c{n + i}"] for i in range(n)])).collect()]
    assert got == [int((a % 2**n == b % 2**n).sum()) for a, b in zip(one, two)]


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(3)
    for n in (1, 5, 80, 3000):
        for _ in range(40):
            every = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            one, two = every[:n], every[rng.integers(0, n):][:n]
            cells = sum(int(x).bit_count() for x in (M.sketch(one) ^ M.sketch(two)).view(np.uint64))
            assert cells <= len(set(one) ^ set(two))


def test_a_group_is_not_expanded_into_pairs(spark, monkeypatch):
    """Of n near copies about n pairs are compared, not n squared."""
    rng = random.Random(5)
    n = 400
    texts = near_copies_of(rng, [f"w{i}" for i in range(150)], n)
    compared = []
    plain = M._confirmed

    def counted(pairs, sets, percent):
        pairs = stored(pairs, "pairs")
        compared.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(M, "_confirmed", counted)
    rows = [(i, t) for i, t in enumerate(texts)]
    assert rows_of(M.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_force(rows)
    assert sum(compared) < 12 * n


def test_members_of_open_lists_are_exchanged_once(spark, monkeypatch):
    """Wide rows of classes are no longer exploded and moved to the lists that are
    still open, and both sides of the join of their members are one exchange."""
    plans = {}
    real = M.stored

    def noted(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(M, "stored", noted)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        words = [f"w{i}" for i in range(60)]
        texts = [" ".join(words[:50 + i]) for i in range(8)] + [" ".join(words[30:]), "other text here", None]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in M.near_copies(df).collect()}
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert got == {**{i: 0 for i in range(8)}, 8: 8, 9: 9, 10: 10}
    assert "ReusedExchange" in plans["across"]
    assert plans["open"].count("Generate explode(prefix") == 1
    narrow = plans["open"][plans["open"].index("Generate explode(prefix"):].splitlines()[0]
    assert "m0" not in narrow and "s0" not in narrow and "component" not in narrow
