import random
import re
from collections import defaultdict

import numpy as np
from moodlake.llm import jaccard_join as J


def brute_force(rows, words=5, percent=80):
    """(doc_id, set size, component) of each row by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append(frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    smallest = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            at = find(i)
            smallest[at] = d if smallest[at] is None else min(smallest[at], d)
    return sorted([(d, len(sets[i]), smallest[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)], key=str)


def near_copies(seed, documents=30, copies=8):
    rng = random.Random(seed)
    rows, word = [], [f"w{i}" for i in range(400)]
    passage = [rng.choice(word) for _ in range(60)]
    for _ in range(documents):
        base = [rng.choice(word) for _ in range(rng.randint(3, 120))]
        if rng.random() < 0.4:
            base[len(base) // 2:len(base) // 2] = passage
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, copies)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(word)
            if rng.random() < 0.3:
                own += [rng.choice(word) for _ in range(rng.randint(1, len(own) // 4 + 1))]
            rows.append(" ".join(own).upper() if rng.random() < 0.2 else "  ".join(own))
    rng.shuffle(rows)
    return list(enumerate(rows))


def result(docs):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(docs).collect()], key=str)


def test_components_equal_brute_force(spark):
    rows = near_copies(1) + [(10_000 + i, t) for i, t in near_copies(2)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute_force(rows)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert result(odd_docs) == brute_force(odd_rows)
    assert result(no_docs) == []


def test_hot_shingles_over_several_buckets(spark, monkeypatch):
    """Shingles dealt over several buckets are still compared."""
    monkeypatch.setattr(J, "HOT_COUNT", 3)
    rows = near_copies(3, documents=12, copies=12)
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute_force(rows)


def test_a_chain_of_links_is_one_component(spark):
    words = [f"c{i}" for i in range(160)]
    rows = [(i, " ".join(words[i * 4:i * 4 + 100])) for i in range(15)]  # neighbours are similar, the ends are not
    got = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_force(rows) and {c for _, _, c in got} == {0}


def test_prefixes_of_similar_sets_share_what_they_ask():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 2000, J.CELLS).astype(np.uint32)
    for _ in range(300):
        n = int(rng.integers(5, 200))
        one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        two = np.unique(np.concatenate([one[rng.random(len(one)) > 0.1], rng.integers(0, 2**63, n // 12 + 1).astype(np.uint64)]))
        shared = len(np.intersect1d(one, two))
        if 100 * shared >= 80 * (len(one) + len(two) - shared):
            a, _, l_a = J.prefix(one, counts, 100.0, 80)
            b, _, l_b = J.prefix(two, counts, 100.0, 80)
            assert len(np.intersect1d(a, b)) >= min(l_a, l_b)


def test_drop_keeps_one_of_each_component(spark):
    rows = near_copies(4, documents=10)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in J.drop_near_duplicates(docs).collect()}
    assert kept == {c for _, _, c in brute_force(rows)}


def test_a_large_group_is_not_expanded(spark):
    rng = random.Random(9)
    base = [f"g{i}" for i in range(120)]
    rows = []
    for i in range(400):
        own = list(base)
        own[rng.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.component_id for r in J.near_duplicates(docs).collect()} == {0}
    bodies = J._bodies(docs, "doc_id", "text")
    counts = J._document_counts(J._signatures(bodies, 5))
    met = J._meetings(J._entries(bodies, counts, 8, 5, 80), counts, 8)
    rated = J._rated(met, 80)
    assert rated.select("key").distinct().count() == 400
    assert rated.filter("reach > size or reach < 0").count() == 0


def test_a_centre_with_far_copies(spark):
    """Copies of one text that are similar to it but not to each other, and
    copies too far from all: nothing near all pairs is compared, no link is lost."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        own = list(base)
        for place in rng.sample(range(120), 2 if i % 2 else 9):
            own[place] = f"e{i}_{place}"
        rows.append((i, " ".join(own)))
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute_force(rows)


def test_sets_move_once(spark, monkeypatch):
    """Sets are written by the tasks that make them and are one exchange of the join of pairs;
    classes of open shingles are one exchange for both sides."""
    plans = {}
    real = J.stored

    def noted(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(J, "stored", noted)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        words = [f"w{i}" for i in range(60)]
        texts = [" ".join(words[:50 + i]) for i in range(4)] * 2 + [" ".join(words[30:]), "other text here", None]
        rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[1]), (0, texts[1]), (None, " ".join(words[1:])), (None, texts[0])]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df).collect()), key=str)
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert got == brute_force(rows)
    assert plans["sets"].count("Exchange") == 1  # that of this test's repartition
    moved = [line for line in plans["links"].splitlines() if "Exchange" in line]
    assert sum("hashpartitioning(row" in line and "Reused" not in line for line in moved) == 3  # the sets, and the pairs for each side
    assert sum("ReusedExchange" in line and "own" in line for line in moved) == 1
    assert "ReusedExchange" in plans["second"]
