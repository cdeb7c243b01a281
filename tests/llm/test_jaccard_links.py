"""All links against a comparison of all pairs, also inside components."""

import random
from collections import Counter

from moodlake.llm import jaccard_join as J
from test_jaccard_join import near_copies


def test_links_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [t for _, t in near_copies(8, documents=8)] + ["", None, "two words", "Two words", "two  WORDS"]
    base = [f"g{i}" for i in range(120)]
    for i in range(20):  # one group of near copies, all of different sets
        own = list(base)
        own[rng.randrange(120)] = f"n{i}"
        texts.append(" ".join(own))
    rows = [(None if i % 7 == 3 else i, t) for i, t in enumerate(texts)]
    sets = [frozenset(J.shingles(t or "").tolist()) for _, t in rows]
    similar = {(a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b and sets[a] and sets[b]
               and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    n_links = Counter(a for a, _ in similar)
    pairs, members = J.near_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    keys = [J.class_key(J.shingles(t or "")) for _, t in rows]
    got = [(r.a, r.b) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == {(keys[a], keys[b]) for a, b in similar if keys[a] < keys[b]}
    assert sorted(((r.doc_id, r.n_shingles, r.key, r.n_links) for r in members.collect()), key=str) == sorted(
        ((d, len(sets[i]), keys[i], n_links[i]) for i, (d, _) in enumerate(rows)), key=str)
    assert len([1 for a, b in similar if a < b and min(a, b) >= len(rows) - 20]) > 19  # more than a star has
