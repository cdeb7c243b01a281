import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from moodlake.llm import packing as P
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_plans_place_every_piece_once():
    rng = random.Random(5)
    for capacity in (1, 2, 10, 31, 100):
        for _ in range(40):
            counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 300)))
            plan = P.BinPlan(dict(counts), capacity)
            bins, ranks = defaultdict(list), defaultdict(set)
            for length, rank, pieces, first, per, offset in plan.rules:
                for i in range(pieces):
                    bins[first + i // per].append((offset + i % per * length, length))
                    assert rank + i not in ranks[length]
                    ranks[length].add(rank + i)
            assert {n: len(r) for n, r in ranks.items()} == dict(counts)
            assert set(bins) == set(range(plan.bins))
            for own in bins.values():
                at = 0
                for offset, length in sorted(own):
                    assert offset == at
                    at += length
                assert at <= capacity
            total = sum(n * c for n, c in counts.items())
            assert plan.bins <= max(1, -(-total * 11 // (capacity * 9)) + 1) or not counts  # best fit decreasing: 11/9


def test_large_items_pair_best():
    assert P.BinPlan({60: 3, 40: 3}, 100).bins == 3
    assert P.BinPlan({50: 5}, 100).bins == 3
    assert P.BinPlan({34: 2, 66: 1, 67: 1}, 100).bins == 3
    assert len(P.BinPlan({n: 10**12 for n in range(1, 4097)}, 4096).rules) < 12 * 4096


def test_pieces_equal_the_library(odd_docs, odd_rows, no_docs):
    got = P.pack(odd_docs, PATH, with_ids=True).collect()
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for doc, text in odd_rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece in range(-(-len(ids) // 4096)):
            own = ids[4096 * piece:4096 * (piece + 1)]
            want[doc, piece, 4096 * piece, len(own), zlib.crc32(own.tobytes()), tuple(own.tolist())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= -(-sum(r.length for r in got) // 4096) + 1
    assert P.pack(no_docs, PATH).count() == 0
