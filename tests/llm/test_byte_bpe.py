import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from moodlake.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_equal_the_library(ranks, library):
    rng = random.Random(3)
    letters = list(" \n\t\x1c\x85\xa0ab'sreéß漢字😀́AaBeEthing.,01²Ⅷ२9-_　<|end>")
    cut = B.splitter(public_tokenizers.PATTERN).findall
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert [i for w in cut(text) for i in B.encode_word(w.encode(), ranks)] == library.encode_ordinary(text)
    for n in (99, 101, 500, 5000):
        word = "".join(rng.choice("abcdethin") for _ in range(n)).encode()
        assert B.encode_word(word, ranks) == library.encode_ordinary(word.decode())
        if n < 600:
            assert B._merge_short(word, ranks) == B._merge_long(word, ranks)


def test_round_trip_of_documents(odd_docs, odd_rows, no_docs, library):
    encoded = B.encode(odd_docs, PATH, public_tokenizers.PATTERN)
    got = sorted([(r.doc_id, r.n_tokens, r.ids, bytes(r.decoded)) for r in B.decode(encoded, PATH).collect()], key=str)
    want = []
    for i, t in odd_rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), ids, (t or "").encode()))
    assert got == sorted(want, key=str)
    assert B.encode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


def test_digests_over_many_chunks(odd_docs, odd_rows, library, monkeypatch):
    monkeypatch.setattr(B, "CHUNK_BYTES", 200)
    got = sorted([tuple(r) for r in B.encode(odd_docs, PATH, public_tokenizers.PATTERN, digests=True).collect()], key=str)
    want = []
    for i, t in odd_rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_vocabulary_lookup():
    assert B.TokenBytes({}).decode(__import__("numpy").zeros(0, int)) == b""


def test_numbers_by_digits():
    rng = np.random.default_rng(1)
    for codes in (np.zeros(0, np.int64), np.array([0, 1, 2, 3, 4, 255, 256, 2**31 - 1]), rng.integers(0, 2**20, 5000) >> rng.integers(0, 20, 5000)):
        packed = B._packed(*B.by_digits(codes))
        assert (B.from_digits(*B._unpacked(packed)) == codes).all()
