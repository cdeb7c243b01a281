import random

import pytest
from pyspark.sql import types as T

# names that the operators use inside, and columns of a usual table
SCHEMA = T.StructType([T.StructField(n, T.LongType() if n == "doc_id" else T.StringType()) for n in (
    "doc_id", "text", "lang", "key", "row", "body", "part", "chunk", "bucket", "component", "length", "shard", "slot",
    "_again", "text_sha256", "id", "maybe", "place", "c0", "size", "rank")])


def make_text(rng, n, words=("the", "of", "stone", "River", "and", "x9", "naïve", "漢字", "it's", "42,", "end.")):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empty and blank texts, ties, repeated rows, odd
    white space and characters, and a very long text."""
    rng = random.Random(11)
    texts = [None, "", "   ", "\n\t", "one", "two words", "two  words", "two\twords", " two words", "...", "漢字 é é 😀",
             "\x1c odd \x85 space \xa0 here", "<|endoftext|> and </s> in a text", "a" * 300, make_text(rng, 30000)]
    rows = list(enumerate(texts))
    rows += [(100, "the same text here now"), (101, "the same text here now"), (101, "the same text here now"),
             (101, "the same text here now"), (None, "the same text here now"), (None, None), (-5, "the  same text here now"),
             (102, "another text under one id"), (102, "a second text under one id")]
    rows += [(200 + i, make_text(rng, rng.randint(1, 60))) for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    data = [(i, t, ("en", "fr", None)[k % 3], *["x"] * (len(SCHEMA) - 3)) for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
