"""Rows without a doc_id are linked and dropped like others."""

from moodlake.llm import jaccard_join as J
from test_jaccard_join import brute_force, near_copies, result

WORDS = [f"c{i}" for i in range(160)]


def window(at):
    return " ".join(WORDS[at:at + 100])


def test_a_text_without_doc_id_bridges_two(spark):
    rows = [(1, window(0)), (None, window(8)), (2, window(16)), (None, window(8)), (3, "x y z")]
    assert {(d, c) for d, _, c in brute_force(rows)} == {(1, 1), (None, 1), (2, 1), (3, 3)}
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_force(rows)


def test_many_texts_without_doc_id(spark):
    rows = [(None if i % 3 else i, t) for i, t in near_copies(6, documents=12)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_force(rows)
    rows = [(None, t) for _, t in rows]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_force(rows)


def test_one_row_of_each_component_stays(spark):
    rows = [(1, window(0)), (None, window(4)), (2, window(8)),  # one group with ids
            (None, "a " + window(40)), (None, "b " + window(40)), (None, "B " + window(40)),  # one without
            (5, "alone"), (None, "alone too"), (None, ""), (None, None), (6, ""),
            (2, "this row of two is like no other"), (7, "twice the same"), (7, "Twice the same")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, at long").repartition(3)
    got = sorted(r.at for r in J.drop_near_duplicates(docs).collect())
    assert len(got) == 9 and set(got) >= {0, 6, 7, 8, 9, 10, 11} and len({3, 4, 5} & set(got)) == 1 and len({12, 13} & set(got)) == 1
