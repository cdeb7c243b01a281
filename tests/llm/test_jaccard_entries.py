"""Copies of one text send no more than the text."""

import numpy as np
from moodlake.llm import jaccard_join as J
from test_jaccard_join import brute_force, near_copies, result


def test_a_task_sends_a_class_once(spark):
    text = " ".join(f"w{i}" for i in range(100))
    counts = np.zeros(J.CELLS, np.uint32)

    def sent(copies):
        docs = spark.createDataFrame([(i, text) for i in range(copies)], "doc_id long, text string").coalesce(1)
        rows = J._entries(J._bodies(docs, "doc_id", "text"), counts, 8, 5, 80).collect()
        return sum(len(r.entries) for r in rows)

    assert sent(200) == sent(1) > 0


def test_buckets_merged_while_they_are_read(spark, monkeypatch):
    monkeypatch.setattr(J, "ENTRIES_PER_BUCKET", 50)
    rows = near_copies(7, documents=4)
    rows += [(1000 + i, t) for i, t in rows]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_force(rows)
