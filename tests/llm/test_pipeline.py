"""Each stage of the pipeline held against a brute-force version of its own, and the whole run."""

import re

import corpus_pipeline as C
from test_jaccard_join import brute_force

DOCUMENTS = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{DOCUMENTS}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in C.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "secret_scan", "packing"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in C.STAGES:
        after = C.stored(stage(spark, docs, DOCUMENTS), name)
        if name == "packing":
            assert {r.doc_id for r in after.select("doc_id").collect()} == set(rows)
            break
        assert after.columns == columns
        got = {r.doc_id: r.text for r in after.collect()}
        if name == "language_id":
            want = {i: t for i, t in rows.items() if t and re.search(r"[^\W\d_]", t)}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(rows):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i]), i)
            want = {i: rows[i] for i in first.values()}
        elif name == "jaccard_join":
            want = {i: rows[i] for i in {c for _, _, c in brute_force(sorted(rows.items()))}}
        else:
            assert set(got) == set(rows)
            changed = {i for i in rows if got[i] != rows[i]}
            assert changed == {i for i, t in rows.items() if re.search(r"token = \"[0-9a-f]{24,}", t)}
            want = got
        assert got == want, name
        docs, rows = after, got


def test_run_gives_the_last_stage(spark):
    out = C.run(spark, DOCUMENTS)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() >= out.select("doc_id").distinct().count() > 150


def test_stages_on_odd_rows_and_on_none(spark, odd_docs, no_docs):
    """Nulls, empty and blank texts, ties, repeated rows and columns named like the stages' own, and an empty table."""
    for docs in (odd_docs, no_docs):
        columns, rows = docs.columns, docs.count()
        for name, stage in C.STAGES:
            docs = C.stored(stage(spark, docs, DOCUMENTS), name)
            if name != "packing":
                assert docs.columns == columns and docs.count() <= rows
        texts = [r.text for r in odd_docs.collect()] if rows else []
        wanted = len({re.sub(r"[\x20\x09-\x0D]+", " ", t) for t in texts if t and re.search(r"[^\W\d_]", t)})
        assert (docs.count() > 0) == (rows > 0) and docs.filter("piece = 0").count() <= wanted
