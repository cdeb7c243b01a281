"""The registered queries over a whole small table: their columns, and their rows against their SQL."""

import duckdb
import pytest
from moodlake.llm import queries as Q

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op2_license_scan": ["doc_id", "licenses", "n_sentences", "sentence_ids"],
    "op3_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op4_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op5_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op6_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op8_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_topk": ["query_id", "rank", "vec_id", "score"],
    "op10_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_minhash_join": ["doc_id", "n_shingles", "component_id", "kept"],
    "op13_centroid_clusters": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}


def test_all_queries():
    assert set(Q.QUERIES) == set(COLUMNS) and set(Q.SQL) <= set(COLUMNS)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    got, want = Q.QUERIES[name](spark, DATA).toPandas(), con.execute(Q.SQL[name]).df()
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns and set(COLUMNS[name]) <= set(columns)
    assert sorted(map(tuple, got[columns].astype(str).values)) == sorted(map(tuple, want[columns].astype(str).values))
