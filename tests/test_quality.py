import pytest

from moodlake.operators import quality as Q


def test_primary_key_counts_null_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    got = {r["check_name"]: r["observed"] for r in Q.dq_primary_key(df, "k").collect()}
    assert got == {"not_null": 2, "unique": 2}


def test_accepted_values_nulls_pass(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "c string")
    r = Q.dq_accepted_values(df, "c", ["a", "b"]).first()
    assert r["observed"] == 1 and not r["passed"]


def test_assert_quality_lists_all_failures(spark):
    df = spark.createDataFrame([(None, 1.5)], "track_id string, energy double")
    rep = Q.dq_report(Q.dq_nulls(df, ["track_id"], "t"), Q.dq_ranges(df, ["energy"], "t"), Q.dq_row_count(df, 10, "t"))
    with pytest.raises(ValueError) as e:
        Q.assert_quality(rep)
    msg = str(e.value)
    assert "not_null t.track_id" in msg and "in_range t.energy" in msg and "row_count" in msg


def test_dq_table_one_pass_counts(spark):
    rows = [(1, 10, "F"), (1, None, "O"), (2, 11, "X"), (None, 12, None), (None, None, "F"), (3, 13, "O")]
    df = spark.createDataFrame(rows, "k bigint, c bigint, s string")
    out = Q.dq_table(df, "t", pk="k", not_null=["c"], accepted={"s": ["F", "O"]})
    got = {(r["check_name"], r["column_name"]): (r["observed"], r["passed"]) for r in out.collect()}
    # duplicates: one extra row for key 1, one for the null key (nulls are equal)
    assert got == {("not_null", "k"): (2, False), ("unique", "k"): (2, False),
                   ("not_null", "c"): (2, False), ("accepted_values", "s"): (1, False)}
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan ExistingRDD") == 1


def test_dq_table_without_key_and_empty_input(spark):
    df = spark.createDataFrame([(None, "A"), (1, "B"), (2, None)], "c bigint, s string")
    got = {(r["check_name"], r["column_name"]): r["observed"]
           for r in Q.dq_table(df, "t", not_null=["c"], accepted={"s": ["A"]}).collect()}
    assert got == {("not_null", "c"): 1, ("accepted_values", "s"): 1}
    empty = Q.dq_table(df.limit(0), "t", pk="c", not_null=["s"]).collect()
    assert {r["check_name"]: (r["observed"], r["passed"]) for r in empty} == {
        "not_null": (0, True), "unique": (0, True)}
    with pytest.raises(ValueError):
        Q.dq_table(df, "t")
