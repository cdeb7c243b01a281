"""Every registered query against its SQL oracle (DuckDB) on the smallest
driver tables; the driver repeats this at sf0.01."""

import importlib.util
import os
import sys

import duckdb
import pytest

from places import ROOT, SMOKE

sys.path.insert(0, os.path.join(ROOT, "tools"))
spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "tools", "check_oracle.py"))
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)

import __spark_entry__ as E  # noqa: E402
from moodlake.plans import registry  # noqa: E402
from moodlake.sources.fixture import TABLES  # noqa: E402

SQL = registry.oracle_sql()  # the training-data operators have tests of their own


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SMOKE}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = {"train_kmeans", "kmeans_labels"}
    missing = set(registry.queries()) - set(SQL) - rows_only
    assert set(registry.queries()) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sp = registry.queries()[name](spark, SMOKE).toPandas()
    dd = con.execute(SQL[name]).df()
    c1, r1 = check.rows_of(sp)
    c2, r2 = check.rows_of(dd)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["track_id", "genre_family", "mood", "mood_cluster"]
    assert df.count() > 0
