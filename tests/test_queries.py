"""Every registered query of the engine against its SQL, on the smallest tables."""

import os

import pytest

from voxlake.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables aren't there")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(repr(tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert plain(map(tuple, got.select(*columns).collect())) == plain(want)


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - registry.oracle_sql().keys()))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, SF).columns


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
