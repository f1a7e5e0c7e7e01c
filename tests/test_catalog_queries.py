"""Every registered query of the catalogue against its SQL, on the smallest tables."""

import os

import pytest

from quadrille import queries as core

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no tables")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", list(core.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = core.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.sql(core.oracle_sql()[name])
    assert sorted(want.columns) == columns
    assert plain(tuple(r[c] for c in columns) for r in got.collect()) == plain(want.select(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    if os.path.isdir(DATA):
        assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
