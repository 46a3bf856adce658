"""Driver contract: entry smoke, key coverage, and every oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as contract
from tagweave.sources.tables import INPUT_TABLES

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "uid" and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) >= 45


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in INPUT_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = [tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else (None if r[i] is None else str(r[i]))
                  for i in order) for r in rows]
    return sorted(norm, key=repr)


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = contract.queries()[key](spark, SF_SMALL)
    res = duck.execute(contract.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())
