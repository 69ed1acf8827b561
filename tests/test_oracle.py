"""Every query of the catalog against its DuckDB oracle on the driver tables (sf0.001), replayed streams included."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from flowdex.plans import catalog
from flowdex.sources.tables import TABLES
from tests.conftest import SF_SMALL

NAMES = sorted(catalog.QUERIES)


def _norm(v):
    if isinstance(v, float):
        return f"{round(v, 6):.6f}"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_id", "value"] and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows) > 0
    assert _digest(df.columns, rows) == _digest(ocols, orows)
