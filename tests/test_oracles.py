"""Every catalogue query against its DuckDB oracle on the small tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidepool.sources.tables import TABLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_query_without_oracle_gives_rows(spark, name):
    assert E.queries()[name](spark, SF_SMALL).limit(1).count() == 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "item", "cnt", "rank"]
    assert df.count() > 0
