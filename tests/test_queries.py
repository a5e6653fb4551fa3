"""Every core query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from simlane.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: None if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(str(clean(r[i])) for i in order) for r in data)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, small, name):
    d = catalog.QUERIES[name](spark, small)
    got = rows(d.columns, d.collect())
    assert len(set(d.columns)) == len(d.columns)
    if name in catalog.ORACLES:
        c = duckdb.connect()
        for t in TABLES.split():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
        x = c.sql(catalog.ORACLES[name])
        assert sorted(x.columns) == sorted(d.columns)
        assert got == rows(x.columns, x.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
