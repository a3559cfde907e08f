"""Every query of the catalog against its SQL."""

import duckdb
import pytest

from isoforge.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(r[i], 6) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_matches_sql(spark, db, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    said = db.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(said.columns)
    assert got == plain(said.fetchall(), said.columns)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_filter_reaches_the_scan(spark, sf_dir):
    plan = catalog.point_lookup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(c_custkey" in plan
