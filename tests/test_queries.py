"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from tilewright.plans import catalogue, oracle

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        return x.isoformat() if hasattr(x, "isoformat") else x

    return sorted(tuple(repr(value(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


#: Reachability by recursive SQL is quadratic in a drawing, and the state of a full canvas is nearly one; test_whole.py has these.
NO_SQL = {"components_d0", "components_d3", "artworks", "run_totals"}


def test_every_other_query_has_sql():
    assert set(catalogue.queries()) - NO_SQL == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, duck, name):
    found = catalogue.queries()[name](spark, SF)
    expected = duck.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert canonical(found.collect(), found.columns) == canonical(expected.fetchall(), columns)
