"""Every query of the library against its SQL in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import pytest

from trackloom.plans import queries as plans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def rows(names, values):
    """Order-free, columns by name, with NaN and null told apart from values."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    text = lambda v: "null" if v is None else "nan" if isinstance(v, float) and math.isnan(v) else str(v)
    return [names[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    ours = plans.QUERIES[name](spark, SF)
    got = ours.collect()
    theirs = duck.execute(plans.SQL[name])
    assert rows(ours.columns, got) == rows([d[0] for d in theirs.description], theirs.fetchall())
    assert got


def test_entry(spark):
    import __spark_entry__ as e

    assert set(plans.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1
