"""Every query with SQL against another engine on the smallest tables."""

import glob
import os

import pytest

from minutesmith import plans

duckdb = pytest.importorskip("duckdb")


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None:
            return ""
        if isinstance(v, bool):
            return str(v)
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in values)


#: Without SQL, and without a row in the smallest tables.
EMPTY = {"name_collisions"}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, data, name):
    found = plans.queries()[name](spark, data)
    values = found.collect()
    sql = plans.oracle_sql().get(name)
    if sql is None:
        assert values or name in EMPTY
        return
    wanted = duck.execute(sql)
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows(found.columns, values) == rows(columns, wanted.fetchall())
