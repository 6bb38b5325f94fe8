"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
if not os.path.isdir(SF):
    pytest.skip("no test tables", allow_module_level=True)

# p2's SQL walks the network by recursion and is compared by the driver and in test_hierarchy
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith("p6_"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]

    def text(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return "null"
        return f"{x:.9g}" if isinstance(x, float) else str(x)

    return sorted(tuple(text(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == plain(cur.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
