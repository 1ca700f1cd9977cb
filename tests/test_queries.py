import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(rows):
    return sorted(tuple("null" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, oracle, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want = oracle.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    assert plain(rows) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
