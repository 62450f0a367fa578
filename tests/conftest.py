import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from foliospark.session import get_spark

    s = get_spark("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DATA}/{f}')")
    return con


def plain(v):
    """A value in a form both engines share."""
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(plain(x)) for x in v) + "]"
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    return v


@pytest.fixture(scope="session")
def same(spark, duck):
    """Compares a query with its SQL on the smallest tables."""

    def check(query, sql):
        df = query(spark, DATA)
        cols = sorted(df.columns)
        r = duck.execute(sql)
        names = [c[0] for c in r.description]
        assert sorted(names) == cols
        ours = sorted(repr([plain(x[c]) for c in cols]) for x in df.collect())
        theirs = sorted(repr([plain(dict(zip(names, x))[c]) for c in cols]) for x in r.fetchall())
        assert ours == theirs

    return check
