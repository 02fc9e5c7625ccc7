import glob
import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def rows(frame):
    return sorted((tuple("" if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in frame), key=str)


RELATIONAL = sorted(n for n in __spark_entry__.oracle_sql() if not n.startswith("op"))


@pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no tables here")
@pytest.mark.parametrize("name", RELATIONAL)
def test_query_matches_sql(spark, db, name):
    got = __spark_entry__.queries()[name](spark, SF)
    want = db.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(tuple(r[c] for c in columns) for r in got.collect()) == rows(tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["contig", "start", "end"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
