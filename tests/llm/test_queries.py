import os

import duckdb
import pytest

import __spark_entry__
from loomspan.llm import registry

SF = "/root/testdata/sf0.001"


def rows(found):
    return sorted((tuple("" if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in found), key=str)


def test_registered():
    names = registry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert set(names) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = registry.queries()[name](spark, SF)
    want = db.sql(registry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(tuple(r[c] for c in columns) for r in got.collect()) == rows(tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall())
