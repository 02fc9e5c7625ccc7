import glob

import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no tables here")


def run(spark, name):
    return __spark_entry__.queries()[name](spark, SF)


def test_graph_queries_read_every_item(spark):
    edges = [(r[0], -1 - r[1] % 1000) for r in spark.read.parquet(f"{SF}/lineitem.parquet").select("l_partkey", "l_orderkey").collect()]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    nodes = {x for e in edges for x in e}
    assert {r["id"]: r["component"] for r in run(spark, "g6_connected_components_whole").collect()} == {x: root(x) for x in nodes}
    assert {r["id"] for r in run(spark, "v1_node_degree_whole").collect()} == nodes
    broken = run(spark, "g8_greedy_break_up").collect()
    assert sorted((r["a"], r["b"]) for r in broken) == sorted(edges)
    assert not all(r["kept"] for r in broken)
