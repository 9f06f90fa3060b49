import pytest
from pyspark.sql import functions as F

from quarry.operators import graph, quality

GRAPHS = {
    1: ("ABCD", ["AB", "AC", "AD", "BA", "CA", "DA"], {"A": .47973, "B": .17342, "C": .17342, "D": .17342}),
    2: ("ABC", ["AB", "BC", "CA"], {"A": .33333, "B": .33333, "C": .33333}),
    3: ("ABCDE", ["AB", "AD", "BC", "BD", "DA", "ED"],
        {"A": .31706, "B": .18719, "C": .13199, "D": .31132, "E": .05244}),
}


@pytest.mark.parametrize("g", [1, 2, 3])
def test_pagerank_golden(spark, g):
    names, edges, want = GRAPHS[g]
    nodes = spark.createDataFrame([(n,) for n in names], "id string")
    links = spark.createDataFrame([(e[0], e[1]) for e in edges], "src string, dst string")
    nodes, links = graph.link_graph(nodes, links)
    ranks = {r["id"]: r["rank"] for r in graph.pagerank(nodes, links, 0.85, 1e-5, 100).collect()}
    for k, v in want.items():
        assert ranks[k] == pytest.approx(v, abs=1e-5)


def test_pagerank_limit_zero_and_checks(spark):
    nodes = spark.createDataFrame([("A",), ("B",)], "id string")
    links = spark.createDataFrame([("A", "B")], "src string, dst string")
    ranks = graph.pagerank(nodes, links, 0.85, 1e-4, 0)
    assert {r["rank"] for r in ranks.collect()} == {0.5}
    checks = {r["check"]: r["violations"] for r in quality.check_ranks(graph.pagerank(nodes, links)).collect()}
    assert checks == {"rank_positive": 0, "rank_sum": 0}


def test_link_graph_drops_self_unknown_and_parallel(spark):
    nodes = spark.createDataFrame([("A",), ("B",)], "id string")
    links = spark.createDataFrame([("A", "A"), ("A", "B"), ("A", "B"), ("B", "Z")], "src string, dst string")
    _, edges = graph.link_graph(nodes, links)
    assert [(r["src"], r["dst"]) for r in edges.collect()] == [("A", "B")]
    _, kept = graph.link_graph(nodes, links, keep_self_links=True)
    assert kept.count() == 2


def test_bfs_order(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 4), (4, 5), (5, 1)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "id long")
    got = [(r["id"], r["distance"]) for r in graph.bfs_order(edges, seeds, 10).collect()]
    assert got == [(1, 0), (2, 1), (3, 1), (4, 2), (5, 3)]
    assert [r["id"] for r in graph.bfs_order(edges, seeds, 2).collect()] == [1, 2]
    visited = spark.createDataFrame([(3,)], "id long")
    assert [r["id"] for r in graph.bfs_order(edges, seeds, 10, visited=visited).collect()] == [1, 2, 4, 5]


def test_buckets_follow_the_links(spark, monkeypatch):
    nodes = spark.range(60).select("id")
    links = nodes.crossJoin(spark.range(60).withColumnRenamed("id", "dst")).select(F.col("id").alias("src"), "dst")
    want = {r["id"]: r["rank"] for r in graph.pagerank(*graph.link_graph(nodes, links), 0.85, 0.0, 3).collect()}
    monkeypatch.setattr("quarry.session.ROWS_PER_TASK", 100)
    written = []
    write = graph.BucketedTable.write.__func__
    monkeypatch.setattr(graph.BucketedTable, "write", classmethod(lambda cls, df, kind, n: written.append(n) or write(cls, df, kind, n)))
    got = {r["id"]: r["rank"] for r in graph.pagerank(*graph.link_graph(nodes, links), 0.85, 0.0, 3).collect()}
    assert set(written) == {36} and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
