"""Results that must not depend on the size of the corpus, and nothing lost without a word."""

import re

import pytest
from pyspark.sql import functions as F

from quarry.operators import graph, search, web
from quarry.operators import index as ix
from quarry.session import scratch_path
from quarry.sources import index_store


def test_tiny_scores_are_ranked_by_value_and_beat_zero(spark):
    rows = [(1, 10, 1e-13), (1, 11, 4e-13), (1, 12, 3e-13), (1, 5, 0.0), (1, 13, 3e-13 * (1 + 1e-14))]
    got = search.top_k_per_query(spark.createDataFrame(rows, "query_id long, doc_id long, score double"), 5).orderBy("pos").collect()
    assert [r["doc_id"] for r in got] == [11, 12, 13, 10, 5]
    negative = [(1, 1, -2.0), (1, 2, -1.0), (1, 3, 0.0), (1, 4, 5.0)]
    got = search.top_k_per_query(spark.createDataFrame(negative, "query_id long, doc_id long, score double"), 4).orderBy("pos").collect()
    assert [r["doc_id"] for r in got] == [4, 3, 2, 1]


def test_ranked_search_keeps_tiny_positive_scores(spark):
    rel = spark.createDataFrame([(1, 30, 1e-9), (1, 20, 2e-9)], "query_id long, doc_id long, relevance double")
    pages = spark.createDataFrame([(i,) for i in (1, 2, 20, 30)], "doc_id long")
    ranks = pages.select(F.col("doc_id").alias("id"), F.lit(1e-12).alias("rank"))
    queries = spark.createDataFrame([(1,)], "query_id long")
    got = search.ranked_search(rel, ranks, pages, queries, 3).orderBy("pos").collect()
    assert [r["doc_id"] for r in got] == [20, 30, 1]


def test_unequal_bucket_counts_open_and_prune_by_their_own(spark):
    paths = []
    for i, buckets in enumerate((4, 9)):
        docs = spark.createDataFrame([(f"d{i}/1", "cat and dog. "), (f"d{i}/2", "cat only. ")], "doc_name string, text string")
        paths.append(scratch_path(spark, "unequal"))
        index_store.write_index(ix.build_index(docs), paths[-1], buckets)
    idx, _ = index_store.open_indexes(spark, paths, validate=True)
    hits = index_store.lookup_words(idx, spark.createDataFrame([("dog",)], "word string"))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*bucket#\d+ (?:IN|=)", plan)) >= 2, plan
    assert sorted((r["index_id"], r["doc_id"]) for r in hits.collect()) == [("0:0", 1), ("1:0", 1)]
    wanted = spark.createDataFrame([("1:0", "dog", 1), ("1:0", "dog", 7)], "index_id string, word string, doc_id long")
    assert [r["positions"] for r in index_store.lookup_positions(idx, wanted).collect()] == [[8]]


def test_interrupted_rewrite_is_not_a_committed_index(spark):
    path = scratch_path(spark, "interrupted")
    one = ix.build_index(spark.createDataFrame([("a", "one cat. ")], "doc_name string, text string"))
    index_store.write_index(one, path, 4)
    two = ix.build_index(spark.createDataFrame([("a", "one cat. "), ("b", "two dogs. ")], "doc_name string, text string"))
    broken = ix.Index(two.doc_table, two.postings.withColumn("n", F.raise_error(F.lit("cut off")).cast("int")))
    with pytest.raises(Exception, match="cut off"):
        index_store.write_index(broken, path, 4)
    with pytest.raises(ValueError):
        index_store.open_index(spark, path, validate=False)


def test_one_document_per_name(spark):
    docs = spark.createDataFrame([("d/1", "beta gamma. "), ("d/1", "alpha alpha. ")], "doc_name string, text string")
    idx = ix.build_index(docs)
    assert idx.doc_table.count() == 1
    got = {r["word"]: r["positions"] for r in idx.postings.collect()}
    assert got == {"alpha": [0, 6]}


def test_text_of_pages_without_body_tag(spark):
    pages = spark.createDataFrame([
        (1, "http://s.org/", "<title>t</title><p>no body tag"),
        (2, "http://s.org/", "<html><head><title>t</title></head><body><p>in</p></body><p>after</p>"),
        (3, "http://s.org/", "<body><noscript>plain </noscript><script>no</script><template>no</template>end</body>"),
        (4, "http://s.org/", "just text")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["words"], r["error"]) for r in web.parse_pages(pages).collect()}
    assert got == {1: (["no", "body", "tag"], None), 2: (["in", "after"], None), 3: (["plain", "end"], None), 4: (["just", "text"], None)}


def test_robots_agents_are_literal_and_texts_of_a_host_are_read_apart(spark):
    robots = spark.createDataFrame([
        ("h", "User-agent: bot (x\nDisallow: /a\nUser-agent: *\nDisallow: /b"),
        ("h", "Disallow: /c\nUser-agent: other\nDisallow: /d"), ("h", "no colon here")], "host string, text string")
    got = {(r["kind"], r["pattern"]) for r in web.parse_robots(robots, "quarrybot").collect()}
    assert got == {("disallow", "/b"), ("disallow", "/c")}
    assert {r["pattern"] for r in web.parse_robots(robots, "bot (x").collect()} == {"/a", "/b", "/c"}


def test_combined_rules_and_content_types(spark):
    rules = spark.createDataFrame([("s.org", "disallow", "/a")], "host string, kind string, pattern string")
    more = spark.createDataFrame([("s.org", "allow", "/a/ok")], "host string, kind string, pattern string")
    urls = spark.createDataFrame([("http://s.org/a/x",), ("http://s.org/a/ok",), ("http://s.org/b",)], "url string")
    got = [r["allowed"] for r in web.robots_filter(urls, web.combine_rules(rules, more)).orderBy("url").collect()]
    assert got == [True, False, True]


def test_absolute_links_are_normalised():
    assert web.resolve_link("http://s.org/", "http://s.org/a/../b/./c") == "http://s.org/b/c"
    assert web.resolve_link("http://s.org/", "http://s.org/../../x/.") == "http://s.org/x/"
    assert web.resolve_link("http://s.org/q/", "../z?k=1#f") == "http://s.org/z?k=1"


def _star():
    return [(0, i) for i in range(1, 12)] + [(i, 0) for i in range(1, 12)]


def test_pagerank_splits_a_hot_source_and_leaves_no_table(spark, monkeypatch):
    nodes = spark.createDataFrame([(i,) for i in range(12)], "id long")
    edges = spark.createDataFrame(_star(), "src long, dst long")
    whole = {r["id"]: r["rank"] for r in graph.pagerank(nodes, edges, epsilon=0, limit=4).collect()}
    monkeypatch.setattr(graph, "LINKS_PER_BUCKET", 2)
    split = {r["id"]: r["rank"] for r in graph.pagerank(nodes, edges, epsilon=0, limit=4).collect()}
    assert whole.keys() == split.keys() and all(abs(whole[i] - split[i]) < 1e-12 for i in whole)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("quarry_")]


def test_rank_step_exchanges_neither_edges_nor_ranks(spark, monkeypatch):
    monkeypatch.setattr(graph, "LINKS_PER_BUCKET", 2)
    nodes = spark.createDataFrame([(i,) for i in range(12)], "id long")
    edges = spark.createDataFrame(_star(), "src long, dst long")
    outdeg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("outdeg"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    made = [graph.bucketed_edges(edges, outdeg, 4), graph.first_ranks(nodes, outdeg, 12, 4)]
    try:
        assert made[0].frame.where("src = 0").select("salt").distinct().count() > 1
        step = graph.rank_step(made[0].frame, made[1].frame, 0.85, 0.0, 0.15 / 12)
        plan = step._jdf.queryExecution().executedPlan().toString()
        # Two exchanges: the sums by target, and their way to the buckets of the ranks.
        assert re.findall(r"Exchange hashpartitioning\((\w+)", plan) == ["src", "dst"], plan
        assert len(re.findall("Bucketed: true", plan)) == 3 and plan.count("SortMergeJoin") == 2, plan
        made.append(graph.BucketedTable.write(step, "ranks", 4))
        files = made[2].frame.select(F.input_file_name().alias("f")).distinct().count()
        assert files <= 4          # one task for each bucket: the next step reads them in place again
        rank = {r["src"]: r["rank"] for r in made[2].frame.collect()}
        assert abs(rank[0] - (0.85 * 11 / 12 + 0.15 / 12)) < 1e-12
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in made:
            t.drop()


def test_crawl_filters_are_joins(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "e")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "id string")
    banned = spark.createDataFrame([("b",)], "id string")
    got = graph.bfs_order(edges, seeds, 10, allow=lambda level: level.join(banned, "id", "left_anti")).collect()
    assert [(r["id"], r["distance"]) for r in got] == [("a", 0), ("c", 1), ("e", 2)]
