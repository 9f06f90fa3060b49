from pyspark.sql import functions as F

from quarry.operators import index as ix
from quarry.operators import search

# Golden postings fixture (word -> doc -> positions).
POSTINGS = [
    (1234, "bananas", [100, 200]), (1234, "pears", [300]), (1234, "apples", [400, 500, 600]),
    (5678, "apples", [700]), (5678, "bananas", [800]),
]


def _postings(spark):
    df = spark.createDataFrame(POSTINGS, "doc_id long, word string, positions array<int>")
    return df.select(F.lit("0").alias("index_id"), "word", "doc_id", F.size("positions").alias("n"), "positions")


def _search(spark, queries):
    log = spark.createDataFrame(list(enumerate(queries)), "query_id long, raw string")
    hits = search.and_search(_postings(spark), search.query_tokens(log, "count"))
    out = {i: [] for i in range(len(queries))}
    for r in hits.orderBy("query_id", F.desc("rank"), "doc_id").collect():
        out[r["query_id"]].append((r["doc_id"], r["rank"]))
    return out


def test_and_search_golden(spark):
    got = _search(spark, ["grapes", "pears", "apples", "apples bananas", "bananas apples", "pears bananas", ""])
    assert got[0] == []
    assert got[1] == [(1234, 1)]
    assert [d for d, _ in got[2]] == [1234, 5678]
    assert got[3] == [(1234, 5), (5678, 2)]
    assert got[4] == [(1234, 5), (5678, 2)]
    assert [d for d, _ in got[5]] == [1234]
    assert got[6] == []                       # empty query: no rows


def test_repeated_query_word_counts_again(spark):
    got = _search(spark, ["apples apples"])
    assert got[0] == [(1234, 6), (5678, 2)]


def test_vocabulary(spark):
    assert _postings(spark).select(F.countDistinct("word")).first()[0] == 3


def test_doc_ids_follow_path_components(spark):
    names = spark.createDataFrame([("0", "a.txt"), ("0", "a/b"), ("0", "a!"), ("0", "a/b")], "index_id string, doc_name string")
    dt = ix.assign_doc_ids(names)
    assert [r["doc_name"] for r in dt.orderBy("doc_id").collect()] == ["a/b", "a!", "a.txt"]
    assert [r["doc_id"] for r in dt.orderBy("doc_id").collect()] == [1, 2, 3]


def test_re_adding_keeps_id_and_new_names_continue(spark):
    names = spark.createDataFrame([("0", "x"), ("0", "y")], "index_id string, doc_name string")
    dt = ix.assign_doc_ids(names)
    more = spark.createDataFrame([("0", "y"), ("0", "z"), ("1", "q")], "index_id string, doc_name string")
    dt2 = ix.assign_doc_ids(more, existing=dt)
    got = {(r["index_id"], r["doc_name"]): r["doc_id"] for r in dt2.collect()}
    assert got == {("0", "x"): 1, ("0", "y"): 2, ("0", "z"): 3, ("1", "q"): 1}
    ids = spark.createDataFrame([("0", "z"), ("0", "nope")], "index_id string, doc_name string")
    assert {r["doc_name"]: r["doc_id"] for r in ix.doc_ids(dt2, ids).collect()} == {"z": 3, "nope": 0}


def test_build_index_end_to_end(spark):
    docs = spark.createDataFrame([("d/1", "the cat sat on the mat."), ("d/2", "café au lait."),
                                  ("d/3", "the dog."), ("d/4", "12345")], "doc_name string, text string")
    idx = ix.build_index(docs)
    assert [r["doc_name"] for r in idx.doc_table.orderBy("doc_id").collect()] == ["d/1", "d/3"]
    p = {(r["word"], r["doc_id"]): r["positions"] for r in idx.postings.collect()}
    assert p[("the", 1)] == [0, 15] and p[("mat", 1)] == [19] and p[("dog", 2)] == [4]


def test_skewed_group_ordinals(spark):
    from quarry.operators.ordinals import ordinal_within
    rows = [("hot", i) for i in range(3000)] + [("cold", i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(8)
    out = ordinal_within(df, ["g"], [F.col("v").desc()], "pos")
    got = {(r["g"], r["v"]): r["pos"] for r in out.collect()}
    assert got[("hot", 2999)] == 1 and got[("hot", 0)] == 3000 and got[("cold", 4)] == 1


def test_web_dialect_double_space_finds_nothing(spark):
    log = spark.createDataFrame([(1, "apples  bananas"), (2, "apples bananas")], "query_id long, raw string")
    web = search.and_search(_postings(spark), search.query_tokens(log, "web"))
    shell = search.and_search(_postings(spark), search.query_tokens(log, "count"))
    assert {r["query_id"] for r in web.collect()} == {2}          # the empty word matches nothing
    assert {r["query_id"] for r in shell.collect()} == {1, 2}     # default collapses spaces


def test_same_document_in_two_indices_appears_twice(spark):
    p = _postings(spark)
    two = p.unionByName(p.withColumn("index_id", F.lit("1")))
    log = spark.createDataFrame([(1, "pears")], "query_id long, raw string")
    hits = search.and_search(two, search.query_tokens(log, "count"))
    assert sorted((r["index_id"], r["doc_id"]) for r in hits.collect()) == [("0", 1234), ("1", 1234)]


def test_build_shuffles_the_text_once(spark):
    docs = spark.createDataFrame([("a/1", "the cat sat. "), ("a/2", "the dog ran. ")], "doc_name string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ix.build_index(docs).postings._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "REPARTITION_BY_COL" not in plan, plan
    # Between the documents and their words there is one exchange.
    down = plan[plan.index("Generate posexplode"):]
    assert down[:down.index("Scan ExistingRDD")].count("Exchange ") == 1, plan
