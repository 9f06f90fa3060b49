import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import search, tfidf

PAGES = [("a", "the mouse played with the cat"),
         ("b", "the quick brown fox jumped over the lazy dog"),
         ("c", "dog 1 and dog 2 ate the hot dog")]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(PAGES, "uri string, text string")
    return tfidf.Model(docs, "uri", "text", "cosine", materialise=False)


def test_vectors_golden(model):
    v = {(r["uri"], r["word"]): r["w"] for r in model.vectors.collect()}
    assert v[("a", "the")] == pytest.approx(0.0, abs=1e-6)
    for w in ("mouse", "played", "with", "cat"):
        assert v[("a", w)] == pytest.approx(0.183102, abs=1e-6)
    for w in ("quick", "brown", "fox", "jumped", "over", "lazy"):
        assert v[("b", w)] == pytest.approx(0.122068, abs=1e-6)
    assert v[("b", "dog")] == pytest.approx(0.045052, abs=1e-6)
    assert v[("c", "dog")] == pytest.approx(0.135155, abs=1e-6)


def test_cosine_relevance_golden(spark, model):
    log = spark.createDataFrame([(1, "the 1 cat")], "query_id long, raw string")
    qw = search.query_tokens(log, "cosine")
    rel = {r["uri"]: r["relevance"] for r in search.cosine_search(model.vectors, model.norms, model.idf, qw, "uri").collect()}
    assert rel["a"] == pytest.approx(0.353553, abs=1e-6)
    assert rel.get("b", 0.0) == pytest.approx(0.0, abs=1e-6)
    assert rel["c"] == pytest.approx(0.283389, abs=1e-6)


def test_unknown_query_word_counts_in_length(spark, model):
    log = spark.createDataFrame([(1, "cat zebra")], "query_id long, raw string")
    qw = search.query_tokens(log, "cosine")
    rel = {r["uri"]: r["relevance"] for r in search.cosine_search(model.vectors, model.norms, model.idf, qw, "uri").collect()}
    assert set(rel) == {"a"} and rel["a"] > 0


def test_python_dialect(spark):
    docs = spark.createDataFrame([(1, "Dogs love to run in the park all day"), (2, "Cats are very cute!"),
                                  (3, "dogs, dogs bark")], "doc_id long, text string")
    m = tfidf.Model(docs, "doc_id", "text", "tfidf", materialise=False)
    idf = {r["word"]: r["idf"] for r in m.idf.collect()}
    assert idf["dogs"] == pytest.approx(math.log(3 / 2))
    log = spark.createDataFrame([(1, "dogs"), (2, "Cats very cute"), (3, "happy")], "query_id long, raw string")
    res = search.tfidf_search(m.tf, m.idf, search.query_tokens(log, "tfidf"))
    got = {}
    for r in res.orderBy("query_id", F.desc("score"), "doc_id").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    assert got == {1: [3, 1], 2: [2]}


def test_python_tf(spark):
    docs = spark.createDataFrame([(1, "the cutest\ncutest dog")], "doc_id long, text string")
    m = tfidf.Model(docs, "doc_id", "text", "tfidf", materialise=False)
    tf = {r["word"]: r["tf"] for r in m.tf.collect()}
    assert tf == {"the": 0.25, "cutest": 0.5, "dog": 0.25}


def test_vector_maps(spark, model):
    maps = {r["uri"]: r for r in tfidf.vector_maps(model.vectors, "uri")
            .select("uri", tfidf.vector_weight("vector", "cat").alias("cat"),
                    tfidf.vector_weight("vector", "zebra", -1.0).alias("zebra"),
                    F.map_contains_key("vector", "dog").alias("has_dog")).collect()}
    assert maps["a"]["cat"] == pytest.approx(0.183102, abs=1e-6) and maps["a"]["zebra"] == -1.0
    assert maps["c"]["has_dog"] and not maps["a"]["has_dog"]
