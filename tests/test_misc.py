import pytest
from pyspark.sql import functions as F

from quarry.operators import graph, index as ix, quality, tfidf


def test_unique_words(spark):
    tok = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "doc long, word string")
    assert sorted(tuple(r) for r in tfidf.unique_words(tok, "doc").collect()) == [(1, "a"), (1, "b"), (2, "a")]


def test_lookup_positions(spark):
    docs = spark.createDataFrame([("d/1", "the cat and the hat. ")], "doc_name string, text string")
    idx = ix.build_index(docs)
    assert [r["positions"] for r in ix.lookup_positions(idx.postings, "the", 1).collect()] == [[0, 12]]
    assert ix.lookup_positions(idx.postings, "dog", 1).count() == 0


def test_rank_of_unknown_raises(spark):
    ranks = spark.createDataFrame([("A", 0.5)], "id string, rank double")
    assert graph.rank_of(ranks, spark.createDataFrame([("A",)], "id string")).first()["rank"] == 0.5
    with pytest.raises(Exception):
        graph.rank_of(ranks, spark.createDataFrame([("Z",)], "id string")).collect()


def test_approx_equal(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.25)], "k long, v double")
    b = spark.createDataFrame([(1, 0.5004), (2, 0.2499)], "k long, v double")
    c = spark.createDataFrame([(1, 0.6), (2, 0.25)], "k long, v double")
    assert quality.approx_equal(a, b, ["k"], "v")
    assert not quality.approx_equal(a, c, ["k"], "v")
    assert not quality.approx_equal(a, a.where(F.col("k") == 1), ["k"], "v")
