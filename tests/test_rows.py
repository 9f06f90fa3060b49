"""What needs one text only is made where the text is read; keys in several rows are grouped as before."""

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions import tokenize
from quarry.operators import index as ix
from quarry.operators import ordinals, rows, tfidf, web

DOCS = [(1, "The cat, the Dog. tail"), (2, "..one two one "), (3, ""), (4, None), (5, "same text same. "), (5, "same text same. "),
        (5, "other words here now. "), (None, "no key. "), (None, "no key. ")]


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, t string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_of_single_texts_are_not_shuffled(spark):
    docs = _docs(spark).where("doc_id < 5")
    got = ix.document_postings(docs, ["doc_id"], "t")
    assert "Exchange " not in _plan(got) and "Window" not in _plan(got)
    assert {(r["doc_id"], r["word"]): (r["n"], r["positions"]) for r in got.collect()} == {
        (1, "the"): (2, [0, 9]), (1, "cat"): (1, [4]), (1, "dog"): (1, [13]), (2, "one"): (2, [2, 10]), (2, "two"): (1, [6])}
    last = ix.document_postings(docs, ["doc_id"], "t", keep_last_word=True)
    assert [r["positions"] for r in last.where("word = 'tail'").collect()] == [[18]]


@pytest.mark.parametrize("keep", [False, True])
def test_postings_equal_windows_and_grouping(spark, keep):
    docs = _docs(spark).where("doc_id IS NULL OR doc_id < 5 OR t LIKE 'same%'")
    want = ix.word_positions(ix._joined_tokens(docs, ["doc_id"], "t", keep), ["doc_id"])
    got = ix.document_postings(docs, ["doc_id"], "t", keep)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))


@pytest.mark.parametrize("dialect", ["cosine", "tfidf", "count"])
def test_terms_equal_grouping(spark, dialect):
    docs = _docs(spark)
    want = tfidf.term_frequency(tfidf.doc_tokens(docs, "doc_id", "t", dialect), "doc_id")
    got = tfidf.document_terms(docs, "doc_id", "t", dialect)
    assert got.dtypes == want.select(*got.columns).dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
    assert "Exchange " not in _plan(tfidf.document_terms(docs.where("doc_id < 5"), "doc_id", "t", dialect))


def test_a_worker_hands_on_a_slice_at_a_time(spark):
    lists = pa.array([["a", "b", "a"], None, [], ["c"]])
    row, (length, word, cnt) = rows._counted(lists)
    assert sorted(zip(row.to_pylist(), length.to_pylist(), word.to_pylist(), cnt.to_pylist())) == [(0, 3, "a", 2), (0, 3, "b", 1), (3, 1, "c", 1)]
    pages = pd.DataFrame({"page_id": range(200), "uri": ["http://a.example/"] * 200, "html": ["<p>one <a href='/x'>two</a>"] * 200})
    parts = list(web._parse_batches([pages]))
    assert len(parts) > 1 and max(map(len, parts)) <= web.PAGES_AT_ONCE and sum(map(len, parts)) == 200


def test_tasks_of_an_order_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr("quarry.session.ROWS_PER_TASK", 50)
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("g"))
    assert ordinals.in_order(df, [F.col("v").desc()]).rdd.getNumPartitions() == 20
    assert [r["v"] for r in ordinals.in_order(df, [F.col("v").desc()]).collect()] == list(range(999, -1, -1))
    got = ordinals.ordinal_within(df, ["g"], ["v"], "pos").collect()
    for g in range(3):
        assert [r["pos"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["v"])] == list(range(1, sum(r["g"] == g for r in got) + 1))


def test_cosine_words_counted_in_tasks_equal_those_of_the_tokenizer(spark):
    texts = ["The cat, THE dog--cat.", " \t\n\x0b\x0c\r lead", "a\u00a0b a\u2003b\x1cc", "\u0130stanbul \u03a3\u03a3 \u00c9T\u00c9 \u00a1ole! \u3002x", "!!! ... ", "", None,
             "x\x00y 'q' $+<=>^`|~ [a]{b}\\c_d/e@f#g%h&i*j(k)", "\U0001f600 a-b", "one"]
    d = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    want = rows.counted_words(d.select("k", tokenize.cosine_words("t").alias("w")), ["k"], "w")
    got = rows.counted_cosine_words(d, ["k"], "t")
    assert got.schema == want.schema and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 17
