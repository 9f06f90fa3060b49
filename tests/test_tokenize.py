from pyspark.sql import functions as F

from quarry.functions import tokenize as tk
from quarry.operators import index as ix


def _one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first()["x"]


def test_count_words_drop_word_at_end(spark):
    # A letter run that reaches the end of the text is not a word (Q-1).
    assert _one(spark, tk.count_words, "The  Fox  Can't   CATCH the  Chicken") == \
        ["the", "fox", "can", "t", "catch", "the"]
    assert _one(spark, tk.count_words, "The Chicken.") == ["the", "chicken"]


def test_c_string_and_ascii(spark):
    df = spark.createDataFrame([("ab\x00cd ",), ("café ",), ("123 456",), ("",)], "t string")
    rows = df.select(tk.c_string("t").alias("c"), tk.is_ascii("t").alias("a"),
                     tk.has_count_words(tk.c_string("t")).alias("w")).collect()
    assert rows[0]["c"] == "ab" and rows[0]["w"] is False      # text after NUL ignored; "ab" ends the text
    assert rows[1]["a"] is False                                 # non-ASCII document dropped
    assert rows[2]["w"] is False                                 # digits only: no words
    assert rows[3]["w"] is False                                 # empty text


def test_positions_are_byte_offsets(spark):
    text = "  The  Fox  Can't   CATCH the  Chicken."
    docs = spark.createDataFrame([(1, text)], "doc_id long, t string")
    got = [(r["word"], r["pos"]) for r in ix.positioned_tokens(docs, ["doc_id"], "t").orderBy("pos").collect()]
    assert got == [("the", 2), ("fox", 7), ("can", 12), ("t", 16), ("catch", 20), ("the", 26), ("chicken", 31)]
    assert all(text[p:p + len(w)].lower() == w for w, p in got)


def test_keep_last_word_option(spark):
    docs = spark.createDataFrame([(1, "alpha beta")], "doc_id long, t string")
    assert [r["word"] for r in ix.positioned_tokens(docs, ["doc_id"], "t").collect()] == ["alpha"]
    assert sorted(r["word"] for r in ix.positioned_tokens(docs, ["doc_id"], "t", keep_last_word=True).collect()) == \
        ["alpha", "beta"]


def test_cosine_words(spark):
    assert _one(spark, tk.cosine_words, "  Can't STOP -- won't stop!\tok") == ["cant", "stop", "wont", "stop", "ok"]


def test_tfidf_words_keep_empty_terms(spark):
    assert _one(spark, tk.tfidf_words, " Hello, -- World_1 ") == ["hello", "", "world_1"]
    assert _one(spark, tk.tfidf_words, " 　 ") == []


def test_query_dialects(spark):
    q = "Report  normal"
    df = spark.createDataFrame([(q,)], "raw string")
    assert df.select(tk.query_words("raw", "count")).first()[0] == ["report", "normal"]
    assert df.select(tk.query_words("raw", "web")).first()[0] == ["report", "", "normal"]
