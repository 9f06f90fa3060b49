"""Property tests: Spark operators against brute-force Python models of the reference loops."""

import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import index as ix
from quarry.operators import search

ALPHABET = string.ascii_letters[:6] + " .,'\n-1"
texts = st.text(alphabet=ALPHABET, max_size=60)


def c_words(text: str):
    """The reference's byte loop: a letter run becomes a word when a non-letter follows it."""
    out, start = [], 0
    for i, ch in enumerate(text):
        if not ch.isalpha():
            if i > start:
                out.append((text[start:i].lower(), start))
            start = i + 1
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=5))
def test_positions_match_byte_loop(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, t string")
    got = sorted((r["doc_id"], r["word"], r["pos"]) for r in ix.positioned_tokens(df, ["doc_id"], "t").collect())
    want = sorted((i, w, p) for i, t in enumerate(docs) for w, p in c_words(t))
    assert got == want


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=1, max_size=5),
       st.lists(st.lists(st.sampled_from(["a", "b", "ab", "ba", "c", "zz"]), max_size=3), min_size=1, max_size=3))
def test_and_search_matches_brute_force(spark, docs, queries):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, t string")
    log = spark.createDataFrame([(q, " ".join(ws)) for q, ws in enumerate(queries)], "query_id long, raw string")
    tokens = ix.word_tokens(df, ["doc_id"], "t")
    got = sorted((r["query_id"], r["doc_id"], r["rank"])
                 for r in search.and_search_tokens(tokens, search.query_tokens(log, "count")).collect())
    want = []
    for q, ws in enumerate(queries):
        if not ws:
            continue
        for d, t in enumerate(docs):
            counts = {}
            for w, _ in c_words(t):
                counts[w] = counts.get(w, 0) + 1
            if all(w in counts for w in ws):
                want.append((q, d, sum(counts[w] for w in ws)))
    assert got == sorted(want)
