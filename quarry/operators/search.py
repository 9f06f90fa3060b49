"""Search operators: every query set is a DataFrame, all queries run in one job.

* and_search      SCH-1/2  AND of all query words, rank = total occurrences (repeats count again)
* tfidf_search    SCH-3    OR of words, score = sum over query tokens of idf * tf
* cosine_search   SCH-4    cosine of TF-IDF vectors; the numerator repeats per query token
* ranked_search   SCH-5/6  cosine * sqrt(PageRank), k best per query, zero scores included (operators/impacts.py
                           finds the positive ones without scoring every pair)

Query words are written first; below Catalyst's byte threshold they are broadcast, so the large
token/posting side is not shuffled on ``word``, and beyond it the join shuffles with skew splitting.  Scores are
aggregated on ``(query_id, doc)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import tokenize as tk
from quarry.functions import urls
from quarry.operators.ordinals import ordinal_within
from quarry.session import sized_side, reliable_checkpoint


# --- fixed values: sentences and lines of a result page (must equal the reference's) ---
NO_RESULTS = "No results found for <b>"
ONE_RESULT = "1 result found for <b>"
MANY_RESULTS = " results found for <b>"
END_OF_HEADER = "</b>"
STATIC_PREFIX = "/static/"
RESULT_LINE = ' <li> <a href="%s">%s</a> [%d]<br>'
# ----------------------------------------------------------------------------------------


def query_tokens(query_log: DataFrame, dialect: str = "count", raw: str = "raw") -> DataFrame:
    """STR-5: (query_id, qi, word) — one row per query token, order kept in ``qi``."""
    return query_log.select("query_id", F.posexplode(tk.query_words(raw, dialect)).alias("qi", "word"))


def _query_sizes(qwords: DataFrame) -> DataFrame:
    return qwords.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_words"))


def _and_core(tc: DataFrame, qwords: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """AND of all query tokens over term counts ``tc(keys..., word, n)`` restricted to the
    query vocabulary.

    Intersection order as in the reference: each query starts from its rarest word (smallest
    document frequency, ties by word); only documents holding it become candidates, and only
    candidates are checked against the other words.  No row is multiplied by the number of
    queries that share a common word.  A query with a word absent from the index has no hits.
    """
    qw = qwords.select("query_id", "qi", "word")
    df = tc.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    per_query = (qw.join(sized_side(df), "word", "left")
                 .groupBy("query_id")
                 .agg(F.min_by("word", F.struct("df", "word")).alias("rare"),
                      F.count_if(F.col("df").isNull()).alias("missing"),
                      F.count(F.lit(1)).alias("n_words"))
                 .where(F.col("missing") == 0))
    per_query = sized_side(per_query)
    candidates = tc.select(*keys, "word").join(
        per_query.select("query_id", F.col("rare").alias("word")), "word").select("query_id", *keys)
    probes = candidates.join(sized_side(qw), "query_id")
    hits = (probes.join(tc.select(*keys, "word", "n"), [*keys, "word"])
            .groupBy("query_id", *keys)
            .agg(F.count(F.lit(1)).alias("matched"), F.sum("n").cast("long").alias("rank")))
    return (hits.join(per_query.select("query_id", "n_words"), "query_id")
            .where(F.col("matched") == F.col("n_words")).select("query_id", *keys, "rank"))


def and_search(postings: DataFrame, qwords: DataFrame, keys: tuple[str, ...] = ("index_id", "doc_id")) -> DataFrame:
    """SCH-1 / SCH-2 / JN-1 / JN-2 over term counts or postings (one row per (doc, word) with ``n``).

    Relational division: a document is a hit when every query token is among its words; rank is
    the sum of the occurrence counts over the query tokens (a repeated token counts again).  AND
    is evaluated inside each index when ``index_id`` is a key.  The postings are first cut to the
    query vocabulary with a broadcast semi join and written once (three consumers below).
    """
    vocab = sized_side(qwords.select("word").distinct())
    tc = reliable_checkpoint(postings.select(*keys, "word", "n").join(vocab, "word", "left_semi"))
    return _and_core(tc, qwords, keys)


def and_search_tokens(tokens: DataFrame, qwords: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """SCH-1 straight from token rows (one per occurrence).  Tokens whose word is in no query
    are dropped by a broadcast semi join before the shuffle (no row is multiplied); the rest are
    counted per (doc, word) with map-side partial aggregation and searched as term counts."""
    vocab = sized_side(qwords.select("word").distinct())
    kept = tokens.select(*keys, "word").join(vocab, "word", "left_semi")
    tc = reliable_checkpoint(kept.groupBy(*keys, "word").agg(F.count(F.lit(1)).cast("int").alias("n")))
    return _and_core(tc, qwords, keys)


def display_rank(hits: DataFrame, score: str = "rank", key: str = "doc_id", name: str = "pos") -> DataFrame:
    """WIN-3 / SRT-1: 1..n per query by score descending, ties by key (skew-safe ordinals)."""
    return ordinal_within(hits, ["query_id"], [F.col(score).desc(), F.col(key).asc()], name)


# Scores that agree in about eleven significant digits are ties (broken by key): summation order
# differs between plans, and must not reorder mathematically equal scores.  The tolerance is relative
# (digits of the logarithm), so it means the same for scores of any magnitude.
TIE_LOG_DIGITS = 11


def score_order(score: str) -> list:
    """Descending order of a score with relative ties: sign first, then magnitude."""
    s = F.col(score)
    size = F.round(F.log10(F.abs(F.when(s != 0, s))), TIE_LOG_DIGITS)
    return [F.signum(s).desc(), F.when(s < 0, -size).otherwise(size).desc()]


def top_k_per_query(scored: DataFrame, k: int, score: str = "score", key: str = "doc_id", name: str = "pos") -> DataFrame:
    """WIN-4: k best per query; Spark inserts a partial WindowGroupLimit before the shuffle, so a
    hot query sends at most k rows per map partition."""
    if k < 0:
        raise ValueError("k must be non-negative")
    w = Window.partitionBy("query_id").orderBy(*score_order(score), F.col(key).asc())
    return scored.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def tfidf_search(tf: DataFrame, idf_df: DataFrame, qwords: DataFrame, key: str = "doc_id") -> DataFrame:
    """SCH-3: documents containing any query token, score = sum over tokens of idf * tf
    (repeated tokens add again; score 0 is kept when df = N)."""
    qw = sized_side(known_idf(idf_df, qwords).join(qwords.select("query_id", "qi", "word"), "word"))
    return (tf.select(key, "word", "tf").join(qw, "word")
            .groupBy("query_id", key)
            .agg(F.sum(F.col("idf") * F.col("tf")).alias("score")))


def known_idf(idf_df: DataFrame, qwords: DataFrame) -> DataFrame:
    """(word, idf) of the query words only: the vocabulary itself is never a join's small side."""
    words = sized_side(qwords.select("word").distinct())
    return idf_df.select("word", "idf").join(words, "word", "left_semi")


def query_vectors(qwords: DataFrame, idf_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Query side of SCH-4: (query_id, word, cnt, qv) for known words and (query_id, qnorm).

    tf uses all query tokens as length (unknown words count in the length, weigh nothing).
    """
    qlen = qwords.groupBy("query_id").agg(F.count(F.lit(1)).alias("qlen"))
    counts = qwords.groupBy("query_id", "word").agg(F.count(F.lit(1)).alias("cnt"))
    qv = (counts.join(qlen, "query_id")
          .join(known_idf(idf_df, qwords), "word")
          .select("query_id", "word", "cnt", (F.col("cnt") / F.col("qlen") * F.col("idf")).alias("qv")))
    qnorm = qv.groupBy("query_id").agg(F.sqrt(F.sum(F.col("qv") * F.col("qv"))).alias("qnorm"))
    return qv, qnorm


def query_term_weights(tf: DataFrame, idf_df: DataFrame, qwords: DataFrame, key: str) -> DataFrame:
    """(key, word, w) of the query words only: all that a search needs of the TF-IDF vectors."""
    idf_side = sized_side(known_idf(idf_df, qwords))
    return tf.select(key, "word", "tf").join(idf_side, "word").select(key, "word", (F.col("tf") * F.col("idf")).alias("w"))


def cosine_search(vectors: DataFrame, doc_norms: DataFrame, idf_df: DataFrame, qwords: DataFrame,
                  key: str = "doc_id") -> DataFrame:
    """SCH-4 / JN-7: (query_id, key, relevance) for documents sharing a known word with the query."""
    qv, qnorm = query_vectors(qwords, idf_df)
    qv = sized_side(qv)
    num = (vectors.select(key, "word", "w").join(qv, "word")
           .groupBy("query_id", key)
           .agg(F.sum(F.col("cnt") * F.col("w") * F.col("qv")).alias("num")))
    den = F.col("norm") * F.col("qnorm")
    return (num.join(doc_norms.select(key, "norm"), key)
            .join(sized_side(qnorm), "query_id")
            .select("query_id", key, F.when(den != 0, F.col("num") / den).otherwise(F.lit(0.0)).alias("relevance")))


def ranked_search(relevance: DataFrame, ranks: DataFrame, pages: DataFrame, queries: DataFrame, k: int = 20,
                  key: str = "doc_id") -> DataFrame:
    """SCH-5 / SCH-6 / JN-12: score = relevance * sqrt(rank) over *every* page, k best per query, from relevances that are
    there already; ``impacts.RankedSearch`` finds the same without scoring every pair.

    ``queries`` has one row per query_id."""
    if k < 0:
        raise ValueError("k must be non-negative")
    checked = ranks.select(F.col("id").alias(key),
                           F.when(F.col("rank") > 0, F.col("rank"))
                           .otherwise(F.raise_error(F.lit("a page without a positive rank"))).alias("prank"))
    scored = (relevance.join(checked, key)
              .select("query_id", key, (F.col("relevance") * F.sqrt("prank")).alias("score")))
    best = reliable_checkpoint(top_k_per_query(scored.where(F.col("score") > 0), k, "score", key).drop("pos"), "best")
    return with_zero_scores(best, pages, queries.select("query_id").distinct().withColumn("k", F.lit(k)), key)


def with_zero_scores(best: DataFrame, pages: DataFrame, limits: DataFrame, key: str = "doc_id") -> DataFrame:
    """query_id, key, score, pos: the best positive scores, filled up with pages of score 0 to each query's own k.

    ``best`` holds at most k rows a query, so a query that needs filling has all of its positive pages in it.  The fill
    comes from the first ``k + |positives|`` pages in key order, below twice the largest k: a bounded top-k
    (TakeOrderedAndProject), so the page table is never sorted, found by an equi-join on the page ordinal.
    ``limits`` has one row per query: query_id, k.
    """
    limits = sized_side(limits.where("k > 0").select("query_id", F.col("k").cast("int").alias("k")))
    most = limits.agg(F.max("k")).first()[0] or 0
    npos = best.groupBy("query_id").agg(F.count(F.lit(1)).cast("int").alias("npos"))
    need = (limits.join(npos, "query_id", "left").withColumn("npos", F.coalesce("npos", F.lit(0))).where(F.col("npos") < F.col("k")))
    first = pages.select(key).distinct().orderBy(key).limit(2 * most)
    ordered_pages = first.withColumn("_ord", F.row_number().over(Window.orderBy(key)))
    slots = need.select("query_id", "npos", "k", F.explode(F.sequence(F.lit(1), F.col("npos") + F.col("k"))).alias("_ord"))
    fill = (slots.join(ordered_pages, "_ord")
            .join(best.select("query_id", key), ["query_id", key], "left_anti"))
    fill = (fill.withColumn("_r", F.row_number().over(Window.partitionBy("query_id").orderBy("_ord")))
            .where(F.col("_r") <= F.col("k") - F.col("npos"))
            .select("query_id", key, F.lit(0.0).alias("score")))
    return top_k_per_query(best.select("query_id", key, "score").unionByName(fill), most, "score", key)


def result_lines(hits: DataFrame, name: str = "doc_name", rank: str = "rank", pos: str = "pos") -> DataFrame:
    """PRJ-2 per hit: link is the name when it starts with http://, else /static/ + name."""
    link = F.when(F.col(name).startswith("http://"), urls.escape_html(F.col(name))) \
        .otherwise(F.concat(F.lit(STATIC_PREFIX), F.col(name)))
    line = F.format_string(RESULT_LINE, link, F.col(name), F.col(rank))
    return hits.select("query_id", pos, line.alias("line"))


def result_headers(query_log: DataFrame, hits: DataFrame, raw: str = "raw") -> DataFrame:
    """PRJ-2 + AGG-16 per query: hit count and the header sentence with the escaped query."""
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_results"))
    n = F.coalesce(F.col("n_results"), F.lit(0)).cast("long")
    q = urls.escape_html(F.trim(F.lower(F.col(raw))))
    header = (F.when(n == 0, F.concat(F.lit(NO_RESULTS), q, F.lit(END_OF_HEADER)))
              .when(n == 1, F.concat(F.lit(ONE_RESULT), q, F.lit(END_OF_HEADER)))
              .otherwise(F.concat(n.cast("string"), F.lit(MANY_RESULTS), q, F.lit(END_OF_HEADER))))
    return (query_log.select("query_id", raw).join(counts, "query_id", "left")
            .select("query_id", n.alias("n_results"), header.alias("header")))
