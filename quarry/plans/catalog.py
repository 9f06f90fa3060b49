"""Named queries over the driver tables: Spark plan + DuckDB oracle SQL for each.

Every query reads the given tables (or frames Spark derives from them) in full; doubles are
rounded to 6 digits on both sides so the value hash is stable across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import tokenize as tk
from quarry.functions import urls
from quarry.operators import graph, impacts
from quarry.operators import index as ix
from quarry.operators import crawl as crawling
from quarry.operators import quality, search, tfidf, web
from quarry.operators.ordinals import next_within
from quarry.operators.topk import top_k
from quarry.plans import sql
from quarry.plans import tables as tb
from quarry.session import reliable_checkpoint, scratch_path, shuffles_end_with_their_job, sized_side
from quarry.sources import index_store, page_files, querylog, segments
from quarry.streaming import stream as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ------------------------------------------------------------------ count dialect: AND search

def _count_docs(spark, sf_dir) -> DataFrame:
    return ix.indexable_docs(tb.documents(spark, sf_dir), "doc_name", "text", carry=("doc_id", "source"))


@register("and_search", f"""
WITH {sql.QUERY_LOG}, {sql.query_words('count')}, {sql.COUNT_DOCS}, {sql.COUNT_TOKENS},
tc AS (SELECT doc_id, word, count(*) AS n FROM tok GROUP BY ALL),
nq AS (SELECT query_id, count(*) AS n_words FROM qw GROUP BY ALL),
h AS (SELECT qw.query_id, tc.doc_id, count(*) AS matched, sum(tc.n) AS rank FROM qw JOIN tc USING (word) GROUP BY ALL)
SELECT h.query_id, h.doc_id, CAST(h.rank AS BIGINT) AS rank FROM h JOIN nq USING (query_id) WHERE matched = n_words
""")
def and_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCH-1 over documents: AND of the words of each logged query, rank = occurrences."""
    docs = _count_docs(spark, sf_dir)
    tokens = ix.word_tokens(docs, ["doc_id"], "t")
    qw = search.query_tokens(tb.query_log(spark, sf_dir), "count")
    return search.and_search_tokens(tokens, qw, ("doc_id",))


@register("and_search_multi_index", f"""
WITH {sql.QUERY_LOG}, {sql.query_words('count')}, {sql.COUNT_DOCS}, {sql.COUNT_TOKENS},
tc AS (SELECT ad.source AS index_id, ad.doc_name, tok.word, count(*) AS n
       FROM tok JOIN ad USING (doc_id) GROUP BY ALL),
nq AS (SELECT query_id, count(*) AS n_words FROM qw GROUP BY ALL),
h AS (SELECT qw.query_id, tc.index_id, tc.doc_name, count(*) AS matched, sum(tc.n) AS rank
      FROM qw JOIN tc USING (word) GROUP BY ALL)
SELECT h.query_id, h.index_id, h.doc_name, CAST(h.rank AS BIGINT) AS rank
FROM h JOIN nq USING (query_id) WHERE matched = n_words
""")
def and_search_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCH-2 / SET-1 / JN-3: one index per source, AND inside each index, names via doc tables."""
    idx = ix.build_index(tb.documents(spark, sf_dir), "doc_name", "text", index_id="source")
    qw = search.query_tokens(tb.query_log(spark, sf_dir), "count")
    hits = search.and_search(idx.postings, qw, ("index_id", "doc_id"))
    return ix.doc_names(idx.doc_table, hits).select("query_id", "index_id", "doc_name", "rank")


@register("doc_table", f"""
WITH {sql.COUNT_DOCS}, {sql.DOC_TABLE}
SELECT CAST(doc_id AS BIGINT) AS doc_id, doc_name FROM dt
""")
def doc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-1 / AGG-9: dense ids 1..N over indexed documents, in path-component order."""
    d = ix.indexable_docs(tb.documents(spark, sf_dir), "doc_name", "text")
    return ix.assign_doc_ids(d.select("index_id", "doc_name")).select("doc_id", "doc_name")


@register("doc_table_per_index", f"""
WITH {sql.COUNT_DOCS}, {sql.DOC_TABLE}
SELECT index_id, CAST(local_id AS BIGINT) AS doc_id, doc_name FROM dt
""")
def doc_table_per_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-1 per index (each source has its own id space)."""
    d = ix.indexable_docs(tb.documents(spark, sf_dir), "doc_name", "text", index_id="source")
    return ix.assign_doc_ids(d.select("index_id", "doc_name"))


@register("doc_lookup", f"""
WITH {sql.COUNT_DOCS}, {sql.DOC_TABLE}
SELECT cd.doc_name, CAST(coalesce(dt.doc_id, 0) AS BIGINT) AS doc_id FROM cd LEFT JOIN dt USING (doc_name)
""")
def doc_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-4: every document name -> its id, 0 when the document was not indexed."""
    docs = tb.documents(spark, sf_dir)
    d = ix.indexable_docs(docs, "doc_name", "text")
    dt = ix.assign_doc_ids(d.select("index_id", "doc_name"))
    names = docs.select(F.lit("0").alias("index_id"), "doc_name")
    return ix.doc_ids(dt, names).select("doc_name", "doc_id")


@register("word_positions", f"""
WITH {sql.COUNT_DOCS}, {sql.COUNT_POSITIONS}
SELECT doc_id, word, pos FROM pos
""")
def word_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1 + WIN-2: every word occurrence with its byte offset."""
    return ix.positioned_tokens(_count_docs(spark, sf_dir), ["doc_id"], "t")


@register("postings", f"""
WITH {sql.COUNT_DOCS}, {sql.COUNT_POSITIONS}
SELECT word, doc_id, CAST(count(*) AS INTEGER) AS n, list(pos ORDER BY pos) AS positions FROM pos GROUP BY ALL
""")
def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-4 / AGG-5 / AGG-13: word -> doc -> ascending positions."""
    return ix.document_postings(_count_docs(spark, sf_dir), ["doc_id"], "t").select("word", "doc_id", "n", "positions")


@register("vocab_size", f"""
WITH {sql.COUNT_DOCS}, {sql.COUNT_TOKENS}
SELECT CAST(count(DISTINCT word) AS BIGINT) AS vocab_size, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs FROM tok
""")
def vocab_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-8 / AGG-9: distinct words and indexed documents."""
    docs = _count_docs(spark, sf_dir).select("doc_id", F.array_distinct(tk.count_words("t")).alias("ws"))
    words = docs.select(F.explode_outer("ws").alias("word")).where("word IS NOT NULL").distinct()
    counts = words.agg(F.count(F.lit(1)).alias("w"), F.lit(0).cast("long").alias("d")).unionByName(
        docs.where(F.size("ws") > 0).agg(F.lit(0).cast("long").alias("w"), F.count(F.lit(1)).alias("d")))
    return counts.agg(F.sum("w").alias("vocab_size"), F.sum("d").alias("n_docs"))


@register("document_frequency", f"""
WITH {sql.COUNT_DOCS}, {sql.COUNT_TOKENS}
SELECT word, CAST(count(DISTINCT doc_id) AS BIGINT) AS df FROM tok GROUP BY word
""")
def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-6 over the count-dialect index."""
    tc = ix.term_counts(ix.word_tokens(_count_docs(spark, sf_dir), ["doc_id"], "t"), ["doc_id"])
    return tc.groupBy("word").agg(F.count(F.lit(1)).alias("df"))


# ------------------------------------------------------------------ cosine dialect: TF-IDF model

def _cosine_model(spark, sf_dir) -> tfidf.Model:
    return tfidf.Model(tb.table(spark, sf_dir, "documents"), "doc_id", "text", "cosine")


@register("term_frequency", f"""
WITH {sql.cosine_model()}
SELECT k AS doc_id, word, CAST(cnt AS BIGINT) AS cnt, round(tf, 6) AS tf FROM ctf
""")
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-1/2/3: occurrences / document length."""
    m = _cosine_model(spark, sf_dir)
    return m.tf.select("doc_id", "word", "cnt", _r6("tf").alias("tf"))


@register("idf", f"""
WITH {sql.cosine_model()}
SELECT word, CAST(df AS BIGINT) AS df, round(idf, 6) AS idf FROM cidf
""")
def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-6/7: ln(N / df), N = all documents."""
    m = _cosine_model(spark, sf_dir)
    return m.idf.select("word", "df", _r6("idf").alias("idf"))


@register("tfidf_vectors", f"""
WITH {sql.cosine_model()}
SELECT k AS doc_id, word, round(w, 6) AS w FROM cvec
""")
def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-12 / JN-6: tf * idf for every (document, word), zeros kept."""
    m = _cosine_model(spark, sf_dir)
    return m.vectors.select("doc_id", "word", _r6("w").alias("w"))


@register("doc_norms", f"""
WITH {sql.cosine_model()}
SELECT d.doc_id, round(coalesce(cnorm.norm, 0), 6) AS norm FROM documents d LEFT JOIN cnorm ON cnorm.k = d.doc_id
""")
def doc_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10: L2 norm of each document vector (0 for a wordless document)."""
    m = _cosine_model(spark, sf_dir)
    docs = tb.table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(m.norms, "doc_id", "left").select("doc_id", _r6(F.coalesce("norm", F.lit(0.0))).alias("norm"))


def _relevance_sql(key: str = "doc_id", table: str = "documents", text: str = "text") -> str:
    return f"""{sql.QUERY_LOG}, {sql.query_words('cosine')}, {sql.cosine_model(key, table, text)},
qcnt AS (SELECT query_id, word, count(*) AS cnt FROM qw GROUP BY ALL),
qlen AS (SELECT query_id, count(*) AS qlen FROM qw GROUP BY ALL),
qv AS (SELECT query_id, word, cnt, cnt / qlen * idf AS qv FROM qcnt JOIN qlen USING (query_id) JOIN cidf USING (word)),
qn AS (SELECT query_id, sqrt(sum(qv * qv)) AS qnorm FROM qv GROUP BY ALL),
num AS (SELECT query_id, k, sum(cnt * w * qv) AS num FROM qv JOIN cvec USING (word) GROUP BY ALL),
rel AS (SELECT query_id, k, CASE WHEN norm * qnorm <> 0 THEN num / (norm * qnorm) ELSE 0 END AS relevance
        FROM num JOIN cnorm USING (k) JOIN qn USING (query_id))"""


_COSINE_REL = _relevance_sql()


@register("cosine_search", f"""
WITH {_COSINE_REL}
SELECT query_id, k AS doc_id, round(relevance, 6) AS relevance FROM rel
""")
def cosine_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCH-4 / JN-7: cosine relevance of each logged query to each document sharing a word."""
    m = _cosine_model(spark, sf_dir)
    qw = search.query_tokens(tb.query_log(spark, sf_dir), "cosine")
    rel = search.cosine_search(search.query_term_weights(m.tf, m.idf, qw, "doc_id"), m.norms, m.idf, qw, "doc_id")
    return rel.select("query_id", "doc_id", _r6("relevance").alias("relevance"))


@register("tfidf_search", f"""
WITH {sql.QUERY_LOG}, {sql.query_words('tfidf')}, {sql.tfidf_model()}
SELECT qw.query_id, ptf.k AS doc_id, round(sum(pidf.idf * ptf.tf), 6) AS score
FROM qw JOIN pidf USING (word) JOIN ptf USING (word) GROUP BY ALL
""")
def tfidf_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCH-3 / STR-3 / STR-4: OR search, score = sum over query tokens of idf * tf."""
    m = tfidf.Model(tb.table(spark, sf_dir, "documents"), "doc_id", "text", "tfidf")
    qw = search.query_tokens(tb.query_log(spark, sf_dir), "tfidf")
    res = search.tfidf_search(m.tf, m.idf, qw, "doc_id")
    return res.select("query_id", "doc_id", _r6("score").alias("score"))


# ------------------------------------------------------------------ link graph and PageRank

def _part_graph(spark, sf_dir):
    nodes, links = tb.part_links(spark, sf_dir)
    return graph.link_graph(nodes, links)


@register("link_graph", f"""
{sql.PART_GRAPH_EDGES}
""")
def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-1 / JN-8 / SET-3: distinct part-succession edges between known parts, no self-links."""
    return _part_graph(spark, sf_dir)[1]


@register("pagerank", f"""
WITH {sql.pagerank_unrolled(sql.PART_GRAPH_NODES, sql.PART_GRAPH_EDGES, 5)}
SELECT id, round(rank * (SELECT n FROM pcnt), 6) AS rank FROM pr5
""")
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-2 with limit 5 and epsilon 0 (so the oracle can unroll the steps); ranks as multiples of 1/N,
    so that rounding means the same on graphs of any size."""
    nodes, edges = _part_graph(spark, sf_dir)
    return _scaled(graph.pagerank(nodes, edges, 0.85, 0.0, 5), nodes.count())


def _scaled(ranks: DataFrame, n: int) -> DataFrame:
    return ranks.select("id", F.round(F.col("rank") * n, 6).alias("rank"))


_STEPS, _SHARE = 16, 0.02


@register("pagerank_converged", f"""
WITH {sql.pagerank_unrolled(sql.PART_GRAPH_NODES, sql.PART_GRAPH_EDGES, _STEPS, decay=0.5)},
{", ".join(f"dl{s} AS (SELECT max(abs(a.rank - b.rank)) AS d FROM pr{s} a JOIN pr{s - 1} b USING (id))" for s in range(1, _STEPS + 1))},
stop AS (SELECT min(s) AS s FROM ({" UNION ALL ".join(f"SELECT {s} AS s, d FROM dl{s}" for s in range(1, _STEPS + 1))})
         WHERE d <= {_SHARE} / (SELECT n FROM pcnt))
{" UNION ALL ".join(f"SELECT id, round(rank * (SELECT n FROM pcnt), 6) AS rank FROM pr{s - 1} WHERE (SELECT s FROM stop) = {s}"
                    for s in range(1, _STEPS + 1))}
""")
def pagerank_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-2 run to convergence with an epsilon that is a share of the mean rank 1/N, and a decay of 0.5 so that
    the oracle can unroll all of its steps."""
    nodes, edges = _part_graph(spark, sf_dir)
    n = nodes.count()
    return _scaled(graph.pagerank(nodes, edges, 0.5, _SHARE / max(1, n)), n)


@register("ranked_search_topk", f"""
WITH {_COSINE_REL}, {sql.pagerank_unrolled(sql.DOC_GRAPH_NODES, sql.DOC_GRAPH_EDGES, 5)},
allq AS (SELECT DISTINCT query_id FROM ql),
sc AS (SELECT q.query_id, d.doc_id, coalesce(rel.relevance, 0) * sqrt(pr5.rank) AS score
       FROM allq q CROSS JOIN documents d JOIN pr5 ON pr5.id = d.doc_id
       LEFT JOIN rel ON rel.query_id = q.query_id AND rel.k = d.doc_id)
SELECT query_id, doc_id, round(score * sqrt((SELECT n FROM pcnt)), 6) AS score, CAST(pos AS INTEGER) AS pos FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id
     ORDER BY CASE WHEN score > 0 THEN round(log10(score), 11) END DESC NULLS LAST, doc_id) AS pos FROM sc)
WHERE pos <= 20
""")
def ranked_search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCH-5 / SCH-6 / WIN-4: cosine * sqrt(PageRank) over every document, 20 best, from an impact index whose bounds say
    which words need not be read; the score is reported times sqrt(N), so that rounding means the same for corpora of
    any size."""
    with shuffles_end_with_their_job(spark):
        m = _cosine_model(spark, sf_dir)
        ql = tb.query_log(spark, sf_dir)
        qw = search.query_tokens(ql, "cosine")
        nodes, links = tb.doc_links(spark, sf_dir)
        nodes, edges = graph.link_graph(nodes, links)
        ranks = graph.pagerank(nodes, edges, 0.85, 0.0, 5)
        index = impacts.write_impacts(m.tf, m.idf, m.norms, ranks, scratch_path(spark, "impacts"), "doc_id")
        limits = ql.select("query_id").distinct().withColumn("k", F.lit(20))
        best = impacts.RankedSearch(index, impacts.query_weights(qw, m.idf), limits).best("doc_id").drop("pos")
    pages = tb.table(spark, sf_dir, "documents").select("doc_id")
    top = search.with_zero_scores(best, pages, limits, "doc_id")
    return top.select("query_id", "doc_id", _r6(F.col("score") * float(pages.count()) ** 0.5).alias("score"),
                      F.col("pos").cast("int").alias("pos"))


# ------------------------------------------------------------------ batch queries and result pages

_AND_HITS = f"""{sql.QUERY_LOG}, {sql.query_words('count')}, {sql.COUNT_DOCS}, {sql.COUNT_TOKENS},
tc AS (SELECT doc_id, word, count(*) AS n FROM tok GROUP BY ALL),
nq AS (SELECT query_id, count(*) AS n_words FROM qw GROUP BY ALL),
h0 AS (SELECT qw.query_id, tc.doc_id, count(*) AS matched, sum(tc.n) AS rank FROM qw JOIN tc USING (word) GROUP BY ALL),
h AS (SELECT h0.query_id, h0.doc_id, CAST(h0.rank AS BIGINT) AS rank,
             row_number() OVER (PARTITION BY h0.query_id ORDER BY h0.rank DESC, h0.doc_id) AS pos
      FROM h0 JOIN nq USING (query_id) WHERE matched = n_words)"""


def _batch_hits(spark, sf_dir) -> DataFrame:
    hits = and_search(spark, sf_dir)
    return search.display_rank(hits, "rank", "doc_id", "pos")


@register("batch_query_log", f"""
WITH {_AND_HITS}
SELECT query_id, doc_id, rank, CAST(pos AS BIGINT) AS pos FROM h
""")
def batch_query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCH-7 / WIN-3 / SRT-1: all logged queries in one job, hits numbered 1..n per query."""
    return _batch_hits(spark, sf_dir).select("query_id", "doc_id", "rank", "pos")


_ESC = ("replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
        "'''', '&apos;'), '\"', '&quot;')")


@register("result_page", f"""
WITH {_AND_HITS}, cnt AS (SELECT query_id, count(*) AS n FROM h GROUP BY ALL)
SELECT ql.query_id, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_results,
  CASE WHEN coalesce(cnt.n, 0) = 0 THEN '{search.NO_RESULTS}' || {_ESC.format(x='trim(lower(raw))')} || '{search.END_OF_HEADER}'
       WHEN cnt.n = 1 THEN '{search.ONE_RESULT}' || {_ESC.format(x='trim(lower(raw))')} || '{search.END_OF_HEADER}'
       ELSE CAST(cnt.n AS VARCHAR) || '{search.MANY_RESULTS}' || {_ESC.format(x='trim(lower(raw))')} || '{search.END_OF_HEADER}' END
  AS header
FROM ql LEFT JOIN cnt USING (query_id)
""")
def result_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-2 / AGG-16 / STR-8: per query the hit count and the escaped header sentence."""
    return search.result_headers(tb.query_log(spark, sf_dir), and_search(spark, sf_dir))


@register("result_lines", f"""
WITH {_AND_HITS}
SELECT h.query_id, CAST(h.pos AS BIGINT) AS pos,
  printf('{search.RESULT_LINE}', '{search.STATIC_PREFIX}' || d.doc_name, d.doc_name, h.rank) AS line
FROM h JOIN cd d USING (doc_id)
""")
def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-2 per hit: list line with the link (/static/ + name for non-http names) and the rank."""
    hits = _batch_hits(spark, sf_dir).join(tb.documents(spark, sf_dir).select("doc_id", "doc_name"), "doc_id")
    return search.result_lines(hits, "doc_name", "rank", "pos")


@register("rounded_average", """
SELECT l_partkey, CAST(floor(avg(l_quantity) + 0.5) AS BIGINT) AS avg_quantity FROM lineitem GROUP BY l_partkey
""")
def rounded_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH-2: mean quantity per part rounded half-up."""
    from quarry.operators.topk import rounded_average as ravg
    return ravg(tb.table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_quantity", "avg_quantity")


@register("topk", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500
""")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-4: the 500 largest order totals (reported ascending)."""
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_k(orders, "o_totalprice", 500, tiebreak="o_orderkey")


# ------------------------------------------------------------------ URLs, filters and robots rules

def _decode_sql(x: str) -> str:
    code = ("((instr('0123456789ABCDEF', upper(substr(p, 2, 1))) - 1) * 16 "
            "+ instr('0123456789ABCDEF', upper(substr(p, 3, 1))) - 1)")
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(?s)(%[0-9A-Fa-f]{{2}}|.)', 1), "
            f"lambda p: CASE WHEN p = '+' THEN ' ' WHEN length(p) = 3 AND {code} BETWEEN 32 AND 127 "
            f"THEN chr(CAST({code} AS INTEGER)) ELSE p END), '')")


_HOST_SQL = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)"
_SUBJECT_SQL = ("regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) || "
                "CASE WHEN regexp_matches(url, '^[^?#]*\\?') THEN '?' || regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) "
                "ELSE '' END")


@register("url_decode", f"""
SELECT page_id, {_decode_sql("split_part(url, '?', 1)")} AS path, {_decode_sql('url')} AS decoded FROM pages
""")
def url_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-6: server-style decode of every page URL and of its path."""
    p = tb.table(spark, sf_dir, "pages")
    return p.select("page_id", urls.url_path("url").alias("path"), urls.url_decode("url").alias("decoded"))


@register("url_args", f"""
WITH a AS (SELECT page_id, unnest(string_split(split_part(url, '?', 2), '&')) AS kv,
                  unnest(generate_series(0, len(string_split(split_part(url, '?', 2), '&')) - 1)) AS i
           FROM pages WHERE len(string_split(url, '?')) >= 2),
e AS (SELECT page_id, i, {_decode_sql("string_split(kv, '=')[1]")} AS k, {_decode_sql("string_split(kv, '=')[2]")} AS v
      FROM a WHERE len(string_split(kv, '=')) = 2)
SELECT page_id, k AS arg_key, arg_max(v, i) AS arg_value FROM e GROUP BY page_id, k
""")
def url_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-7: query arguments of every page URL, decoded, a later key wins (long form)."""
    p = tb.table(spark, sf_dir, "pages").select("page_id", urls.url_arg_pairs("url").alias("a"))
    # Within the row: of each key the last pair stays.
    last = F.filter("a", lambda x: ~F.exists("a", lambda y: (y["key"] == x["key"]) & (y["i"] > x["i"])))
    return (p.select("page_id", F.explode(last).alias("a"))
            .select("page_id", F.col("a.key").alias("arg_key"), F.col("a.value").alias("arg_value")))


@register("host_filter", f"""
WITH h AS (SELECT {_HOST_SQL} AS host, count(*) AS n FROM pages GROUP BY 1 HAVING count(*) >= 2)
SELECT page_id, url FROM pages WHERE {_HOST_SQL} IN (SELECT host FROM h)
""")
def host_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-4: pages whose host is whitelisted; the whitelist is every host with two or more pages."""
    p = tb.table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = (p.select(urls.url_host("url").alias("host")).groupBy("host").count()
             .where(F.col("count") >= 2).select("host"))
    return web.host_allowed(p, hosts, "url")


_ROBOTS_AGENT = "quarrybot"


def _robots_table(pages: DataFrame) -> DataFrame:
    """One robots.txt per host of the page table, from a fixed template (blog hosts add a rule)."""
    hosts = pages.select(urls.url_host("url").alias("host")).distinct()
    text = F.concat(F.lit("User-agent: *\nDisallow: /fr/\nAllow: /fr/1\nDisallow: /*?utm_source=\n"),
                    F.when(F.col("host").startswith("blog."), F.lit("Disallow: /es/ # no translations\n"))
                    .otherwise(F.lit("")),
                    F.lit("\nUser-agent: otherbot\nDisallow: /\n"))
    return hosts.select("host", text.alias("text"))


_ROBOTS_SQL = f"""
rb AS (SELECT host, 'User-agent: *' || chr(10) || 'Disallow: /fr/' || chr(10) || 'Allow: /fr/1' || chr(10)
         || 'Disallow: /*?utm_source=' || chr(10)
         || CASE WHEN starts_with(host, 'blog.') THEN 'Disallow: /es/ # no translations' || chr(10) ELSE '' END
         || chr(10) || 'User-agent: otherbot' || chr(10) || 'Disallow: /' || chr(10) AS text
       FROM (SELECT DISTINCT {_HOST_SQL} AS host FROM pages)),
rl AS (SELECT host, unnest(string_split(text, chr(10))) AS raw,
              unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS ln FROM rb),
rc AS (SELECT host, ln, trim(split_part(raw, '#', 1)) AS line FROM rl),
rp AS (SELECT host, ln,
         CASE WHEN strpos(line, ':') > 0 THEN trim(split_part(line, ':', 1)) END AS directive,
         CASE WHEN strpos(line, ':') > 0 THEN trim(substr(line, strpos(line, ':') + 1)) END AS data
       FROM rc WHERE line <> ''),
ru AS (SELECT *, last_value(CASE WHEN directive = 'User-agent' THEN data END IGNORE NULLS)
         OVER (PARTITION BY host ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ua FROM rp),
rules AS (SELECT host, lower(directive) AS kind,
            replace(replace(replace(replace(data, '\\', '\\\\'), '%', '\\%'), '_', '\\_'), '*', '%') || '%' AS lk
          FROM ru WHERE directive IN ('Allow', 'Disallow') AND data <> ''
            AND regexp_full_match('{_ROBOTS_AGENT}', replace(coalesce(ua, '*'), '*', '.*')))"""


@register("robots_rules", f"""
WITH {_ROBOTS_SQL} SELECT host, kind, lk AS like_pattern FROM rules
""")
def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-6: robots.txt of every host parsed into the rules that apply to our agent."""
    rules = web.parse_robots(_robots_table(tb.table(spark, sf_dir, "pages")), _ROBOTS_AGENT)
    return rules.select("host", "kind", web._like_prefix(F.col("pattern")).alias("like_pattern"))


@register("robots_filter", f"""
WITH {_ROBOTS_SQL},
pg AS (SELECT page_id, {_HOST_SQL} AS host, {_SUBJECT_SQL} AS subject FROM pages)
SELECT pg.page_id,
  coalesce(bool_or(rules.kind = 'allow' AND pg.subject LIKE rules.lk ESCAPE '\\'), false)
  OR NOT coalesce(bool_or(rules.kind = 'disallow' AND pg.subject LIKE rules.lk ESCAPE '\\'), false) AS allowed
FROM pg LEFT JOIN rules USING (host) GROUP BY pg.page_id
""")
def robots_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-6..8 / JN-11: robots verdict for every page URL (allow wins, else disallow rejects)."""
    pages = tb.table(spark, sf_dir, "pages").select("page_id", "url")
    rules = web.parse_robots(_robots_table(pages), _ROBOTS_AGENT)
    return web.robots_filter(pages, rules, "url").select("page_id", "allowed")


# ------------------------------------------------------------------ HTML pages

_LINKS_SQL = """
lk AS (SELECT page_id, url, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS hrefs FROM pages),
lx AS (SELECT page_id, url, unnest(hrefs) AS href, unnest(generate_series(0, len(hrefs) - 1)) AS i FROM lk),
links AS (SELECT page_id, url AS src_uri, CAST(i AS INTEGER) AS pos,
            regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || split_part(href, '#', 1) AS dst_uri
          FROM lx)"""


def _parsed_pages(spark, sf_dir) -> DataFrame:
    return web.parse_pages(tb.table(spark, sf_dir, "pages"))


@register("page_links", f"""
WITH {_LINKS_SQL} SELECT page_id, src_uri, pos, dst_uri FROM links
""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-1 / STR-9: every <a href> of every page, resolved against the page URL, in order."""
    return web.page_links(_parsed_pages(spark, sf_dir)).select(
        "page_id", "src_uri", F.col("pos").cast("int").alias("pos"), "dst_uri")


@register("extension_filter", f"""
WITH {_LINKS_SQL},
sub AS (SELECT page_id, pos, dst_uri, regexp_extract(dst_uri, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) ||
          CASE WHEN regexp_matches(dst_uri, '^[^?#]*\\?') THEN '?' || regexp_extract(dst_uri, '^[^?#]*\\?([^#]*)', 1)
          ELSE '' END AS subject FROM links)
SELECT page_id, pos, dst_uri FROM sub WHERE NOT regexp_matches(subject, '{web.extension_pattern()}')
""")
def extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-5: outgoing links that do not point at a blacklisted file type."""
    links = web.page_links(_parsed_pages(spark, sf_dir)).select(
        "page_id", F.col("pos").cast("int").alias("pos"), "dst_uri")
    return web.extension_filter(links, "dst_uri")


@register("page_words", f"""
WITH {sql.PARSED_PAGES}, w AS (SELECT page_id, {sql.STR2.format(x='body')} AS ws FROM parsed)
SELECT page_id, CAST(unnest(generate_series(0, len(ws) - 1)) AS INTEGER) AS pos, unnest(ws) AS word FROM w
""")
def page_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-2 / STR-2: visible body words of every page (script, style and comments excluded)."""
    parsed = _parsed_pages(spark, sf_dir)
    return parsed.select("page_id", F.posexplode("words").alias("pos", "word"))


@register("page_summary", f"""
WITH {sql.PARSED_PAGES}, {sql.SUMMARIES} SELECT page_id, uri, title, blurb FROM summaries
""")
def page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EXT-3 / STR-13 / STR-14 / PRJ-1: uri, title (fallback uri) and blurb of every page."""
    return web.summaries(_parsed_pages(spark, sf_dir))


_REQUEST_K = "length(text) % 30"


@register("search_requests", f"""
WITH {sql.QUERY_LOG} SELECT ql.query_id, raw, CAST(CASE WHEN length(text) % 3 = 0 THEN 20 ELSE {_REQUEST_K} END AS INTEGER) AS k
FROM ql JOIN benchmark b ON b.item_id = ql.query_id
""")
def search_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10 / STR-7 / LIM-2: search requests with the query and, in two of three, the number of results asked for."""
    return querylog.from_search_requests(_requests(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for every logged query, as a web front end would log it."""
    b = tb.table(spark, sf_dir, "benchmark").select("item_id", F.length("text").alias("n"))
    ql = tb.query_log(spark, sf_dir).join(b.withColumnRenamed("item_id", "query_id"), "query_id")
    uri = F.concat(F.lit("/search?query="), F.replace("raw", F.lit(" "), F.lit("+")),
                   F.when(F.col("n") % 3 != 0, F.concat(F.lit("&num_results="), (F.col("n") % 30).cast("string"))).otherwise(""))
    return ql.select("query_id", uri.alias("uri"))


_PAGE_TABLES = f"""{sql.PARSED_PAGES}, {sql.SUMMARIES},
site AS (SELECT uri, arg_min(title, p.page_id) AS title, arg_min(blurb, p.page_id) AS blurb, arg_min(p.body, p.page_id) AS body,
           regexp_extract(uri, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host
         FROM parsed p JOIN (SELECT page_id, blurb FROM summaries) USING (page_id) GROUP BY uri)"""
_SITE_EDGES = ("SELECT DISTINCT src, dst FROM (SELECT uri AS src, min(uri) OVER (PARTITION BY host) AS dst FROM site UNION ALL "
               "SELECT src_uri, dst_uri FROM links WHERE dst_uri IN (SELECT uri FROM site)) WHERE src <> dst")


@register("page_search", f"""
WITH {_LINKS_SQL}, {_PAGE_TABLES}, {_relevance_sql("uri", "site", "body")}, {sql.pagerank_unrolled("SELECT uri AS id FROM site", _SITE_EDGES, 5)},
req AS (SELECT ql.query_id, CASE WHEN length(text) % 3 = 0 THEN 20 ELSE {_REQUEST_K} END AS k FROM ql JOIN benchmark b ON b.item_id = ql.query_id),
sc AS (SELECT req.query_id, req.k, s.uri, s.title, s.blurb, coalesce(rel.relevance, 0) * sqrt(pr5.rank) AS score
       FROM req CROSS JOIN site s JOIN pr5 ON pr5.id = s.uri LEFT JOIN rel ON rel.query_id = req.query_id AND rel.k = s.uri)
SELECT query_id, CAST(pos AS INTEGER) AS pos, uri, title, blurb, round(score * sqrt((SELECT n FROM pcnt)), 6) AS score FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id
     ORDER BY CASE WHEN score > 0 THEN round(log10(score), 11) END DESC NULLS LAST, uri) AS pos FROM sc)
WHERE pos <= k
""")
def page_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10 / SCH-6 / JN-12 / LIM-2 / SET-2: the requests are searched over the parsed pages, each for its own number of
    results; title and blurb are fetched for the winners only.  Pages of one URI are one page; links are those of the markup and
    one from each page to the first page of its host."""
    parsed = reliable_checkpoint(web.distinct_pages(_parsed_pages(spark, sf_dir), "uri", "page_id"), "parsed")
    requests = reliable_checkpoint(querylog.from_search_requests(_requests(spark, sf_dir)), "requests")
    m = tfidf.Model(parsed.select("uri", F.array_join("words", " ").alias("text")), "uri", "text", "cosine")
    home = parsed.groupBy(urls.url_host("uri").alias("host")).agg(F.min("uri").alias("dst"))
    links = web.page_links(parsed).select(F.col("src_uri").alias("src"), F.col("dst_uri").alias("dst")).unionByName(
        parsed.select(F.col("uri").alias("src"), urls.url_host("uri").alias("host")).join(sized_side(home), "host").select("src", "dst"))
    nodes, edges = graph.link_graph(parsed.select(F.col("uri").alias("id")), links)
    ranks = graph.pagerank(nodes, edges, 0.85, 0.0, 5)
    index = impacts.write_impacts(m.tf, m.idf, m.norms, ranks, scratch_path(spark, "impacts"), "uri")
    weights = impacts.query_weights(search.query_tokens(requests, "cosine"), m.idf)
    limits = requests.select("query_id", "k")
    best = impacts.RankedSearch(index, weights, limits).best("uri").drop("pos")
    winners = sized_side(search.with_zero_scores(best, parsed, limits, "uri"))
    shown = web.summaries(parsed).drop("page_id").join(winners, "uri")
    return shown.select("query_id", F.col("pos").cast("int").alias("pos"), "uri", "title", "blurb",
                        _r6(F.col("score") * float(parsed.count()) ** 0.5).alias("score"))


# ------------------------------------------------------------------ written index, checks

def _global_index(spark, sf_dir) -> ix.Index:
    return ix.build_index(tb.documents(spark, sf_dir), "doc_name", "text")


@register("posting_lookup", f"""
WITH {sql.QUERY_LOG}, {sql.query_words('count')}, {sql.COUNT_DOCS}, {sql.COUNT_POSITIONS},
pst AS (SELECT word, doc_id, CAST(count(*) AS INTEGER) AS n, list(pos ORDER BY pos) AS positions FROM pos GROUP BY ALL)
SELECT pst.word, cd.doc_name, pst.n, pst.positions FROM pst JOIN cd USING (doc_id)
WHERE pst.word IN (SELECT word FROM qw)
""")
def posting_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 / SRC-7 / JN-1 / JN-5: write the index as bucketed Parquet with a manifest, reopen
    it and read the postings of every logged query word (bucket-pruned scan)."""
    path = scratch_path(spark, "index")
    index_store.write_index(_global_index(spark, sf_dir), path, buckets=16)
    idx, buckets = index_store.open_indexes(spark, [path])
    words = search.query_tokens(tb.query_log(spark, sf_dir), "count").select("word")
    hits = index_store.lookup_words(idx, words, buckets)
    return ix.doc_names(idx.doc_table, hits).select("word", "doc_name", "n", "positions")


@register("indexed_and_search", f"""
WITH {sql.QUERY_LOG}, {sql.query_words('count')}, {sql.COUNT_DOCS}, {sql.COUNT_TOKENS},
tc AS (SELECT CASE WHEN ad.source < 'src5' THEN '0' ELSE '1' END || ':' || ad.source AS index_id, ad.doc_name, tok.word, count(*) AS n
       FROM tok JOIN ad USING (doc_id) GROUP BY ALL),
nq AS (SELECT query_id, count(*) AS n_words FROM qw GROUP BY ALL),
h AS (SELECT qw.query_id, tc.index_id, tc.doc_name, count(*) AS matched, sum(tc.n) AS rank FROM qw JOIN tc USING (word) GROUP BY ALL)
SELECT h.query_id, h.index_id, h.doc_name, CAST(h.rank AS BIGINT) AS rank,
       CAST(row_number() OVER (PARTITION BY h.query_id ORDER BY h.rank DESC, h.index_id, h.doc_name) AS BIGINT) AS pos
FROM h JOIN nq USING (query_id) WHERE matched = n_words
""")
def indexed_and_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 / SRC-7 / SRC-8 / JN-1 / JN-2 / JN-3 / SCH-2 / SRT-2: two indices are written with different bucket
    counts and opened together; the logged queries' words prune each scan by its own buckets; hits
    are ranked over all indices by occurrences, then index, then name."""
    docs = tb.documents(spark, sf_dir)
    paths = [scratch_path(spark, "index"), scratch_path(spark, "index")]
    for path, part, buckets in zip(paths, (F.col("source") < "src5", F.col("source") >= "src5"), (16, 24), strict=True):
        index_store.write_index(ix.build_index(docs.where(part), "doc_name", "text", index_id="source"), path, buckets)
    idx, _ = index_store.open_indexes(spark, paths)
    qw = search.query_tokens(tb.query_log(spark, sf_dir), "count")
    hits = search.and_search(index_store.lookup_words(idx, qw), qw, ("index_id", "doc_id"))
    named = ix.doc_names(idx.doc_table, hits).withColumn("_order", F.struct("index_id", "doc_name"))
    return search.display_rank(named, "rank", "_order", "pos").select("query_id", "index_id", "doc_name", "rank", "pos")


_CHECK_NAMES = ["doc_id_unique", "doc_id_dense", "doc_name_ascii", "doc_name_length", "word_ascii_lower",
                "word_length", "positions_count", "positions_increasing", "posting_unique", "posting_doc_resolves",
                "bucket_placement"]


@register("index_check", f"""
WITH {sql.COUNT_DOCS}, {sql.DOC_TABLE}, {sql.COUNT_POSITIONS},
pst AS (SELECT dt.doc_id, pos.word, count(*) AS n, list(pos.pos ORDER BY pos.pos) AS positions
        FROM pos JOIN dt ON dt.src_id = pos.doc_id GROUP BY ALL),
c AS (SELECT
  (SELECT count(*) - count(DISTINCT doc_id) FROM dt) AS doc_id_unique,
  (SELECT CASE WHEN max(doc_id) = count(DISTINCT doc_id) AND min(doc_id) = 1 THEN 0 ELSE 1 END FROM dt) AS doc_id_dense,
  (SELECT count(*) FILTER (WHERE regexp_matches(doc_name, '[^\\x00-\\x7F]')) FROM dt) AS doc_name_ascii,
  (SELECT count(*) FILTER (WHERE length(doc_name) >= 1024) FROM dt) AS doc_name_length,
  (SELECT count(*) FILTER (WHERE regexp_matches(word, '[^\\x00-\\x7F]') OR regexp_matches(word, '[A-Z]')) FROM pst)
    AS word_ascii_lower,
  (SELECT count(*) FILTER (WHERE length(word) >= 8192) FROM pst) AS word_length,
  (SELECT count(*) FILTER (WHERE n >= 1000000 OR n <> len(positions)) FROM pst) AS positions_count,
  (SELECT count(*) FILTER (WHERE positions <> list_sort(list_distinct(positions))) FROM pst) AS positions_increasing,
  (SELECT count(*) FROM (SELECT word, doc_id FROM pst GROUP BY ALL HAVING count(*) > 1)) AS posting_unique,
  (SELECT count(*) FROM pst WHERE doc_id NOT IN (SELECT doc_id FROM dt)) AS posting_doc_resolves, 0 AS bucket_placement)
SELECT "check", CAST(violations AS BIGINT) AS violations FROM c
UNPIVOT (violations FOR "check" IN ({", ".join(_CHECK_NAMES)}))
""")
def index_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-2..6: structural checks of the index built from documents (all zero when healthy).

    The checks read a written index, with the placement of words in buckets (DQ-4)."""
    path = scratch_path(spark, "index")
    index_store.write_index(_global_index(spark, sf_dir), path, buckets=16)
    idx, buckets = index_store.open_indexes(spark, [path])
    return quality.check_index(idx, buckets)


@register("rank_check", f"""
WITH {sql.pagerank_unrolled(sql.PART_GRAPH_NODES, sql.PART_GRAPH_EDGES, 5)},
c AS (SELECT count(*) FILTER (WHERE rank <= 0) AS rank_positive,
             CASE WHEN abs(sum(rank) - 1.0) > 1e-9 THEN 1 ELSE 0 END AS rank_sum FROM pr5)
SELECT "check", CAST(violations AS BIGINT) AS violations FROM c UNPIVOT (violations FOR "check" IN (rank_positive, rank_sum))
""")
def rank_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-7: PageRank of the part graph is positive and sums to 1."""
    nodes, edges = _part_graph(spark, sf_dir)
    return quality.check_ranks(graph.pagerank(nodes, edges, 0.85, 0.0, 5))


def _crawl_sql(levels: int, seeds: int, limit: int) -> str:
    parts = [f"pe AS ({sql.PART_GRAPH_EDGES})",
             f"l0 AS (SELECT id FROM ({sql.PART_GRAPH_NODES}) ORDER BY id LIMIT {seeds})",
             "r0 AS (SELECT id, 0 AS distance FROM l0)"]
    for d in range(1, levels + 1):
        parts.append(f"l{d} AS (SELECT DISTINCT pe.dst AS id FROM l{d - 1} JOIN pe ON pe.src = l{d - 1}.id "
                     f"WHERE pe.dst NOT IN (SELECT id FROM r{d - 1}))")
        parts.append(f"r{d} AS (SELECT * FROM r{d - 1} UNION ALL SELECT id, {d} AS distance FROM l{d})")
    return ("WITH " + ", ".join(parts) +
            f" SELECT id, CAST(distance AS INTEGER) AS distance FROM r{levels} ORDER BY distance, id LIMIT {limit}")


@register("crawl_order", _crawl_sql(8, 3, 100))
def crawl_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-4 / JN-9 / LIM-1 / SRT-7: breadth-first visit order over the part graph from the three
    smallest part keys, 100 pages."""
    nodes, edges = _part_graph(spark, sf_dir)
    seeds = nodes.orderBy("id").limit(3)
    return graph.bfs_order(edges, seeds, 100).select("id", F.col("distance").cast("int").alias("distance"))


@register("saved_pages", f"""
SELECT md5(url) AS page_key, {_HOST_SQL} AS host, url AS uri, md5(h) AS html_md5, CAST(length(h) AS BIGINT) AS n_chars
FROM (SELECT url, arg_min(html, page_id) AS h FROM pages WHERE html IS NOT NULL GROUP BY url)
""")
def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 / SRC-4 / SRC-5 / SET-2 / STR-12: every page is saved as a file of its own under its host, the tree is listed and read again, and
    the metadata header gives back its URI."""
    pages = tb.table(spark, sf_dir, "pages").where("html IS NOT NULL")
    first = web.distinct_pages(pages.select(F.col("url").alias("uri"), "page_id", F.col("html").alias("body")), "uri", "page_id")
    root = scratch_path(spark, "page-files")
    page_files.save_page_files(first.select("uri", "body"), root)
    found = page_files.read_files(page_files.list_tree(spark, root))
    back = web.read_raw_pages(found.select("name", F.decode("content", "UTF-8").alias("content")))
    return back.select(F.element_at(F.split("name", "/"), -1).alias("page_key"), urls.url_host("uri").alias("host"), "uri",
                       F.md5("html").alias("html_md5"), F.length("html").cast("long").alias("n_chars"))


_CRAWL_STOP, _CRAWL_LIMIT, _CRAWL_LEVELS = 120, 300, 8
_NORMAL = ("lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', 0)) || "
           "CASE WHEN regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) = '' THEN '/' "
           "ELSE regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) END || regexp_extract({u}, '^[^?#]*(\\?[^#]*)', 1)")


def _crawl_filtered_sql() -> str:
    url_of = lambda x: _NORMAL.replace("\\\\", "\\").format(u=x)
    subject, host = _SUBJECT_SQL.replace("url", "uri"), _HOST_SQL.replace("url", "uri")
    levels = "".join(f""",
l{d} AS (SELECT DISTINCT ce.dst AS uri FROM l{d - 1} JOIN ce ON ce.src = l{d - 1}.uri WHERE ce.dst IN (SELECT uri FROM ok) AND ce.dst NOT IN (SELECT uri FROM v{d - 1})),
v{d} AS (SELECT * FROM v{d - 1} UNION ALL SELECT uri, {d} AS distance FROM l{d})""" for d in range(1, _CRAWL_LEVELS + 1))
    return f"""
WITH {_LINKS_SQL}, {_ROBOTS_SQL},
pg AS (SELECT page_id, url, {_HOST_SQL} AS host FROM pages),
nx AS (SELECT url AS src, lead(url) OVER (PARTITION BY host ORDER BY page_id) AS dst FROM pg),
ce AS (SELECT DISTINCT {url_of('src')} AS src, {url_of('dst')} AS dst FROM (SELECT src_uri AS src, dst_uri AS dst FROM links
       UNION ALL SELECT src, dst FROM nx WHERE dst IS NOT NULL)),
sd AS (SELECT DISTINCT {url_of('u')} AS uri FROM (SELECT arg_min(url, page_id) AS u FROM pg GROUP BY host)),
cand AS (SELECT uri, {host} AS host, {subject} AS subject FROM (SELECT uri FROM sd UNION SELECT dst FROM ce)),
ok AS (SELECT uri FROM cand LEFT JOIN rules USING (host)
       WHERE host IN (SELECT host FROM pg GROUP BY host HAVING count(*) >= 2) AND NOT regexp_matches(subject, '{web.extension_pattern()}')
       GROUP BY uri HAVING coalesce(bool_or(rules.kind = 'allow' AND subject LIKE rules.lk ESCAPE '\\'), false)
         OR NOT coalesce(bool_or(rules.kind = 'disallow' AND subject LIKE rules.lk ESCAPE '\\'), false)),
l0 AS (SELECT uri FROM sd WHERE uri IN (SELECT uri FROM ok)), v0 AS (SELECT uri, 0 AS distance FROM l0){levels}
SELECT uri, CAST(distance AS INTEGER) AS distance, CAST(row_number() OVER (ORDER BY distance, uri) AS BIGINT) AS pos
FROM (SELECT * FROM v{_CRAWL_LEVELS} ORDER BY distance, uri LIMIT {_CRAWL_LIMIT})
"""


@register("crawl_filtered", _crawl_filtered_sql())
def crawl_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-4 / FLT-4..7 / JN-9 / LIM-1 / SRC-9 / SNK-4 / Q-12: a crawl over the links of the pages and from each page to the next
    of its host, from the first page of every host; hosts with two pages or more, robots rules and file extensions
    decide what is admitted.  The crawl stops after 120 URIs and is resumed from its state to 300."""
    pages = tb.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    named = pages.select("page_id", F.col("url").alias("uri"), urls.url_host("url").alias("host"))
    following = next_within(named, ["host"], ["page_id"], "uri", "next").where("next IS NOT NULL")
    links = web.page_links(web.parse_pages(pages)).select("src_uri", "dst_uri").unionByName(
        following.select(F.col("uri").alias("src_uri"), F.col("next").alias("dst_uri")))
    hosts = named.groupBy("host").count().where("count >= 2").select("host")
    rules = sized_side(web.parse_robots(_robots_table(pages), _ROBOTS_AGENT))
    seeds = named.groupBy("host").agg(F.min_by("uri", "page_id").alias("uri")).select("uri")
    admission = crawling.Admission(hosts=sized_side(hosts), robots=rules, extensions=web.EXTENSION_BLACKLIST)
    state = scratch_path(spark, "crawl")
    crawling.crawl(links, seeds, state, _CRAWL_STOP, admission)
    return crawling.crawl(links, seeds, state, _CRAWL_LIMIT, admission)


# ------------------------------------------------------------------ streaming

@register("stream_queries", ORACLE["and_search"])
def stream_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-1: logged queries arrive in three files, one micro-batch each; every batch is searched against the
    fixed index (foreachBatch, idempotent per batch id); result = the batch result."""
    root = scratch_path(spark, "stream-queries")
    bench = tb.table(spark, sf_dir, "benchmark")
    bench.repartition(3, "item_id").write.parquet(f"{root}/incoming")
    stream = spark.readStream.schema(bench.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/incoming")
    # The fixed index: term counts materialised once; every micro-batch only probes it.
    counts = reliable_checkpoint(ix.term_counts(ix.word_tokens(_count_docs(spark, sf_dir), ["doc_id"], "t"), ["doc_id"]))
    q = streaming.stream_search(stream.withColumnRenamed("item_id", "query_id"), counts, f"{root}/out",
                                f"{root}/checkpoint", "count", raw_from=("query_id", "text"))
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("query_id", "doc_id", "rank")


@register("incremental_index", f"""
WITH {sql.COUNT_DOCS}, {sql.COUNT_POSITIONS}
SELECT cd.doc_name, pos.word, CAST(count(*) AS INTEGER) AS n FROM pos JOIN cd USING (doc_id) GROUP BY ALL
""")
def incremental_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-2 / SET-6: the documents table arrives as a file stream (one file per micro-batch) and
    is appended to an index whose ids continue across batches; result = postings keyed by
    document name.  The table's own files are streamed; nothing is copied."""
    root = scratch_path(spark, "stream-index")
    stream = tb.document_stream(spark, sf_dir).select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("doc_name"), "text")
    q = streaming.stream_index(stream, f"{root}/index", f"{root}/checkpoint")
    q.awaitTermination()
    idx = streaming.read_stream_index(spark, f"{root}/index")
    return ix.doc_names(idx.doc_table, idx.postings).select("doc_name", "word", "n")


@register("segmented_index", f"""
WITH {sql.COUNT_DOCS}, {sql.COUNT_POSITIONS}
SELECT cd.doc_name, pos.word, CAST(count(*) AS INTEGER) AS n, list(pos.pos ORDER BY pos.pos) AS positions, true AS ids_dense, CAST(4 AS INTEGER) AS batches
FROM pos JOIN cd USING (doc_id) GROUP BY ALL
""")
def segmented_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-2 / SET-6 / SNK-2 / SRC-7: the documents arrive in four files, one micro-batch each; small segments are merged on the
    way, one batch is sent again; result = the postings of the last version by name, and whether its ids are dense."""
    root = scratch_path(spark, "segments")
    docs = tb.documents(spark, sf_dir).select("doc_name", "text")
    docs.repartition(4, "doc_name").write.parquet(f"{root}/incoming")
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/incoming")
    streaming.stream_segments(stream, f"{root}/index", f"{root}/checkpoint", merge_docs=1 << 40, merge_at=3).awaitTermination()
    segments.add_batch(docs.limit(1), f"{root}/index", 0)
    idx = segments.open_segments(spark, f"{root}/index")
    dense = idx.doc_table.agg(F.max("doc_id") == F.count(F.lit(1))).first()[0]
    found = ix.doc_names(idx.doc_table, idx.postings).select("doc_name", "word", "n", "positions")
    batches = len(segments.manifest(spark, f"{root}/index")["batches"])
    return found.withColumn("ids_dense", F.lit(dense)).withColumn("batches", F.lit(batches))
