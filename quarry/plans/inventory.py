"""Queries that run the rest of the operator inventory over the given tables, each with its DuckDB SQL; ``QUERIES`` and
``ORACLE`` are those of the catalog with these added."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import urls
from quarry.operators import collect, graph, quality, search, tfidf, web
from quarry.operators import index as ix
from quarry.operators.ordinals import in_order, ordinal_within
from quarry.plans import sql
from quarry.plans import tables as tb
from quarry.plans.catalog import (_AND_HITS, _HOST_SQL, _LINKS_SQL, _ROBOTS_AGENT, _ROBOTS_SQL, _SUBJECT_SQL, ORACLE, QUERIES, _cosine_model, _count_docs, _global_index,
                                  _part_graph, _r6, _robots_table, _scaled, register)
from quarry.session import scratch_path
from quarry.sources import files, index_store, querylog


@register("tfidf_ranked", f"""
WITH {sql.QUERY_LOG}, {sql.query_words('tfidf')}, {sql.tfidf_model()},
s AS (SELECT qw.query_id, ptf.k AS doc_id, round(sum(pidf.idf * ptf.tf), 6) AS score
      FROM qw JOIN pidf USING (word) JOIN ptf USING (word) GROUP BY ALL)
SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS BIGINT) AS pos FROM s
""")
def tfidf_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-3 / SCH-3 / SET-5 / WIN-3: the hits of the OR search in their order, numbered per query; scores that agree in
    six decimals are in document order."""
    m = tfidf.Model(tb.table(spark, sf_dir, "documents"), "doc_id", "text", "tfidf")
    hits = search.tfidf_search(m.tf, m.idf, search.query_tokens(tb.query_log(spark, sf_dir), "tfidf"), "doc_id")
    rounded = hits.select("query_id", "doc_id", _r6("score").alias("score"))
    ordered = ordinal_within(rounded, ["query_id"], [F.col("score").desc(), "doc_id"], "pos")
    return in_order(ordered.select("query_id", "doc_id", "score", "pos"), ["query_id", "pos"])


@register("vector_maps", f"""
WITH {sql.cosine_model()}
SELECT k AS doc_id, CAST(count(*) AS INTEGER) AS n_words, round(coalesce(max(w) FILTER (WHERE word = 'the'), -1), 6) AS the_weight,
  bool_or(word = 'the') AS has_the FROM cvec GROUP BY k
""")
def vector_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAP-1 / MAP-2: each document's vector as a map, with lookup, default and membership test."""
    v = tfidf.vector_maps(_cosine_model(spark, sf_dir).vectors, "doc_id")
    return v.select("doc_id", F.size("vector").alias("n_words"), _r6(tfidf.vector_weight("vector", "the", -1.0)).alias("the_weight"),
                    F.map_contains_key("vector", F.lit("the")).alias("has_the"))


@register("unique_words", f"""
WITH w AS (SELECT doc_id, {sql.STR2.format(x='text')} AS ws FROM documents) SELECT DISTINCT doc_id, unnest(ws) AS word FROM w
""")
def unique_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-11: the distinct words of each document."""
    return tfidf.unique_words(tfidf.doc_tokens(tb.table(spark, sf_dir, "documents"), "doc_id", "text", "cosine"), "doc_id")


@register("term_documents", f"""
WITH {sql.COUNT_DOCS}, {sql.COUNT_TOKENS}
SELECT word, list(doc_id ORDER BY doc_id) AS docs, CAST(sum(n) AS BIGINT) AS occurrences FROM (SELECT word, doc_id, count(*) AS n FROM tok GROUP BY ALL) GROUP BY word
""")
def term_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13 / AGG-14: term -> list of its documents, by the list collector."""
    tc = ix.term_counts(ix.word_tokens(_count_docs(spark, sf_dir), ["doc_id"], "t"), ["doc_id"])
    return tc.groupBy("word").agg(F.sort_array(F.collect_list("doc_id")).alias("docs"), F.sum("n").alias("occurrences"))


def _moments() -> collect.Collector:
    """Count, mean and variance by pairwise updating of (n, mean, sum of squares)."""
    def merge(a: bytes, b: bytes) -> bytes:
        (n, m, q), (k, o, r) = struct.unpack("<qdd", a), struct.unpack("<qdd", b)
        if not n or not k:
            return b if not n else a
        d, t = o - m, n + k
        return struct.pack("<qdd", t, m + d * k / t, q + r + d * d * n * k / t)

    def add(state: bytes, values: list) -> bytes:
        there = [float(v) for v in values if v is not None]
        if not there:
            return state
        m = sum(there) / len(there)
        return merge(state, struct.pack("<qdd", len(there), m, sum((v - m) ** 2 for v in there)))

    def finish(state: bytes) -> dict:
        n, m, q = struct.unpack("<qdd", state)
        return {"n": n, "mean": m if n else None, "variance": q / n if n else None}
    return collect.Collector(lambda: struct.pack("<qdd", 0, 0.0, 0.0), add, merge, finish, "n long, mean double, variance double")


@register("user_aggregate", """
SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(var_pop(l_extendedprice) / 1e6, 4) AS variance
FROM lineitem GROUP BY ALL
""")
def user_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-3: an aggregate of the user's own over four large groups, equal to the built-in ones."""
    made = collect.collect(tb.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", _moments())
    return made.select("l_returnflag", "l_linestatus", "n", F.round("mean", 4).alias("mean"), F.round(F.col("variance") / 1e6, 4).alias("variance"))


@register("rank_lookup", f"""
WITH {sql.pagerank_unrolled(sql.PART_GRAPH_NODES, sql.PART_GRAPH_EDGES, 2)}
SELECT id, round(rank * (SELECT n FROM pcnt), 6) AS rank FROM pr2 WHERE id IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1)
""")
def rank_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRF-3: ranks of the parts that open an order."""
    nodes, edges = _part_graph(spark, sf_dir)
    wanted = tb.table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_partkey").alias("id")).distinct()
    return _scaled(graph.rank_of(graph.pagerank(nodes, edges, 0.85, 0.0, 2), wanted), nodes.count())


@register("position_lookup", f"""
WITH {_AND_HITS}, {sql.COUNT_POSITIONS}
SELECT cd.doc_name, pos.word, list(pos.pos ORDER BY pos.pos) AS positions FROM pos JOIN cd USING (doc_id)
WHERE (pos.doc_id, pos.word) IN (SELECT h.doc_id, qw.word FROM h JOIN qw USING (query_id)) GROUP BY ALL
""")
def position_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-5 / DQ-1 / SRC-7: where the words of each query stand in the documents it finds, through a written index whose
    buckets are checked before they are read."""
    path = scratch_path(spark, "index")
    index_store.write_index(_global_index(spark, sf_dir), path, buckets=16)
    idx, buckets = index_store.open_indexes(spark, [path])
    qw = search.query_tokens(tb.query_log(spark, sf_dir), "count")
    hits = search.and_search(index_store.checked_lookup(spark, path, qw), qw, ("index_id", "doc_id"))
    wanted = hits.select("query_id", "index_id", "doc_id").join(qw.select("query_id", "word"), "query_id").select("index_id", "word", "doc_id").distinct()
    return ix.doc_names(idx.doc_table, index_store.lookup_positions(idx, wanted, buckets)).select("doc_name", "word", "positions")


@register("index_validated", f"""
WITH {sql.COUNT_DOCS}, {sql.COUNT_TOKENS}
SELECT (SELECT count(*) FROM ad) AS n_docs, (SELECT count(*) FROM (SELECT DISTINCT doc_id, word FROM tok)) AS n_postings, CAST(0 AS BIGINT) AS changed_buckets
""")
def index_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-1 / SRC-7: an index is opened with validation: counts and checksums of all tables, and the digest of every bucket."""
    path = scratch_path(spark, "index")
    index_store.write_index(_global_index(spark, sf_dir), path, buckets=16)
    idx, manifest = index_store.open_index(spark, path, validate=True)
    changed = len(index_store.changed_buckets(spark, path))
    return idx.doc_table.agg(F.count(F.lit(1)).alias("n_docs")).select(
        "n_docs", F.lit(manifest["n_postings"]).cast("long").alias("n_postings"), F.lit(changed).cast("long").alias("changed_buckets"))


@register("web_and_search", ORACLE["and_search"])
def web_and_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10 / STR-5 / STR-7 / Q-14: the logged queries as ``/query?terms=`` requests in the web dialect."""
    requests = tb.query_log(spark, sf_dir).select("query_id", F.concat(F.lit("/query?terms="), F.replace("raw", F.lit(" "), F.lit("+"))).alias("uri"))
    qw = search.query_tokens(querylog.from_requests(requests), "web")
    return search.and_search_tokens(ix.word_tokens(_count_docs(spark, sf_dir), ["doc_id"], "t"), qw, ("doc_id",))


@register("shell_and_search", ORACLE["and_search"])
def shell_and_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-5: the logged queries in the dialect that splits at any white space; words are parted by tabs and line ends here."""
    log = tb.query_log(spark, sf_dir).select("query_id", F.replace("raw", F.lit(" "), F.lit(" \t\n")).alias("raw"))
    return search.and_search_tokens(ix.word_tokens(_count_docs(spark, sf_dir), ["doc_id"], "t"), search.query_tokens(log, "cpp"), ("doc_id",))


_TYPE = "CASE WHEN url LIKE '%.html%' THEN ' Text/HTML; charset=utf-8' WHEN url LIKE '%?%' THEN 'application/json' WHEN url LIKE '%#%' THEN 'text/plain' END"


@register("content_types", f"SELECT page_id, {_TYPE} AS content_type FROM pages WHERE url LIKE '%.html%' OR (url LIKE '%#%' AND url NOT LIKE '%?%')")
def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-9: pages whose content type, told here from the form of the url, is among those that are kept."""
    return web.content_type_filter(tb.table(spark, sf_dir, "pages").select("page_id", F.expr(_TYPE).alias("content_type")))


@register("combined_rules", f"""
WITH {_ROBOTS_SQL}, more AS (SELECT * FROM rules UNION ALL SELECT host, 'disallow', '/de/%' FROM rb UNION ALL SELECT host, 'allow', '/de/%7%' FROM rb),
pg AS (SELECT page_id, {_HOST_SQL} AS host, {_SUBJECT_SQL} AS subject FROM pages)
SELECT pg.page_id, coalesce(bool_or(more.kind = 'allow' AND pg.subject LIKE more.lk ESCAPE '\\'), false)
  OR NOT coalesce(bool_or(more.kind = 'disallow' AND pg.subject LIKE more.lk ESCAPE '\\'), false) AS allowed
FROM pg LEFT JOIN more USING (host) GROUP BY pg.page_id
""")
def combined_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-8 / FLT-7: robots rules combined with rules of our own for every host."""
    pages = tb.table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(urls.url_host("url").alias("host")).distinct()
    own = hosts.select("host", F.explode(F.array(F.struct(F.lit("disallow").alias("kind"), F.lit("/de/").alias("pattern")),
                                                 F.struct(F.lit("allow").alias("kind"), F.lit("/de/*7").alias("pattern")))).alias("r")).select("host", "r.*")
    rules = web.combine_rules(web.parse_robots(_robots_table(pages), _ROBOTS_AGENT), own)
    return web.robots_filter(pages, rules, "url").select("page_id", "allowed")


@register("parsed_table", f"""
WITH {sql.PARSED_PAGES}, {_LINKS_SQL}, n AS (SELECT page_id, count(*) AS n FROM links GROUP BY page_id)
SELECT page_id, uri, title, CAST(len({sql.STR2.format(x='body')}) AS INTEGER) AS n_words, CAST(coalesce(n.n, 0) AS INTEGER) AS n_links, false AS broken
FROM parsed LEFT JOIN n USING (page_id)
""")
def parsed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6 / SNK-1 / UDF-4: pages are parsed once, saved, and read back; a page that could not be parsed says so in its row."""
    path = scratch_path(spark, "parsed")
    files.load_parsed_pages(spark, path, tb.table(spark, sf_dir, "pages"), web.parse_pages)
    saved = files.load_parsed_pages(spark, path)
    return saved.select("page_id", "uri", "title", F.size("words").alias("n_words"), F.size("links").alias("n_links"), F.col("error").isNotNull().alias("broken"))


@register("csv_columns", "SELECT p_partkey, p_name, p_retailprice FROM part")
def csv_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5: columns written as CSV with a header and read back by their types."""
    path = scratch_path(spark, "csv")
    part = tb.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    files.write_columns_csv(part, path)
    return spark.read.schema(part.schema).option("header", True).csv(path)


@register("approx_check", f"""
WITH {sql.cosine_model()}
SELECT bool_and(abs(norm - (SELECT sqrt(sum(w * w)) FROM cvec WHERE cvec.k = cnorm.k)) <= 0.001) AS equal, false AS equal_to_doubled FROM cnorm
""")
def approx_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-8: norms computed in two ways agree within the tolerance; doubled ones do not."""
    m = _cosine_model(spark, sf_dir)
    other = m.vectors.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    doubled = other.withColumn("norm", F.col("norm") * 2 + 1)
    both = (quality.approx_equal(m.norms, other, ["doc_id"], "norm"), quality.approx_equal(m.norms, doubled, ["doc_id"], "norm"))
    return spark.createDataFrame([both], "equal boolean, equal_to_doubled boolean")
