"""DuckDB oracle SQL: shared CTE fragments that mirror the library's Column expressions.

Regex classes are written out explicitly so Java regex (Spark) and RE2 (DuckDB) agree.
"""

# STR-2 on column X.
STR2 = (r"list_filter(list_transform(string_split_regex(lower({x}), '[ \t\n\x0B\f\r]+'), "
        r"lambda x: regexp_replace(x, '[!-/:-@\[-`{{-~]', '', 'g')), lambda x: x <> '')")

# STR-3 on column X (all-blank text -> no tokens).
_WS = r"[ \t\n\x0B\f\r\x1c-\x1f\x85\p{{Z}}]+"
STR3 = ("CASE WHEN regexp_replace({x}, '^" + _WS + "|" + _WS + "$', '', 'g') = '' THEN []::VARCHAR[] ELSE "
        "list_transform(string_split_regex(regexp_replace({x}, '^" + _WS + "|" + _WS + "$', '', 'g'), '" + _WS + "'), "
        r"lambda x: lower(regexp_replace(x, '[^\p{{L}}\p{{N}}_]+', '', 'g'))) END")

QUERY_LOG = ("ql AS (SELECT item_id AS query_id, array_to_string(" + STR2.format(x="text")
             + ", ' ') AS raw FROM benchmark)")


def query_words(dialect: str) -> str:
    """qw(query_id, qi, word) from ql."""
    if dialect == "count":
        words = "list_filter(string_split(lower(raw), ' '), lambda x: x <> '')"
    elif dialect == "cosine":
        words = STR2.format(x="raw")
    elif dialect == "tfidf":
        words = STR3.format(x="raw")
    else:
        raise ValueError(dialect)
    return ("qw AS (SELECT query_id, unnest(generate_series(0, len(w) - 1)) AS qi, unnest(w) AS word "
            f"FROM (SELECT query_id, {words} AS w FROM ql))")


# Count dialect: C-string text, ASCII documents only.
COUNT_DOCS = (r"cd AS (SELECT doc_id, source, source || '/' || CAST(doc_id AS VARCHAR) AS doc_name, "
              r"split_part(text, chr(0), 1) AS t FROM documents), "
              r"ad AS (SELECT * FROM cd WHERE NOT regexp_matches(t, '[^\x00-\x7F]') "
              r"AND regexp_matches(t, '[A-Za-z][^A-Za-z]'))")

COUNT_TOKENS = "tok AS (SELECT doc_id, lower(unnest(regexp_extract_all(t, '([A-Za-z]+)[^A-Za-z]', 1))) AS word FROM ad)"

# Positions: chunks tile the text after its non-letter prefix.
COUNT_POSITIONS = (
    "ch AS (SELECT doc_id, length(regexp_extract(t, '^[^A-Za-z]*', 0)) AS pre, "
    "unnest(regexp_extract_all(t, '([A-Za-z]+[^A-Za-z]+)', 1)) AS c, "
    "unnest(generate_series(0, len(regexp_extract_all(t, '([A-Za-z]+[^A-Za-z]+)', 1)) - 1)) AS i FROM ad), "
    "pos AS (SELECT doc_id, lower(regexp_extract(c, '^[A-Za-z]+', 0)) AS word, "
    "CAST(pre + coalesce(sum(length(c)) OVER (PARTITION BY doc_id ORDER BY i "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS pos FROM ch)")

# Dense ids over indexed documents, per index (source) and global.
DOC_TABLE = ("dt AS (SELECT source AS index_id, doc_id AS src_id, doc_name, "
             "row_number() OVER (PARTITION BY source ORDER BY string_split(doc_name, '/')) AS local_id, "
             "row_number() OVER (ORDER BY string_split(doc_name, '/')) AS doc_id FROM ad)")


def cosine_model(key: str = "doc_id", table: str = "documents", text: str = "text") -> str:
    """ctok, ctf(key, word, cnt, len, tf), nd(n), cidf(word, df, idf), cvec(key, word, w), cnorm(key, norm)."""
    return (
        f"cw AS (SELECT {key} AS k, " + STR2.format(x=text) + f" AS w FROM {table}), "
        "ctok AS (SELECT k, len(w) AS len, unnest(w) AS word FROM cw), "
        "ctf AS (SELECT k, word, count(*) AS cnt, any_value(len) AS len, count(*) / any_value(len) AS tf "
        "FROM ctok GROUP BY k, word), "
        f"nd AS (SELECT count(*) AS n FROM {table}), "
        "cidf AS (SELECT word, count(*) AS df, ln((SELECT n FROM nd) / count(*)) AS idf FROM ctf GROUP BY word), "
        "cvec AS (SELECT k, word, tf, tf * idf AS w FROM ctf JOIN cidf USING (word)), "
        "cnorm AS (SELECT k, sqrt(sum(w * w)) AS norm FROM cvec GROUP BY k)")


def tfidf_model(table: str = "documents", text: str = "text") -> str:
    """ptf(k, word, tf), pidf(word, df, idf) for the tfidf (Python) dialect."""
    return (
        "pw AS (SELECT doc_id AS k, " + STR3.format(x=text) + f" AS w FROM {table}), "
        "ptok AS (SELECT k, len(w) AS len, unnest(w) AS word FROM pw), "
        "ptf AS (SELECT k, word, count(*) / any_value(len) AS tf FROM ptok GROUP BY k, word), "
        f"pnd AS (SELECT count(*) AS n FROM {table}), "
        "pidf AS (SELECT word, count(*) AS df, ln((SELECT n FROM pnd) / count(*)) AS idf FROM ptf GROUP BY word)")


def pagerank_unrolled(nodes_sql: str, edges_sql: str, steps: int, decay: float = 0.85) -> str:
    """nodes(id), edges(src, dst) CTE bodies -> pr{steps}(id, rank) after ``steps`` updates."""
    parts = [f"pn AS ({nodes_sql})", f"pe AS ({edges_sql})",
             "pcnt AS (SELECT count(*) AS n FROM pn)",
             "pod AS (SELECT src, count(*) AS od FROM pe GROUP BY src)",
             "pw AS (SELECT pe.src, pe.dst, 1.0 / pod.od AS wt FROM pe JOIN pod USING (src))",
             "pdn AS (SELECT pn.id, pod.od IS NULL AS dangling FROM pn LEFT JOIN pod ON pn.id = pod.src)",
             "pr0 AS (SELECT id, dangling, 1.0 / (SELECT n FROM pcnt) AS rank FROM pdn)"]
    for s in range(1, steps + 1):
        p = f"pr{s - 1}"
        parts.append(
            f"pr{s} AS (SELECT {p}.id, {p}.dangling, "
            f"{decay} * (coalesce(c.c, 0) + (SELECT coalesce(sum(rank), 0) FROM {p} WHERE dangling) / (SELECT n FROM pcnt)) "
            f"+ (1 - {decay}) / (SELECT n FROM pcnt) AS rank FROM {p} LEFT JOIN "
            f"(SELECT pw.dst, sum(r.rank * pw.wt) AS c FROM pw JOIN {p} r ON r.id = pw.src GROUP BY pw.dst) c "
            f"ON c.dst = {p}.id)")
    return ", ".join(parts)


PART_GRAPH_NODES = "SELECT DISTINCT l_partkey AS id FROM lineitem"
PART_GRAPH_EDGES = (
    "SELECT DISTINCT src, dst FROM (SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey "
    "ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS dst FROM lineitem) "
    "WHERE dst IS NOT NULL AND src <> dst")

DOC_GRAPH_NODES = "SELECT doc_id AS id FROM documents"
DOC_GRAPH_EDGES = (
    "SELECT DISTINCT src, dst FROM ("
    "SELECT doc_id AS src, lead(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS dst FROM documents "
    "UNION ALL SELECT d.doc_id AS src, m.dst FROM documents d JOIN "
    "(SELECT lang, min(doc_id) AS dst FROM documents GROUP BY lang) m USING (lang)) "
    "WHERE dst IS NOT NULL AND src <> dst")


# Pages of plain markup: what the HTML parser makes of them, as SQL.  Comments, scripts and styles go; the body is what follows
# its tag; block tags part the text, other tags vanish; links are marked by \x01 and \x02, blocks by \x03.
_BLOCKS = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|"
           "pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul")


def _decoded(x: str) -> str:
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">")):
        x = f"replace({x}, '{entity}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _spaces(x: str) -> str:
    return f"trim(regexp_replace({x}, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"


PARSED_PAGES = rf"""
pm AS (SELECT page_id, url, html, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
         '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g') AS m FROM pages),
pb AS (SELECT page_id, url, {_spaces(_decoded("regexp_extract(m, '(?is)<title[^>]*>(.*?)</title>', 1)"))} AS title,
         {_decoded("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(m, '(?is)<body[^>]*>(.*)$', 1), "
                   "'(?i)<a( [^>]*)?>', chr(1), 'g'), '(?i)</a>', chr(2), 'g'), '(?i)</?(" + _BLOCKS + ")( [^>]*)?/?>', chr(3), 'g'), '<[^>]*>', '', 'g')")}
           AS marked FROM pm),
pp AS (SELECT page_id, url, title, marked, {_spaces("translate(marked, chr(1) || chr(2) || chr(3), '  ')".replace("'  '", "chr(1) || chr(2) || ' '"))} AS b0 FROM pb),
parsed AS (SELECT page_id, url AS uri, CASE WHEN title <> '' THEN title ELSE url END AS title,
         {_spaces("replace(replace(b0, chr(1), ''), chr(2), '')")} AS body, marked FROM pp)"""

SUMMARIES = rf"""
bk AS (SELECT page_id, unnest(string_split(marked, chr(3))) AS x, unnest(generate_series(1, len(string_split(marked, chr(3))))) AS i FROM parsed),
bt AS (SELECT page_id, i, {_spaces("replace(replace(x, chr(1), ''), chr(2), '')")} AS t,
         {_spaces("array_to_string(regexp_extract_all(x, '\x01([^\x02]*)', 1), ' ')")} AS l FROM bk),
bs AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) AS i, t, len(string_split(t, ' '))
         - 3 * CASE WHEN l = '' THEN 0 ELSE len(string_split(l, ' ')) END - 8 AS score FROM bt WHERE t <> ''),
bp AS (SELECT *, sum(score) OVER (PARTITION BY page_id ORDER BY i) AS s FROM bs),
b1 AS (SELECT page_id, i, t, s, s - score AS before FROM bp),
b2 AS (SELECT page_id, i, t, s - min(before) OVER w AS best, arg_max(i, struct_pack(a := -before, b := i)) OVER w AS start FROM b1
       WINDOW w AS (PARTITION BY page_id ORDER BY i)),
b3 AS (SELECT page_id, arg_max(struct_pack(f := start, e := i), struct_pack(a := best, b := -i)) AS run, max(best) AS best FROM b2 GROUP BY page_id),
mt AS (SELECT b1.page_id, string_agg(t, ' ' ORDER BY i) AS main FROM b1 JOIN b3 USING (page_id)
       WHERE best > 0 AND i BETWEEN run.f AND run.e GROUP BY b1.page_id),
tx AS (SELECT page_id, string_split_regex(coalesce(main, body), '[ 	

]+') AS w FROM parsed LEFT JOIN mt USING (page_id)),
wl AS (SELECT page_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS j FROM tx),
ws AS (SELECT page_id, word, j, sum(length(word) + 1) OVER (PARTITION BY page_id ORDER BY j) AS n FROM wl),
bl AS (SELECT page_id, string_agg(word || CASE WHEN n > 200 THEN '...' ELSE ' ' END, '' ORDER BY j) AS blurb FROM ws
       WHERE n - length(word) - 1 <= 200 GROUP BY page_id),
summaries AS (SELECT page_id, uri, title, blurb FROM parsed JOIN bl USING (page_id))"""
