"""Web pages and URL rules: HTML parse (the one Python step), links, host / extension /
content-type / robots filters.

Only HTML parsing and link resolution run in Python (``mapInPandas`` over Arrow batches, stdlib
``html.parser`` and ``urllib.parse``); tokenizing, title fallback, blurb and every filter are
Catalyst expressions.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import tokenize as tk
from quarry.functions import urls
from quarry.session import sized_side

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's lists).
# URL file extensions that are never fetched; each is matched as "/.*" + extension, in lower and
# upper case, anchored at the start of path+query but not at its end, with "." left unescaped.
EXTENSION_BLACKLIST = [
    ".doc", ".docx", ".log", ".odt", ".rtf", ".tex", ".txt", ".wpd", ".wps", ".csv", ".dat",
    ".pps", ".ppt", ".pptx", ".tar", ".xml", ".aif", ".m3u", ".m4a", ".mid", ".mp3", ".mpa",
    ".wav", ".avi", ".flv", ".m4v", ".mov", ".mp4", ".mpg", ".swf", ".vob", ".bmp", ".gif",
    ".jpg", ".png", ".psd", ".pspimage", ".tif", ".tiff", ".ps", ".svg", ".pdf", ".xlr",
    ".xls", ".xlsx", ".sql", ".apk", ".app", ".jar", ".rom", ".sav", ".css", ".js", ".xhtml",
    ".otf", ".ttf", ".dll", ".ico", ".7z", ".gz", ".pkg", ".rar", ".rpm", ".tar.gz", ".zip",
    ".zipx", ".bin", ".iso", ".msi", ".part", ".torrent", ".xml",
]
# MIME types whose bodies are kept.
CONTENT_TYPES = ["application/xhtml+xml", "text/plain", "text/html"]
# Blurb length bound (characters counted as word length + 1).
MAX_BLURB_LEN = 200
# ---------------------------------------------------------------------------------------------


def extension_pattern(extensions: list[str] = EXTENSION_BLACKLIST) -> str:
    alts = []
    for ext in extensions:
        alts.append("/.*" + ext)
        alts.append("/.*" + ext.upper())
    return "^(" + "|".join(alts) + ")"


def extension_blacklisted(url) -> Column:
    """FLT-5 predicate on the URL's path + query."""
    return urls.url_subject(url).rlike(extension_pattern())


def extension_filter(df: DataFrame, url_col: str = "url") -> DataFrame:
    """FLT-5: drop URLs with a blacklisted file extension (the reference's intent)."""
    return df.where(~extension_blacklisted(url_col))


def content_type_filter(df: DataFrame, col: str = "content_type", types: list[str] = CONTENT_TYPES) -> DataFrame:
    """FLT-9: keep bodies whose MIME type (before ';', case-insensitive) is whitelisted."""
    mime = F.lower(F.trim(F.substring_index(F.col(col), ";", 1)))
    return df.where(mime.isin(types))


def host_allowed(df: DataFrame, hosts: DataFrame, url_col: str = "url") -> DataFrame:
    """FLT-4: keep rows whose URL host is in ``hosts(host)`` (size-checked broadcast semi join)."""
    h = sized_side(hosts.select("host").distinct())
    return df.withColumn("_host", urls.url_host(url_col)).join(h.withColumnRenamed("host", "_host"), "_host",
                                                                "left_semi").drop("_host")


# ------------------------------------------------------------------------------- robots rules

def _java_trim(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def parse_robots(robots: DataFrame, agent: str) -> DataFrame:
    """FLT-6: robots(host, text) -> rules(host, kind, pattern) that apply to ``agent``.

    Per line: cut the '#' comment, trim, split on the first ':'; a ``User-agent`` line sets the
    current agent pattern ('*' is a wildcard, all else is literal, the whole agent must match; lines
    before any ``User-agent`` apply to every agent); ``Allow`` / ``Disallow`` with non-empty data are
    rules.  Several texts of one host are read one by one and their rules united.
    """
    texts = robots.select("host", "text", F.xxhash64("text").alias("tid")).distinct()
    lines = texts.select("host", "tid", F.posexplode(F.split("text", "\n")).alias("ln", "raw"))
    line = _java_trim(F.substring_index(F.col("raw"), "#", 1))
    lines = lines.select("host", "tid", "ln", line.alias("line")).where(F.instr("line", ":") > 0)
    directive = _java_trim(F.substring_index("line", ":", 1))
    data = _java_trim(F.expr("substring(line, instr(line, ':') + 1)"))
    parsed = lines.select("host", "tid", "ln", directive.alias("directive"), data.alias("data"))
    # the window holds the lines of one text.
    upto = Window.partitionBy("host", "tid").orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)
    ua = F.last(F.when(F.col("directive") == "User-agent", F.col("data")), ignorenulls=True).over(upto)
    parsed = parsed.withColumn("ua", ua)
    wanted = _like_literal(F.coalesce("ua", F.lit("*")))
    applies = F.like(F.lit(agent), wanted)
    rules = parsed.where(F.col("directive").isin("Allow", "Disallow") & (F.col("data") != "") & applies)
    return rules.select("host", F.lower("directive").alias("kind"), F.col("data").alias("pattern"))


def combine_rules(*rules: DataFrame) -> DataFrame:
    """FLT-8: the union of rule sets (alternation of their patterns)."""
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


def _like_literal(pattern: Column) -> Column:
    """A pattern of literal text and '*' as a LIKE pattern for the whole string."""
    esc = F.replace(F.replace(F.replace(pattern, F.lit("\\"), F.lit("\\\\")), F.lit("%"), F.lit("\\%")),
                    F.lit("_"), F.lit("\\_"))
    return F.replace(esc, F.lit("*"), F.lit("%"))


def _like_prefix(pattern: Column) -> Column:
    """Robots pattern -> LIKE prefix pattern: literal text, '*' as wildcard, anchored at start."""
    return F.concat(_like_literal(pattern), F.lit("%"))


def robots_filter(df: DataFrame, rules: DataFrame, url_col: str = "url", keep: bool = False) -> DataFrame:
    """FLT-7 / JN-11: ``allowed`` per row — an allow rule wins, else a disallow rule rejects,
    else accepted.  Rules are grouped per host (bounded by one robots text) and joined to the
    rows by host; with ``keep`` only allowed rows are returned."""
    per_host = (rules.select("host", "kind", _like_prefix(F.col("pattern")).alias("lk"))
                .groupBy("host").agg(F.collect_list(F.struct("kind", "lk")).alias("_rules")))
    per_host = sized_side(per_host.withColumnRenamed("host", "_host"))
    rows = (df.withColumn("_host", urls.url_host(url_col)).withColumn("_subject", urls.url_subject(url_col))
            .join(per_host, "_host", "left"))
    allow = F.expr("exists(coalesce(_rules, array()), r -> r.kind = 'allow' AND _subject LIKE r.lk)")
    deny = F.expr("exists(coalesce(_rules, array()), r -> r.kind = 'disallow' AND _subject LIKE r.lk)")
    out = rows.withColumn("allowed", allow | ~deny).drop("_host", "_subject", "_rules")
    return out.where("allowed") if keep else out


# ------------------------------------------------------------------------------- HTML parsing

_BLOCK_TAGS = {
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tbody", "td", "tfoot",
    "th", "thead", "title", "tr", "ul",
}
_SKIP_TAGS = {"script", "style", "template"}
_HEAD_TAGS = {"html", "head", "title", "base", "link", "meta", "noscript"} | _SKIP_TAGS
_BAD_URI = re.compile(r"[\s\"<>\\^`{|}]|%(?![0-9A-Fa-f]{2})")
_WS_RUN = re.compile(r"[ \t\n\r\f]+")


class _PageParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.body, self.links = [], [], []
        self.blocks: list[tuple[str, int, int]] = []        # text, words, words inside links
        self._block, self._linked = [], []
        self.description = None
        self.skip = self.in_title = self.in_body = self.in_link = 0
        self.in_head = False

    def _sep(self):
        if self.in_body:
            self.body.append(" ")
            self.end_block()

    def end_block(self):
        text = _norm_ws(self._block)
        if text:
            linked = _norm_ws(self._linked)
            self.blocks.append((text, text.count(" ") + 1, linked.count(" ") + 1 if linked else 0))
        self._block, self._linked = [], []

    def handle_starttag(self, tag, attrs):
        # A page without a body tag has one all the same: it opens at the first thing that no head can hold, and
        # what follows its end tag still belongs to it.
        self.in_head = tag == "head" or self.in_head and tag in _HEAD_TAGS
        if tag not in _HEAD_TAGS and not self.in_body:
            self.in_body = 1
        if tag in _SKIP_TAGS:
            self.skip += 1
        elif tag == "title":
            self.in_title += 1
        elif tag == "a":
            self.in_link = 1
            for k, v in attrs:
                if k == "href" and v is not None:
                    self.links.append(v)
                    break
        elif tag == "meta":
            a = dict(attrs)
            if (a.get("name") or "").lower() == "description" and a.get("content"):
                self.description = a["content"]
        if tag in _BLOCK_TAGS:
            self._sep()

    def handle_endtag(self, tag):
        if tag in _BLOCK_TAGS:
            self._sep()
        if tag in _SKIP_TAGS:
            self.skip = max(0, self.skip - 1)
        elif tag == "title":
            self.in_title = max(0, self.in_title - 1)
        elif tag == "head":
            self.in_head = False
        elif tag == "a":
            self.in_link = 0
            self._linked.append(" ")

    def handle_data(self, data):
        if self.skip:
            return
        if self.in_title:
            self.title.append(data)
            return
        if not self.in_body and not self.in_head and data.strip():
            self.in_body = 1
        if self.in_body:
            self.body.append(data)
            self._block.append(data)
            if self.in_link:
                self._linked.append(data)


def _norm_ws(parts: list[str]) -> str:
    return _WS_RUN.sub(" ", "".join(parts)).strip()


def resolve_link(base: str, href: str) -> str | None:
    """STR-9: resolve against the page URI, drop the fragment, collapse dot segments (of absolute links
    too); malformed links and links without a host (mailto:, javascript:) are dropped."""
    if _BAD_URI.search(href):
        return None
    try:
        joined = urljoin(base, href)
        p = urlsplit(joined)
    except ValueError:
        return None
    if not p.scheme or not p.netloc:
        return None
    return urlunsplit((p.scheme, p.netloc, _without_dots(p.path), p.query, ""))


def _without_dots(path: str) -> str:
    """A path without '.' and '..' segments; '..' above the root goes."""
    if "/." not in path:
        return path
    out: list[str] = []
    for part in path.split("/"):
        if part == "..":
            if len(out) > 1:
                out.pop()
        elif part != ".":
            out.append(part)
    if path.endswith(("/.", "/..")):
        out.append("")
    return "/".join(out) or "/"


# Pages that are handed on at a time: a parsed page takes many times its bytes in Python.
PAGES_AT_ONCE = 64


def _parse_batches(batches):
    for whole in batches:
        for at in range(0, len(whole), PAGES_AT_ONCE):
            yield _parsed(whole.iloc[at:at + PAGES_AT_ONCE])


def _parsed(pdf):
    out = {"page_id": [], "uri": [], "title": [], "description": [], "body_text": [], "blocks": [],
           "links": [], "error": []}
    for pid, uri, html in zip(pdf["page_id"], pdf["uri"], pdf["html"]):
        p, error = _PageParser(), None
        try:
            p.feed(html or "")
            p.close()
            p.end_block()
        except (AssertionError, ValueError, IndexError) as broken:
            error = f"{type(broken).__name__}: {broken}"     # the row keeps what was parsed, and says so
        links = [r for r in (resolve_link(uri, h) for h in p.links) if r is not None]
        out["page_id"].append(pid)
        out["uri"].append(uri)
        out["title"].append(_norm_ws(p.title))
        out["description"].append(p.description)
        out["body_text"].append(_norm_ws(p.body))
        out["blocks"].append([{"text": t, "words": w, "linked": n} for t, w, n in p.blocks])
        out["links"].append(links)
        out["error"].append(error)
    return pd.DataFrame(out)


PARSED_SCHEMA = ("page_id long, uri string, title string, description string, body_text string, "
                 "blocks array<struct<text: string, words: int, linked: int>>, links array<string>, error string")

# A block of text speaks for the main text by its words, against it by those inside links and by being a block: headings,
# menus, adverts and footers are short or made of links, paragraphs are neither.
LINK_WEIGHT = 3
BLOCK_COST = 8


def main_text(blocks) -> Column:
    """EXT-3: the run of neighbouring blocks whose scores (words - LINK_WEIGHT * linked words - BLOCK_COST) have the largest
    sum, joined by spaces; '' if no sum is positive.  Of equal sums the run that ends first, and of those the shortest."""
    b = F.col(blocks) if isinstance(blocks, str) else blocks
    zero = F.lit(0).cast("long")
    init = F.struct(zero.alias("i"), zero.alias("sum"), zero.alias("start"), zero.alias("best"), zero.alias("from"), zero.alias("to"))

    def step(acc, x):
        i = acc["i"] + 1
        fresh = acc["sum"] <= 0
        total = F.when(fresh, zero).otherwise(acc["sum"]) + x["words"] - LINK_WEIGHT * x["linked"] - BLOCK_COST
        start = F.when(fresh, i).otherwise(acc["start"])
        better = total > acc["best"]
        return F.struct(i.alias("i"), total.alias("sum"), start.alias("start"), F.when(better, total).otherwise(acc["best"]).alias("best"),
                        F.when(better, start).otherwise(acc["from"]).alias("from"), F.when(better, i).otherwise(acc["to"]).alias("to"))

    run = F.aggregate(b, init, step)
    texts = F.transform(b, lambda x: x["text"])
    return F.when(run["best"] > 0, F.array_join(F.slice(texts, run["from"].cast("int"), (run["to"] - run["from"] + 1).cast("int")), " ")
                  ).otherwise("")


def blurb(description, text) -> Column:
    """STR-13: the description when present, else words of the text appended until the running
    sum of (length + 1) exceeds the bound, then '...'; otherwise each word gets a space."""
    words = F.split(F.col(text) if isinstance(text, str) else text, r"\s+")
    init = F.struct(F.lit("").alias("buf"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(acc, w):
        n = acc["n"] + F.length(w) + 1
        over = n > MAX_BLURB_LEN
        return F.when(acc["done"], acc).otherwise(F.struct(
            F.concat(acc["buf"], w, F.when(over, F.lit("...")).otherwise(F.lit(" "))).alias("buf"),
            n.alias("n"), over.alias("done")))

    built = F.aggregate(words, init, step)["buf"]
    d = F.col(description) if isinstance(description, str) else description
    return F.when(d.isNotNull() & (d != ""), d).otherwise(built)


def parse_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """EXT-1..3 / STR-14 / STR-13 / UDF-4: (page_id, uri, title, blurb, words, links, error).

    The Python step emits texts and resolved links; words (STR-2), title fallback and blurb are
    computed in the JVM.  The blurb is taken from the main text, found by the density of text and links over the
    page's blocks, and from the whole body where no block stands out.
    """
    raw = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("uri"),
                       F.col(html_col).alias("html"))
    parsed = raw.mapInPandas(_parse_batches, PARSED_SCHEMA)
    parsed = parsed.withColumn("_main", main_text("blocks"))
    body = F.when(F.col("_main") != "", F.col("_main")).otherwise(F.col("body_text"))
    return parsed.select(
        "page_id", "uri",
        F.coalesce(F.when(F.col("title") != "", F.col("title")), F.col("uri")).alias("title"),
        blurb("description", body).alias("blurb"),
        tk.cosine_words("body_text").alias("words"),
        "links",
        "error",
    )


def page_links(parsed: DataFrame) -> DataFrame:
    """EXT-1 long form: (page_id, src_uri, pos, dst_uri), duplicates kept, document order."""
    return parsed.select("page_id", F.col("uri").alias("src_uri"),
                         F.posexplode_outer("links").alias("pos", "dst_uri")).where(F.col("dst_uri").isNotNull())


def distinct_pages(pages: DataFrame, uri_col: str = "uri", path_col: str = "path") -> DataFrame:
    """SET-2: one page per URI; of several files with the same URI the smallest path wins
    (deterministic, with map-side partial aggregation)."""
    cols = [c for c in pages.columns if c not in (uri_col, path_col)]
    best = pages.groupBy(uri_col).agg(F.min_by(F.struct(path_col, *cols), F.col(path_col)).alias("_p"))
    return best.select(uri_col, "_p.*")


def summaries(parsed: DataFrame) -> DataFrame:
    """PRJ-1: drop words and links early."""
    return parsed.select("page_id", "uri", "title", "blurb")


# ------------------------------------------------------------------------------- raw page files

HOST_BUCKETS = 64

def read_raw_pages(df: DataFrame, content_col: str = "content", strict: bool = True) -> DataFrame:
    """SRC-5: files that start with a ``<!-- METADATA`` block of ``key: value`` lines up to
    ``-->``; ``uri`` keys the page.  Strict mode raises on a file without the header; otherwise
    such rows get a null uri and an ``error``."""
    c = F.col(content_col)
    header = F.regexp_extract(c, r"^<!-- METADATA\n((?:[^\n]*\n)*?)-->\n", 1)
    ok = c.startswith("<!-- METADATA\n") & c.contains("\n-->\n")
    meta = F.str_to_map(F.regexp_replace(header, r"\n$", ""), F.lit("\n"), F.lit(": "))
    html = F.expr(f"substring({content_col}, instr({content_col}, '\\n-->\\n') + 5)")
    out = df.withColumn("metadata", F.when(ok, meta)).withColumn("html", F.when(ok, html))
    uri = F.col("metadata").getItem("uri")
    if strict:
        uri = F.when(ok, uri).otherwise(F.raise_error(F.lit("page file without its metadata block")))
        return out.withColumn("uri", uri)
    return out.withColumn("uri", uri).withColumn(
        "error", F.when(~ok, F.lit("missing metadata header")))


def with_metadata_header(df: DataFrame, uri_col: str = "uri", body_col: str = "body") -> DataFrame:
    """SNK-3 helper: the saved form of a fetched page — header, then the body; key = md5(uri)."""
    content = F.concat(F.lit("<!-- METADATA\nuri: "), F.col(uri_col), F.lit("\nlocal: false\n-->\n"), F.col(body_col))
    return df.select(urls.url_host(uri_col).alias("host"), urls.md5_hex(uri_col).alias("page_key"),
                     F.col(uri_col).alias("uri"), content.alias("content"))


def save_raw_pages(fetched: DataFrame, path: str, uri_col: str = "uri", body_col: str = "body") -> None:
    """SNK-3: fetched pages with their metadata header, clustered into a fixed number of host buckets and
    keyed by md5(uri); a reader keeps one row per key (``distinct_pages``), so a replayed write does no harm."""
    pages = with_metadata_header(fetched, uri_col, body_col).withColumn("bucket", F.pmod(F.xxhash64("host"), F.lit(HOST_BUCKETS)))
    pages.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(path)
