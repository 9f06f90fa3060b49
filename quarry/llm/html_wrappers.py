"""Operator 8, main text of web pages by wrappers inferred for each host (union-free expressions).

A page is read as nested token streams: for each element the sequence of its block children and text
slots.  Texts that stand on most of a host's pages at the same place are template, the others data; Spark counts
them by host, place and digest.  Pages of one skeleton are a layout.  Streams of the same place (host, layout and
element path) are aligned one after another: runs that repeat become repeated groups, tokens that only one side
has become optional groups, and texts are slots, of data or of template.  The result is the layout's wrapper: a
union-free expression for each place.  Names and roles of elements set surroundings apart; the article is an
<article> or <main> with text, else the deepest element with most of the layout's data, or, if that is in a
repeated group, the element around the group.  Each page is read along the wrapper of its layout: template texts
outside <article> and <main> are dropped, unless the page has nothing else, and a page without data
in its layout's article gives its own largest block.

Streams are collapsed and counted in every batch before they are shuffled, and a place's distinct
streams are folded in SALT parts first.  A layout is a group of its own, so a host with a third of all pages makes no
larger group than one skeleton has places.  Pages join the template by host and the wrapper by host and layout;
Catalyst chooses the joins by size.

Defined results: null and empty html give an empty text; a page without a usable url belongs to the host
''; a repeated page gives equal rows; html cut off anywhere is read as if its elements were
closed; a white-space run, also across inline tags or <br>, is one space; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table, written

SALT = 32
LONGEST_GROUP = 4              # tokens of a repeated group that is looked for
TEMPLATE_PAGES = 3             # a text on fewer pages of a host is data
TEMPLATE_SHARE = 0.5           # a text on more than this share of the host's pages with its place is template
SCHEMA = "page_id long, url string, text string, n_chars long"

# --- fixed values: how HTML names things ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style noscript template head title iframe object svg canvas math select textarea button "
                   "option input audio video".split())
AROUND = frozenset("nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog".split())
AROUND_NAMES = re.compile(
    r"(?:^|[-_ .])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|newsletter|subscri\w*|"
    r"popup|modal|overlay|shar(?:e|ing)|social|related|recommend\w*|breadcrumbs?|menu|nav\w*|side-?bar|widget\w*|footer|"
    r"masthead|site-?header|page-?header|comments?|commentlist|disqus|respond|replies|toolbar|pagination|pager|login|"
    r"signup|search)(?:$|[-_ .])", re.I)
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                     "pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}
NAMED = re.compile(r"/(?:article|main)(?:\.[^/!]*)?(?:/|$)")
LEAF = re.compile(r"/(?:p|h\d|li|td|th|tr|pre|blockquote|dd|dt)(?:\.[^/!]*)?(?:/|$)")
# --------------------------------------------

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>|<[!?][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def label_of(tag: str, attributes: str) -> tuple[str, bool]:
    """Name of an element in paths, and whether its name, role or class puts it around the article."""
    around = tag in AROUND or tag in UNSEEN
    if not attributes:
        return tag, around
    names = []
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "role" and value.lower() in ROLES:
            around = True
        elif key != "role":
            names += value.split()
    if names and tag not in ("html", "body", "article", "main") and not around:
        around = any(AROUND_NAMES.search(n) for n in names)
    name = ".".join([tag, *sorted(re.sub(r"[^\w-]+", "_", re.sub(r"\d+", "0", n)) for n in names)])
    return name, around


def blocks_of(source: str | None) -> Iterator[tuple[str, str, str]]:
    """Events of a page in order: ('open', path, label), ('close', path, ''), ('text', path, text).

    A path ends in '!' below an element that lies around the article.  The text of a block is one event."""
    source = source or ""
    path, tags = [""], [""]
    text: list[str] = []
    at = 0

    def flush():
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if joined:
                yield "text", path[-1], joined

    def close(to: int):
        while len(tags) > to:
            yield "close", path.pop(), ""
            tags.pop()

    for m in TOKEN.finditer(source):
        if m.start() > at:
            text.append(source[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue                                       # comment, script, style, title, declaration
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif tag in UNSEEN:
                continue
            continue
        yield from flush()
        if m[2]:
            if tag in tags:
                yield from close(len(tags) - 1 - tags[::-1].index(tag))
            continue
        if tag in CLOSES_P and "p" in tags:
            yield from close(len(tags) - 1 - tags[::-1].index("p"))
        if tag in SIBLINGS:
            for i in range(len(tags) - 1, 0, -1):
                if tags[i] in SCOPES[tag]:
                    break
                if tags[i] in SIBLINGS[tag]:
                    yield from close(i)
                    break
        label, around = label_of(tag, m[4])
        above = path[-1]
        inside = "/article" in above or "/main" in above
        if tag == "header" and not inside:
            around = True
        mark = "!" if above.endswith("!") or around else ""
        yield "open", above, label
        if tag in VOID:
            continue
        path.append(f"{above.rstrip('!')}/{label}{mark}")
        tags.append(tag)
    if at < len(source):
        text.append(source[at:])
    yield from flush()
    yield from close(1)


# ---- union-free expressions: a list of items 'label', 'label?', 'label+', 'label*'; a group is '(a b)' ----

def base(item: str) -> str:
    return item[:-1] if item[-1] in "?+*" else item


def join_flags(a: str, b: str, optional: bool = False, repeated: bool = False) -> str:
    flags = {i[-1] for i in (a, b) if i[-1] in "?+*"}
    optional |= bool(flags & {"?", "*"})
    repeated |= bool(flags & {"+", "*"})
    return base(a) + ("*" if optional and repeated else "?" if optional else "+" if repeated else "")


def collapse(items: list[str]) -> list[str]:
    """Runs of equal items, and of equal groups of items, as one repeated item."""
    out = list(items)
    for size in range(1, LONGEST_GROUP + 1):
        i, made = 0, []
        while i < len(out):
            group = [base(x) for x in out[i:i + size]]
            j = i + size
            while len(group) == size and [base(x) for x in out[j:j + size]] == group:
                j += size
            if j > i + size:
                if size == 1:
                    item = out[i]
                    for other in out[i + 1:j]:
                        item = join_flags(item, other, repeated=True)
                    # one obligatory occurrence makes the whole run obligatory
                    if any(x[-1] not in "?*" for x in out[i:j]):
                        item = base(item) + "+"
                    made.append(item)
                else:
                    made.append("(" + " ".join(out[i:i + size]) + ")+")
                i = j
            else:
                made.append(out[i])
                i += 1
        out = made
    return out


def align(a: list[str], b: list[str]) -> list[str]:
    """The expression that covers both: what one side lacks becomes optional."""
    if a == b:
        return a
    n, m = len(a), len(b)
    x, y = [base(i) for i in a], [base(i) for i in b]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and x[i] == y[j]:
            out.append(join_flags(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append(join_flags(a[i], a[i], optional=True))
            i += 1
        else:
            out.append(join_flags(b[j], b[j], optional=True))
            j += 1
    return collapse(out)


def layout_of(paths: Iterable[str]) -> int:
    """Digest of a page's skeleton: its places that can hold blocks, down to <article> and <main>."""
    places = {p for p in paths if not p.endswith("!") and not LEAF.search(p)}
    skeleton = sorted(p for p in places if not NAMED.search(p.rsplit("/", 1)[0]))
    return digest("\n".join(skeleton))


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def is_candidate(path: str) -> bool:
    """Whether constant text at the place is template: not around an article anyway, and not inside its tag."""
    return not path.endswith("!") and not NAMED.search(path)


def streams(source: str | None, constant: frozenset = frozenset()) -> dict[str, tuple[list[list[str]], int]]:
    """Path -> the collapsed token streams of the elements there, and the characters of their own data.
    A text is '#' where it is data and '=' where it is constant over the host's pages."""
    found: dict[str, tuple[list[list[str]], int]] = {}
    stack: list[list[str]] = [[]]
    chars: dict[str, int] = defaultdict(int)
    seen: dict[str, list[list[str]]] = defaultdict(list)
    for kind, path, what in blocks_of(source):
        if kind == "text":
            data = not constant or (path, digest(what)) not in constant
            stack[-1].append("#" if data else "=")
            chars[path] += len(what) if data else 0
        elif kind == "open":
            stack[-1].append(what)
            if what.split(".")[0] not in VOID:
                stack.append([])
        else:
            seen[path].append(collapse(stack.pop()))
    seen[""].append(collapse(stack[0]))
    for path, lists in seen.items():
        distinct = list({json.dumps(s): s for s in lists}.values())
        found[path] = (distinct, chars[path])
    return found


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def constants(pages: DataFrame) -> DataFrame:
    """host, constant (JSON: place -> digests of its template texts).  A text is template where it stands on most of the
    host's pages that have its place, and on different ones: exact copies of one page make nothing template."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple, list[int]] = {}
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page, own = digest(source or ""), set()
                for kind, path, what in blocks_of(source):
                    if kind == "text" and is_candidate(path):
                        own |= {(host, path, digest(what)), (host, path, None)}
                for key in own:
                    n, low, high = counts.get(key, (0, page, page))
                    counts[key] = [n + 1, min(low, page), max(high, page)]
            rows = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int64()), *(pa.array([counts[r][k] for r in rows], pa.int64()) for k in range(3))],
                names=["host", "path", "h", "n", "low", "high"])

    counted = written(pages.select(host_of(F.col("url")).alias("host"), "html")
                      .mapInArrow(run, "host string, path string, h long, n long, low long, high long")
                      .groupBy("host", "path", "h").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
                      .where(F.col("h").isNull() | (F.col("n") >= TEMPLATE_PAGES)), "html-texts")
    places = counted.where(F.col("h").isNull()).select("host", "path", F.col("n").alias("pages"))
    return (counted.where(F.col("h").isNotNull() & (F.col("low") != F.col("high"))).join(places, ["host", "path"])
            .where(F.col("n") > TEMPLATE_SHARE * F.col("pages"))
            .groupBy("host", "path").agg(F.sort_array(F.collect_list("h")).alias("hs"))
            .groupBy("host").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("path", "hs")))).alias("constant")))


def with_constants(pages: DataFrame, template: DataFrame) -> DataFrame:
    """_host, html, constant and the named columns of every page."""
    return (pages.select("page_id", "url", "html", host_of(F.col("url")).alias("_host"))
            .join(template.select(F.col("host").alias("_host"), "constant"), "_host", "left"))


class Known:
    """Parsed template texts of the hosts a task has met."""

    def __init__(self) -> None:
        self.parsed: dict[str, frozenset] = {}

    def get(self, constant: str | None) -> frozenset:
        if constant is None:
            return frozenset()
        if constant not in self.parsed:
            if len(self.parsed) > 1000:
                self.parsed.clear()
            self.parsed[constant] = frozenset((p, h) for p, hs in json.loads(constant).items() for h in hs)
        return self.parsed[constant]


def stream_counts(pages: DataFrame, template: DataFrame) -> DataFrame:
    """host, layout, path, stream, chars: the distinct token streams of every place, counted in each batch first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in batches:
            counts: dict[tuple, int] = defaultdict(int)
            for host, source, constant in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = streams(source, known.get(constant))
                layout = layout_of(found)
                for path, (lists, chars) in found.items():
                    if path.endswith("!"):
                        continue
                    for i, s in enumerate(lists):
                        counts[host, layout, path, json.dumps(s)] += 0 if i else chars
            rows = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 *(pa.array([r[k] for r in rows], pa.string()) for k in (2, 3)), pa.array([counts[r] for r in rows], pa.int64())],
                names=["host", "layout", "path", "stream", "chars"])

    return (with_constants(pages, template).select(F.col("_host").alias("host"), "html", "constant")
            .mapInArrow(run, "host string, layout long, path string, stream string, chars long")
            .groupBy("host", "layout", "path", "stream").agg(F.sum("chars").alias("chars")))


def fold(group: pd.DataFrame) -> tuple[str, int]:
    wrapper: list[str] | None = None
    for s in sorted(group["stream"]):
        items = json.loads(s)
        wrapper = items if wrapper is None else align(wrapper, items)
    return json.dumps(wrapper), int(group["chars"].sum())


def repeats(path: str, expressions: dict[str, list[str]]) -> bool:
    """Whether the element is in a repeated group of its parent's expression."""
    above, _, label = path.rpartition("/")
    return any(item[-1] in "+*" and label in base(item).strip("()").split() or item[:1] == "(" and label in
               (base(x) for x in base(item).strip("()").split()) for item in expressions.get(above, ()))


def main_path(places: dict[str, int], expressions: dict[str, list[str]]) -> str:
    """The element that holds the article of a layout: <article> or <main> where there is one, else the deepest
    element with most of the data that does not lie around it; of a repeated group, the element around the group."""
    below: dict[str, int] = defaultdict(int)
    for path, chars in places.items():
        if not path.endswith("!"):
            parts = path.split("/")
            for k in range(1, len(parts) + 1):
                below["/".join(parts[:k])] += chars
    named = [p for p in below if re.fullmatch(r"article|main", p.rsplit("/", 1)[-1].split(".")[0])]
    if named and any(below[p] for p in named):
        inner = [p for p in named if re.match("article", p.rsplit("/", 1)[-1]) and below[p]] or named
        return max(inner, key=lambda p: (below[p], p))
    total = below.get("", 0)
    holders = [p for p in below if below[p] >= 0.7 * total and not LEAF.search(p)]
    best = max(holders, key=lambda p: (p.count("/"), below[p], p), default="")
    while best and repeats(best, expressions):
        best = best.rpartition("/")[0]
    return best


def wrappers(pages: DataFrame) -> DataFrame:
    """host, layout, main (path of the article), constant (template texts of the host), one row for each layout."""
    template = written(constants(pages), "html-constants")
    counted = stream_counts(pages, template).withColumn("salt", F.pmod(F.xxhash64("stream"), F.lit(SALT)))

    def part(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        wrapper, chars = fold(group)
        return pd.DataFrame({"host": [key[0]], "layout": [key[1]], "path": [key[2]], "stream": [wrapper], "chars": [chars]})

    def whole(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        places = {path: fold(g) for path, g in group.groupby("path")}
        main = main_path({p: c for p, (_, c) in places.items()}, {p: json.loads(w) for p, (w, _) in places.items()})
        return pd.DataFrame({"host": [key[0]], "layout": [key[1]], "main": [main]})

    parts = counted.groupBy("host", "layout", "path", "salt").applyInPandas(
        part, "host string, layout long, path string, stream string, chars long")
    return (parts.groupBy("host", "layout").applyInPandas(whole, "host string, layout long, main string")
            .join(template, "host", "left"))


def choose(texts: list[dict], main: str | None) -> str:
    """The data texts in the layout's article, in page order; a page that has none there gives its own largest block.
    Template texts count only on a page that has nothing else."""
    every = lambda path: bool(NAMED.search(path))
    inside = lambda path: main is not None and (path == main or path.startswith(main + "/"))
    data = [t for t in texts if t["data"]]
    kept = [t for t in data if inside(t["path"]) or every(t["path"])]
    if not kept and texts:
        left, places = data or texts, defaultdict(int)
        for t in left:
            places[t["path"]] += len(t["text"])
        own = main_path(places, {})
        kept = [t for t in left if t["path"] == own or t["path"].startswith(own + "/")]
    return "\n".join(t["text"] for t in kept)


def extract(pages: DataFrame, found: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, read along the wrapper of its host and layout."""
    template = found.where(F.col("constant").isNotNull()).groupBy("host").agg(F.first("constant").alias("constant"))
    texts = "array<struct<path:string,text:string,data:boolean>>"
    arrow = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("data", pa.bool_())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in batches:
            layouts, made = [], []
            for source, constant in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                paths, own, some = {""}, [], known.get(constant)
                for kind, path, what in blocks_of(source):
                    if kind == "close":
                        paths.add(path)
                    elif kind == "text" and not path.endswith("!"):
                        own.append({"path": path, "text": what, "data": not some or (path, digest(what)) not in some})
                layouts.append(layout_of(paths))
                made.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), batch.column(2).cast(pa.string()),
                 pa.array(layouts, pa.int64()), pa.array(made, arrow)], names=["page_id", "url", "_host", "layout", "texts"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [choose(t, main) for t, main in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    parsed = (with_constants(pages, template).select("page_id", "url", "_host", "html", "constant")
              .mapInArrow(read, f"page_id long, url string, _host string, layout long, texts {texts}"))
    mains = found.select(F.col("host").alias("_host"), "layout", "main")
    return (parsed.join(mains, ["_host", "layout"], "left").select("page_id", "url", "texts", "main")
            .mapInArrow(write, SCHEMA))


def op8_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, written(wrappers(pages), "html-wrappers"))
