from pyspark.sql import functions as F

from quarry.operators import web

ROBOTS = """# comment line
User-agent: *
Disallow: /private/
Allow: /private/ok
Disallow: /*.cgi

User-agent: badbot
Disallow: /
"""


def test_robots_parse_and_match(spark):
    robots = spark.createDataFrame([("h.example.com", ROBOTS)], "host string, text string")
    rules = web.parse_robots(robots, "quarrybot")
    assert sorted((r["kind"], r["pattern"]) for r in rules.collect()) == \
        [("allow", "/private/ok"), ("disallow", "/*.cgi"), ("disallow", "/private/")]
    urls = spark.createDataFrame([(1, "http://h.example.com/private/x"), (2, "http://h.example.com/private/ok2"),
                                  (3, "http://h.example.com/a/b.cgi?x=1"), (4, "http://h.example.com/pub"),
                                  (5, "http://other.example.com/private/x")], "id long, url string")
    got = {r["id"]: r["allowed"] for r in web.robots_filter(urls, rules).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: True}
    bad = web.parse_robots(robots, "badbot")
    assert ("disallow", "/") in {(r["kind"], r["pattern"]) for r in bad.collect()}


def test_extension_blacklist(spark):
    df = spark.createDataFrame([("http://x.org/a/file.pdf",), ("http://x.org/IMG.PNG",), ("http://x.org/page",),
                                ("http://x.org/docs?x=1",)], "url string")
    kept = [r["url"] for r in web.extension_filter(df).collect()]
    assert kept == ["http://x.org/page", "http://x.org/docs?x=1"]


def test_content_type_filter(spark):
    df = spark.createDataFrame([("text/html; charset=utf-8",), ("image/png",), ("TEXT/PLAIN",)], "content_type string")
    assert web.content_type_filter(df).count() == 2


def test_host_allowed(spark):
    df = spark.createDataFrame([("http://a.com/x",), ("https://b.com/y",)], "url string")
    hosts = spark.createDataFrame([("a.com",)], "host string")
    assert [r["url"] for r in web.host_allowed(df, hosts).collect()] == ["http://a.com/x"]


HTML = """<html><head><title> My  Page </title><script>var a = "<a href='/no'>";</script>
<meta name="description" content=""></head><body><nav><a href="/a#frag">A</a> <a href="../b?q=1">B</a>
<a href="mailto:x@y.z">M</a><a href="bad link">C</a></nav><!-- <a href="/hidden"> -->
<article><h1>Head</h1><p>Hello <b>wor</b>ld &amp; more.</p></article><style>p{}</style></body></html>"""


def test_parse_page(spark):
    pages = spark.createDataFrame([(1, "http://s.org/dir/page.html", HTML)], "page_id long, url string, html string")
    p = web.parse_pages(pages).first()
    assert p["title"] == "My Page"
    assert p["links"] == ["http://s.org/a", "http://s.org/b?q=1"]
    assert p["words"] == ["a", "b", "mc", "head", "hello", "world", "more"]
    assert "var" not in p["words"] and "hidden" not in p["words"]
    # No block of this page stands out, so the blurb is taken from the whole body.
    assert p["blurb"] == "A B MC Head Hello world & more. "


def test_blurb_cut(spark):
    text = " ".join(["word"] * 100)
    df = spark.createDataFrame([(None, text)], "d string, t string")
    b = df.select(web.blurb(F.col("d"), F.col("t"))).first()[0]
    # 40 words reach exactly 200; the 41st crosses the bound, is kept, and "..." follows.
    assert b.endswith("word...") and b.count("word") == 41


def test_metadata_header(spark):
    df = spark.createDataFrame([("<!-- METADATA\nuri: http://a.b/c\nlocal: false\n-->\n<html>x</html>",),
                                ("<html>no header</html>",)], "content string")
    rows = web.read_raw_pages(df, strict=False).collect()
    assert rows[0]["uri"] == "http://a.b/c" and rows[0]["html"] == "<html>x</html>"
    assert rows[1]["uri"] is None and rows[1]["error"] is not None


def test_save_raw_pages(spark):
    import tempfile
    path = tempfile.mkdtemp(prefix="quarry-raw-") + "/raw"
    df = spark.createDataFrame([("http://a.org/x", "<p>x</p>"), ("http://b.org/y", "<p>y</p>")], "uri string, body string")
    web.save_raw_pages(df, path)
    back = spark.read.parquet(path)
    rows = {r["host"]: r for r in back.collect()}
    assert set(rows) == {"a.org", "b.org"}
    parsed = web.read_raw_pages(back.select("content")).collect()
    assert sorted(r["uri"] for r in parsed) == ["http://a.org/x", "http://b.org/y"]


def test_main_text_is_found_by_density_without_article_tags(spark):
    long = "a paragraph of plain prose that says something in more than a dozen words, "
    menu = "<ul>" + "".join(f'<li><a href="/{i}">a menu entry of quite a few words that are all inside a link</a></li>' for i in range(6)) + "</ul>"
    pages = [
        (1, f"<body>{menu}<div><h2>Head</h2><div>{long}one.</div><div>rather short.</div><div>{long}{long}two <a href='/x'>with a link</a>.</div></div>"
            f"<div>small print</div>{menu}</body>"),
        (2, f"<body><div>{long}alone.</div>{menu}<div>{long}first. {long}second. {long}third.</div></body>"),
        (3, f"<body>{menu}<p>too short to stand out</p></body>"), (4, ""), (5, None),
        (6, f"<body><p>{long}left open <a href='/y'>{long}<p>{long}not closed {long}"),
        (7, "<body>" + "<p>" + "word " * 40_000 + "</p>" * 2 + menu)]
    frame = spark.createDataFrame([(i, f"http://s.org/{i}", h) for i, h in pages], "page_id long, url string, html string")
    raw = frame.select("page_id", frame.url.alias("uri"), "html").mapInPandas(web._parse_batches, web.PARSED_SCHEMA)
    got = {r.page_id: r.main for r in raw.select("page_id", web.main_text("blocks").alias("main")).collect()}
    assert got[1] == f"{long}one. rather short. {long}{long}two with a link."
    assert got[2] == f"{long}first. {long}second. {long}third."
    assert got[3] == got[4] == got[5] == ""
    assert got[6].startswith(f"{long}left open") is False and "left open" not in got[6]
    assert got[7] == ("word " * 40_000).strip()

    def brute(blocks):
        scores = [b["words"] - 3 * b["linked"] - 8 for b in blocks]
        runs = [(-sum(scores[i:j + 1]), j, -i) for i in range(len(scores)) for j in range(i, len(scores))]
        best = min(runs, default=(0, 0, 0))
        return " ".join(b["text"] for b in blocks[-best[2]:best[1] + 1]) if best[0] < 0 else ""
    assert all(brute(r.blocks) == got[r.page_id] for r in raw.collect())
    blurbs = {r.page_id: r.blurb for r in web.parse_pages(frame).collect()}
    assert blurbs[1].startswith(long) and blurbs[3].startswith("a menu entry")
