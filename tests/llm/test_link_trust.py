"""Operator 11 against a plain walk in Python and against its SQL, on small webs with odd rows."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from quarry.llm import link_trust as lt

R = random.Random(11)
HOSTS = ["a.example.com", "www.example.com", "example.com", "com", "xcom", "net", "s1.example.net", "s2.example.net", "S3.Example.NET", "o1.org", "o2.org",
         "o3.org", "o4.org", "o5.org", "farm.example.net"]


def html(links):
    made = []
    for i, x in enumerate(links):
        made.append([f'<a href="{x}">x</a>', f"<A class='b' HREF = '{x}'>x</A>", f"<a\nhref={x}>x</a>", f'<a title="t"href="{x}">'][i % 4])
    return "<p>t</p>" + "".join(made) + '<!-- <a href="http://o1.org/"> --><script>"<a href=\'http://o2.org/\'>"</script><b data-href="http://o3.org/">'


def web():
    rows = []
    for i in range(150):
        host = HOSTS[0] if i % 3 == 0 else R.choice(HOSTS)
        path = R.choice(["/en/1", "/es/2", "/fr/3", "/de/4", "", "/", "/en", "/x?y=/fr/"])
        if host == "farm.example.net":
            path = "/fr/9"
        if host == "s1.example.net":
            path = R.choice(["/es/1", "/fr/1", "/es/2", "/de/1"])
        links = [R.choice(["http://", "//", "HTTPS://"]) + R.choice([h for h in HOSTS if h != "o1.org"] + ["unseen.org"]) + R.choice(["/a", "", "?q", "#f"]) for _ in range(R.randint(0, 4))]
        if host == "o1.org":
            links = ["http://farm.example.net/fr/1", "//farm.example.net"]
        rows.append((i, f"{R.choice(['http', 'https'])}://{host}{path}{R.choice(['', '#top', '?a=b'])}", html(links + ["/rel", "mailto:x@o1.org", "rel//o2.org"])))
    return rows + [(900, None, html(["//o1.org"])), (901, "no scheme", html(["//o1.org"])), (902, "", None), (903, "x://", ""), (904, "http://o2.org/a", None),
                   (905, "http://O2.org\n/en/b", html([]) + "z" * 300_000), (1, rows[1][1], rows[1][2]), (906, "a://com://b/", "")]


def brute(rows, s=lt.Spread()):
    low = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x)
    urls = []
    for page, url, _ in rows:
        rest = (url or "").partition("://")[2]
        host = low(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fit = [r for r in lt.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        urls.append((page, host, path, max(fit, key=lambda r: len(r.text), default=None)))
    links = Counter()
    for (_, _, text), (_, host, _, _) in zip(rows, urls, strict=True):
        bare = re.sub(r"(?is)<script[ >].*?</script", " ", re.sub(r"(?s)<!--.*?-->", " ", text or ""))
        for tag in re.findall(r"(?i)<a\s[^>]*>", bare):
            m = re.search(r"""(?i)[\s"']href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\s]*)""", tag)
            if m and low(m[1]) and host and low(m[1]) != host:
                links[host, low(m[1])] += 1
    pages, scores = defaultdict(list), {}
    for _, host, _, rule in urls:
        if host:
            pages[host].append(rule.verdict if rule else None)
    for kind, word in (("trust", "allow"), ("distrust", "block")):
        seeds = {h: 1.0 for h, v in pages.items() if v.count(word) > s.seed_share * len(v)}
        edges = {(a, b) if kind == "trust" else (b, a): n for (a, b), n in links.items()}
        out = Counter()
        for (a, _), n in edges.items():
            out[a] += n
        now = dict(seeds)
        for _ in range(s.steps):
            new = defaultdict(float, seeds)
            for (a, b), n in edges.items():
                if a in now:
                    new[b] += s.damping * now[a] * n / out[a]
            now = new
        scores[kind] = now
    bad = {h for h, d in scores["distrust"].items() if d >= s.floor and d > s.ratio * scores["trust"].get(h, 0)}
    return sorted((p, h, x, r.text if r else None, r.verdict if r else "block" if h in bad else "allow") for p, h, x, r in urls), bad


@pytest.fixture
def pages_of(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "h", 1, "v") for r in rows], "page_id long, url string, html string, host string, n long, verdict string")
    return make


def test_query_against_brute_force_and_sql(pages_of):
    rows = web()
    want, bad = brute(rows)
    assert "o1.org" in bad and len(bad) > 2          # reached by links alone
    got = sorted((tuple(r) for r in lt.url_verdicts(pages_of(rows)).collect()))
    assert got == want
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(con.sql(lt.ORACLE).fetchall()) == want


def test_hosts_with_many_partners_are_split(pages_of, monkeypatch):
    rows = web()
    whole = sorted(map(tuple, lt.host_scores(lt.host_links(pages_of(rows)), lt.host_seeds(lt.ruled(lt.parsed(pages_of(rows)), lt.RULES), .5)).collect()))
    monkeypatch.setattr(lt, "LINKS_PER_PART", 2)
    split = sorted(map(tuple, lt.host_scores(lt.host_links(pages_of(rows)), lt.host_seeds(lt.ruled(lt.parsed(pages_of(rows)), lt.RULES), .5)).collect()))
    assert [x[:2] for x in whole] == [x[:2] for x in split]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(whole, split, strict=True))


def test_allowed_pages_keep_their_columns(pages_of):
    rows = web()
    want = sorted(p for p, *_, v in brute(rows)[0] if v == "allow")
    kept = lt.allowed_pages(pages_of(rows))
    assert kept.columns == ["page_id", "url", "html", "host", "n", "verdict"]
    assert sorted(r.page_id for r in kept.collect()) == want


def test_empty_table_and_plan_without_python(pages_of):
    none = lt.url_verdicts(pages_of([]))
    assert none.count() == 0
    plan = none._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_longest_rule_wins_and_ties_are_defined(pages_of):
    rules = (lt.Rule("allow", "b.org", "/"), lt.Rule("block", "a.b.org", "/x/"), lt.Rule("allow", "org", "/xxxx"), lt.Rule("block", "org", "/xxxx"))
    rows = [(1, "h://a.b.org/x/1", ""), (2, "h://a.b.org/y", ""), (3, "h://c.org/xxxxy", ""), (4, "h://xb.org/", "")]
    got = {r.page_id: (r.rule, r.rule_verdict) for r in lt.ruled(lt.parsed(pages_of(rows)), rules).collect()}
    assert got == {1: ("a.b.org/x/", "block"), 2: ("b.org/", "allow"), 3: ("org/xxxx", "block"), 4: (None, None)}
