"""URL filters: rules by host and path, and for the rest link-graph propagation over host edges.

A page's own rule wins: a rule fits its host and all subdomains if the path starts with the rule's;
the longest one decides.  Where no rule fits, the host decides.  Hosts with more than ``seed_share`` of their
pages allowed by rules are trusted seeds, those with more than that share blocked are blocked seeds.
Trust walks along the links from the trusted seeds (personalised PageRank); distrust walks from the blocked
seeds against the links, so it reaches hosts that link to them.  A host is blocked when its distrust
is at least ``floor`` and more than ``ratio`` times its trust.

Scores are sums over walks of at most ``steps`` links, in units of one seed: a seed has at least 1.  What a
host without links holds is not dealt out again to the seeds; that would only multiply all scores
of one kind by one number.  So no total over the graph is needed in a step, and each step reads the scores once.

Spark does all of it: links are read from the markup by regular expressions, host pairs are counted with
map-side aggregation, both walks are one frame told apart by ``kind``.  A host with very many partners is split over
several join keys (``LINKS_PER_PART``).  Every ``WRITE_STEPS`` steps the scores are written to the shared folder.  The
pages meet only the table of blocked hosts, which is written first: broadcast below Spark's own byte
threshold, beyond it joined with skew splitting.

Defined results: a null url, or one without ``://``, has empty host and path, no rule, and is allowed; a null html has no links;
of links, those with a host of their own count (comments and scripts are no markup), each occurrence once; links inside a host and to an empty host
do not count; hosts of links without pages take part but are no seeds; of equally long rules the one with the longer host, then the
blocking one, decides; repeated rows count as pages of their own; an empty table gives an empty one; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table, written
from quarry.session import sized_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Partners of one host under one join key; a host with more is split.
LINKS_PER_PART = 100_000
WRITE_STEPS = 5
NOT_MARKUP = [r"(?s)<!--.*?-->", r"(?is)<script[ \t\n\f\r>].*?</script"]
LINK_HOST = r"""(?i)<a[ \t\n\f\r](?:[^>]*?[ \t\n\f\r"'])?href[ \t\n\f\r]*=[ \t\n\f\r]*["']?[ \t\n\f\r]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'> \t\n\f\r]*)"""


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str  # begins with /

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


@dataclass(frozen=True)
class Spread:
    """How trust and distrust spread, and what blocks a host."""

    seed_share: float = 2 / 3
    damping: float = 0.85
    steps: int = 20
    floor: float = 0.01
    ratio: float = 1.0


def parsed(pages: DataFrame, *carry: str) -> DataFrame:
    """page_id, host, path and ``carry`` of every page."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url")))
    return (pages.select("page_id", *carry, F.coalesce(rest, F.lit("")).alias("_rest"))
            .select("page_id", *carry, F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
                    F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1).alias("path")))


def _ordered(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block", r.text))


def ruled(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``urls`` with ``rule`` and ``rule_verdict`` (null where no rule fits)."""
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(_ordered(rules)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between the hosts of pages and other hosts."""
    markup = F.col("html")
    for pattern in NOT_MARKUP:
        markup = F.regexp_replace(markup, pattern, " ")
    hosts = F.regexp_extract_all(markup, F.lit(LINK_HOST), 1)
    links = parsed(pages, "html").select(F.col("host").alias("src"), hosts.alias("_all"))
    return (links.select("src", F.explode("_all").alias("_dst")).select("src", F.translate("_dst", UPPER, LOWER).alias("dst"))
            .where((F.col("src") != F.col("dst")) & (F.col("src") != "") & (F.col("dst") != ""))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def host_seeds(judged: DataFrame, share: float) -> DataFrame:
    """kind, host: trusted and blocked seeds of pages with ``rule_verdict``."""
    counts = (judged.where("host <> ''").groupBy("host")
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rule_verdict") == "allow").alias("allow"),
                   F.count_if(F.col("rule_verdict") == "block").alias("block")))
    kind = F.when(F.col("allow") > share * F.col("n"), "trust").when(F.col("block") > share * F.col("n"), "distrust")
    return counts.select(kind.alias("kind"), "host").where(F.col("kind").isNotNull())


def _walks(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges of both walks (kind, src, salt, dst, p, parts of dst), and (kind, host, parts)."""
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    ends = written(both.groupBy("kind", "src").agg(F.sum("n").alias("out"), F.ceil(F.count(F.lit(1)) / LINKS_PER_PART).alias("parts")),
                   "link-ends")
    hosts = ends.select("kind", F.col("src").alias("host"), "parts")
    edges = (both.join(ends, ["kind", "src"])
             .select("kind", "src", F.pmod(F.xxhash64("dst"), "parts").alias("salt"), "dst", (F.col("n") / F.col("out")).alias("p"))
             .join(hosts.withColumnRenamed("host", "dst"), ["kind", "dst"], "left")
             .select("kind", "src", "salt", "dst", "p", F.coalesce("parts", F.lit(0).cast("long")).alias("parts")))
    return written(edges, "link-edges"), hosts


def host_scores(links: DataFrame, seeds: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """kind, host, score of every host that a walk reaches.  ``links``: src, dst, n; ``seeds``: kind, host."""
    links = written(links, "host-links")
    edges, hosts = _walks(links)
    base = written(seeds.join(hosts, ["kind", "host"], "left")
                   .select("kind", "host", F.coalesce("parts", F.lit(0).cast("long")).alias("parts"), F.lit(1.0).alias("score")), "link-seeds")
    scores = base
    for step in range(1, spread.steps + 1):
        # A host stands once for each of its parts; one without links onwards stands nowhere.
        at = (scores.where("parts > 0")
              .select("kind", F.col("host").alias("src"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"), "score"))
        moved = edges.join(at, ["kind", "src", "salt"]).select(
            "kind", F.col("dst").alias("host"), "parts", (F.col("score") * F.col("p") * spread.damping).alias("score"))
        scores = base.unionByName(moved).groupBy("kind", "host").agg(F.max("parts").alias("parts"), F.sum("score").alias("score"))
        if step % WRITE_STEPS == 0 or step == spread.steps:
            scores = written(scores, "host-scores")
    return scores.select("kind", "host", "score")


def blocked_hosts(scores: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """host of those whose distrust outweighs their trust.  Nine digits: sums differ by their order."""
    of = lambda kind: F.round(F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)), 9)
    return (scores.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
            .where((F.col("distrust") >= spread.floor) & (F.col("distrust") > spread.ratio * F.col("trust"))).select("host"))


def url_verdicts(pages: DataFrame, rules: Sequence[Rule] = RULES, spread: Spread = Spread()) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    judged = ruled(parsed(pages), rules)
    scores = host_scores(host_links(pages), host_seeds(judged, spread.seed_share), spread)
    blocked = sized_side(blocked_hosts(scores, spread)).withColumn("_blocked", F.lit(True))
    return (judged.join(blocked, "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("rule_verdict", F.when(F.col("_blocked"), "block").otherwise("allow")).alias("verdict")))


def allowed_pages(pages: DataFrame, rules: Sequence[Rule] = RULES, spread: Spread = Spread()) -> DataFrame:
    """The pages whose own url is allowed, with every column as it was."""
    packed = pages.select("page_id", "url", "html", F.struct(*[pages[c] for c in pages.columns]).alias("_row"))
    judged = ruled(parsed(packed, "_row"), rules)
    scores = host_scores(host_links(packed), host_seeds(judged, spread.seed_share), spread)
    blocked = sized_side(blocked_hosts(scores, spread)).withColumn("_blocked", F.lit(True))
    kept = judged.join(blocked, "host", "left").where(
        F.coalesce(F.col("rule_verdict") == "allow", F.col("_blocked").isNull()))
    return kept.select("_row.*")


def op11_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def _oracle(rules: Sequence[Rule], s: Spread) -> str:
    fits = [(r, f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')") for r in _ordered(rules)]
    case = lambda of: "CASE " + " ".join(f"WHEN {c} THEN '{of(r)}'" for r, c in fits) + " END"
    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    markup = "html"
    for p in NOT_MARKUP:
        markup = f"regexp_replace({markup}, '{p}', ' ', 'g')"
    steps = "".join(f""",
s{k} AS (SELECT kind, host, sum(score) AS score FROM (SELECT kind, host, 1.0::DOUBLE AS score FROM seeds UNION ALL
  SELECT e.kind, e.dst, x.score * e.p * {s.damping} FROM edges e JOIN s{k - 1} x ON x.kind = e.kind AND x.host = e.src) GROUP BY ALL)"""
                    for k in range(1, s.steps + 1))
    link = LINK_HOST.replace("'", "''")
    return rf"""
WITH r AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, html, {lower("regexp_extract(rest, '^[^/?#]*', 0)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (SELECT page_id, host, path, {case(lambda r: r.text)} AS rule, {case(lambda r: r.verdict)} AS rv FROM u),
hc AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE rv = 'allow') AS a, count(*) FILTER (WHERE rv = 'block') AS b FROM j WHERE host <> '' GROUP BY host),
seeds AS (SELECT * FROM (SELECT CASE WHEN a > {s.seed_share!r} * n THEN 'trust' WHEN b > {s.seed_share!r} * n THEN 'distrust' END AS kind, host FROM hc) WHERE kind IS NOT NULL),
lk AS (SELECT host AS src, {lower("d")} AS dst FROM (SELECT host, unnest(regexp_extract_all({markup}, '{link}', 1)) AS d FROM u)),
l AS (SELECT src, dst, count(*) AS n FROM lk WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY ALL),
b AS (SELECT 'trust' AS kind, src, dst, n FROM l UNION ALL SELECT 'distrust', dst, src, n FROM l),
edges AS (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS p FROM b),
s0 AS (SELECT kind, host, 1.0::DOUBLE AS score FROM seeds){steps},
bl AS (SELECT host FROM (SELECT host, round(coalesce(sum(score) FILTER (WHERE kind = 'trust'), 0), 9) AS t,
  round(coalesce(sum(score) FILTER (WHERE kind = 'distrust'), 0), 9) AS d FROM s{s.steps} GROUP BY host) WHERE d >= {s.floor} AND d > {s.ratio} * t)
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN host IN (SELECT host FROM bl) THEN 'block' ELSE 'allow' END) AS verdict FROM j
"""


ORACLE = _oracle(RULES, Spread())
