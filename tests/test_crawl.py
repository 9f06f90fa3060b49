"""Restartable crawl: order, admission by tables, normal forms, faults in the middle of a level."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.urls import normalised
from quarry.operators import crawl as c
from quarry.operators import web
from quarry.session import remove_path, scratch_path
from quarry.sources import files


@pytest.fixture(scope="module")
def net(spark):
    links = [("http://a.org", "http://A.org/x/../b#top"), ("http://a.org/", "http://b.org/"), ("http://a.org/b", "http://a.org/./c"),
             ("http://a.org/b", "http://bad.org/"), ("http://b.org", "http://b.org/pic.png"), ("http://b.org/", "http://b.org/no/1"),
             ("http://b.org/", "http://b.org/d"), ("http://a.org/c", "http://a.org/"), ("http://b.org/d", "http://a.org/e?q=1#f"),
             ("http://bad.org/", "http://a.org/never"), (None, "http://a.org/null"), ("http://a.org/c", None), ("http://a.org/c", "mailto:x")]
    return (spark.createDataFrame(links, "src_uri string, dst_uri string"),
            spark.createDataFrame([("HTTP://a.org#x",), ("http://a.org/",), (None,)], "uri string"),
            c.Admission(hosts=spark.createDataFrame([("a.org",), ("b.org",)], "host string"),
                        robots=spark.createDataFrame([("b.org", "disallow", "/no/")], "host string, kind string, pattern string"),
                        extensions=web.EXTENSION_BLACKLIST))


ORDER = [("http://a.org/", 0), ("http://a.org/b", 1), ("http://b.org/", 1), ("http://a.org/c", 2), ("http://b.org/d", 2), ("http://a.org/e?q=1", 3)]


def rows(df):
    return [(r.uri, r.distance) for r in df.orderBy("pos").collect()]


def test_one_run_and_stopped_runs_give_the_same_order(spark, net):
    links, seeds, admission = net
    assert rows(c.crawl(links, seeds, scratch_path(spark, "crawl"), 100, admission)) == ORDER
    state = scratch_path(spark, "crawl")
    for limit in (0, 1, 2, 4, 4, 100, 3):
        got = c.crawl(links, seeds, state, limit, admission)
        assert rows(got) == ORDER[:limit]
        assert [r.pos for r in got.orderBy("pos").collect()] == list(range(1, len(ORDER[:limit]) + 1))


def test_a_level_that_was_cut_off_is_written_again(spark, net):
    links, seeds, admission = net
    state = scratch_path(spark, "crawl")
    c.crawl(links, seeds, state, 3, admission)
    assert c.completed_levels(spark, state) == 2
    spark.createDataFrame([("http://half.org/", 2)], c.LEVEL).write.parquet(f"{state}/level-000002")
    remove_path(spark, f"{state}/level-000002/_SUCCESS")
    assert rows(c.crawl(links, seeds, state, 100, admission)) == ORDER


def test_urls_of_an_earlier_log_are_not_visited(spark, net):
    links, seeds, _ = net
    log = scratch_path(spark, "visited")
    files.append_visited(spark.createDataFrame([("http://b.org",)], "uri string"), log)
    got = c.crawl(links, seeds, scratch_path(spark, "crawl"), 100, c.Admission(visited=files.load_visited(spark, log)))
    assert ("http://b.org/", 1) not in rows(got) and ("http://bad.org/", 2) in rows(got)
    none = spark.createDataFrame([], "src_uri string, dst_uri string")
    assert rows(c.crawl(none, seeds.limit(0), scratch_path(spark, "crawl"), 5)) == []
    with pytest.raises(ValueError):
        c.crawl(none, seeds, scratch_path(spark, "crawl"), -1)


def test_normal_forms(spark):
    cases = {"HTTP://Ex.org": "http://ex.org/", "http://e.org/a/./b/../c": "http://e.org/a/c", "http://e.org/../../x": "http://e.org/x",
             "http://e.org/a/..": "http://e.org/", "http://e.org/a/b/..": "http://e.org/a/", "http://e.org/a/.": "http://e.org/a/",
             "http://e.org?Q=1#f": "http://e.org/?Q=1", "http://e.org/a.b/.c": "http://e.org/a.b/.c", "http://e.org//x": "http://e.org//x",
             "/rel": None, "mailto:x@e.org": None, "": None, None: None}
    frame = spark.createDataFrame([(k,) for k in cases], "u string")
    assert {r.u: r.n for r in frame.select("u", normalised("u").alias("n")).collect()} == cases
    for u, n in cases.items():
        if n and "//x" not in n and u.islower():
            assert web.resolve_link("http://e.org/", u).rstrip("/") == n.replace("/?", "?").rstrip("/")
    assert frame.where(F.col("u").isNull()).select(normalised("u")).first()[0] is None
