import pytest
from pyspark.sql import functions as F

from quarry.functions import urls
from quarry.operators.topk import top_k
from quarry.sources import querylog


def test_top_k(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "value int")
    assert [r[0] for r in top_k(df, "value", 5).collect()] == [15, 16, 17, 18, 19]
    assert top_k(df, "value", 30).count() == 20
    assert [r[0] for r in top_k(df, "value", 1).collect()] == [19]
    assert top_k(df, "value", 0).count() == 0
    with pytest.raises(ValueError):
        top_k(df, "value", -1)
    df2 = spark.createDataFrame([(50,), (25,), (5,), (70,), (55,)], "value int")
    assert [r[0] for r in top_k(df2, "value", 5).collect()] == [5, 25, 50, 55, 70]


@pytest.mark.parametrize("raw,want", [
    ("", ""), ("foo", "foo"), ("%74%77%6f", "two"), ("%74%77%6F", "two"), ("%16nope", "%16nope"),
    ("%broken%1", "%broken%1"), ("%20+blah blah", "  blah blah"),
])
def test_url_decode(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "s string").select(urls.url_decode("s")).first()[0] == want


def _args(spark, url):
    df = spark.createDataFrame([(url,)], "u string").select(F.explode(urls.url_arg_pairs("u")).alias("a"))
    out = {}
    for r in df.orderBy("a.i").collect():
        out[r["a"]["key"]] = r["a"]["value"]
    return out


def test_url_args(spark):
    assert _args(spark, "/foo/bar") == {} and _args(spark, "/foo/bar?") == {}
    assert _args(spark, "?foo=blah+blah") == {"foo": "blah blah"}
    assert _args(spark, "?foo=bar&bam=baz") == {"foo": "bar", "bam": "baz"}
    assert _args(spark, "?foo=%22bar%22&bam=baz") == {"foo": '"bar"', "bam": "baz"}
    assert _args(spark, "?a=1&a=2&b") == {"a": "2"}


@pytest.mark.parametrize("raw,want", [
    ("Triumph & Disaster", "Triumph &amp; Disaster"), ("'Animals'", "&apos;Animals&apos;"),
    ("vectroid<int>", "vectroid&lt;int&gt;"),
])
def test_escape_html(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "s string").select(urls.escape_html("s")).first()[0] == want


def test_crc32(spark):
    df = spark.createDataFrame([(bytearray([1, 2, 3, 4]),)], "b binary")
    assert df.select(urls.crc32_hex("b")).first()[0] == "0xB63CFBCD"


def test_rounded_average_half_up(spark):
    from quarry.operators.topk import rounded_average
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 2.0), ("b", 3.0), ("c", -1.0), ("c", -2.0)],
                               "k string, v double")
    assert {r["k"]: r["avg"] for r in rounded_average(df, ["k"], "v").collect()} == {"a": 2, "b": 3, "c": -1}


def test_query_log_from_requests(spark):
    from quarry.sources import querylog
    reqs = spark.createDataFrame([(1, "/query?terms=Whale+Ocean"), (2, "/static/x.html"),
                                  (3, "/query?terms=a&terms=b%20c")], "query_id long, uri string")
    got = {r["query_id"]: r["raw"] for r in querylog.from_requests(reqs).collect()}
    assert got == {1: "Whale Ocean", 3: "b c"}


def test_search_requests_carry_their_own_number_of_results(spark):
    reqs = spark.createDataFrame([
        (1, "/search?query=a+b%21&num_results=5"), (2, "/search?query=x"), (3, "/search?num_results=7&query=y&query=z&num_results=%38"),
        (4, "/search?query=q&num_results=many"), (5, "/search?num_results=0"), (6, "/search"), (7, None), (8, "/search?query=n&num_results=-1")],
        "query_id long, uri string")
    got = {r["query_id"]: (r["raw"], r["k"]) for r in querylog.from_search_requests(reqs).collect()}
    assert got == {1: ("a b!", 5), 2: ("x", 20), 3: ("z", 8), 4: ("q", 20), 5: ("", 0), 6: ("", 20), 7: ("", 20), 8: ("n", 20)}
