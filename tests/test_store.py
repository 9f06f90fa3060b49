import re

import pytest

from quarry.operators import index as ix
from quarry.operators import quality
from quarry.session import scratch_path
from quarry.sources import index_store


@pytest.fixture(scope="module")
def built(spark):
    docs = spark.createDataFrame([("a/1", "the cat sat. "), ("a/2", "the dog ran. "), ("b/1", "cat and dog. ")],
                                 "doc_name string, text string")
    return ix.build_index(docs, index_id=None)


def test_write_open_lookup(spark, built):
    path = scratch_path(spark, "test-index")
    manifest = index_store.write_index(built, path, buckets=8)
    assert manifest["n_docs"] == 3 and manifest["n_postings"] == 9
    idx, buckets = index_store.open_indexes(spark, [path])
    words = spark.createDataFrame([("cat",), ("dog",)], "word string")
    hits = index_store.lookup_words(idx, words, buckets)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (IN|=)", plan), plan
    assert sorted((r["word"], r["doc_id"]) for r in hits.collect()) == [("cat", 1), ("cat", 3), ("dog", 2), ("dog", 3)]
    checks = {r["check"]: r["violations"] for r in quality.check_index(idx, buckets).collect()}
    assert set(checks.values()) == {0}


def test_two_indices_keep_own_id_space(spark, built):
    p1, p2 = scratch_path(spark, "i1"), scratch_path(spark, "i2")
    index_store.write_index(built, p1, buckets=4)
    index_store.write_index(built, p2, buckets=4)
    idx, _ = index_store.open_indexes(spark, [p1, p2])
    assert idx.doc_table.select("index_id", "doc_id").distinct().count() == 6


def test_missing_manifest_is_invalid(spark):
    with pytest.raises(ValueError):
        index_store.open_index(spark, scratch_path(spark, "nothing-here"))


def test_checks_find_violations(spark):
    dt = spark.createDataFrame([("0", 1, "a"), ("0", 3, "b")], "index_id string, doc_id long, doc_name string")
    po = spark.createDataFrame([("0", "Cat", 1, 2, [5, 3]), ("0", "dog", 9, 1, [1])],
                               "index_id string, word string, doc_id long, n int, positions array<int>")
    checks = {r["check"]: r["violations"] for r in quality.check_index(ix.Index(dt, po)).collect()}
    assert checks["doc_id_dense"] == 1 and checks["word_ascii_lower"] == 1
    assert checks["positions_increasing"] == 1 and checks["posting_doc_resolves"] == 1


def test_tampered_index_fails_validation(spark, built):
    path = scratch_path(spark, "tamper")
    index_store.write_index(built, path, buckets=4)
    extra = spark.read.parquet(f"{path}/postings").limit(1)
    extra.write.mode("append").partitionBy("bucket").parquet(f"{path}/postings")
    with pytest.raises(ValueError):
        index_store.open_index(spark, path, validate=True)
    idx, _ = index_store.open_index(spark, path, validate=False)   # the web server's choice
    assert idx.postings.count() == 10


def test_distinct_pages(spark):
    from quarry.operators import web
    df = spark.createDataFrame([("u1", "b/x.html", "two"), ("u1", "a/x.html", "one"), ("u2", "c.html", "three")],
                               "uri string, path string, body string")
    got = {r["uri"]: (r["path"], r["body"]) for r in web.distinct_pages(df).collect()}
    assert got == {"u1": ("a/x.html", "one"), "u2": ("c.html", "three")}


def test_lookup_checks_only_the_buckets_it_reads(spark, built):
    path = scratch_path(spark, "digests")
    index_store.write_index(built, path, buckets=16)
    bucket = {r["word"]: r["bucket"] for r in spark.read.parquet(f"{path}/postings").select("word", "bucket").distinct().collect()}
    cat, other = "cat", next(w for w in bucket if bucket[w] != bucket["cat"])
    words = spark.createDataFrame([(cat,)], "word string")
    assert index_store.checked_lookup(spark, path, words).count() == 2 and index_store.changed_buckets(spark, path) == []
    extra = spark.read.parquet(f"{path}/postings").where(f"word = '{other}'").limit(1)
    extra.write.mode("append").partitionBy("bucket").parquet(f"{path}/postings")
    assert index_store.checked_lookup(spark, path, words).count() == 2
    assert index_store.changed_buckets(spark, path) == [bucket[other]]
    with pytest.raises(ValueError, match=rf"buckets \[{bucket[other]}\]"):
        index_store.checked_lookup(spark, path, spark.createDataFrame([(other,)], "word string"))
    spark.createDataFrame([(bucket[other], 99, 1)], "bucket int, rows long, checksum long").coalesce(1).write.mode("append").json(f"{path}/_digests")
    with pytest.raises(ValueError, match="digests"):
        index_store.changed_buckets(spark, path)
