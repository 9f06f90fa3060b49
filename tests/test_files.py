import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import index as ix
from quarry.operators import search
from quarry.sources import files, page_files

TREE = {
    "a.txt": b"apple pie. ",
    "a/b": b"Apple and banana.\n",
    "a!": b"banana bread ",
    "bin": b"caf\xe9 au lait. ",
    "nul": b"apple\x00 banana. ",
    "empty": b"",
    "digits": b"12345 ",
}


@pytest.fixture(scope="module")
def tree():
    root = tempfile.mkdtemp(prefix="quarry-tree-")
    for name, data in TREE.items():
        full = os.path.join(root, name)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as f:
            f.write(data)
    return root


def test_read_tree_and_index(spark, tree):
    df = files.read_tree(spark, tree)
    assert sorted(r["name"] for r in df.collect()) == sorted(TREE)
    idx = ix.build_index(df, "name", "text")
    # ASCII, non-empty, worded files in path-component order; "nul" keeps only "apple" (ends the text).
    assert [r["doc_name"] for r in idx.doc_table.orderBy("doc_id").collect()] == ["a/b", "a!", "a.txt"]
    log = spark.createDataFrame([(1, "banana"), (2, "apple banana")], "query_id long, raw string")
    hits = search.and_search(idx.postings, search.query_tokens(log, "count"))
    got = sorted((r["query_id"], r["doc_id"], r["rank"]) for r in hits.collect())
    assert got == [(1, 1, 1), (1, 2, 1), (2, 1, 2)]


def test_read_tree_errors(spark, tree):
    with pytest.raises(ValueError):
        files.read_tree(spark, "")
    with pytest.raises(ValueError):
        files.read_tree(spark, os.path.join(tree, "missing"))
    with pytest.raises(ValueError):
        files.read_tree(spark, os.path.join(tree, "a.txt"))


def test_flat_scan_and_glob(spark, tree):
    flat = files.read_tree(spark, os.path.join(tree, "a"), recursive=False)
    assert [r["name"] for r in flat.collect()] == ["b"]
    only_txt = files.read_tree(spark, tree, glob="*.txt")
    assert [r["name"] for r in only_txt.collect()] == ["a.txt"]


def test_parsed_cache_csv_and_visited(spark):
    root = tempfile.mkdtemp(prefix="quarry-io-")
    raw = spark.createDataFrame([(1, "http://x.org/", "<html><body><p>hi there</p></body></html>")],
                                "page_id long, url string, html string")
    from quarry.operators import web
    cached = files.load_parsed_pages(spark, os.path.join(root, "parsed"), raw, web.parse_pages)
    assert cached.first()["words"] == ["hi", "there"]
    again = files.load_parsed_pages(spark, os.path.join(root, "parsed"))
    assert again.count() == 1
    files.write_columns_csv(spark.createDataFrame([(1, 2.0)], "size int, time double"), os.path.join(root, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(root, "csv")).columns == ["size", "time"]
    visited = os.path.join(root, "visited")
    assert files.load_visited(spark, visited).count() == 0
    files.append_visited(spark.createDataFrame([("http://x.org/",)], "uri string"), visited)
    files.append_visited(spark.createDataFrame([("http://y.org/",)], "uri string"), visited)
    assert sorted(r["id"] for r in files.load_visited(spark, visited).collect()) == ["http://x.org/", "http://y.org/"]


def test_every_name_is_listed_by_tasks(spark, tmp_path, monkeypatch):
    names = [".hidden", "_d/x.txt", "a/.b/_c/d e.txt", "ü/é.html", "a/b.HTML", "..two", "a/[x]*.txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"words here. \xe9")
    (tmp_path / "a" / "loop").symlink_to(tmp_path)
    monkeypatch.setattr(page_files, "FOLDERS_PER_TASK", 1)
    listed = page_files.list_tree(spark, str(tmp_path))
    assert sorted(r.name for r in listed.collect()) == sorted(names)
    got = {r.name: r.text for r in files.read_tree(spark, f"file://{tmp_path}").collect()}
    assert got == dict.fromkeys(names, "words here. é")
    assert [r.name for r in files.read_tree(spark, str(tmp_path), glob="*.html").collect()] == ["ü/é.html"]
    assert sorted(r.name for r in files.read_tree(spark, str(tmp_path), recursive=False).collect()) == ["..two", ".hidden"]
    # The driver lists nothing: folders are rows of jobs, and a tree of three levels takes four of them.
    monkeypatch.setattr(page_files, "_entries", lambda *a: [("p", "n", 1, False)])
    assert page_files.list_tree(spark, str(tmp_path)).collect()[0].path == "p"
    gone = spark.createDataFrame([(str(tmp_path / "gone"), "gone", 1)], "path string, name string, size long")
    assert page_files.read_files(gone).first().content is None


def test_pages_are_saved_one_file_each(spark, tmp_path):
    from quarry.operators import web
    root = str(tmp_path / "saved")
    pages = spark.createDataFrame([("http://a.org/1", "<p>one é"), ("http://a.org/2", ""), ("http://b.org/", None), ("no host", "x"),
                                   ("http://a.org/1", "<p>one é"), ("http://../etc", "y")], "uri string, body string")
    placed = page_files.save_page_files(pages.fillna({"body": ""}), root)
    assert placed.count() == 5
    found = page_files.read_files(page_files.list_tree(spark, root))
    assert sorted(r.name.count("/") for r in found.collect()) == [1] * 5 and not any(".attempts" in r.name for r in found.collect())
    back = {r.uri: r.html for r in web.read_raw_pages(found.select(F.decode("content", "UTF-8").alias("content"))).collect()}
    assert back == {"http://a.org/1": "<p>one é", "http://a.org/2": "", "http://b.org/": "", "no host": "x", "http://../etc": "y"}
    assert os.path.exists(os.path.join(root, "a.org", hashlib.md5(b"http://a.org/1").hexdigest()))
    page_files.save_page_files(spark.createDataFrame([("http://a.org/1", "new")], "uri string, body string"), root)
    again = page_files.read_files(page_files.list_tree(spark, root))
    assert again.count() == 5 and again.where("contains(decode(content, 'UTF-8'), 'new')").count() == 1


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "saved")
    bad = spark.range(40).select(F.concat(F.lit("http://a.org/"), "id").alias("uri"),
                                 F.when(F.col("id") == 33, F.raise_error(F.lit("cut off"))).otherwise("x").alias("body"))
    with pytest.raises(Exception, match="cut off"):
        page_files.save_page_files(bad, root)
    assert not os.path.exists(root) or [n for n in os.listdir(root) if not n.endswith(".crc")] == []
