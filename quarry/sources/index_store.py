"""SNK-2 / SRC-7 / SRC-8 / JN-1: the index as Parquet tables.

Layout under ``path``::

    doc_table/                 (index_id, doc_id, doc_name)
    postings/bucket=B/         (index_id, word, doc_id, n, positions), sorted by word in each file
    _digests/                  one JSON row per bucket: bucket, rows, order-free checksum
    _manifest/                 one JSON row: version, buckets, counts, order-free checksums, the digest of the digests

The manifest is the commit record: it is deleted before a write touches the tables and written last,
so an index without it is not valid and a write that was cut off cannot pass as committed.  Checksums are ``bit_xor`` of per-row ``xxhash64`` values, so
they do not depend on row order or partitioning and cannot overflow.  Each bucket has a digest of its own, so a lookup can
check the buckets it reads (``checked_lookup``) without reading the others.
"""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.urls import word_bucket
from quarry.operators.index import Index
from quarry.session import sized_side
from quarry.sources.files import _exists

VERSION = 2
POSTINGS = "index_id string, word string, doc_id long, n int, positions array<int>, bucket int"


def _fs_delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def _doc_checksums(doc_table: DataFrame) -> dict:
    d = doc_table.agg(F.count(F.lit(1)).alias("n_docs"),
                      F.coalesce(F.bit_xor(F.xxhash64("index_id", "doc_id", "doc_name")), F.lit(0)).alias("doc_checksum")).first()
    return {"n_docs": int(d["n_docs"]), "doc_checksum": int(d["doc_checksum"])}


def bucket_digests(postings: DataFrame) -> DataFrame:
    """bucket, n, checksum of every bucket of ``postings``."""
    row = F.xxhash64("index_id", "word", "doc_id", "n", "positions")
    return postings.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(row).alias("checksum"))


def _combined(digests: list) -> dict:
    """Counts and checksums of the whole from those of its buckets (as many as the index has)."""
    whole = root = 0
    for d in sorted(digests, key=lambda d: d["bucket"]):
        whole ^= d["checksum"]
        root = zlib.crc32(f"{d['bucket']}:{d['rows']}:{d['checksum']};".encode(), root)
    return {"n_postings": sum(d["rows"] for d in digests), "postings_checksum": whole, "digest": root}


def _checksums(doc_table: DataFrame, postings: DataFrame) -> dict:
    return _doc_checksums(doc_table) | _combined(bucket_digests(postings).collect())


def write_index(index: Index, path: str, buckets: int = 64) -> dict:
    """Persist ``index``; returns the manifest.  Postings are partitioned by word bucket; the
    rebalance hint lets AQE split a bucket that holds a hot word over several writer tasks."""
    spark = index.postings.sparkSession
    path = path.rstrip("/")
    _fs_delete(spark, f"{path}/_manifest")
    _fs_delete(spark, f"{path}/_digests")
    index.doc_table.select("index_id", "doc_id", "doc_name").write.mode("overwrite").parquet(f"{path}/doc_table")
    (index.postings.select("index_id", "word", "doc_id", "n", "positions")
     .withColumn("bucket", word_bucket("word", buckets))
     .hint("rebalance", "bucket")
     .sortWithinPartitions("bucket", "word", "doc_id")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings"))
    digests = bucket_digests(spark.read.schema(POSTINGS).parquet(f"{path}/postings"))
    digests.coalesce(1).write.mode("overwrite").json(f"{path}/_digests")
    manifest = {"version": VERSION, "buckets": buckets, **_doc_checksums(spark.read.parquet(f"{path}/doc_table")),
                **_combined(read_digests(spark, path))}
    spark.createDataFrame([manifest]).coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")
    return manifest


def read_digests(spark: SparkSession, path: str) -> list:
    return spark.read.schema("bucket int, rows long, checksum long").json(f"{path.rstrip('/')}/_digests").collect()


def read_manifest(spark: SparkSession, path: str) -> dict:
    at = f"{path.rstrip('/')}/_manifest"
    if not _exists(spark, f"{at}/_SUCCESS"):
        raise ValueError(f"{path} is not a committed index (no manifest)")
    row = spark.read.json(at).first()
    if row is None or row["version"] != VERSION:
        raise ValueError(f"{path} has no valid manifest")
    return row.asDict()


def open_index(spark: SparkSession, path: str, validate: bool = True) -> tuple[Index, dict]:
    """SRC-7: open one index; ``validate`` recomputes counts and checksums against the manifest."""
    path = path.rstrip("/")
    manifest = read_manifest(spark, path)
    idx = Index(spark.read.parquet(f"{path}/doc_table"), spark.read.parquet(f"{path}/postings"))
    if validate:
        got = _checksums(idx.doc_table, idx.postings)
        bad = {k: (manifest[k], v) for k, v in got.items() if manifest[k] != v}
        if bad:
            raise ValueError(f"index {path} fails validation: {bad}")
    return idx, manifest


def open_indexes(spark: SparkSession, paths: list[str], validate: bool = False) -> tuple[Index, int]:
    """SRC-8: several indices, each with its own id space and bucket count; the index key becomes
    ``<position>:<index_id>`` when more than one path is given.  Returns the index, whose ``parts`` keep
    the bucket count of each path, and the first count.  The checksums were taken when the index was
    written; ``validate`` reads every posting to take them again (DQ-1)."""
    docs, parts = [], []
    for i, p in enumerate(paths):
        idx, m = open_index(spark, p, validate)
        key = F.col("index_id") if len(paths) == 1 else F.concat(F.lit(f"{i}:"), F.col("index_id"))
        docs.append(idx.doc_table.withColumn("index_id", key))
        parts.append((idx.postings.withColumn("index_id", key), m["buckets"]))
    union = DataFrame.unionByName
    return Index(reduce(union, docs), reduce(union, [p for p, _ in parts]), tuple(parts)), parts[0][1]


def lookup_words(index: Index, words: DataFrame, buckets: int | None = None) -> DataFrame:
    """JN-1: postings of ``words(word)`` in all opened indices.  The words' buckets (at most as many as an index
    has) go into each scan as literals, so only those bucket folders are read (Catalyst cannot
    derive the bucket from the word by itself)."""
    w = sized_side(words.select("word").distinct())
    wanted: dict[int, list[int]] = {}
    out = []
    for postings, n in index.parts or ((index.postings, buckets),):
        if n not in wanted:
            wanted[n] = [r[0] for r in w.select(word_bucket("word", n)).distinct().collect()]
        scan = postings.where(F.col("bucket").isin(wanted[n]))
        out.append(scan.join(w.withColumn("bucket", word_bucket("word", n)), ["bucket", "word"]))
    return reduce(DataFrame.unionByName, out)


def changed_buckets(spark: SparkSession, path: str, buckets: list[int] | None = None) -> list[int]:
    """DQ-1 / SRC-7: those of the given buckets (or of all) whose content is not what was written; only they are read.  Digests
    that do not agree with the manifest are an error."""
    path = path.rstrip("/")
    manifest, digests = read_manifest(spark, path), read_digests(spark, path)
    if _combined(digests)["digest"] != manifest["digest"]:
        raise ValueError(f"the digests of {path} are not those of its manifest")
    wanted = set(range(manifest["buckets"])) if buckets is None else set(buckets)
    scan = spark.read.schema(POSTINGS).parquet(f"{path}/postings").where(F.col("bucket").isin(sorted(wanted)))
    got = {r["bucket"]: (r["rows"], r["checksum"]) for r in bucket_digests(scan).collect()}
    was = {d["bucket"]: (d["rows"], d["checksum"]) for d in digests if d["bucket"] in wanted}
    return sorted(b for b in wanted if got.get(b) != was.get(b))


def checked_lookup(spark: SparkSession, path: str, words: DataFrame) -> DataFrame:
    """JN-1 with the check of SRC-7: the postings of ``words`` from one index, after the buckets they lie in were checked."""
    idx, n = open_indexes(spark, [path])
    w = sized_side(words.select("word").distinct())
    wanted = [r[0] for r in w.select(word_bucket("word", n)).distinct().collect()]
    if bad := changed_buckets(spark, path, wanted):
        raise ValueError(f"buckets {bad} of {path} are not what was written")
    return lookup_words(idx, w)


def lookup_positions(index: Index, wanted: DataFrame, buckets: int | None = None) -> DataFrame:
    """JN-5: positions of the (index_id, word, doc_id) rows of ``wanted``, read from the words' buckets only;
    absent ones drop out."""
    hits = lookup_words(index, wanted, buckets)
    key = ["index_id", "word", "doc_id"]
    return hits.join(wanted.select(*key), key, "left_semi").select(*key, "positions")
