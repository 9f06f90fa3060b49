"""STM-2 / SET-6 / SNK-2 / SRC-7: an index that grows in immutable segments under a versioned manifest.

Layout under ``path``::

    segments/NAME/doc_table, segments/NAME/postings/bucket=B     written once, never changed
    versions/N.json                                              the segments of version N, and the batches in them

A version is published last, by renaming its file into place: a reader opens one version and keeps it, whatever is added or
merged meanwhile; a writer that lost the race for a number finds the file there and fails.  A batch is applied
once: its id is in the manifest, so a replay changes nothing.  Known names keep their ids, new names continue after
the largest id of their index.  Small segments are merged into one, which moves rows and renumbers nothing; what no kept version
refers to any more can be removed.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.urls import word_bucket
from quarry.operators import index as ix
from quarry.session import remove_path, sized_side

BUCKETS = 16
DOC_TABLE = "index_id string, doc_id long, doc_name string"
POSTINGS = "index_id string, word string, doc_id long, n int, positions array<int>, bucket int"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, ascending."""
    p, fs = _fs(spark, f"{path.rstrip('/')}/versions")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """The newest or a given version; version 0 is the empty index."""
    found = versions(spark, path)
    version = (found[-1] if found else 0) if version is None else version
    if version == 0:
        return {"version": 0, "batches": [], "segments": []}
    if version not in found:
        raise ValueError(f"{path} has no version {version}")
    text = spark.read.option("wholetext", True).text(f"{path.rstrip('/')}/versions/{version}.json").first()[0]
    return json.loads(text)


def _publish(spark: SparkSession, path: str, made: dict) -> dict:
    base = f"{path.rstrip('/')}/versions"
    tmp, fs = _fs(spark, f"{base}/.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(json.dumps(made).encode()))
    finally:
        out.close()
    final, _ = _fs(spark, f"{base}/{made['version']}.json")
    if fs.exists(final) or not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise RuntimeError(f"version {made['version']} of {path} was published by another writer")
    return made


def _segment(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/segments/{name}"


def _write_segment(index: ix.Index, path: str, name: str) -> dict:
    spark, at = index.postings.sparkSession, _segment(path, name)
    index.doc_table.select("index_id", "doc_id", "doc_name").write.mode("overwrite").parquet(f"{at}/doc_table")
    (index.postings.select("index_id", "word", "doc_id", "n", "positions").withColumn("bucket", word_bucket("word", BUCKETS))
     .hint("rebalance", "bucket").sortWithinPartitions("bucket", "word", "doc_id")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{at}/postings"))
    return {"name": name, "docs": spark.read.schema(DOC_TABLE).parquet(f"{at}/doc_table").count()}


def open_segments(spark: SparkSession, path: str, version: int | None = None) -> ix.Index:
    """SRC-7: one version of the index; ``parts`` lets lookups read the words' buckets of each segment only."""
    names = [s["name"] for s in manifest(spark, path, version)["segments"]]
    if not names:
        return ix.Index(spark.createDataFrame([], DOC_TABLE), spark.createDataFrame([], POSTINGS))
    docs = spark.read.schema(DOC_TABLE).parquet(*[f"{_segment(path, n)}/doc_table" for n in names])
    parts = tuple((spark.read.schema(POSTINGS).parquet(f"{_segment(path, n)}/postings"), BUCKETS) for n in names)
    return ix.Index(docs, reduce(DataFrame.unionByName, [p for p, _ in parts]), parts)


def add_batch(docs: DataFrame, path: str, batch_id: int, name: str = "doc_name", text: str = "text", index_id=None) -> dict:
    """Adds a batch of documents as one segment and publishes the next version; a batch that is in the index already, or has
    nothing new, changes nothing but the list of batches."""
    spark = docs.sparkSession
    now = manifest(spark, path)
    if batch_id in now["batches"]:
        return now
    key = ["index_id", "doc_name"]
    known = open_segments(spark, path).doc_table
    fresh = ix.indexable_docs(docs, name, text, index_id).join(known.select(*key), key, "left_anti")
    built = ix.build_index(fresh.select(*key, F.col("t").alias("text")), "doc_name", "text", "index_id")
    top = sized_side(known.groupBy("index_id").agg(F.max("doc_id").alias("_top")))

    def shifted(df: DataFrame) -> DataFrame:
        return df.join(top, "index_id", "left").withColumn("doc_id", F.col("doc_id") + F.coalesce("_top", F.lit(0))).drop("_top")
    # The name tells the writer's attempt apart: one that died before its version was published is never read.
    segment = _write_segment(ix.Index(shifted(built.doc_table), shifted(built.postings)), path, f"b{batch_id}-{uuid.uuid4().hex[:8]}")
    return _publish(spark, path, {"version": now["version"] + 1, "batches": [*now["batches"], batch_id],
                                  "segments": now["segments"] + ([segment] if segment["docs"] else [])})


def merge_small(spark: SparkSession, path: str, max_docs: int, at_least: int = 2) -> dict:
    """Merges the segments of at most ``max_docs`` documents into one, if there are ``at_least`` so many."""
    now = manifest(spark, path)
    small = [s for s in now["segments"] if s["docs"] <= max_docs]
    if len(small) < max(2, at_least):
        return now
    docs = spark.read.schema(DOC_TABLE).parquet(*[f"{_segment(path, s['name'])}/doc_table" for s in small])
    postings = reduce(DataFrame.unionByName, [spark.read.schema(POSTINGS).parquet(f"{_segment(path, s['name'])}/postings") for s in small])
    merged = _write_segment(ix.Index(docs, postings), path, f"m-{uuid.uuid4().hex[:8]}")
    return _publish(spark, path, {"version": now["version"] + 1, "batches": now["batches"],
                                  "segments": [s for s in now["segments"] if s not in small] + [merged]})


def remove_unused(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Forgets all versions but the last ``keep``, then removes the segments that no kept version names."""
    found = versions(spark, path)
    kept = found[-max(1, keep):]
    used = {s["name"] for v in kept for s in manifest(spark, path, v)["segments"]}
    p, fs = _fs(spark, f"{path.rstrip('/')}/segments")
    there = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    for v in found[:-max(1, keep)]:
        remove_path(spark, f"{path.rstrip('/')}/versions/{v}.json")
    gone = [n for n in there if n not in used]
    for n in gone:
        remove_path(spark, _segment(path, n))
    return gone
