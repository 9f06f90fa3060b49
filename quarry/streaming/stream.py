"""STM-1 / STM-2: Structured Streaming over a fixed or growing index.

Both sinks are ``foreachBatch`` writers that overwrite a folder named by the batch id, so a
batch replayed after a failure rewrites the same output (idempotent); the streaming checkpoint
lives in the shared folder given by the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import index as ix
from quarry.operators import search
from quarry.sources import querylog, segments
from quarry.sources.files import _exists


def stream_search(query_stream: DataFrame, postings: DataFrame, sink: str, checkpoint: str,
                  dialect: str = "count", raw_from: tuple[str, str] | None = None,
                  keys: tuple[str, ...] = ("doc_id",), available_now: bool = True) -> StreamingQuery:
    """STM-1: each micro-batch of queries runs SCH-1 against a fixed, materialised index.

    ``postings`` has (keys..., word, n) — term counts or written postings, read from files so a
    batch only probes it.  ``query_stream`` has (query_id, raw); with ``raw_from=(id_col,
    text_col)`` raw queries are first derived from text rows.  Output: ``sink/batch_id=E`` with
    (query_id, keys..., rank).
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        log = querylog.from_texts(batch, *raw_from) if raw_from else batch.select("query_id", "raw")
        hits = search.and_search(postings, search.query_tokens(log, dialect), keys)
        hits.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={epoch_id}")

    w = query_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def stream_index(doc_stream: DataFrame, path: str, checkpoint: str, name: str = "doc_name", text: str = "text",
                 available_now: bool = True) -> StreamingQuery:
    """STM-2: append documents to an index batch by batch.

    Names already indexed keep their ids, new ones continue after the largest id (SET-6); doc
    table rows and postings of batch E go to ``path/{doc_table,postings}/batch_id=E``.  A batch reads
    the doc tables of earlier batches (names and ids) but none of their postings, so its cost follows
    the batch.  Whether earlier batches exist is asked of the file system; a read that fails fails the batch.
    """
    base = path.rstrip("/")

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        key = ["index_id", "doc_name"]
        docs = ix.indexable_docs(batch, name, text)
        known = None
        if _exists(spark, f"{base}/doc_table"):
            known = (spark.read.schema("index_id string, doc_id long, doc_name string, batch_id long").parquet(f"{base}/doc_table")
                     .where(F.col("batch_id") < epoch_id).drop("batch_id"))
            docs = docs.join(known.select(*key), key, "left_anti")
        fresh = ix.build_index(docs.select("index_id", "doc_name", F.col("t").alias("text")), "doc_name", "text", "index_id")
        if known is not None:
            top = known.groupBy("index_id").agg(F.max("doc_id").alias("_top"))
            shifted = lambda df: (df.join(F.broadcast(top), "index_id", "left")  # noqa: E731 - one row per index
                                  .withColumn("doc_id", F.col("doc_id") + F.coalesce("_top", F.lit(0))).drop("_top"))
            fresh = ix.Index(shifted(fresh.doc_table), shifted(fresh.postings))
        fresh.doc_table.select("index_id", "doc_id", "doc_name").write.mode("overwrite").parquet(f"{base}/doc_table/batch_id={epoch_id}")
        fresh.postings.write.mode("overwrite").parquet(f"{base}/postings/batch_id={epoch_id}")

    w = doc_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_stream_index(spark: SparkSession, path: str) -> ix.Index:
    base = path.rstrip("/")
    return ix.Index(spark.read.parquet(f"{base}/doc_table").drop("batch_id"),
                    spark.read.parquet(f"{base}/postings").drop("batch_id"))


def stream_segments(doc_stream: DataFrame, path: str, checkpoint: str, name: str = "doc_name", text: str = "text",
                    merge_docs: int = 0, merge_at: int = 4, available_now: bool = True) -> StreamingQuery:
    """STM-2 into a segmented index: a segment and a version for each micro-batch; when ``merge_at`` segments of at most
    ``merge_docs`` documents have gathered, they become one.  A replayed batch is known by its id."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        segments.add_batch(batch, path, epoch_id, name, text)
        if merge_docs:
            segments.merge_small(batch.sparkSession, path, merge_docs, merge_at)

    w = doc_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
