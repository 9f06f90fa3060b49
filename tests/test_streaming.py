import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators import index as ix
from quarry.streaming import stream as streaming


def test_incremental_index_ids_continue_across_batches(spark):
    root = tempfile.mkdtemp(prefix="quarry-stm-")
    incoming = os.path.join(root, "in")
    batches = [[("d/2", "beta gamma. "), ("d/1", "alpha beta. ")],
               [("d/1", "alpha again. "), ("d/3", "gamma delta. ")],
               [("c/9", "delta. ")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "doc_name string, text string").coalesce(1) \
            .write.parquet(os.path.join(incoming, f"part{i}"))
    stream = (spark.readStream.schema("doc_name string, text string").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(incoming))
    q = streaming.stream_index(stream, os.path.join(root, "index"), os.path.join(root, "ckpt"))
    q.awaitTermination()
    idx = streaming.read_stream_index(spark, os.path.join(root, "index"))
    ids = {r["doc_name"]: r["doc_id"] for r in idx.doc_table.collect()}
    # ids are dense in arrival order; a re-added name keeps its id and its first text
    assert sorted(ids.values()) == [1, 2, 3, 4]
    assert ids["c/9"] == 4 and ids["d/3"] == 3
    words = {(r["doc_name"], r["word"]) for r in ix.doc_names(idx.doc_table, idx.postings).collect()}
    assert ("d/1", "again") not in words and ("d/1", "alpha") in words
    assert ix.build_index(spark.createDataFrame(sum(batches, []), "doc_name string, text string")) \
        .postings.count() >= idx.postings.count()


def test_stream_search_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="quarry-sts-")
    spark.createDataFrame([(1, "apple banana"), (2, "cherry")], "query_id long, raw string") \
        .write.parquet(os.path.join(root, "q"))
    tokens = spark.createDataFrame([(10, "apple", 2), (10, "banana", 1), (11, "cherry", 1)],
                                   "doc_id long, word string, n int")
    stream = spark.readStream.schema("query_id long, raw string").parquet(os.path.join(root, "q"))
    q = streaming.stream_search(stream, tokens, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination()
    got = sorted((r["query_id"], r["doc_id"], r["rank"]) for r in spark.read.parquet(os.path.join(root, "out")).collect())
    assert got == [(1, 10, 3), (2, 11, 1)]


def test_documents_stream_from_one_file_and_from_a_folder_of_part_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from quarry.plans import catalog

    rows = [(i, "web" if i % 2 else "mail", f"Alpha beta{i % 3} alpha. Tail word {i}") for i in range(9)]
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "source": [r[1] for r in rows], "text": [r[2] for r in rows]})
    (tmp_path / "one").mkdir()
    pq.write_table(table, tmp_path / "one/documents.parquet")
    (tmp_path / "parts/documents.parquet").mkdir(parents=True)
    for i in range(3):
        pq.write_table(table.slice(3 * i, 3), tmp_path / f"parts/documents.parquet/part-{i:05d}.parquet")
    one, parts = (sorted(map(tuple, catalog.incremental_index(spark, str(tmp_path / d)).collect())) for d in ("one", "parts"))
    assert one and parts == one
    assert {r[0] for r in parts} == {f"{r[1]}/{r[0]}" for r in rows}
