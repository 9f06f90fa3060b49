"""Driver tables and the frames derived from them that the catalog queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.ordinals import next_within
from quarry.session import sized_side, tasks_for
from quarry.sources import querylog
from quarry.sources.files import _fs_path


# Tables whose rows carry long texts: tokenizing them is CPU-heavy per byte.
TEXT_TABLES = {"documents", "pages", "benchmark", "conversations"}
# Session setting by which a caller (the benchmark on tables of one Parquet row group, which no reader can
# split) asks for text tables to be dealt over so many partitions.  Unset, scans stay as they are.
SPREAD = "quarry.text.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read in full."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spread = int(spark.conf.get(SPREAD, "0"))
    return df.repartition(spread) if spread and name in TEXT_TABLES else df


def document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a file stream, one file per micro-batch, whether the table is one file or a folder of part files."""
    at = sf_dir.rstrip("/")
    stream = spark.readStream.schema(table(spark, sf_dir, "documents").schema).option("maxFilesPerTrigger", 1)
    path, fs = _fs_path(spark, f"{at}/documents.parquet")
    if fs.getFileStatus(path).isDirectory():
        return stream.parquet(f"{at}/documents.parquet")
    return stream.option("pathGlobFilter", "documents.parquet").parquet(at)      # a stream's path must be a folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with a path-like name ``source/doc_id`` (the index's document name)."""
    d = table(spark, sf_dir, "documents")
    return d.withColumn("doc_name", F.concat_ws("/", "source", F.col("doc_id").cast("string")))


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark texts as a query log: every item is one query made of its whole text."""
    return querylog.from_texts(table(spark, sf_dir, "benchmark"), "item_id", "text")


def part_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Part-succession graph: nodes = parts on order lines; link l_partkey -> the part of the next
    line of the same order (order lines ordered by linenumber, partkey, suppkey, price)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_extendedprice")
    nodes = li.select(F.col("l_partkey").alias("id"))
    # An order has a handful of lines: one shuffle, to as many tasks as the lines need, and a window.
    if tasks := tasks_for(spark, li.count()):
        li = li.repartition(tasks, "l_orderkey")
    line = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    nxt = li.withColumn("next_part", F.lead("l_partkey").over(line))
    links = nxt.where(F.col("next_part").isNotNull()).select(F.col("l_partkey").alias("src"),
                                                               F.col("next_part").alias("dst"))
    return nodes, links


def doc_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Document graph: doc -> next doc_id of the same source, doc -> smallest doc_id of its lang."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    nodes = d.select(F.col("doc_id").alias("id"))
    nxt = next_within(d.select("doc_id", "source"), ["source"], ["doc_id"], "doc_id", "next_doc")
    seq = nxt.where(F.col("next_doc").isNotNull()).select(F.col("doc_id").alias("src"), F.col("next_doc").alias("dst"))
    # one row per language, written first: Catalyst sees that it is small and a hot language is not shuffled.
    first = sized_side(d.groupBy("lang").agg(F.min("doc_id").alias("dst")))
    hub = d.join(first, "lang").select(F.col("doc_id").alias("src"), "dst")
    return nodes, seq.unionByName(hub)
