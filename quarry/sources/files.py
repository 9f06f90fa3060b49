"""File sources and sinks: text trees, parsed-page cache, column CSV, visited-URL log.

Tables are read and written by Spark (Parquet, CSV) on any Hadoop-compatible path; trees of files are listed and read
by tasks (``page_files``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.page_files import list_tree, read_files


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs_path(spark, path)
    return fs.exists(p)


def read_tree(spark: SparkSession, root: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """SRC-1 / SRC-3 / SRC-4 / FLT-3: every regular file under ``root`` -> (path, name, text), listed and read by tasks.

    ``name`` is the path relative to ``root``; ``text`` keeps every byte as one character
    (ISO-8859-1), so a byte above 0x7F stays non-ASCII for FLT-1; it is null for a file that cannot be read.  Names may
    start with any character.  A missing root, an empty string or a root that is not a directory is an error.
    """
    found = read_files(list_tree(spark, root, recursive, glob))
    return found.select("path", "name", F.decode(F.col("content"), "ISO-8859-1").alias("text"))


def save_parsed_pages(parsed: DataFrame, path: str) -> None:
    """SNK-1: the parsed-page table (uri, title, blurb, words, links) as Parquet."""
    parsed.write.mode("overwrite").parquet(path)


def load_parsed_pages(spark: SparkSession, path: str, raw: DataFrame | None = None, parse=None) -> DataFrame:
    """SRC-6: read the parsed-page table when its write was completed (``_SUCCESS``); otherwise parse
    ``raw`` with ``parse``, save it, and read it back.  Any other fault of the store is raised."""
    if _exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        return spark.read.parquet(path)
    if raw is None or parse is None:
        raise ValueError(f"{path} holds no completed parsed-page table")
    save_parsed_pages(parse(raw), path)
    return spark.read.parquet(path)


def write_columns_csv(df: DataFrame, path: str) -> None:
    """SNK-5: header + one row per index, in as many part files as the frame has partitions; an empty
    column set is an error (unequal column lengths cannot occur in a DataFrame)."""
    if not df.columns:
        raise ValueError("no columns to write")
    df.write.mode("overwrite").option("header", True).csv(path)


def append_visited(uris: DataFrame, path: str) -> None:
    """SNK-4: append fetched URIs to the visited log."""
    uris.select(F.col("uri").alias("id")).write.mode("append").parquet(path)


def load_visited(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: the visited log (column ``id``), empty when it does not exist yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "id string")
    return spark.read.schema("id string").parquet(path)
