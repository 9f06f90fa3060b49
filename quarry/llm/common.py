"""Helpers shared by the training-data operators: tables, written intermediates, Arrow maps."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from the given folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts the lineage, survives
    lost executors, and later scans read only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns), doc_id and text: whatever the table's other columns are called, they clash with nothing."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", "text")


def map_rows(df: DataFrame, fn: Callable[[list], dict], columns: list[str], schema: str,
             done: Callable[[], None] | None = None) -> DataFrame:
    """``fn`` gets the named columns of one Arrow batch as lists and returns a dict of output lists.

    The batch is the unit of memory: nothing is kept between batches.  ``done`` runs at the end of each partition,
    to free what ``fn`` has cached: the process may go on with other work.
    """
    out = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                # Texts vary from nothing to many MB: a batch is cut so that a slice holds few rows.
                for at in range(0, batch.num_rows, 2000):
                    part = batch.slice(at, 2000)
                    made = fn(*[part.column(i).to_pylist() for i in range(part.num_columns)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(made[f.name], type=f.type) for f in arrow], schema=arrow)
        finally:
            if done:
                done()

    return df.select(*columns).mapInArrow(run, out)


def crc_of(doc_id) -> int:
    """crc32 of the id written as text, as SQL's crc32(cast(doc_id as string)); a null id counts as ''."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def crc_col(name: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))
