"""Dense ordinals in a global order without a single-partition window.

``row_number() over (order by ...)`` moves every row into one task and
``row_number() over (partition by g ...)`` moves a whole group into one task, which breaks when
one key holds a large share of the rows.  Here the rows are range-partitioned on the full sort
key (the sampler splits a hot group over many partitions), written to the shared checkpoint
folder so that partition contents are fixed, and numbered from per-partition counts.  The only
broadcast is the per-partition offset table, whose size is the number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import reliable_checkpoint, sized_side, tasks_for


def _exprs(cols: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def in_order(df: DataFrame, order_by: Sequence) -> DataFrame:
    """``df`` in a global order, by as many tasks as its rows need, so that one task's sort does not grow with the input.  The
    rows are counted, and sampled for the ranges, before they are sorted: ``df`` should be written."""
    tasks = tasks_for(df.sparkSession, df.count())
    if tasks is None:
        return df.orderBy(*_exprs(order_by))
    return df.repartitionByRange(tasks, *_exprs(order_by)).sortWithinPartitions(*_exprs(order_by))


def with_ordinal(df: DataFrame, order_by: Sequence, name: str = "ordinal") -> DataFrame:
    """Add ``name`` = 1..N following ``order_by`` (ascending unless Columns say otherwise)."""
    tagged = (
        in_order(reliable_checkpoint(df), order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_mono", F.monotonically_increasing_id())
    )
    tagged = reliable_checkpoint(tagged)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # monotonically_increasing_id = (partition index << 33) + row index inside the partition.
    local = F.col("_mono") - F.shiftleft(F.col("_part").cast("long"), 33)
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + local + 1)
        .drop("_part", "_mono", "_off")
    )


def ordinal_within(df: DataFrame, group_by: Sequence[str], order_by: Sequence, name: str = "pos") -> DataFrame:
    """1..n inside each group of ``group_by`` following ``order_by`` (skew-safe row_number)."""
    g = with_ordinal(df, [*group_by, *order_by], "_g")
    first = g.groupBy(*group_by).agg(F.min("_g").alias("_g0"))
    first = sized_side(first)
    return g.join(first, list(group_by)).withColumn(name, F.col("_g") - F.col("_g0") + 1).drop("_g", "_g0")


def next_within(df: DataFrame, group_by: Sequence[str], order_by: Sequence, value: str, name: str) -> DataFrame:
    """``lead(value)`` inside each group, as an equi-join on ordinal + 1 instead of a window."""
    g = with_ordinal(df, [*group_by, *order_by], "_o")
    nxt = g.select(*group_by, (F.col("_o") - 1).alias("_o"), F.col(value).alias(name))
    return g.join(nxt, [*group_by, "_o"], "left").drop("_o")
