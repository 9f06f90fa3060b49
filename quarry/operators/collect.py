"""UDF-3 / AGG-14: aggregates of the user's own (supplier, accumulator, combiner, finisher), in two levels with mergeable states.

An aggregate is four plain functions; its state travels as bytes.  Every Arrow batch is folded into one state for each of
its groups before anything is shuffled.  Partial states are merged by (keys, salt), then by keys, each time in
a sorted stream that holds one state, so a group that has a third of all rows is spread over ``salts`` tasks and never
stands in memory.  For what Spark has built in, its own functions are faster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructType


@dataclass(frozen=True)
class Collector:
    """``start()`` -> state; ``add(state, values)`` -> state; ``merge(state, state)`` -> state; ``finish(state)`` -> dict of the result."""

    start: Callable[[], bytes]
    add: Callable[[bytes, list], bytes]
    merge: Callable[[bytes, bytes], bytes]
    finish: Callable[[bytes], dict[str, Any]]
    result: str


def collect(df: DataFrame, keys: Sequence[str], value: str, collector: Collector, salts: int = 32) -> DataFrame:
    """The keys and the result of ``collector`` over ``value`` of each group; null keys form a group, null values are passed on."""
    keys = list(keys)
    key_type = StructType([df.schema[k] for k in keys])
    partial = StructType([*key_type.fields]).add("_state", BinaryType())
    result = df.sparkSession.createDataFrame([], collector.result).schema
    final = StructType([*key_type.fields, *result.fields])
    width = len(keys)

    def rows(columns: list[list], schema: StructType) -> pa.RecordBatch:
        arrow = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple, list] = {}
            for *key, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                groups.setdefault(tuple(key), []).append(v)
            states = [collector.add(collector.start(), vs) for vs in groups.values()]
            yield rows([*([k[i] for k in groups] for i in range(width)), states], partial)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
        now, state = None, b""
        for batch in batches:
            for *key, s in zip(*(batch.column(i).to_pylist() for i in (*range(width), batch.schema.get_field_index("_state"))), strict=True):
                if now is not None and tuple(key) == now:
                    state = collector.merge(state, s)
                    continue
                if now is not None:
                    yield now, state
                now, state = tuple(key), s
        if now is not None:
            yield now, state

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, state in merged(batches):
            yield rows([*([k] for k in key), [state]], partial)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, state in merged(batches):
            made = collector.finish(state)
            yield rows([*([k] for k in key), *([made[n]] for n in result.names)], final)

    parts = df.select(*keys, value).mapInArrow(fold, partial).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    once = parts.repartition(*keys, "_salt").sortWithinPartitions(*keys, "_salt").mapInArrow(merge, partial)
    return once.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(finish, final)
