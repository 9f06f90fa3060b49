"""Work that needs one text only, done where the text is read: nothing is exploded before it is counted, so no token rows
are sorted, shuffled or spilled.

Tasks take batches of rows as Arrow and hand on ``SLICE`` rows at a time, so what a worker holds does not grow with the batch.
A key that stands in several rows is told apart first (``split_repeated``); its rows go the way of grouping.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from quarry.session import reliable_checkpoint

SLICE = 256
# Bytes of rows that a task holds to put them in another order.
GATHER = 64 << 20


def split_repeated(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key (nulls are equal) stands once, and those of the other keys, if there are any.  Only keys are grouped."""
    repeated = reliable_checkpoint(df.groupBy(*keys).count().where("count > 1").select(*[F.col(k).alias(f"_r_{k}") for k in keys]), "repeated")
    if repeated.isEmpty():
        return df, None
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")


def _by_slices(df: DataFrame, columns: list[str], made: list[StructField], work: Callable) -> DataFrame:
    """``columns`` but the last, and those of ``made``: ``work`` turns a slice of the last column into the row that each result
    belongs to (None: one for every row) and the new columns."""
    given = df.select(*columns)
    kept = len(columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                row, arrays = work(part.column(kept))
                keys = [part.column(i) if row is None else part.column(i).take(row) for i in range(kept)]
                if row is None or len(row):
                    yield pa.RecordBatch.from_arrays([*keys, *arrays], [*columns[:-1], *[f.name for f in made]])

    return given.mapInArrow(run, StructType([*given.schema.fields[:-1], *made]))


def _counted(lists: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Of every list of words: its length, and each word with its number."""
    lengths = lists.value_lengths().fill_null(0).to_numpy()
    words = lists.flatten().dictionary_encode()
    if not len(words):
        return pa.array([], pa.int64()), []
    size = len(words.dictionary)
    found, counts = np.unique(np.repeat(np.arange(len(lengths)), lengths) * size + words.indices.to_numpy(), return_counts=True)
    row = found // size
    return pa.array(row), [pa.array(lengths[row].astype(np.int32)), words.dictionary.take(pa.array(found % size)), pa.array(counts.astype(np.int64))]


def counted_words(df: DataFrame, keys: list[str], words: str) -> DataFrame:
    """(keys..., len, word, cnt): the words of each row's array with their numbers."""
    made = [StructField("len", IntegerType()), StructField("word", StringType()), StructField("cnt", LongType())]
    return _by_slices(df, [*keys, words], made, _counted)


def offsets(lengths) -> pa.Array:
    """Where lists of such lengths begin and end."""
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


# What the cosine dialect deletes, as Java's \\p{Punct} does.
_PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _counted_lower(texts: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """Of every text in lower case: the number of its words in the cosine dialect, and each word with its number."""
    # bytes.split() knows ASCII white space only, and no byte of another letter is ASCII.
    lists = [t.as_py().translate(None, _PUNCT).split() if t.is_valid else [] for t in texts.cast(pa.binary())]
    found = [Counter(words) for words in lists]
    row = np.repeat(np.arange(len(found)), [len(words) for words in found])
    lengths = np.array([len(words) for words in lists], np.int32)
    words = pa.array([w for words in found for w in words], pa.binary()).cast(pa.string())
    return pa.array(row), [pa.array(lengths[row]), words, pa.array([n for words in found for n in words.values()], pa.int64())]


def counted_cosine_words(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys..., len, word, cnt) as ``counted_words`` of ``tokenize.cosine_words``; no arrays of words leave the JVM."""
    made = [StructField("len", IntegerType()), StructField("word", StringType()), StructField("cnt", LongType())]
    return _by_slices(df.select(*keys, F.lower(text).alias(text)), [*keys, text], made, _counted_lower)


def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a partition in tables of about ``GATHER`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHER:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if sum(batch.num_rows for batch in held):
        yield pa.Table.from_batches(held)


def packed(table: pa.Table) -> bytes:
    """A table as compressed bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpacked(data: pa.Buffer) -> pa.Table:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_all()


def _words_at(text: str, pattern: re.Pattern) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for m in pattern.finditer(text):
        found.setdefault(m.group().lower(), []).append(m.start())
    return found


def placed_words(df: DataFrame, keys: list[str], text: str, keep_last_word: bool = False) -> DataFrame:
    """(keys..., word, n, positions): runs of ASCII letters, lower-cased, with the ascending offsets of their first letters; a
    run that ends the text counts with ``keep_last_word`` only."""
    pattern = re.compile("[A-Za-z]+" if keep_last_word else "[A-Za-z]+(?=[^A-Za-z])")

    def work(texts: pa.Array) -> tuple[None, list[pa.Array]]:
        found = [_words_at(t, pattern) if t else {} for t in texts.to_pylist()]
        places = [p for words in found for p in words.values()]
        n = np.fromiter(map(len, places), np.int32, len(places))
        flat = np.fromiter((x for p in places for x in p), np.int32, int(n.sum()))
        positions = pa.ListArray.from_arrays(offsets(n), pa.array(flat))
        words = pa.array([w for words in found for w in words], pa.string())
        entries = pa.StructArray.from_arrays([words, pa.array(n), positions], ["word", "n", "positions"])
        return None, [pa.ListArray.from_arrays(offsets([len(words) for words in found]), entries)]

    entry = StructType([StructField("word", StringType()), StructField("n", IntegerType()), StructField("positions", ArrayType(IntegerType()))])
    lists = _by_slices(df, [*keys, text], [StructField("_words", ArrayType(entry))], work)
    return lists.select(*keys, F.posexplode("_words").alias("_i", "_w")).select(*keys, "_w.word", "_w.n", "_w.positions")
