"""Operator 3, quality rules: word and line counts, then bands of zstandard ratios.

A text compresses to a share of its bytes.  Repetitive text compresses to far less than prose of
its length, noise (encoded binaries, random strings) to far more.  Both the whole text and its
fixed chunks are compared with limits that depend on their length: short texts compress badly
whatever they say, so their bands are wide, and the shortest have none.

Defined results: a null text has no words (counts 0, base_failed, not kept); an empty text likewise;
rows are judged one by one, so repeated rows get equal verdicts; an empty table gives an empty
result.  The report takes only doc_id and text from the table; the filter keeps all of its columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import map_rows, table

# --- fixed values: the base rules, and the bands (bytes below this: lowest and highest ratio) ---
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
# Highest ratios on sf0.1 from 128 bytes: 0.91, from 256: 0.75, 512: 0.70, 1 KB: 0.59, 4 KB: 0.48, 16 KB: 0.43; in a chunk 0.48.
WHOLE_BANDS = ((128, 0.0, 9.0), (256, 0.28, 0.97), (512, 0.26, 0.82), (1024, 0.26, 0.76), (2048, 0.24, 0.67),
               (4096, 0.24, 0.60), (16384, 0.20, 0.57), (None, 0.16, 0.50))
CHUNK_BYTES = 4096
CHUNK_BAND = (0.14, 0.57)
MAX_BAD_CHUNKS = 0.25          # share of a text's chunks that may lie outside their band
LEVEL = 3
# ------------------------------------------------------------------------------------------------

REPORT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, ratio double, bad_chunks long")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur twice or more in the text, first ones included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    span = 1
    while span < WINDOW:                      # equal ranks <=> equal runs of ``span`` words
        pair = rank[:-span] * np.int64(len(words) + 1) + rank[span:]
        rank = np.unique(pair, return_inverse=True)[1]
        span *= 2
        if rank.max() + 1 == len(rank):       # every run is unique already
            return 0
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def in_band(raw: int, ratio: float) -> bool:
    for below, low, high in WHOLE_BANDS:
        if below is None or raw < below:
            return low <= ratio <= high
    return True


def compression(data: bytes, z: zstandard.ZstdCompressor) -> tuple[float, int, bool]:
    """Ratio of the whole text, number of chunks out of band, and whether both tests pass.  The last chunk is the
    final CHUNK_BYTES bytes."""
    if not data:
        return 0.0, 0, True
    ratio = len(z.compress(data)) / len(data)
    last = len(data) - CHUNK_BYTES
    chunks = [*range(0, last, CHUNK_BYTES), last] if last > 0 else []
    bad = 0
    if chunks:                                # a single chunk says what the whole text has said
        low, high = CHUNK_BAND
        bad = sum(not low <= len(z.compress(data[a:a + CHUNK_BYTES])) / CHUNK_BYTES <= high for a in chunks)
    return ratio, bad, in_band(len(data), ratio) and bad <= MAX_BAD_CHUNKS * len(chunks)


def judge(text: str | None, z: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    data = text.encode()
    words = data.split()                      # bytes.split cuts at exactly \x20 and \x09-\x0D
    n = len(words)
    blank = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    lines = [x for x in data.split(b"\n") if x.split(None, 1)]
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    ratio, bad, fits = compression(data, z)
    return (n, len(text) - blank, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeat,
            failed, not failed and fits, ratio, bad)


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document with the counts, the ratios and the verdict."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio",
             "bad_chunks"]

    def rows(ids: list, texts: list) -> dict:
        z = zstandard.ZstdCompressor(level=LEVEL)
        judged = [judge(t, z) for t in texts]
        return {"doc_id": ids} | {c: [j[i] for j in judged] for i, c in enumerate(names)}

    return map_rows(docs, rows, ["doc_id", "text"], REPORT)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, with every column of the table as it was."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            mask = pa.array((judge(t.as_py(), z)[6] for t in batch.column(at)), type=pa.bool_())
            yield batch.filter(pc.fill_null(mask, False))

    return docs.mapInArrow(keep, docs.schema)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))
