"""Operator 5, benchmark decontamination by training suffix arrays.

The documents are dealt out in shards of bounded size.  A shard's words are mapped to the ids of
the benchmark's vocabulary; runs of known words that are at least as long as the shortest window are
kept (no window can match elsewhere) and their suffix array is built by prefix doubling.  Every
suffix of every test item is then binary-searched in it: the suffixes that begin with the test
suffix's window are one interval of the array, which gives the places of all verbatim matches;
matches that follow each other on a diagonal join into the longest ones.

The benchmark is the stated query set.  It is taken in blocks of bounded bytes, each sent to the
executors once; the documents never leave their partition, so nothing is shuffled and a hot source
or a passage that every document holds is no special case.

Defined results: null and empty texts have no words (n_hit 0, not contaminated); null or empty items have no
windows; an item id that occurs twice counts once, with the windows of all its rows; an item
without an id is searched and reported with the id ''; repeated documents get equal rows; empty
tables give an empty result, or documents without hits.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table

WINDOW = 10                    # words of a window
BLOCK_BYTES = 8 << 20          # benchmark text sent to the executors at once
SHARD_BYTES = 8 << 20          # document text under one suffix array (one longer document: an array of its own)

# Lower-cases A-Z and turns every byte that is no word character into a space: what bytes.split then cuts
# out are the matches of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))

MATCH = "item string, doc_word int, item_word int, n_words int"
SCHEMA = f"doc_id long, text string, n_words long, matches array<struct<{MATCH.replace(' ', ':').replace(',:', ',')}>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class TestSet:
    """A block of benchmark items: vocabulary, and the test suffixes by their windows."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[bytes, list[tuple[str, int]]] = defaultdict(list)    # window -> (item, first word)
        self.shortest, self.longest = WINDOW, 1
        number = self.vocabulary.setdefault
        for item, text in items:
            ids = np.array([number(w, len(self.vocabulary) + 1) for w in words_of(text)], ">u4")
            if not len(ids):
                continue
            data, width = ids.tobytes(), min(WINDOW, len(ids))
            self.shortest, self.longest = min(self.shortest, width), max(self.longest, len(ids))
            for i in range(len(ids) - width + 1):
                self.windows[data[4 * i:4 * (i + width)]].append((item, i))


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``ids`` in the order of their suffixes, compared to at least ``depth`` symbols."""
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    span = 1
    while span < depth and rank.max() < len(rank):
        after = np.zeros(len(rank), np.int64)
        after[:-span] = rank[span:]
        rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1] + 1
        span *= 2
    return np.argsort(rank, kind="stable")


def known_runs(ids: np.ndarray, shortest: int) -> np.ndarray:
    """Mask of the words inside runs of at least ``shortest`` known (non-zero) words."""
    edge = np.diff(np.concatenate([[0], (ids > 0).astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = last - first >= shortest
    cover = np.zeros(len(ids) + 1, np.int64)
    cover[first[long]] += 1
    cover[last[long]] -= 1
    return np.cumsum(cover[:-1]) > 0


def search(shard: list[np.ndarray], tests: TestSet) -> list[list[tuple]]:
    """Per document of the shard: its verbatim matches as (item, doc word, item word, words)."""
    found: list[list[tuple]] = [[] for _ in shard]
    parts, at = [], []                                   # with a separator 0 after each run's document
    for d, ids in enumerate(shard):
        keep = np.flatnonzero(known_runs(ids, tests.shortest))
        if len(keep):
            cut = np.flatnonzero(np.diff(keep) > 1) + 1
            parts += [np.append(np.insert(ids[keep], cut, 0), 0)]
            at += [np.append(np.insert(keep, cut, -1), -1) + (d << 40)]
    if not parts:
        return found
    words, at = np.concatenate(parts), np.concatenate(at)
    order = suffix_array(words, tests.longest).tolist()
    data = words.astype(">u4").tobytes()
    diagonals: dict[tuple, list[int]] = defaultdict(list)
    for window, places in tests.windows.items():
        size = len(window)
        prefix = lambda p, n=size: data[4 * p:4 * p + n]
        low = bisect_left(order, window, key=prefix)
        if low == len(order) or prefix(order[low]) != window:
            continue
        hits = at[order[low:bisect_right(order, window, lo=low, key=prefix)]].tolist()
        for item, i in places:
            for p in hits:
                diagonals[p >> 40, item, (p & (1 << 40) - 1) - i, size // 4].append(i)
    for (d, item, shift, width), starts in diagonals.items():
        starts.sort()
        first = last = starts[0]
        for i in [*starts[1:], None]:
            if i is None or i > last + 1:
                found[d].append((item, first + shift, first, last + width - first))
                first = i
            last = i
    return found


def match_texts(texts: list, tests: TestSet) -> tuple[list[int], list[list[tuple]]]:
    """Number of words and matches of each text, shard by shard."""
    counts, found, shard, size = [], [], [], 0
    get = tests.vocabulary.get
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        shard.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        size += len(text or "")
        if size >= SHARD_BYTES:
            found += search(shard, tests)
            shard, size = [], 0
    return counts, found + search(shard, tests)


def test_blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark's rows in blocks of bounded text; the driver holds one block at a time."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").alias("t"))
    for row in rows.toLocalIterator():
        block.append((row.i, row.t))
        size += len(row.t or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words and all verbatim matches of whole windows, one row per document."""
    spark = docs.sparkSession
    schema = spark.createDataFrame([], SCHEMA).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def step(shared, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for batch in batches:
                counts, found = match_texts(batch.column(1).to_pylist(), tests)
                earlier = batch.column(3).to_pylist()
                matches = [[*(tuple(m.values()) for m in e or ()), *f] for e, f in zip(earlier, found, strict=True)]
                made = [[dict(zip(("item", "doc_word", "item_word", "n_words"), m, strict=True)) for m in ms] for ms in matches]
                text = pa.nulls(batch.num_rows, arrow[1].type) if last else batch.column(1).cast(arrow[1].type)
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow[0].type), text, pa.array(counts, arrow[2].type),
                                                  pa.array(made, arrow[3].type)], schema=arrow)
        return run

    out = docs.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"),
                      F.array().cast(schema["matches"].dataType).alias("matches"))
    blocks = list(map(spark.sparkContext.broadcast, map(TestSet, test_blocks(benchmark)))) or [
        spark.sparkContext.broadcast(TestSet([]))]
    for shared in blocks:                                 # one scan; each block is a further step in the same task
        out = out.mapInArrow(step(shared, shared is blocks[-1]), schema)
    return out.drop("text")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of the matches: hit words, items, and the longest verbatim match."""
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m.doc_word.alias("a"), (m.doc_word + m.n_words).alias("b"))))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    covered = F.aggregate(spans, zero, lambda s, x: F.struct(
        (s.n + F.greatest(x.b - F.greatest(x.a, s.upto), F.lit(0))).alias("n"), F.greatest(s.upto, x.b).alias("upto")))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return find_matches(docs, benchmark).select(
        "doc_id", "n_words", covered.n.cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.n_words)), F.lit(0)).cast("long").alias("longest_match"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of the benchmark, with every column as it was."""
    at = docs.columns.index("text")

    def step(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for batch in batches:
                found = match_texts(batch.column(at).to_pylist(), tests)[1]
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))
        return run

    out = docs
    for block in test_blocks(benchmark):
        out = out.mapInArrow(step(docs.sparkSession.sparkContext.broadcast(TestSet(block))), docs.schema)
    return out


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest_match")


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
test AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
         FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
place AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
          FROM d, (SELECT DISTINCT k FROM test), unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k),
hit AS (SELECT doc_id, i, k, item FROM place JOIN test USING (k, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, k FROM hit), unnest(range(i, i + k)) AS t(p)
          GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
