"""Operator 7, line dedup by pairwise alignment.

Documents that overlap are found by what they share: a line that is a passage by itself (PASSAGE_WORDS words), a
shorter long line that is rare (held by at most RARE_SHARE of the documents, or RARE_DOCS of a small table), two lines
in a row of which one is long, three short lines in a row, or the whole text.  Only single lines shorter than a
passage have a limit of frequency: one that many unrelated documents hold brings nobody together by itself.  For each such
piece of evidence the first document (smallest id) that holds it is paired with every later one: links grow
with the lines, not with the square of a group.  Each pair is aligned by patience diff over line hashes;
aligned blocks that hold a long line, that have PASSAGE_WORDS words in SHORT_LINES lines or more, or that make up the whole
later document, are deleted from the later document.

A line is deleted only where an earlier document holds it, so of every deleted line the first
holder's copy stays.  Only ids and hashes of lines are shuffled to find and align pairs.

Defined results: null and empty texts are left as they are; blank lines align only beside
other lines; a row that repeats an earlier row in full (id and text) shares its decisions; rows that
repeat an id with another text are documents of their own; a document whose lines are all deleted
is dropped by ``line_dedup``; an empty table gives an empty result; columns beside the text keep their values,
but ``n_chars``, if present, follows the text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import packed, table, written

RARE_DOCS, RARE_SHARE = 50, 0.05  # a line shorter than a passage in more documents, and in more than this share, is no evidence
PASSAGE_WORDS = 20             # words of a line that is a passage by itself, and of a block of short lines that goes
SHORT_LINES = 3                # lines of a block of short lines that goes
LONG_LINE = 40                 # characters of a line that is evidence, and that lets a block go

KEY = ["_id", "_h"]


def keyed(docs: DataFrame) -> DataFrame:
    """The key of a row: its id (a number even if null) and a digest of its text."""
    return (docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2 ** 63))))
            .withColumn("_h", F.xxhash64(F.lit(11), "text")))


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: pairs (i, j) of equal lines in rising order.  Lines that are unique on both sides are
    anchored by a longest rising sequence; the gaps between anchors are treated alike."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, n, j, m = work.pop()
        while i < n and j < m and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            n, m = n - 1, m - 1
            out.append((n, m))
        if i == n or j == m:
            continue
        in_a, in_b = Counter(a[i:n]), Counter(b[j:m])
        place = {x: k for k, x in enumerate(b[j:m], j) if x and in_b[x] == 1 and in_a[x] == 1}
        common = [(k, place[x]) for k, x in enumerate(a[i:n], i) if x in place]
        tails: list[int] = []                              # longest rising sequence by piles
        top: list[int] = []
        back: list[int] = []
        for c, (_, y) in enumerate(common):
            pile = bisect_left(tails, y)
            if pile == len(tails):
                tails.append(y)
                top.append(c)
            else:
                tails[pile], top[pile] = y, c
            back.append(top[pile - 1] if pile else -1)
        c, anchors = top[-1] if top else -1, []
        while c >= 0:
            anchors.append(common[c])
            c = back[c]
        anchors.reverse()
        if not anchors:
            continue
        for (x, y), (to_x, to_y) in zip(anchors, [*anchors[1:], (n, m)], strict=True):
            work.append((x, to_x, y, to_y))                # starts with the anchor itself
        work.append((i, anchors[0][0], j, anchors[0][1]))
    return sorted(out)


def common_blocks(later: list[int], earlier: list[int]) -> list[tuple[int, int]]:
    """Ranges of lines of the later document to delete.  A hash is 0 if its line is blank; its lowest bit is set if the line
    is long, the next if it is a passage, and three more count its words up to seven."""
    blocks: list[list[int]] = []
    for i, j in aligned(later, earlier):
        if blocks and blocks[-1][1] == i and blocks[-1][2] == j:
            blocks[-1][1:] = [i + 1, j + 1]
        else:
            blocks.append([i, i + 1, j + 1])
    def goes(lines: list[int]) -> bool:
        some = [x for x in lines if x]
        return (len(lines) == len(later) or any(x & 1 for x in some)
                or len(some) >= SHORT_LINES and sum(x >> 2 & 7 for x in some) >= PASSAGE_WORDS)

    return [(s, e) for s, e, _ in blocks if goes(later[s:e])]


def line_hashes(docs: DataFrame) -> DataFrame:
    """_id, _h, lines: one hash for each line of every distinct document with text."""
    trimmed = F.transform(F.split("text", "\n", -1), lambda line: F.btrim(line))
    def marks(line):
        words = F.size(F.split(line, "\\s+"))
        long = F.length(line) >= LONG_LINE
        return (F.when(long, 1).otherwise(0) + F.when(long & (words >= PASSAGE_WORDS), 2).otherwise(0)
                + 4 * F.least(words, F.lit(7))).cast("long")

    hashed = F.transform(trimmed, lambda line: F.when(line == "", F.lit(0).cast("long")).otherwise(
        F.xxhash64(F.lit(7), line).bitwiseAND(F.lit(-32)).bitwiseOR(marks(line))))
    return (keyed(docs.select("doc_id", "text")).where(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != "")
            .select(*KEY, hashed.alias("lines")).groupBy(*KEY).agg(F.first("lines").alias("lines")))


def overlaps(lines: DataFrame) -> DataFrame:
    """Pairs (_id, _h, o_id, o_h) of a later document and the first document that holds the same evidence."""
    n = F.size("lines")
    singles = F.filter("lines", lambda x: x.bitwiseAND(F.lit(3)) == 1)
    passages = F.filter("lines", lambda x: x.bitwiseAND(F.lit(3)) == 3)
    short = lambda x: (x != 0) & (x.bitwiseAND(F.lit(1)) == 0)
    after = lambda i, k: F.get("lines", i + k)
    triples = F.when(n > 2, F.transform(F.slice("lines", 1, F.greatest(n - 2, F.lit(1))), lambda x, i: F.when(
        short(x) & short(after(i, 1)) & short(after(i, 2)), F.xxhash64(x, after(i, 1), after(i, 2)))))
    doubles = F.when(n > 1, F.zip_with(
        F.slice("lines", 1, F.greatest(n - 1, F.lit(1))), F.slice("lines", 2, F.greatest(n - 1, F.lit(1))),
        lambda x, y: F.when((x != 0) & (y != 0) & ((x.bitwiseOR(y)).bitwiseAND(F.lit(1)) == 1), F.xxhash64(x, y))))
    pieces = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("v")))
    every = F.flatten(F.array(pieces(0, F.array_distinct(singles)),
                              pieces(1, F.coalesce(F.array_distinct(doubles), F.array().cast("array<bigint>"))),
                              pieces(2, F.array(F.xxhash64("lines"))),
                              pieces(3, F.array_distinct(passages)),
                              pieces(4, F.coalesce(F.array_distinct(triples), F.array().cast("array<bigint>")))))
    seeds = written(lines.select(*KEY, F.explode(every).alias("s")).select(*KEY, "s.kind", "s.v").where(F.col("v").isNotNull()),
                    "line-seeds")
    rare = max(RARE_DOCS, int(RARE_SHARE * lines.count()))
    first = (seeds.groupBy("kind", "v").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct(*KEY)).alias("o"))
             .where((F.col("docs") > 1) & ((F.col("kind") != 0) | (F.col("docs") <= rare)))
             .select("kind", "v", F.col("o._id").alias("o_id"), F.col("o._h").alias("o_h")))
    return (seeds.join(first, ["kind", "v"]).where((F.col("_id") != F.col("o_id")) | (F.col("_h") != F.col("o_h")))
            .select(*KEY, "o_id", "o_h").distinct())


def deletions(docs: DataFrame) -> DataFrame:
    """_id, _h, cuts: for every document that overlaps an earlier one, the line ranges to delete."""
    lines = written(line_hashes(docs), "line-hashes")
    owners = lines.select(F.col("_id").alias("o_id"), F.col("_h").alias("o_h"), F.col("lines").alias("earlier"))
    pairs = overlaps(lines).join(lines, KEY).join(owners, ["o_id", "o_h"]).select(*KEY, "lines", "earlier")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [[{"a": s, "b": e} for s, e in common_blocks(x, y)]
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cuts, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
                names=["_id", "_h", "cuts"])

    return (pairs.mapInArrow(run, "_id long, _h long, cuts array<struct<a:int,b:int>>").where(F.size("cuts") > 0)
            .groupBy(*KEY).agg(F.array_distinct(F.flatten(F.collect_list("cuts"))).alias("cuts")))


def with_cuts(docs: DataFrame) -> DataFrame:
    """The documents with _all (their lines) and _left (the lines that stay); both null where nothing is deleted."""
    cut = written(deletions(docs), "line-cuts")
    every = F.split("text", "\n", -1)
    left = F.filter(every, lambda _, i: ~F.exists("cuts", lambda c: (c.a <= i) & (i < c.b)))
    return (keyed(docs).join(cut, KEY, "left").withColumn("_all", F.when(F.col("cuts").isNotNull(), every))
            .withColumn("_left", F.when(F.col("cuts").isNotNull(), left)).drop("cuts", *KEY))


def line_dedup(docs: DataFrame) -> DataFrame:
    """The documents without the deleted lines, with all of their columns; documents with nothing left go."""
    text = F.when(F.col("_left").isNull(), F.col("text")).otherwise(F.array_join("_left", "\n"))
    empty = F.col("_left").isNotNull() & (F.btrim(F.array_join("_left", ""), F.lit(" \t\n\x0b\x0c\r")) == "")
    values = {c: F.col("row").getField(c) for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        length = F.when(F.col("_left").isNull(), values["n_chars"]).otherwise(F.length(text))
        values["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return with_cuts(packed(docs)).where(~empty).select(*[v.alias(c) for c, v in values.items()])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the text that stays) of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    every = F.when(F.coalesce(F.col("text"), F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split("text", "\n", -1)))
    kept = F.when(F.col("_left").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join("_left", "\n"))
    return with_cuts(docs).select(
        "doc_id", every.cast("long").alias("n_lines"),
        F.when(F.col("_left").isNull(), F.lit(0)).otherwise(F.size("_all") - F.size("_left")).cast("long").alias("n_removed"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))
