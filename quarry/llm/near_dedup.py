"""Operator 1, near-duplicate documents by DartMinHash.

A document is a weighted set of shingles of five words (by default each distinct shingle weighs one; its
number of occurrences can be taken instead).  Darts are thrown at every unit of an element's weight: their
ranks form a Poisson process that depends on the element and the unit only, so two documents see the
same darts where their weights overlap.  A dart lands on one of K coordinates; each coordinate keeps its
earliest dart.  Throwing stops at a rank where, for the document's whole weight, all coordinates are
expected to be hit; the few documents with an empty coordinate are thrown on to twice that rank.
So small documents get many darts per element and long ones few, about K log K in all.

Coordinates are joined in bands.  Texts that share a band are candidates, and every candidate
pair that matters is verified on its whole texts (Jaccard similarity of THRESHOLD or more):
1. equal texts are one node;
2. in each bucket every node is compared with up to CENTRES nodes of it, so that links grow with the rows;
3. nodes of one bucket that are still in different components are searched exactly, without pairing a
   bucket: their shingles are ordered by frequency over all such nodes, and similar sets must meet in one
   of their rarest shingles, at places that leave enough of both sets to reach the threshold.  So no link
   between candidates is lost, and groups of copies are never expanded into pairs.
What travels to a comparison are the sorted shingles of a text, made once for each node, not the text.
Classes are the connected components, found by joins on written tables.

A pair at the threshold misses all BANDS bands of ROWS with a chance of (1 - 0.8^6)^30 = 1e-4.

Defined results: texts with fewer than five words have one shingle, the whole of them; null texts and
texts without a word have none and are a class of their own each (of one row); rows that repeat id and text
are in one class, of which the filter keeps one row; of a class the smallest id stays (a null id
counts as the smallest), and of equal ids the smallest text digest; an empty table gives an empty
result; the filter keeps every column as it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import packed, table, written
from quarry.session import sized_side

WORDS = 5
THRESHOLD = 0.8
ROWS, BANDS = 6, 30
K = ROWS * BANDS
CENTRES = 4                    # nodes of a bucket that all others are compared with
SPARE = 4.0                    # darts per coordinate beyond log K: all but 2 % of the documents fill at once
CHUNK = 500_000                # elements thrown at together,
CHUNK_TEXTS = 500              # of so many texts at most: each takes some 1,700 darts, however short it is

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on whole arrays."""
    x = (x + _A).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Hashes of all runs of WORDS words, in order, with repeats."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    out = np.zeros(n, np.uint64)
    for i in range(WORDS):
        out = mix(out ^ h[i:i + n])
    return out


def weighted(text: str | None, counts: bool = False) -> tuple[np.ndarray, np.ndarray]:
    elements, n = np.unique(shingles(text), return_counts=True)
    return elements, n.astype(float) if counts else np.ones(len(elements))


def throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, documents: int, k: int = K) -> np.ndarray:
    """Signatures (documents x k): for each coordinate the identity of the earliest dart that hits the set."""
    signature = np.zeros((documents, k), np.uint64)
    total = np.bincount(owner, weights, documents)
    todo = total > 0
    factor = 1.0
    while todo.any():
        limit = np.zeros(documents)
        limit[todo] = factor * k * (np.log(k) + SPARE) / total[todo]
        mine = todo[owner]
        units = np.ceil(weights[mine]).astype(np.int64)
        at = np.repeat(np.flatnonzero(mine), units)
        unit = np.arange(len(at)) - np.repeat(np.cumsum(units) - units, units)
        state = mix(elements[at] ^ mix(unit.astype(np.uint64)))
        doc, room = owner[at], weights[at] - unit          # a last unit may be a fraction
        rank = np.zeros(len(at))
        first = np.full(documents * k, np.inf)
        darts = []
        while len(at):
            state = mix(state)
            rank = rank - np.log(((state >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53)
            near = rank <= limit[doc]
            at, state, doc, room, rank = at[near], state[near], doc[near], room[near], rank[near]
            height = (mix(state ^ _B) >> np.uint64(11)).astype(float) * 2.0 ** -53
            name = mix(state ^ _C)
            hit = height < room
            slot = doc[hit] * k + (name[hit] % np.uint64(k)).astype(np.int64)
            np.minimum.at(first, slot, rank[hit])
            darts.append((slot, rank[hit], name[hit]))
        flat = signature.reshape(-1)
        for slot, r, name in darts:
            won = first[slot] == r
            flat[slot[won]] = name[won]
        todo &= ~np.isfinite(first.reshape(documents, k)).all(1)
        factor *= 2
    return signature


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit value for each band, which also tells the bands apart."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64)), (len(signature), BANDS))
    for r in range(ROWS):
        out = mix(out ^ parts[:, :, r])
    return out.astype(np.uint64).view(np.int64)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets of shingles reaches the threshold."""
    if min(len(x), len(y)) < THRESHOLD * max(len(x), len(y)):
        return False                                       # too unlike in size
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= THRESHOLD * max(1, len(x) + len(y) - common)


def text_bands(texts: list[str | None], counts: bool = False) -> list[list[int] | None]:
    """Band values of each text; None for a text without words."""
    out: list[list[int] | None] = []
    part: list[tuple[np.ndarray, np.ndarray]] = []

    def done() -> None:
        sizes = np.array([len(e) for e, _ in part], np.int64)
        if len(part):
            signature = throw(np.concatenate([e for e, _ in part]), np.concatenate([w for _, w in part]),
                              np.repeat(np.arange(len(part)), sizes), len(part))
            out.extend(b if n else None for b, n in zip(bands(signature).tolist(), sizes, strict=True))
            part.clear()

    size = 0
    for text in texts:
        part.append(weighted(text, counts))
        size += len(part[-1][0])
        if size >= CHUNK or len(part) >= CHUNK_TEXTS:
            done()
            size = 0
    done()
    return out


def keyed(docs: DataFrame) -> DataFrame:
    return (docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2 ** 63))))
            .withColumn("_t", F.md5(F.col("text").cast("binary"))))


def nodes_of(docs: DataFrame) -> DataFrame:
    """node, _id, _t, bands: one row for each distinct text with words; _id is the smallest that has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(text_bands(batch.column(2).to_pylist()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), made], names=["_id", "_t", "bands"])

    rows = keyed(docs.select("doc_id", "text")).where("text IS NOT NULL").select("_id", "_t", "text")
    distinct = (rows.mapInArrow(run, "_id long, _t string, bands array<long>").where("bands IS NOT NULL")
                .groupBy("_t").agg(F.min("_id").alias("_id"), F.first("bands").alias("bands")))
    # The numbers hold because the table is written before anybody reads them.
    return written(distinct.select(F.monotonically_increasing_id().alias("node"), "_id", "_t", "bands"), "near-nodes")


def shingles_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, sh: the distinct shingles, in order, of the text of each wanted (node, _id, _t)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingles(t.as_py()).view(np.int64)) for t in batch.column(1)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))],
                                             names=["node", "sh"])

    # Rows that repeat id and text are in one node: one of them is read.  Texts are dealt out by their digests whatever
    # the number of wanted ones, so that small tables go the way of large ones.
    texts = keyed(docs.select("doc_id", "text")).join(wanted.hint("merge"), ["_id", "_t"]).select("node", "text")
    made = texts.mapInArrow(run, "node long, sh array<long>")
    return written(made.groupBy("node").agg(F.first("sh").alias("sh")), "near-shingles")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose whole texts are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, at), (y, to) = ((c.values.to_numpy(), c.offsets.to_numpy()) for c in (batch.column(2), batch.column(3)))
            near = [similar(x[at[i]:at[i + 1]], y[to[i]:to[i + 1]]) for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    one = sets.select(F.col("node").alias("u"), F.col("sh").alias("a"))
    two = sets.select(F.col("node").alias("v"), F.col("sh").alias("b"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _at_least(share: float, n: Column) -> Column:
    """The least whole number of ``share * n`` or more (the term allows for rounding of the product)."""
    return F.ceil(F.lit(share) * n - F.lit(1e-9))


def unlinked_pairs(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v), u > v, of nodes (node, comp) in different components, with all that reach the threshold among them.

    Each set is ordered by the frequency of its shingles, rare first.  Two sets similar enough have at least
    ``t / (1 + t)`` of their joint size in common, so the first common shingle stands at a place in each after which that
    many are left; shingles that only one node has can be no such place, but count as places.
    """
    rows = written(nodes.join(sets, "node").select("node", "comp", F.size("sh").cast("long").alias("n"), F.explode("sh").alias("s")), "near-open")
    often = rows.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    one = Window.partitionBy("node")
    place = F.col("n") - F.count(F.lit(1)).over(one) + F.row_number().over(one.orderBy("f", "s")) - 1
    prefix = written(rows.join(often, "s").select("s", "node", "comp", "n", place.alias("at"))
                     .where(F.col("at") <= F.col("n") - _at_least(THRESHOLD, F.col("n"))), "near-prefix")
    x = prefix.select("s", *[F.col(c).alias(f"{c}_x") for c in ("node", "comp", "n", "at")])
    y = prefix.select("s", *[F.col(c).alias(f"{c}_y") for c in ("node", "comp", "n", "at")])
    common = _at_least(THRESHOLD / (1 + THRESHOLD), F.col("n_x") + F.col("n_y"))
    met = x.join(y, "s").where(
        (F.col("comp_x") != F.col("comp_y"))
        & ((F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("node_x") < F.col("node_y"))))
        & (F.col("n_x") >= _at_least(THRESHOLD, F.col("n_y")))
        & (F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y")) >= common))
    return met.select(F.greatest("node_x", "node_y").alias("u"), F.least("node_x", "node_y").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, comp: the smallest node of each linked node's component, by joins until no link is left.

    Every node points to the smallest of itself and its neighbours; pointers are followed to their ends by
    doubling, and the links between different ends are the next round's, so rounds shrink fast and chains take
    the logarithm of their length."""
    edges = written(links.select("u", "v").distinct(), "near-links")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("comp")), "near-ends")
        moved = True
        while moved:
            far = ends.select(F.col("u").alias("comp"), F.col("comp").alias("far"))
            jumped = written(ends.join(far, "comp").select("u", F.col("far").alias("comp"), (F.col("far") != F.col("comp")).alias("moved")), "near-ends")
            ends, moved = jumped.select("u", "comp"), not jumped.where("moved").isEmpty()
        if labels is None:
            labels = ends
        else:
            further = ends.select(F.col("u").alias("comp"), F.col("comp").alias("far"))
            labels = written(labels.join(further, "comp", "left").select("u", F.coalesce("far", "comp").alias("comp")), "near-labels")
        edges = written(edges.join(ends.select("u", F.col("comp").alias("cu")), "u")
                        .join(ends.select(F.col("u").alias("v"), F.col("comp").alias("cv")), "v").where("cu <> cv")
                        .select(F.greatest("cu", "cv").alias("u"), F.least("cu", "cv").alias("v")).distinct(), "near-links")
        if edges.isEmpty():
            return labels.select(F.col("u").alias("node"), "comp")


# Numbers that, xor-ed with the nodes, put them into another order for each centre.
MASKS = [int(m) & (1 << 50) - 1 for m in mix(np.arange(CENTRES, dtype=np.uint64))]


def centres() -> list[Column]:
    return [F.min(F.col("node").bitwiseXOR(F.lit(m))).alias(f"c{i}") for i, m in enumerate(MASKS)]


def centre_array() -> Column:
    return F.array(*[F.col(f"c{i}").bitwiseXOR(F.lit(m)) for i, m in enumerate(MASKS)]).alias("centres")


def with_centres(rows: DataFrame) -> DataFrame:
    """Pairs (u, v), u > v, of each node with the centres of its bucket."""
    pairs = rows.select("node", F.explode("centres").alias("c")).where("node <> c")
    return pairs.select(F.greatest("node", "c").alias("u"), F.least("node", "c").alias("v")).distinct()


def near_classes(docs: DataFrame) -> DataFrame:
    """_t, class_id, class_text: for every distinct text that is near another one, its class (of smallest id)."""
    nodes = nodes_of(docs)
    rows = written(nodes.select("node", F.explode("bands").alias("bucket")), "near-buckets")
    first = rows.groupBy("bucket").agg(*centres(), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    shared = written(rows.join(first, "bucket").select("bucket", "node", centre_array()), "near-shared")
    wanted = shared.select("node").distinct().join(nodes.select("node", "_id", "_t"), "node")
    sets = shingles_of(docs, wanted)
    tried = written(with_centres(shared), "near-tried")
    links = written(verified(tried, sets), "near-verified")
    comps = components(links)
    tagged = shared.select("bucket", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = tagged.groupBy("bucket").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("bucket")
    still = written(tagged.join(split, "bucket").select("node", "comp").distinct(), "near-unlinked")
    rest = written(unlinked_pairs(still, sets).join(tried, ["u", "v"], "left_anti"), "near-rest")
    # The new links join whole components: a node that has none yet is one of its own.
    label = lambda end: still.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
    bridges = verified(rest, sets).join(label("u"), "u").join(label("v"), "v").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    merged = components(bridges)
    every = comps.unionByName(merged.select("node", F.col("node").alias("comp")).join(comps.select("node"), "node", "left_anti"))
    comps = every.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("far")), "comp", "left").select(
        "node", F.coalesce("far", "comp").alias("comp"))
    named = comps.join(nodes.select("node", "_id", "_t"), "node")
    best = named.groupBy("comp").agg(F.min(F.struct("_id", "_t")).alias("best"))
    return written(named.join(best, "comp").select("_t", F.col("best._id").alias("class_id"), F.col("best._t").alias("class_text")),
                   "near-classes")


def copies(docs: DataFrame) -> DataFrame:
    """_t, _class, _best (digest of the text that stays), _n (rows of the text) of each text that is in several rows or
    in a class with others; written, so that Catalyst knows its size."""
    rows = keyed(docs.select("doc_id", "text")).where(F.col("_t").isNotNull()).groupBy("_t").agg(
        F.min("_id").alias("own"), F.count(F.lit(1)).alias("_n"))
    named = rows.join(near_classes(docs), "_t", "left").where((F.col("_n") > 1) | F.col("class_id").isNotNull())
    return sized_side(named.select("_t", F.coalesce("class_id", "own").alias("_class"), F.coalesce("class_text", "_t").alias("_best"), "_n"))


def classed(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``keyed`` rows with the class of their text: _class, _best, _n; a text in no table of ``copies`` is its own."""
    return (rows.join(known, "_t", "left").withColumn("_class", F.coalesce("_class", "_id"))
            .withColumn("_best", F.coalesce("_best", "_t")).withColumn("_n", F.coalesce("_n", F.lit(1).cast("long"))))


def has_word() -> Column:
    return F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(" \t\n\x0b\x0c\r")) != ""


def near_dedup(docs: DataFrame) -> DataFrame:
    """One document of each class of near duplicates, with all columns; documents without words stay."""
    rows = classed(keyed(packed(docs)), copies(docs))
    best = (F.col("_id") == F.col("_class")) & (F.col("_t") == F.col("_best"))
    alone = rows.where(~has_word() | (best & (F.col("_n") == 1)))
    # Rows that repeat id and text: one stays.
    row = Window.partitionBy("_t", "_id").orderBy("_id")
    once = rows.where(has_word() & best & (F.col("_n") > 1)).withColumn("_k", F.row_number().over(row)).where("_k = 1")
    return alone.select("row.*").union(once.select("row.*"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class; a document without near duplicates has its own), duplicate."""
    docs = table(spark, sf_dir, "documents")
    rows = keyed(docs.select("doc_id", "text")).withColumn("_words", has_word()).drop("text")
    null_id = F.lit(-(2 ** 63))
    named = F.when(F.col("_class") == null_id, F.lit(None)).otherwise(F.col("_class"))
    return classed(rows, copies(docs)).select(
        "doc_id", F.when(F.col("_words"), named).otherwise(F.col("doc_id").cast("long")).alias("class_id"),
        (F.col("_words") & (F.col("_id") != F.col("_class"))).alias("duplicate"))
