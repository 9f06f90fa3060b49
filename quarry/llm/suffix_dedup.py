"""Operator 10, exact substring dedup by suffix arrays built with linear grouping.

A byte goes if it lies in a string of SPAN bytes that also starts anywhere else in the corpus.  Suffix arrays
decide; three steps before bring together what can be equal and leave out what cannot:

1. Anchors.  Of WINDOW GRAM-byte strings in a row the one of least hash is an anchor.  The windows inside a
   SPAN-byte string depend on nothing outside it, so equal strings have equal anchors.  Anchors are counted
   over the corpus; a string with an anchor seen once is unique.  What remains are regions of candidate starts.
2. Contexts.  The starts of a region are dealt out by the least hash of short grams in their SPAN bytes:
   equal strings come to the same group.  A context is a run of such starts with all of their bytes.
   Contexts equal as a whole (copies) are one context with a count before anything is sorted: all of
   its strings repeat.
3. Suffix arrays.  In a group with a context seen once, contexts that lie in another one as a whole (copies cut
   off by an edit) are marked in both and left to the longer one, and loops are cut to a few turns (their strings
   all repeat); the suffixes of what remains are
   ordered by linear grouping, and neighbours in the order that agree in SPAN bytes are repeats.

Suffix order (GSACA): suffixes are grouped by their longest Lyndon prefix.  Groups are taken in
descending order; each suffix finds its previous smaller suffix by following the pointers of larger ones, and
that suffix moves up behind the rest of its group, by the number of its children in the group at hand.
Then the groups are read in ascending order: a suffix that has its place places, along the previous-smaller
pointers, those that end before it.  No names are assigned anew and nothing recurs.

A group whose distinct contexts have more than GROUP_BYTES is not given to one task: each of its strings becomes
a digest, and equal digests are counted by Spark.

Defined results: null and empty texts have no bytes, no spans, and the digest of nothing; texts shorter than SPAN
lose nothing; a repeated row counts as another text (so both lose everything if long enough); rows
that repeat an id are told apart by their text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table, written

SPAN = 400
GRAM, WINDOW = 200, 145        # an anchor is the GRAM-byte string of least hash among WINDOW in a row
SHORT_GRAM = 32                # bytes of the grams that deal out contexts: long runs of starts share one
GROUP_BYTES = 1 << 20          # distinct contexts that one task sorts together
KEY = ["_id", "_h"]

_M = 2 ** 64
_P = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@lru_cache(maxsize=2)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    out = []
    for b in (_P, pow(_P, -1, _M)):
        x = np.full(size, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def gram_hashes(data: bytes, width: int) -> np.ndarray:
    """Mixed rolling hash of every ``width``-byte string of ``data``."""
    n = len(data)
    up, down = powers(1 << max(16, (n + 1).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[width:] - sums[:-width]) * down[:n - width + 1]
    h ^= h >> np.uint64(30)
    h *= _MIX[0]
    h ^= h >> np.uint64(27)
    h *= _MIX[1]
    h ^= h >> np.uint64(31)
    return h


def sliding(x: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Least (or largest) value of every ``width`` values in a row, from running values in blocks."""
    n = len(x)
    edge = np.uint64(_M - 1) if pick is np.minimum else np.uint64(0)
    blocks = np.concatenate([x, np.full(-n % width, edge, np.uint64)]).reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n - width + 1], ahead[width - 1:n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The least hash of every window, and the hashes of all places that are the least of some window."""
    h = gram_hashes(data, GRAM)
    least = sliding(h, WINDOW)
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least, np.zeros(WINDOW - 1, np.uint64)])
    return least, h[h == sliding(padded, WINDOW, np.maximum)]


def candidate_starts(data: bytes, repeated: np.ndarray) -> np.ndarray:
    """Mask of the starts of SPAN bytes whose windows have none but repeated anchors."""
    least = sliding(gram_hashes(data, GRAM), WINDOW)
    single = np.concatenate([[0], np.cumsum(~np.isin(least, repeated))])
    inside = SPAN - (GRAM + WINDOW - 1) + 1
    return single[inside:] == single[:-inside]


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def contexts(data: bytes, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(group, first start, end of starts) for the runs of candidate starts, by their least short gram."""
    out = []
    for a, b in runs(starts):
        least = sliding(gram_hashes(data[a:b + SPAN - 1], SHORT_GRAM), SPAN - SHORT_GRAM + 1)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = [0, *cut.tolist()]
        out += [(int(g), a + s, a + e) for g, s, e in
                zip(least[first].view(np.int64).tolist(), first, [*first[1:], b - a], strict=True)]
    return out


def suffix_order(seq: list[int]) -> list[int]:
    """Suffix array of ``seq`` by linear grouping."""
    n = len(seq)
    members: dict[int, dict[int, None]] = {}               # start of a group in the order -> its suffixes
    group = [0] * n                                        # suffix -> start of its group
    last: dict[int, int] = {}                              # end of a group -> its start
    by: dict[int, list[int]] = {}
    for i, c in enumerate(seq):
        by.setdefault(c, []).append(i)
    at = 0
    for c in sorted(by):
        members[at] = dict.fromkeys(by[c])
        for i in by[c]:
            group[i] = at
        last[at + len(by[c])] = at
        at += len(by[c])
    smaller = [-1] * n                                     # previous smaller suffix
    while at > 0:                                          # groups in descending order; ``at`` is the end of the next
        start = last[at]
        at = start
        children: dict[int, int] = {}
        for s in members[start]:
            p = s - 1
            while p >= 0 and group[p] > start:
                p = smaller[p]
            if p >= 0 and group[p] == start:               # the same Lyndon word once more: the same parent
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                children[p] = children.get(p, 0) + 1
        moved: dict[int, dict[int, list[int]]] = {}
        for p, n_children in children.items():
            moved.setdefault(group[p], {}).setdefault(n_children, []).append(p)
        for g, by_count in moved.items():
            own = members[g]
            if len(by_count) == 1 and len(next(iter(by_count.values()))) == len(own):
                continue
            for parents in by_count.values():
                for p in parents:
                    del own[p]
            to = g + len(own)
            if own:
                last[to] = g
            for n_children in sorted(by_count):            # more children of a larger word: further up
                parents = sorted(by_count[n_children])
                members[to] = dict.fromkeys(parents)
                for p in parents:
                    group[p] = to
                last[to + len(parents)] = to
                to += len(parents)
    order = [0] * n
    free = list(range(n))                                  # next place of the group that starts here
    placed = bytearray(n)
    i, p = -1, n
    while True:
        j = p - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = smaller[j]
        i += 1
        if i == n:
            return order
        p = order[i]


def repeats_itself(text: bytes) -> bool:
    """Whether a context may hold the same SPAN bytes at two starts.  All of its starts share the bytes in the middle
    (if there are few enough of them), which then occur twice as well."""
    starts = len(text) - SPAN + 1
    middle = text[starts - 1:SPAN]
    return not middle or text.find(middle, text.find(middle) + 1) >= 0


def repeats(texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each of some distinct contexts, the runs of starts whose SPAN bytes occur twice or more in them."""
    twice = [np.zeros(len(t) - SPAN + 1, bool) for t in texts]
    longest: list[int] = []
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        for k in longest:
            at = texts[k].find(texts[i])
            if at >= 0:                                    # whole inside a longer one: both repeat
                twice[i][:] = True
                twice[k][at:at + len(twice[i])] = True
                break
        else:
            longest.append(i)
    cuts = [cut_loop(texts[i]) for i in longest]
    found = [np.zeros(len(c[0]) - SPAN + 1, bool) for c in cuts]
    if len(longest) > 1 or repeats_itself(cuts[0][0]):
        parts = possible_parts([c[0] for c in cuts])
        for (i, a, b), f in zip(parts, sorted_repeats([cuts[i][0][a:b + SPAN - 1] for i, a, b in parts]), strict=True):
            found[i][a:b] = f
    for i, (_, at, gone, low, high), f in zip(longest, cuts, found, strict=True):
        twice[i][:at] |= f[:at]
        twice[i][at + gone:] |= f[at:]
        twice[i][low:high] = True
    return [runs(t) for t in twice]


def possible_parts(texts: list[bytes]) -> list[tuple[int, int, int]]:
    """(context, first start, end of starts) of the starts whose SPAN bytes hold no short gram that stands once in
    all of these contexts: no other start can repeat."""
    grams = [gram_hashes(t, SHORT_GRAM) for t in texts]
    _, which, n = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    single = n[which] == 1
    out, at = [], 0
    for i, g in enumerate(grams):
        seen = np.concatenate([[0], np.cumsum(single[at:at + len(g)])])
        at += len(g)
        inside = SPAN - SHORT_GRAM + 1
        out += [(i, a, b) for a, b in runs(seen[inside:] == seen[:-inside])]
    return out


def cut_loop(text: bytes) -> tuple[bytes, int, int, int, int]:
    """The context with the middle of its loop taken out: what is left, the place and number of the bytes gone, and
    the starts (low, high) of the loop, which all repeat.

    Bytes that agree with those one turn on make a loop.  Three turns and SPAN bytes of it stay, so every string of
    SPAN bytes that occurs in the context occurs in what is left, and at its own distance from either end."""
    half = max(0, (len(text) - SPAN) // 2)
    turn = text.find(text[half:half + SPAN], half + 1) - half
    if turn > 0:
        a = np.frombuffer(text, np.uint8)
        other = np.flatnonzero(a[:-turn] != a[turn:])
        k = int(np.searchsorted(other, half))
        low = int(other[k - 1]) + 1 if k else 0
        end = (int(other[k]) if k < len(other) else len(text) - turn) + turn      # the loop is text[low:end]
        gone = (end - low - SPAN - 3 * turn) // turn * turn
        if gone > 0:
            at = low + turn
            return text[:at] + text[at + gone:], at, gone, low, end - SPAN + 1
    return text, 0, 0, 0, 0




def sorted_repeats(texts: list[bytes]) -> list[np.ndarray]:
    """Masks of the starts whose SPAN bytes occur twice or more in the texts, by their suffix array."""
    if not texts:
        return []
    seq: list[int] = []
    base = []
    for t in texts:
        base.append(len(seq))
        seq += [c + 1 for c in t]
        seq.append(0)                                      # smaller than any byte: no match runs on
    data = b"\0".join(texts) + b"\0"
    full = np.zeros(len(seq), bool)
    for b, t in zip(base, texts, strict=True):
        full[b:b + len(t) - SPAN + 1] = True
    order = np.array(suffix_order(seq))
    order = order[full[order]].tolist()                    # starts with SPAN bytes of their own
    twice = np.zeros(len(seq), bool)
    for a, b in zip(order, order[1:], strict=False):
        if data[a:a + SPAN] == data[b:b + SPAN]:
            twice[a] = twice[b] = True
    return [twice[b:b + len(t) - SPAN + 1] for b, t in zip(base, texts, strict=True)]


def keyed(docs: DataFrame) -> DataFrame:
    """One row for each distinct (id, text) with its number of rows; texts too short to lose anything are left out."""
    return (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2 ** 63))).alias("_id"),
                        F.xxhash64(F.lit(11), "text").alias("_h"), "text"))


def long_texts(docs: DataFrame) -> DataFrame:
    return keyed(docs).where(F.octet_length("text") >= SPAN)


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """_id, _h, anchors: the anchors of each text that occur twice or more in the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                which, values, counts = [], [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    v, n = np.unique(anchors(text.encode())[1], return_counts=True)
                    which.append(np.full(len(v), i))
                    values.append(v.view(np.int64))
                    counts.append(np.minimum(n, 2))
                if which:
                    w = pa.array(np.concatenate(which))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(w), part.column(1).take(w), pa.array(np.concatenate(values)),
                                                      pa.array(np.concatenate(counts).astype(np.int32))], names=[*KEY, "a", "n"])

    found = written(long_texts(docs).mapInArrow(run, "_id long, _h long, a long, n int"), "suffix-anchors")
    twice = found.groupBy("a").agg(F.sum("n").alias("n")).where("n > 1").select("a")
    return found.select(*KEY, "a").join(twice, "a").groupBy(*KEY).agg(F.collect_set("a").alias("anchors"))


def all_contexts(docs: DataFrame) -> DataFrame:
    """_id, _h, g, c (digest of the context), first, n (starts), context: candidates of every distinct row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows = []
                for i, (text, known) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    data = text.encode()
                    starts = candidate_starts(data, np.array(known, np.int64).view(np.uint64))
                    for g, a, b in contexts(data, starts):
                        c = data[a:b + SPAN - 1]
                        rows.append((i, g, hashlib.blake2b(c, digest_size=16).digest(), a, b - a, c))
                w = pa.array([r[0] for r in rows], pa.int64())
                kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0).take(w), part.column(1).take(w)] + [
                    pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds, 1)], names=[*KEY, "g", "c", "first", "n", "context"])

    joined = long_texts(docs).join(repeated_anchors(docs), KEY).select(*KEY, "text", "anchors")
    return joined.mapInArrow(run, "_id long, _h long, g long, c binary, first int, n int, context binary")


def repeated_starts(found: DataFrame) -> DataFrame:
    """g, c, runs: for every distinct context the runs of starts (from its first byte) that repeat somewhere."""
    distinct = written(found.groupBy("g", "c").agg(F.count(F.lit(1)).alias("m"), F.first("context").alias("context")), "suffix-distinct")
    copies = distinct.where("m > 1").select("g", "c", F.array(F.struct(
        F.lit(0).alias("a"), (F.length("context") - (SPAN - 1)).alias("b"))).alias("runs"))
    groups = distinct.groupBy("g").agg(F.min("m").alias("least"), F.sum(F.length("context")).alias("size")).where("least = 1")
    unsure = distinct.select("g", "c", "context").join(groups.select("g", "size"), "g")

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come sorted by group; one group at a time is held, over the ends of batches."""
        group, names, texts = None, [], []

        def done() -> pa.RecordBatch:
            made = [[{"a": a, "b": b} for a, b in r] for r in repeats(texts)]
            return pa.RecordBatch.from_arrays([pa.array([group] * len(names), pa.int64()), pa.array(names, pa.binary()),
                                               pa.array(made, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
                                              names=["g", "c", "runs"])

        for batch in batches:
            finished = []
            for g, c, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if g != group and names:
                    finished.append(done())
                    names, texts = [], []
                group = g
                names.append(c)
                texts.append(t)
            if finished:
                yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
        if names:
            yield done()

    shape = "g long, c binary, runs array<struct<a:int,b:int>>"
    ordered = (unsure.where(F.col("size") <= GROUP_BYTES).select("g", "c", "context").repartition("g")
               .sortWithinPartitions("g").mapInArrow(sort_groups, shape))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, c, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                n = len(text) - SPAN + 1
                for at in range(0, n, 10_000):
                    to = min(n, at + 10_000)
                    made = [hashlib.blake2b(text[i:i + SPAN], digest_size=16).digest() for i in range(at, to)]
                    yield pa.RecordBatch.from_arrays([pa.array([g] * len(made), pa.int64()), pa.array([c] * len(made), pa.binary()),
                                                      pa.array(range(at, to), pa.int32()), pa.array(made, pa.binary())],
                                                     names=["g", "c", "i", "d"])

    def joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for starts in batch.column(2).to_pylist():
                mask = np.zeros(max(starts) + 1, bool)
                mask[starts] = True
                made.append([{"a": a, "b": b} for a, b in runs(mask)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                              pa.array(made, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
                                             names=["g", "c", "runs"])

    each = unsure.where(F.col("size") > GROUP_BYTES).select("g", "c", "context").mapInArrow(digests, "g long, c binary, i int, d binary")
    twice = each.groupBy("d").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("d")
    counted = (each.join(twice, "d").groupBy("g", "c").agg(F.collect_list("i").alias("i")).mapInArrow(joined_runs, shape))
    return copies.unionByName(ordered).unionByName(counted)


def removals(docs: DataFrame) -> DataFrame:
    """_id, _h, spans: for every distinct row that loses bytes, the starts of repeated strings as runs."""
    found = written(all_contexts(docs), "suffix-contexts")
    starts = repeated_starts(found).where(F.size("runs") > 0)
    return (found.select(*KEY, "g", "c", "first").join(starts, ["g", "c"])
            .select(*KEY, F.transform("runs", lambda r: F.struct((r.a + F.col("first")).alias("a"), (r.b + F.col("first")).alias("b"))).alias("r"))
            .groupBy(*KEY).agg(F.flatten(F.collect_list("r")).alias("spans")))


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left, the bytes removed and the number of maximal removed runs."""
    kept, at, removed, n = [], 0, 0, 0
    for a, b in sorted(spans):
        b += SPAN - 1
        if a > at or not n:
            kept.append(data[at:a])
            n += 1
            removed += b - a
        else:
            removed += max(0, b - at)
        at = max(at, b)
    kept.append(data[at:])
    return b"".join(kept), removed, n


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [(t or "").encode() for t in part.column(1).to_pylist()]
                made = [cut(t, [(x["a"], x["b"]) for x in s or ()]) for t, s in zip(texts, part.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([m[1] for m in made], pa.int64()),
                     pa.array([m[2] for m in made], pa.int64()), pa.array([m[0] for m in made], pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    spans = written(removals(docs), "suffix-spans")
    joined = keyed(docs.select("doc_id", "text")).join(spans, KEY, "left")
    ids = F.when(F.col("_id") == F.lit(-(2 ** 63)), F.lit(None)).otherwise(F.col("_id"))
    return joined.select(ids.alias("doc_id"), "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
