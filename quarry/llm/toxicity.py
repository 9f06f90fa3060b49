"""Operator 4, toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max index.

Terms are all words, and beginnings of words, of the indexed examples, known by 64-bit hashes.  Texts are TF-IDF
vectors over these terms, with document frequencies over all documents, and each term weighted by how far and how
surely its document counts under the two labels differ; no weight is zero.  Labelled examples form an inverted
index in blocks of like examples.  Rare terms are added up from their postings; common ones have their largest weight in
each block, and both together bound a block's cosines.  A query completes its blocks of highest bounds first, then all
blocks whose bound reaches the nearest found, so the nearest ones are exact and other blocks are not read.  Their votes
are weighted by cosine and shrunk to the base rate, and isotonic regression on other labelled rows turns votes into
probabilities.  The nearest examples are returned as evidence.

The classifier is fitted on a bounded sample of labelled rows: LABELLED rows of each label (the smallest hashes of
their ids) weight the terms, and of these rows EXAMPLES are indexed and CALIBRATION calibrate.  The terms of the sample
are written as a table; the driver reads those of the examples one partition at a time, and tasks take the votes of the others.

Defined results: null and empty texts, and texts without a term, have no neighbours and get the
calibrated score of no vote; rows with a null label and ids with contradicting labels are not learned
from; without usable labels the score is 0; equal cosines keep the example that comes first in
block order; repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import batched
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import crc_col, crc_of, map_rows, table, written
from quarry.llm.decontaminate import WORD_BYTES
from quarry.llm.quality_model import bounded_sample, clean_labels

LABELLED = 20_000              # of each label, to weight terms by
EXAMPLES = 4000                # of each label, in the index
CALIBRATION = 2000             # of each label, for the calibration
BEGINNINGS = (4, 5, 6, 7)       # bytes of a word's beginnings that are terms too
LIFT, SIGNIFICANCE = 8.0, 15.0  # ratio of a term's rates that has full weight, G of its counts that has half
LEAST_WEIGHT = 0.01            # weight of a term that tells nothing about the labels
NEAREST, BLOCK = 15, 64
FIRST, SHARE = 4, 8            # blocks completed for each query (or one in SHARE) before the others are held against what they gave
COMMON = 32                    # a term in more than one of so many examples is kept in the matrix
QUERIES, POSTINGS = 512, 1 << 18  # texts that are searched for together, and postings that are read at once
FOLDED = 256                   # dimensions by which like examples are found
TERMS = 1 << 17                # terms that the driver weights together
PIECE = 1 << 20                # bytes of text that are split into words together
TEXTS = 512                    # texts of the sample that are read together; whole batches of queries
SHRINK = 0.5                   # weight of the base rate among the votes
THRESHOLD = 0.3
SCHEMA = ("doc_id long, held_out boolean, score double, predicted int, "
          "evidence array<struct<doc_id:long,cosine:double,label:int>>")

_BYTES = np.frombuffer(bytes(0 if c == 32 else c for c in WORD_BYTES), np.uint8)    # 0 where no word is
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def piece_terms(data: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """First bytes of the words; and for whole words and each length of beginnings: which words have one, and hashes."""
    held = np.flatnonzero(data)
    edge = np.flatnonzero(np.diff(held, prepend=-2) > 1)
    sizes = np.diff(np.append(edge, len(held)))
    if not len(edge):
        return edge, [], []
    place = np.arange(len(held)) - np.repeat(edge, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), _BASE, np.uint64))
    values = data[held].astype(np.uint64) * powers[place]
    which, hashes = [np.arange(len(edge))], [mixed(np.add.reduceat(values, edge))]
    for k in BEGINNINGS:
        longer = np.flatnonzero(sizes > k)
        part = values[edge[longer][:, None] + np.arange(k)].sum(axis=1, dtype=np.uint64)
        which.append(longer)
        hashes.append(mixed(part + np.uint64(k)))
    return held[edge], which, hashes


def text_terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The number of the text and the hash of every term of the texts, repeats included."""
    coded = [(t or "").encode() for t in texts]
    ends = np.cumsum([len(c) + 1 for c in coded])
    data = _BYTES[np.frombuffer(b" ".join(coded) + b" ", np.uint8)] if coded else np.zeros(0, np.uint8)
    owners, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        to = min(len(data), at + PIECE)
        while to < len(data) and data[to]:      # a piece ends where no word is
            to += 1
        first, which, found = piece_terms(data[at:to])
        owner = np.searchsorted(ends, first + at, "right")
        owners += [owner[w] for w in which]
        hashes += found
        at = to
    return np.concatenate(owners), np.concatenate(hashes)


class Counts:
    """Terms of texts in rows: text ``i`` holds ``terms[starts[i]:starts[i + 1]]``, ascending, so many times each."""

    def __init__(self, n: int, owner: np.ndarray, terms: np.ndarray, times: np.ndarray | None = None) -> None:
        key = (owner.astype(np.int64) << 32) | terms
        if times is None:
            key = np.sort(key)
            new = np.flatnonzero(np.diff(key, prepend=-1))
            key, self.times = key[new], np.diff(np.append(new, len(key)))
        else:       # of distinct terms
            order = np.argsort(key)
            key, self.times = key[order], times[order]
        self.n, self.owner, self.terms = n, key >> 32, key & 0xFFFFFFFF

    @classmethod
    def joined(cls, parts: Iterator[Counts], most: int) -> Counts:
        """The texts of all parts, one part after another, with ``most`` terms at most; a part is dropped once it is copied."""
        out, at = cls(0, np.zeros(0, np.int32), np.zeros(0, np.int32)), 0
        owner, terms, times = (np.empty(most, np.int32) for _ in range(3))
        for part in parts:
            to = at + len(part.terms)
            owner[at:to], terms[at:to], times[at:to] = part.owner + out.n, part.terms, part.times
            out.n, at = out.n + part.n, to
        out.owner, out.terms, out.times = owner[:at], terms[:at], times[:at]
        return out

    def slices(self, size: int) -> Iterator[Counts]:
        """The texts, so many at a time."""
        for at in range(0, self.n, size):
            part = Counts.__new__(Counts)
            a, b = np.searchsorted(self.owner, np.array([at, at + size], self.owner.dtype))
            part.n, part.owner = min(size, self.n - at), self.owner[a:b] - at
            part.terms, part.times = self.terms[a:b], self.times[a:b]
            yield part


class Vocabulary:
    """Numbers of terms by their hashes: the place in ascending order, found by the leading bits."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.__setstate__(np.unique(hashes))

    def __getstate__(self) -> np.ndarray:
        return self.hashes

    def __setstate__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        bits = np.uint64(max(8, min(22, len(self.hashes).bit_length() + 1)))
        self.shift = np.uint64(64) - bits
        self.first = np.searchsorted(self.hashes >> self.shift, np.arange((1 << int(bits)) + 1, dtype=np.uint64)).astype(np.int32)
        self.most = int(np.diff(self.first).max())

    def __len__(self) -> int:
        return len(self.hashes)

    def counts(self, n: int, owner: np.ndarray, hashes: np.ndarray, times: np.ndarray | None = None) -> Counts:
        """The known terms of ``n`` texts; with ``times`` each is given once."""
        slot = hashes >> self.shift
        at, end = self.first[slot], self.first[slot + np.uint64(1)]
        term, left = np.full(len(hashes), -1, np.int32), np.arange(len(hashes))
        for step in range(self.most):
            left = left[at[left] + step < end[left]]
            same = self.hashes[at[left] + step] == hashes[left]
            term[left[same]] = at[left[same]] + step
            left = left[~same]
        known = term >= 0
        return Counts(n, owner[known], term[known], None if times is None else times[known])

    def of(self, texts: list[str | None]) -> Counts:
        return self.counts(len(texts), *text_terms(texts))


def distinct(lists: list[np.ndarray]) -> np.ndarray:
    """The distinct hashes of all lists; some lists at a time, which bounds what is held beside the result."""
    found = np.zeros(0, np.uint64)
    for at in range(0, len(lists), TEXTS):
        found = np.unique(np.concatenate([found, *lists[at:at + TEXTS]]))
    return found


def tally(numbers: np.ndarray, n: int) -> np.ndarray:
    """How often each number below ``n`` is there; bincount makes a copy in 64 bits, so some are counted at a time."""
    out = np.zeros(n, np.int64)
    for at in range(0, len(numbers), POSTINGS):
        out += np.bincount(numbers[at:at + POSTINGS], minlength=n)
    return out


def parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that have about PIECE characters together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= PIECE:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def alike(rows: np.ndarray) -> np.ndarray:
    """An order of rows in which every BLOCK of them are alike: they are halved, at multiples of BLOCK, along the
    direction in which they differ most, over and over."""
    order, todo = np.arange(len(rows)), [(0, len(rows))]
    while todo:
        a, b = todo.pop()
        if b - a <= BLOCK:
            continue
        own = rows[order[a:b]]
        own = own - own.mean(axis=0)
        along = own[np.argmax((own * own).sum(axis=1))]
        for _ in range(8):
            along = (own @ along) @ own
            along /= max(1e-30, float(np.sqrt(along @ along)))
        order[a:b] = order[a:b][np.argsort(own @ along, kind="stable")]
        middle = a + BLOCK * max(1, (b - a) // (2 * BLOCK))
        todo += [(a, middle), (middle, b)]
    return order


def folded(n: int, owner: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The vectors in FOLDED dimensions, in which terms add up or cancel by a hash: enough to tell which are alike."""
    out = np.zeros(n * FOLDED, np.float32)
    for at in range(0, len(terms), POSTINGS):
        part = slice(at, at + POSTINGS)
        h = mixed(terms[part].astype(np.uint64) * _BASE + np.uint64(1))
        to = owner[part].astype(np.int64) * FOLDED + (h % np.uint64(FOLDED)).astype(np.int64)
        np.add.at(out, to, np.where(h >> np.uint64(63), weights[part], -weights[part]).astype(np.float32))
    return out.reshape(n, FOLDED)


class BlockMaxIndex:
    """Unit vectors of the examples in blocks: postings of rare terms; of common terms the weights in each block that holds
    them, and the largest of these."""

    def __init__(self, n: int, owner: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int) -> None:
        self.n, self.n_blocks = n, -(-n // BLOCK)
        count = tally(terms, n_terms)
        common = np.flatnonzero(count * COMMON > n)
        self.columns(common, n_terms)
        # Like examples share a block, which tightens its bounds.
        self.example = alike(folded(n, owner, terms, weights))      # of each place
        starts = np.searchsorted(owner, np.arange(n + 1, dtype=owner.dtype))     # of another type it would copy the owners
        held = np.zeros(n + 1, np.int64)        # common terms of the places before
        count[common] = 0
        self.posting = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        for place, i in enumerate(self.example):
            held[place + 1] = held[place] + np.count_nonzero(self.column[terms[starts[i]:starts[i + 1]]] >= 0)
        self.ends = held[np.minimum(n, np.arange(self.n_blocks + 1) * BLOCK)]
        self.common = np.empty(held[-1], np.int32), np.empty(held[-1], np.float32)
        self.places = np.empty(self.posting[-1], np.uint16 if n <= 1 << 16 else np.int32)
        self.weights = np.empty(self.posting[-1], np.float32)
        self.block_max = None
        # The terms are dealt out example by example, by ascending places: nothing of the postings' length is sorted.
        free = self.posting[:-1].copy()
        for place, i in enumerate(self.example):
            own, weight = terms[starts[i]:starts[i + 1]], weights[starts[i]:starts[i + 1]]
            column = self.column[own]
            dense = column >= 0
            part = slice(held[place], held[place + 1])
            self.common[0][part], self.common[1][part] = place % BLOCK * self.n_columns + column[dense], weight[dense]
            own = own[~dense]
            to = free[own]
            self.places[to], self.weights[to] = place, weight[~dense]
            free[own] += 1
        self.read = self.blocks = 0             # blocks completed, and blocks bounded

    def columns(self, common: np.ndarray, n_terms: int) -> None:
        """The column of each common term, by its number; -1 for rare ones."""
        self.column = np.full(n_terms, -1, np.int32)
        self.column[common] = np.arange(len(common))
        self.n_columns = len(common)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"block_max": None, "column": np.flatnonzero(self.column >= 0)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.columns(state["column"], len(self.posting) - 1)

    def block(self, b: int) -> np.ndarray:
        """The weights of the common terms in the examples of a block, as a matrix."""
        cells, weights = (x[self.ends[b]:self.ends[b + 1]] for x in self.common)
        matrix = np.zeros(BLOCK * self.n_columns, np.float32)
        matrix[cells] = weights
        return matrix.reshape(BLOCK, -1)

    def unfold(self) -> None:
        """The largest weight of each common term in each block; done where the index is used."""
        self.block_max = np.zeros((self.n_columns, self.n_blocks), np.float32)
        for b in range(self.n_blocks):
            self.block_max[:, b] = self.block(b).max(axis=0, initial=0)

    def nearest(self, n: int, owner: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of ``n`` queries (rows in order) the k largest positive cosines and their examples, the first place first
        among equal ones."""
        if self.block_max is None:
            self.unfold()
        column, out = self.column[terms], []
        for at in range(0, n, QUERIES):
            to = min(n, at + QUERIES)
            a, b = np.searchsorted(owner, [at, to])
            out += self._nearest(to - at, owner[a:b] - at, terms[a:b], weights[a:b], column[a:b], k)
        return out

    def rare(self, n: int, owner: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The sums of the rare terms: a row for each query, a column for each place."""
        width, first = self.n_blocks * BLOCK, self.posting[terms].astype(np.int64)
        out, sizes = np.zeros((n, width)), self.posting[terms + 1] - self.posting[terms]
        read = np.cumsum(np.bincount(owner, sizes, n))
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(read, (read[at - 1] if at else 0) + POSTINGS, "right")))
            a, b = np.searchsorted(owner, [at, to])
            own, places = sizes[a:b], ranges(first[a:b], sizes[a:b])
            cells = np.repeat((owner[a:b] - at) * width, own) + self.places[places]
            out[at:to] = np.bincount(cells, np.repeat(weights[a:b], own) * self.weights[places], (to - at) * width).reshape(to - at, width)
            at = to
        return out

    def _nearest(self, n: int, owner: np.ndarray, terms: np.ndarray, weights: np.ndarray, column: np.ndarray,
                 k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if not self.n or not len(owner):
            return [(np.zeros(0), np.zeros(0, np.int64))] * n
        dense = np.zeros((n, len(self.block_max)), np.float32)
        dense[owner[column >= 0], column[column >= 0]] = weights[column >= 0]
        # Rare terms are in few examples of a block: their sums are exact and bound a block better than their maxima.
        cosine = self.rare(n, owner[column < 0], terms[column < 0], weights[column < 0]).reshape(n, self.n_blocks, BLOCK)
        bound = (cosine.max(axis=2) + dense @ self.block_max) * (1 + 1e-5)
        done = bound <= 0

        def complete(wanted: np.ndarray) -> None:
            # A block is multiplied with the queries that ask for it.
            for block in np.flatnonzero(wanted.any(axis=0)):
                asked = np.flatnonzero(wanted[:, block])
                cosine[asked, block] += dense.take(asked, 0) @ self.block(block).T
            done[wanted] = True
            self.read += int(wanted.sum())

        n_first = max(FIRST, self.n_blocks // SHARE)
        first = (np.argpartition(bound, -n_first, axis=1)[:, -n_first:] if self.n_blocks > n_first
                 else np.tile(np.arange(self.n_blocks), (n, 1)))
        wanted = np.zeros_like(done)
        np.put_along_axis(wanted, first, True, axis=1)
        complete(wanted & ~done)
        found = np.take_along_axis(cosine, first[:, :, None], axis=1).reshape(n, -1)
        # The k-th largest cosine is no smaller than the k-th largest of the first blocks.
        least = np.maximum(0.0, np.partition(found, -k, axis=1)[:, -k]) if found.shape[1] > k else np.zeros(n)
        complete(~done & (bound >= least[:, None]))
        cosine[~done] = 0.0
        cosine = cosine.reshape(n, -1)
        self.blocks += bound.size
        out = []
        for row, enough in zip(cosine, least, strict=True):
            some = np.flatnonzero((row >= enough) & (row > 0))
            some = some[np.argsort(-row[some], kind="stable")][:k]
            out.append((np.minimum(1.0, row[some]), self.example[some]))
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: the points (upper end of a pool, its mean) of a rising step function."""
    pools: list[list[float]] = []
    for v in np.unique(x):
        here = y[x == v]
        pools.append([float(here.sum()), float(len(here)), float(v)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, top = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, top]
    return np.array([p[2] for p in pools]), np.array([p[0] / p[1] for p in pools])


class Model:
    """Terms with their weights, the index, and the labels and ids of its examples."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray, ids: list, labels: np.ndarray, base: float,
                 rows: Iterable[tuple[int, int, np.ndarray, np.ndarray]], sizes: np.ndarray) -> None:
        """``rows``: place, label, and the hashes of the terms and their counts, of the examples, in any order; ``sizes``: of
        each place the number of terms."""
        self.vocabulary, self.weights, self.ids, self.labels, self.base = vocabulary, weights, ids, labels, base
        ends = np.cumsum(sizes, dtype=np.int64)
        terms, vectors = (np.empty(int(sizes.sum()), kind) for kind in (np.int32, np.float32))
        for some in batched(rows, TEXTS):
            part = counted(some, vocabulary)
            to = ranges(*(x[[r[0] for r in some]] for x in (ends - sizes, sizes)))
            terms[to], vectors[to] = part.terms, self.vectors(part)
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.index = BlockMaxIndex(len(sizes), owner, terms, vectors, len(weights))

    def vectors(self, texts: Counts) -> np.ndarray:
        """The weights of the texts' terms; each text's vector has length 1."""
        raw = (1 + np.log(texts.times)) * self.weights[texts.terms]
        return raw if not len(raw) else raw / np.sqrt(np.bincount(texts.owner, raw * raw, texts.n))[texts.owner]

    def neighbours(self, texts: Counts) -> list[tuple[np.ndarray, np.ndarray]]:
        return self.index.nearest(texts.n, texts.owner, texts.terms, self.vectors(texts), NEAREST)

    def vote(self, cosines: np.ndarray, examples: np.ndarray) -> float:
        return (float(cosines @ self.labels[examples]) + SHRINK * self.base) / (float(cosines.sum()) + SHRINK)

    def votes(self, texts: Counts) -> list[tuple[float, list[tuple]]]:
        """The vote of each text, and its nearest examples."""
        return [(self.vote(c, e), [(self.ids[i], float(x), int(self.labels[i])) for x, i in zip(c[:3], e[:3], strict=True)])
                for c, e in self.neighbours(texts)]


class Calibration:
    """Probabilities of votes, by the votes and labels of rows that are not indexed."""

    def __init__(self, votes: np.ndarray, labels: np.ndarray, base: float) -> None:
        self.at = self.rate = None
        if len(votes):
            # The sample is balanced; weights bring back the base rate of the labels.
            weight = np.where(labels == 1, base / max(1e-9, labels.mean()), (1 - base) / max(1e-9, 1 - labels.mean()))
            self.at, balanced = isotonic(votes, labels)
            ones, zeros = balanced * weight[labels == 1].max(initial=0), (1 - balanced) * weight[labels == 0].max(initial=0)
            self.rate = ones / np.maximum(1e-12, ones + zeros)

    def score(self, vote: float) -> float:
        return vote if self.at is None else float(np.interp(vote, self.at, self.rate))


class Fitted:
    """What the driver keeps of a fit: the ids of the examples, the calibration, and the model where the tasks find it."""

    def __init__(self, ids: list, shared: Broadcast, calibration: Calibration) -> None:
        self.ids, self.shared, self.calibration = ids, shared, calibration


def term_weights(counts: dict[int, np.ndarray], zeros: int, ones: int) -> np.ndarray:
    """The weight of each term: how far its rates under the two labels differ, times how sure that is."""
    n = len(counts[1]) - 1
    out = np.empty(n)
    for at in range(0, n, TERMS):       # some terms at a time: the driver holds no other array of the vocabulary's length
        to = min(n, at + TERMS)
        out[at:to] = _part_weights(counts[1][at:to].astype(float), counts[0][at:to].astype(float), zeros, ones)
    return out


def _part_weights(a: np.ndarray, b: np.ndarray, zeros: int, ones: int) -> np.ndarray:
    both, total = a + b, zeros + ones
    part = lambda o, e: np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(e, 1e-9)), 0.0)
    g = np.maximum(0.0, 2 * (part(a, both * ones / total) + part(b, both * zeros / total)))
    lift = np.abs(np.log(((a + 0.5) / (ones + 1)) / ((b + 0.5) / (zeros + 1))))
    return LEAST_WEIGHT + g / (g + SIGNIFICANCE) * np.minimum(1.0, lift / np.log(LIFT))


def term_counts(docs: DataFrame, shared: Broadcast) -> dict[int, np.ndarray]:
    """For each label (-1: not sampled) the documents that hold each term, by its number, and last the number of all
    documents.  One pass over the texts; at most the vocabulary leaves a task for each label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            texts, labels = batch.column(1).to_pylist(), np.array(batch.column(0).to_pylist(), np.int64)
            for a, b in parts(texts):
                held = vocabulary.of(texts[a:b])
                for label in np.unique(labels[a:b]):
                    own = labels[a:b] == label
                    n = seen.setdefault(int(label), np.zeros(len(vocabulary) + 1, np.int64))
                    n += np.bincount(held.terms[own[held.owner]], minlength=len(n))
                    n[-1] += own.sum()
        for label, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), label, np.int32)), pa.array(at.astype(np.int32)),
                                              pa.array(n[at])], names=["label", "term", "n"])

    counted = (docs.select(F.col("label").cast("int"), "text").mapInArrow(run, "label int, term int, n long")
               .groupBy("term").agg(*[F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (-1, 0, 1)])
               .select("term", "n-1", F.col("n0").cast("int"), F.col("n1").cast("int"))     # of the sample, which is bounded
               .toArrow())
    out = {k: np.zeros(len(shared.value) + 1, np.int64 if k < 0 else np.int32) for k in (-1, 0, 1)}
    for batch in counted.to_batches():
        for at, k in enumerate(out, 1):
            out[k][batch.column(0).to_numpy()] = batch.column(at).to_numpy()
    return out


def sampled_terms(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, label, the hashes of the terms and their counts (as bytes), the number of terms and checksums of both, and a
    number of its own for each of the sampled documents; written, as it is read several times."""
    def terms(ids: list, labels: list, texts: list) -> dict:
        found = [np.unique(text_terms([t])[1], return_counts=True) for t in texts]
        hashes, times = [h.tobytes() for h, _ in found], [n.astype(np.int32).tobytes() for _, n in found]
        return {"doc_id": ids, "label": labels, "hashes": hashes, "times": times, "n": [len(h) for h, _ in found],
                "h": [crc32(h) for h in hashes], "t": [crc32(n) for n in times]}

    picked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).drop("_id")
    found = map_rows(picked, terms, ["doc_id", "label", "text"],
                     "doc_id long, label int, hashes binary, times binary, n long, h long, t long")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "toxicity-terms")


def placed(terms: DataFrame, rows: list[dict]) -> DataFrame:
    """place, label, hashes, times of the given rows of the sample; a place is a number in the given order."""
    places = pa.table({"row": pa.array([r["row"] for r in rows], pa.int64()), "place": pa.array(range(len(rows)), pa.int32())})
    return (terms.join(F.broadcast(terms.sparkSession.createDataFrame(places)), "row")
            .select("place", "label", "hashes", "times"))


def unpacked(places: Iterable[int], labels: Iterable[int], hashes: Iterable[bytes],
             times: Iterable[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for i, y, h, n in zip(places, labels, hashes, times, strict=True):
        yield i, y, np.frombuffer(h, np.uint64), np.frombuffer(n, np.int32)


def known_terms(examples: DataFrame) -> Vocabulary:
    """The distinct terms of the examples: only these come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = distinct([np.frombuffer(h, np.uint64) for h in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["hash"])

    got = examples.select("hashes").mapInArrow(run, "hash long").distinct().toArrow()
    return Vocabulary(got.column(0).to_numpy().view(np.uint64))


def counted(rows: Iterable[tuple[int, int, np.ndarray, np.ndarray]], vocabulary: Vocabulary) -> Counts:
    """Rows in the order given; some at a time, which bounds what is held beside the result."""
    def made() -> Iterator[Counts]:
        for at in range(0, len(rows), TEXTS):
            part = rows[at:at + TEXTS]
            owner = np.repeat(np.arange(len(part), dtype=np.int32), [len(r[2]) for r in part])
            yield vocabulary.counts(len(part), owner, np.concatenate([r[2] for r in part]), np.concatenate([r[3] for r in part]))

    return Counts.joined(made(), sum(len(r[2]) for r in rows))


def votes(calibration: DataFrame, shared: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """The votes for the rows that calibrate, taken in tasks, and their labels."""
    def run(*columns: list) -> dict:
        held = counted([*unpacked(*columns)], shared.value.vocabulary)
        return {"label": columns[1], "vote": [v for part in held.slices(TEXTS) for v, _ in shared.value.votes(part)]}

    got = map_rows(calibration, run, ["place", "label", "hashes", "times"], "label int, vote double").toArrow()
    return got.column(1).to_numpy(), got.column(0).to_numpy().astype(float)


def fit(docs: DataFrame, labels: DataFrame) -> Fitted:
    context = docs.sparkSession.sparkContext
    learn = clean_labels(labels, "toxic", crc_col() % 4 != 2)
    sizes = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        none = np.zeros(0, np.int64)
        model = Model(Vocabulary(np.zeros(0, np.uint64)), np.zeros(0), [], np.zeros(0), 0.0, [], none)
        return Fitted([], context.broadcast(model), Calibration(none, none, 0.0))

    def sample(n: int) -> DataFrame:
        part = {k: bounded_sample(learn.where(F.col("label") == k), sizes[k], n) for k in (0, 1)}
        return part[0].unionByName(part[1]).withColumnRenamed("doc_id", "_id")

    # A third of the sample, by another hash of the id, calibrates; the rest is indexed.
    terms = sampled_terms(docs, sample(EXAMPLES + CALIBRATION))
    got = sorted(terms.select("row", "doc_id", "label", "n", "h", "t").toArrow().to_pylist(),
                 key=lambda r: (crc_of(f"{r['doc_id']}:"), r["doc_id"], r["n"], r["h"], r["t"]))
    share = CALIBRATION / (EXAMPLES + CALIBRATION)
    judged, kept = [], []
    for label in (0, 1):
        own = [r for r in got if r["label"] == label]
        cut = int(len(own) * share)
        judged += own[:cut]
        kept += own[cut:]
    examples = placed(terms, kept)
    vocabulary = known_terms(examples)
    shared = context.broadcast(vocabulary)
    marked = (docs.select("doc_id", "text").join(F.broadcast(sample(LABELLED)), F.col("doc_id") == F.col("_id"), "left")
              .select(F.coalesce("label", F.lit(-1)).alias("label"), "text"))
    counts = term_counts(marked, shared)
    shared.destroy()        # the model brings the terms again
    pa.default_memory_pool().release_unused()
    weights = term_weights(counts, min(LABELLED, sizes[0]), min(LABELLED, sizes[1]))
    df = counts[-1]
    df += counts[0]
    df += counts[1]
    for at in range(0, len(weights), TERMS):
        to = min(len(weights), at + TERMS)
        weights[at:to] *= np.log(1 + df[-1] / np.maximum(1, df[at:to]))
    del counts, df
    ids, labelled = [r["doc_id"] for r in kept], np.array([r["label"] for r in kept], float)
    base = sizes[1] / (sizes[0] + sizes[1])
    rows = (r for x in examples.toLocalIterator() for r in unpacked(*([v] for v in x)))
    shared = context.broadcast(Model(vocabulary, weights, ids, labelled, base, rows, np.array([r["n"] for r in kept], np.int64)))
    del vocabulary, weights, rows
    return Fitted(ids, shared, Calibration(*votes(placed(terms, judged), shared), base))


def score(docs: DataFrame, fitted: Fitted) -> DataFrame:
    shared, calibration = fitted.shared, fitted.calibration

    def rows(ids: list, texts: list) -> dict:
        model = shared.value
        made = [x for a, b in parts(texts) for x in model.votes(model.vocabulary.of(texts[a:b]))]
        scores = [calibration.score(v) for v, _ in made]
        return {"doc_id": ids, "held_out": [crc_of(i) % 4 == 2 for i in ids], "score": scores,
                "predicted": [int(x >= THRESHOLD) for x in scores],
                "evidence": [[dict(zip(("doc_id", "cosine", "label"), e, strict=True)) for e in m[1]] for m in made]}

    return map_rows(docs, rows, ["doc_id", "text"], SCHEMA)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
