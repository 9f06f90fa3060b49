"""Operator 9, quality classifier: histogram gradient-boosted trees over document statistics.

Every text becomes one row of statistics (lengths, character classes, repetition, compression).  The
trees are grown level by level from histograms of binned statistics with the logistic loss, and are
kept as flat arrays (feature, threshold, leaf value of a complete binary tree), so that scoring walks
all rows of a batch through a tree with a few numpy gathers per level.

The labelled sample the trees are fitted on is bounded (TRAIN_ROWS rows, the smallest hashes of the
ids); statistics are computed by Spark on whole texts, and only they reach the driver.

Defined results: null and empty texts have all statistics 0 and are scored like any other row; rows with a
null label, and ids with contradicting labels, are not learned from; without usable labels every
score is 0.5; repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import crc_col, crc_of, map_rows, table

TRAIN_ROWS = 20_000            # labelled rows the trees are fitted on
TREES, DEPTH, BINS = 120, 4, 64
RATE, LEAF_PENALTY, LEAST_HESSIAN = 0.15, 2.0, 2.0
THRESHOLD = 0.5
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
N_STATISTICS = 29

_CLASS = np.zeros(256, np.int64)           # of a byte: 0 other punctuation, 1 lower, 2 upper, 3 digit, 4 blank, 5 beyond
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_MARKS = [ord(c) for c in "#*$%&|<>!.,?:;"]


def statistics(text: str | None, z: zstandard.ZstdCompressor) -> list[float]:
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * N_STATISTICS
    size = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, counts, 6) / size
    share = counts[counts > 0] / size
    lines = [x for x in data.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    kinds = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    same = sum(map(bytes.__eq__, words, words[1:]))
    marks = counts[_MARKS] / n
    return [n, np.log1p(size), *classes, -(share * np.log2(share)).sum(), share.max(), kinds / n, pairs / max(1, n - 1),
            same / n, len(lines), n / len(lines), 1 - len(set(lines)) / len(lines), lengths.mean(), lengths.std(),
            lengths.max(), len(z.compress(data)) / size, marks[:6].sum(), marks[5], marks[8], marks[9], marks[10],
            marks[11:].sum(), float((lengths <= 3).mean()), counts[45] / n,
            sum(x[-1:].isalnum() for x in lines) / len(lines)]


class Trees:
    """Boosted complete binary trees as flat arrays; row t of each array is tree t."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> None:
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - (2 ** DEPTH - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Fits the trees.  Each level takes one histogram of gradients over (node, statistic, bin)."""
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(rate / (1 - rate)))
    if len(y) == 0 or y.min() == y.max():
        none = np.zeros((0, inner))
        return Trees(base, none.astype(np.int64), none, np.zeros((0, leaves)))
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    margin = np.full(n, base)
    features, thresholds, values = [], [], []
    slot = np.arange(width) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)                       # within the level
        for level in range(DEPTH):
            nodes = 2 ** level
            cell = (node[:, None] * (width * BINS) + slot + binned).ravel()
            shape = (nodes, width, BINS)
            gs = np.bincount(cell, np.repeat(g, width), nodes * width * BINS).reshape(shape).cumsum(2)
            hs = np.bincount(cell, np.repeat(h, width), nodes * width * BINS).reshape(shape).cumsum(2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs ** 2 / (hs + LEAF_PENALTY) + (gt - gs) ** 2 / (ht - hs + LEAF_PENALTY) - gt ** 2 / (ht + LEAF_PENALTY)
            gain[(hs < LEAST_HESSIAN) | (ht - hs < LEAST_HESSIAN)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            right = np.zeros(n, bool)
            for k in range(nodes):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                    feature[nodes - 1 + k], threshold[nodes - 1 + k] = f, cuts[f][b]
                    here = node == k
                    right[here] = binned[here, f] > b
            node = 2 * node + right
        value = -RATE * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + LEAF_PENALTY)
        margin += value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


def clean_labels(labels: DataFrame, column: str, learn) -> DataFrame:
    """doc_id, label: one row for each id that may be learned from and whose labels agree."""
    return (labels.where(learn & F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
            .groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("_most"))
            .where(F.col("label") == F.col("_most")).select("doc_id", F.col("label").cast("int")))


def bounded_sample(learn: DataFrame, size: int, most: int) -> DataFrame:
    """At most ``most`` of the ``size`` rows of ``learn``: those of smallest hash.  A cut on the hash first leaves
    about that many rows in all, so that no task ever holds more than a small multiple of them."""
    order = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 30))
    share = min(1.0, 1.2 * (most + 100) / max(1, size))
    return learn.where(order <= int(share * (1 << 30))).orderBy(order, "doc_id").limit(most)


def fit(docs: DataFrame, labels: DataFrame) -> Trees:
    learn = clean_labels(labels, "quality", crc_col() % 3 != 1)
    sample = bounded_sample(learn, learn.count(), TRAIN_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))

    def measure(ids: list, labels: list, texts: list) -> dict:
        z = zstandard.ZstdCompressor(level=1)
        return {"doc_id": ids, "label": labels, "x": [[float(v) for v in statistics(t, z)] for t in texts]}

    got = map_rows(rows, measure, ["doc_id", "label", "text"], "doc_id long, label int, x array<double>").toArrow()
    order = np.lexsort((np.array([sum(v) for v in got["x"].to_pylist()]), got["doc_id"].to_numpy())) if got.num_rows else []
    x = np.array(got["x"].to_pylist(), float).reshape(-1, N_STATISTICS)[order]
    return grow(x, got["label"].to_numpy().astype(float)[order])


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def rows(ids: list, texts: list) -> dict:
        z = zstandard.ZstdCompressor(level=1)
        x = np.array([statistics(t, z) for t in texts], float).reshape(-1, N_STATISTICS)
        s = shared.value.score(x)
        return {"doc_id": ids, "held_out": [crc_of(i) % 3 == 1 for i in ids], "score": s.tolist(),
                "predicted": (s >= THRESHOLD).astype(int).tolist()}

    return map_rows(docs, rows, ["doc_id", "text"], SCHEMA)


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
