"""Operator 2, byte-level BPE: encoding with a hierarchical-bitmap rank queue, and decoding.

Every match of the split pattern (a pre-token) starts as a linked list of single bytes.  Each pair
of neighbours that is a token waits in the bucket of its merge rank; a two-level bitmap marks the
buckets that are not empty, so the next rank to merge is found by two find-first-set steps (lowest rank first) however
many ranks there are.  Buckets are heaps of list positions (the leftmost pair of a rank merges first);
merging leaves stale entries behind, which are skipped when they come up.  Work per pre-token
is O(n log n) at worst, so a pre-token of megabytes is no special case.

Defined results: a null text encodes as an empty one (no ids); any string round-trips exactly;
rows are encoded one by one, so repeated rows agree; an empty table gives an empty result; other
columns of the table are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import threading
from array import array
from collections.abc import Iterable
from heapq import heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import map_rows, table

# --- fixed values: white space as the split pattern's \\s has it, and units it never cuts across ---
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u01ba"       # letters all; a run of them that another character of ASCII ends is one match
UNIT = rf" ?[{LETTER}]++(?=[{SPACE}!-/:-@\[-`{{-~]|\Z)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
# -------------------------------------------------------------------------------------------------
PUBLIC_TAIL = r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 8                       # bits of a rank that index a leaf word of the bitmap
LOW = (1 << LEAF) - 1
CACHE_BYTES = 40_000_000       # of a cache generation (two are kept); only speed depends on it
IDLE = 1.5                     # seconds after a partition until an idle worker lets go of its codec
ENTRY = 230                    # bytes of an entry besides its text and ids, roughly
CACHED_LENGTH = 64             # longer pre-tokens are never remembered
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Memory:
    """Cache bounded in bytes, of two generations: a full one becomes the old one, and what is used again moves on."""

    __slots__ = ("limit", "room", "new", "old")

    def __init__(self, limit: int) -> None:
        self.limit = self.room = limit
        self.new, self.old = {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, ids: bytes) -> None:
        if len(key) <= CACHED_LENGTH:
            if self.room <= 0:
                self.new, self.old, self.room = {}, self.new, self.limit
            self.room -= ENTRY + len(key) + len(ids)
            self.new[key] = ids

    def clear(self) -> None:
        self.new, self.old, self.room = {}, {}, self.limit


class Codec:
    """Encoder and decoder over mergeable ranks (bytes of a token -> its rank, which is its id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        # In the public pattern a match is white space, or lies inside one run of other characters with
        # the space before it.  Such units are found by a plain scan and most are known already.
        self.unit = re.compile(UNIT) if pattern.endswith(PUBLIC_TAIL) else None
        # Of units and of matches: a match by itself is a unit of one match.
        self.units = self.pieces = Memory(CACHE_BYTES)
        self.timer: threading.Timer | None = None
        # The queue of a merge.  Every merge leaves it empty, so it is made once: a bucket of list positions for each
        # rank, and the leaf words of the bitmap over the ranks.  Ranks count from the last one here: the lowest rank
        # is the highest bit, which Python finds in one step.
        top_rank = max(ranks.values(), default=0)
        self.turn = {b: top_rank - i for b, i in ranks.items()}
        self.turn_of_two = [[self.turn.get(bytes((a, b))) for b in range(256)] for a in range(256)]
        self.buckets: list[list[int]] = [[] for _ in range(top_rank + 1)]
        self.leaves = [0] * ((top_rank >> LEAF) + 1)
        self.bits = [1 << i for i in range(max(len(self.leaves), 1 << LEAF))]
        self.packed = {b: array("I", [i]).tobytes() for b, i in ranks.items()}
        self.table = np.full(top_rank + 1, None, object)        # the bytes by id, to be taken many at a time
        for i, b in self.bytes_of.items():
            self.table[i] = b

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return cls(ranks, pattern)

    def merge(self, data: bytes) -> bytes:
        """Token ids of one pre-token, packed."""
        whole = self.packed.get(data)
        if whole is not None:
            return whole
        n = len(data)
        get, two, buckets, leaves, bits = self.turn.get, self.turn_of_two, self.buckets, self.leaves, self.bits
        end = list(range(1, n + 1))            # the token at i covers data[i:end[i]]; end[i] is also its next
        before = list(range(-1, n))
        rank_at = [two[a][b] for a, b in zip(data, data[1:], strict=False)]     # of the pair that starts at i
        top = 0                                # the upper level of the bitmap: leaf words that are not empty
        for i, r in enumerate(rank_at):
            if r is not None:
                bucket = buckets[r]
                if not bucket:
                    leaf = r >> LEAF
                    leaves[leaf] |= bits[r & LOW]
                    top |= bits[leaf]
                bucket.append(i)               # positions come in ascending order: a valid heap
        rank_at += (None, None)
        while top:
            leaf = top.bit_length() - 1                      # find the highest bit set, in both levels
            word = leaves[leaf]
            bit = word.bit_length() - 1
            r = leaf << LEAF | bit
            bucket = buckets[r]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket.pop()
                leaves[leaf] = word = word ^ bits[bit]
                if not word:
                    top ^= bits[leaf]
            if rank_at[i] != r:                # stale: the pair has changed or gone
                continue
            j = end[i]                         # merge the token at i with its neighbour at j
            k = end[i] = end[j]
            rank_at[i] = rank_at[j] = None
            before[k] = i
            if k < n:
                rank_at[i] = q = get(data[i:end[k]])
                if q is not None:
                    bucket = buckets[q]
                    if bucket:
                        heappush(bucket, i)
                    else:
                        bucket.append(i)
                        leaf = q >> LEAF
                        leaves[leaf] |= bits[q & LOW]
                        top |= bits[leaf]
            p = before[i]
            if p >= 0:
                rank_at[p] = q = get(data[p:k])
                if q is not None:
                    bucket = buckets[q]
                    if bucket:
                        heappush(bucket, p)
                    else:
                        bucket.append(p)
                        leaf = q >> LEAF
                        leaves[leaf] |= bits[q & LOW]
                        top |= bits[leaf]
        ids, i, packed = [], 0, self.packed
        while i < n:
            k = end[i]
            ids.append(packed[data[i:k]])
            i = k
        return b"".join(ids)

    def encode_unit(self, unit: str) -> bytes:
        """Packed ids of a stretch of text that no match of the pattern crosses."""
        ids = []
        for piece in self.pattern.findall(unit):
            known = self.units.get(piece)
            if known is None:
                known = self.merge(piece.encode())
                self.units.put(piece, known)
            ids.append(known)
        if len(ids) == 1:
            return ids[0]
        known = b"".join(ids)
        if self.unit is not None:
            self.units.put(unit, known)
        return known

    def encode_packed(self, text: str) -> bytes:
        """Ids of a text as machine integers of 32 bits: each match of the pattern is encoded separately."""
        if self.unit is None:
            return self.encode_unit(text)
        units = self.unit.findall(text)
        found = list(map(self.units.new.get, units))
        if None in found:
            for i, known in enumerate(found):
                if known is None:
                    known = self.units.get(units[i])
                    found[i] = self.encode_unit(units[i]) if known is None else known
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return array("I", self.encode_packed(text)).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_packed(self, packed: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        return b"".join(self.table[np.frombuffer(packed, np.uint32)].tolist())

    def rest(self) -> None:
        """To be called at the end of a partition: tables and caches serve the worker's next partition, and are freed if none
        comes within ``IDLE`` seconds, since the process may go on with other work."""
        if self.timer:
            self.timer.cancel()
        self.timer = threading.Timer(IDLE, self.forget)
        self.timer.daemon = True
        self.timer.start()

    def forget(self) -> None:
        self.units.clear()
        for key in [k for k, c in _codecs.items() if c is self]:
            _codecs.pop(key, None)


def little_endian(packed: bytes) -> bytes:
    """Packed ids as unsigned 32-bit integers, low byte first."""
    if sys.byteorder == "little":
        return packed
    swapped = array("I", packed)
    swapped.byteswap()
    return swapped.tobytes()


_codecs: dict[tuple, Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, loaded once per worker process, and again after it was idle."""
    found = _codecs.get((path, pattern))
    if found is None:
        found = _codecs[path, pattern] = Codec.load(path, pattern)
    if found.timer:
        found.timer.cancel()
        found.timer = None
    return found


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids: the token ids of every text."""
    def rows(ids: list, texts: list) -> dict:
        c = codec(path, pattern)
        return {"doc_id": ids, "ids": [c.encode(t or "") for t in texts]}
    return map_rows(docs, rows, ["doc_id", "text"], "doc_id long, ids array<int>", lambda: codec(path, pattern).rest())


def bpe_decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data: the bytes that the ids stand for."""
    def rows(ids: list, tokens: list) -> dict:
        c = codec(path, pattern)
        return {"doc_id": ids, "data": [c.decode(t or ()) for t in tokens]}
    return map_rows(encoded, rows, ["doc_id", "ids"], "doc_id long, data binary")


def bpe_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every text, decode the ids, and return counts and digests of both."""
    def rows(doc_ids: list, texts: list) -> dict:
        c = codec(path, pattern)
        out = {"doc_id": doc_ids, "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for t in texts:
            packed = c.encode_packed(t or "")
            out["n_tokens"].append(len(packed) // 4)
            out["ids_sha256"].append(hashlib.sha256(little_endian(packed)).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(c.decode_packed(packed)).hexdigest())
        return out
    return map_rows(docs, rows, ["doc_id", "text"], SCHEMA, lambda: codec(path, pattern).rest())


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents"), *default_vocabulary())
