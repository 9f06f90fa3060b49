"""Conversation structure repair: a secondary-sorted stream that carries its dynamic program across batches.

Rows are repartitioned by conversation and sorted by turn inside partitions; ``mapInPandas`` then reads
one Arrow batch after the other and keeps, for the conversation it is in, four states of a dynamic program
(nothing said yet, system said, user said last, assistant said last).  A state holds its cheapest cost, the
place of its edits among those of the other states (for ties), and the running digest of its repaired
text, so nothing of a conversation is kept but four bytes of backpointers a row; beyond ``SPILL_BYTES`` they go
to an unnamed file of the task, which dies with it (a rerun task starts again from the shuffle).
A conversation of any length is read once, in constant memory but for its own audit string.

Edits bring the roles to ``(s?(ua)+)?``: Keep 0, Rerole 2, Delete 3, Insert 2, and 1 for each truncated row that
stays; blank and duplicate rows must go.  Of equally cheap edits the ASCII-least string wins.

Faults are found by Spark before the stream.  "Seen earlier in the conversation" is a row number within equal
(conversation, role, text), so no set of texts grows in a task; blank rows, which need none, are
dealt over their turns.

Defined results: null roles and texts are one space, null ids and turns count as one space in the hash; null turns come
first; rows of one turn follow role, then text; null ids form one conversation; repeated rows are duplicates; a
conversation without rows has zeros, an empty audit and the digest of nothing; a gap over 2^63-1 is given as that; an
empty table gives an empty one; further columns are not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import table

# States: what the repaired conversation ends with.
START, SYSTEM, USER, ASSISTANT = range(4)
LETTERS = "DKRI"
D, K, R = range(3)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# An inserted turn: the state after it.
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
SPILL_BYTES = 4 << 20
EDIT_ROWS = 50_000
FAULTS = ("", "blank", "duplicate", "truncated")


def _moves(initial: str, must_go: bool, truncated: bool) -> list[tuple[int, int, int, int, int, str]]:
    """(from, to, cost, inserts, letter, edits) of one row: of each pair of states the cheapest, ties least.

    Inserts stand before a Keep or Rerole only: before a Delete they would come later in ASCII for the same price.
    """
    best: dict[tuple[int, int], tuple] = {}
    for p in range(4):
        options = [(p, DELETE, 0, D)]
        q = p
        for inserts in range(0 if must_go else 3):
            extra = INSERT * inserts + TRUNCATED * truncated
            if (initial == "s" and q == START) or (initial == "u" and q != USER) or (initial == "a" and q == USER):
                options.append((SYSTEM if initial == "s" else NEXT[q], extra + KEEP, inserts, K))
            options.append((NEXT[q], extra + REROLE, inserts, R))
            q = NEXT[q]
        for to, cost, inserts, letter in options:
            edits = "I" * inserts + LETTERS[letter]
            if (p, to) not in best or (cost, edits) < best[p, to][:2]:
                best[p, to] = (cost, edits, inserts, letter)
    return [(p, to, c, k, letter, e) for (p, to), (c, e, k, letter) in sorted(best.items())]


MOVES = {(i, go, t): _moves(i, go, t) for i in ("s", "u", "a", "") for go in (False, True) for t in (False, True)}


class Backpointers:
    """Four bytes a row, written to an unnamed file of the task beyond ``SPILL_BYTES``; read from the last row back."""

    def __init__(self) -> None:
        self.tail, self.file, self.spilled = bytearray(), None, 0

    def push(self, row: bytes) -> None:
        self.tail += row
        if len(self.tail) >= SPILL_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.tail)
            self.spilled += len(self.tail)
            self.tail = bytearray()

    def backwards(self) -> Iterator[bytes]:
        for at in range(len(self.tail) - 4, -1, -4):
            yield self.tail[at:at + 4]
        end = self.spilled
        while end:
            start = max(0, end - SPILL_BYTES // 4 * 4)
            self.file.seek(start)
            block = self.file.read(end - start)
            for at in range(len(block) - 4, -1, -4):
                yield block[at:at + 4]
            end = start

    def close(self) -> None:
        if self.file:
            self.file.close()


class Conversation:
    """The dynamic program over the rows of one conversation, fed in turn order."""

    def __init__(self, key) -> None:
        self.key = key
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.rows = self.turns = 0
        self.low = self.high = self.before = None
        # Per state: cost (None: not reached), place among the states' edits as (rank, short rest), digest.
        self.cost: list = [0, None, None, None]
        self.place: list = [(0, ""), None, None, None]
        self.sha: list = [hashlib.sha256(), None, None, None]
        self.back = Backpointers()

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        self.rows += 1
        if fault:
            self.counts[fault] += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        must_go = fault in ("blank", "duplicate")
        best: list = [None] * 4
        for move in MOVES[initial if initial in ("s", "u", "a") else "", must_go, fault == "truncated"]:
            p, to, cost, _, _, edits = move
            if self.cost[p] is None:
                continue
            total = self.cost[p] + cost
            if best[to] is None or total <= best[to][0]:
                rank, rest = self.place[p]
                found = (total, rank, rest + edits, move)
                if best[to] is None or found[:3] < best[to][:3]:
                    best[to] = found
        self.sha = [b and self._said(b[3], role, text) for b in best]
        self.cost = [b and b[0] for b in best]
        self._rank(best)
        self.back.push(bytes(b[3][0] | b[3][3] << 2 | b[3][4] << 4 if b else 0 for b in best))

    def _said(self, move: tuple, role: str, text: str):
        """Digest of the repaired text after a move."""
        p, to, _, inserts, letter, _ = move
        if letter == D:
            return self.sha[p]
        sha, said, state = self.sha[p].copy(), [], p
        for _ in range(inserts):
            state = NEXT[state]
            said.append(f"{ROLE[state]}:")
        said.append(f"{role if letter == K else ROLE[to]}:{text}")
        sha.update(("\n" * (p != START) + "\n".join(said)).encode())
        return sha

    def _rank(self, best: list) -> None:
        """Orders the states' edits anew.  Strings that part for good get ranks of their own; one that another
        begins with shares its rank, and the other keeps the few letters that follow."""
        order = sorted((b[1], b[2], s) for s, b in enumerate(best) if b)
        self.place = [None] * 4
        rank, base = -1, None
        for old, rest, s in order:
            if base is None or old != base[0] or not rest.startswith(base[1]):
                rank, base = rank + 1, (old, rest)
            self.place[s] = (rank, rest[len(base[1]):])

    def finish(self) -> tuple[int, int, int]:
        """(cost, state, inserts after the last row) of the cheapest, least edits."""
        ends = []
        for s in range(4):
            if self.cost[s] is not None:
                inserts = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}[s]
                rank, rest = self.place[s]
                ends.append((self.cost[s] + INSERT * inserts, rank, rest + "I" * inserts, s, inserts))
        cost, _, _, state, inserts = min(ends)
        return cost, state, inserts

    def edits_backwards(self) -> Iterator[tuple[str, int | None, str | None]]:
        """(letter, number of the row or None, role said or None if kept or deleted) from the last edit to the first."""
        _, state, inserts = self.finish()
        for role in ("assistant", "user")[:inserts] if state == SYSTEM else ("assistant",)[:inserts]:
            yield "I", None, role
        row = self.rows
        for pointers in self.back.backwards():
            row -= 1
            p, inserts, letter = pointers[state] & 3, pointers[state] >> 2 & 3, pointers[state] >> 4
            yield LETTERS[letter], row, ROLE[state] if letter == R else None
            path = [p]
            for _ in range(inserts):
                path.append(NEXT[path[-1]])
            for s in reversed(path[1:]):
                yield "I", None, ROLE[s]
            state = p

    def summary(self) -> dict:
        cost, state, inserts = self.finish()
        sha, said = self.sha[state], []
        for _ in range(inserts):
            state = NEXT[state]
            said.append(f"\n{ROLE[state]}:")
        if said:
            sha = sha.copy()
            sha.update("".join(said).encode())
        audit = bytearray()
        for letter, _, _ in self.edits_backwards():
            audit += letter.encode()
        audit.reverse()
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2 ** 63 - 1)
        return {"key": self.key, "gaps": gaps, **self.counts, "illegal": self.illegal, "cost": cost, "audit": audit.decode(),
                "repaired_sha256": sha.hexdigest()}


def conversations_of(batches: Iterator[pd.DataFrame]) -> Iterator[Conversation | None]:
    """Each conversation when its last row was read, and None after each batch."""
    now = None
    for batch in batches:
        for key, turn, role, text, fault, there in zip(*(batch[c] for c in ("key", "turn", "role", "text", "fault", "there")), strict=True):
            if now is None or key != now.key:
                if now is not None:
                    yield now
                now = Conversation(key)
            if there:
                now.add(None if turn is None else int(turn), role, text, fault)
        yield None
    if now is not None:
        yield now


def faulted(rows: DataFrame) -> DataFrame:
    """key, turn, role, text, fault, there, first: rows of conversations with the first fault of each."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # Blank rows are never compared: they are dealt over their turns.
    same = F.when(F.col("there") & ~blank, F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).otherwise(
        F.concat(F.lit("-"), F.coalesce(F.col("turn").cast("string"), F.lit(""))))
    seen = F.row_number().over(Window.partitionBy("key", "_same").orderBy(F.col("turn").asc_nulls_first()))
    fault = (F.when(~F.col("there"), "").when(blank, "blank").when(F.col("_seen") > 1, "duplicate")
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise(""))
    return rows.withColumn("_same", same).withColumn("_seen", seen).select("key", "turn", "role", "text", fault.alias("fault"), "there")


def damaged(conversations: DataFrame) -> DataFrame:
    """key, turn, role, text, there: the rows after the contract's damage; a dropped row stays as a mark without text."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    base = conversations.select(F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("long").alias("turn"), one("role").alias("role"),
                                one("text").alias("text"), kind.alias("_kind"))
    k = F.col("_kind")
    text = F.when(k.isin(0, 1), "").when(k == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return base.select("key", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (k != 0).alias("there"), copies.alias("_copy")).drop("_copy")


def as_rows(conversations: DataFrame) -> DataFrame:
    """key, turn, role, text, there of conversations as they are (nulls: one space)."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("long").alias("turn"),
                                one("role").alias("role"), one("text").alias("text"), F.lit(True).alias("there"))


def in_turn_order() -> list:
    """Sort keys inside a conversation; of equal rows the one that is no duplicate comes first."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("fault") == "duplicate"]


def streamed(rows: DataFrame) -> DataFrame:
    """``faulted`` rows by conversation, in turn order, as the stream reads them (turns as text: a null would make floats)."""
    return (rows.repartition("key").sortWithinPartitions("key", *in_turn_order())
            .select("key", F.col("turn").cast("string").alias("turn"), "role", "text", "fault", "there"))


SUMMARY = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit and the digest of the repaired conversation."""
    columns = [c.split()[0] for c in SUMMARY.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = []
        for c in conversations_of(batches):
            if c is not None:
                done.append(c.summary())
                c.back.close()
            elif done:
                yield pd.DataFrame(done, columns=columns)
                done = []
        if done:
            yield pd.DataFrame(done, columns=columns)

    return streamed(faulted(rows)).mapInPandas(run, SUMMARY)


def repair_edits(faults: DataFrame) -> DataFrame:
    """One row per edit, read from the backpointers: key, back (edits from the last, counted from 0), edit, row_no, said."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "back", "edit", "row_no", "said"]
        out = []
        for c in conversations_of(batches):
            if c is None:
                continue
            for back, (letter, row, said) in enumerate(c.edits_backwards()):
                out.append((c.key, back, letter, -1 if row is None else row, said))
                if len(out) == EDIT_ROWS:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            c.back.close()
        if out:
            yield pd.DataFrame(out, columns=columns)

    return streamed(faults).mapInPandas(run, "key string, back long, edit string, row_no long, said string")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (numbered from 0), role, text, edit (K, R or I) of every row that stays."""
    kind = conversations.schema["conv_id"].dataType
    rows = faulted(as_rows(conversations))
    numbered = rows.withColumn("row_no", F.row_number().over(Window.partitionBy("key").orderBy(*in_turn_order())).cast("long") - 1)
    # A null id is joined as an id of its own.
    join_key = F.coalesce(F.concat(F.lit("="), "key"), F.lit("null"))
    edits = repair_edits(rows).where("edit <> 'D'").withColumn("_k", join_key)
    both = edits.join(numbered.select(join_key.alias("_k"), "row_no", "role", "text"), ["_k", "row_no"], "left")
    turn = F.row_number().over(Window.partitionBy("_k").orderBy(F.col("back").desc())).cast("long") - 1
    return both.select(F.col("key").cast(kind).alias("conv_id"), turn.alias("turn"), F.coalesce("said", "role").alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"), "edit")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    kind = conversations.schema["conv_id"].dataType
    report = repair_report(damaged(conversations))
    return report.select(F.col("key").cast(kind).alias("conv_id"), *report.columns[1:])
