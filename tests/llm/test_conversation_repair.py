"""Operator 12 against a recursive brute force, across batches and spills, and on odd tables."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pandas as pd
import pytest

from quarry.llm import conversation_repair as cr

RNG = random.Random(12)
SPACE = " \t\n\x0b\x0c\r"


def brute_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """Rows (turn, role, text) in turn order -> the contract's columns, by trying every edit."""
    faults = brute_faults(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserts):
        found = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if inserts < 3:
            c, e = best(i, after[last], inserts + 1)
            found.append((c + 2, "I" + e))
        if i < len(rows):
            c, e = best(i + 1, last, 0)
            found.append((c + 3, "D" + e))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                first = rows[i][1][:1]
                if first == "s" and last == "" or first in ("u", "a") and first == after[last]:
                    c, e = best(i + 1, first, 0)
                    found.append((c + extra, "K" + e))
                c, e = best(i + 1, after[last], 0)
                found.append((c + 2 + extra, "R" + e))
        return min(found) if found else (10 ** 6, "")

    cost, audit = best(0, "", 0)
    said, i, last = [], 0, ""
    for e in audit:
        if e == "I":
            last = after[last]
            said.append({"u": "user:", "a": "assistant:"}[last])
            continue
        if e != "D":
            last = rows[i][1][:1] if e == "K" else after[last]
            said.append(f"{rows[i][1] if e == 'K' else {'u': 'user', 'a': 'assistant'}[last]}:{rows[i][2]}")
        i += 1
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def summary(c):
    s = c.summary()
    return tuple(s[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


def fed(rows, key="k"):
    c = cr.Conversation(key)
    for (t, role, text), fault in zip(rows, brute_faults(rows), strict=True):
        c.add(t, role, text, fault)
    return c


def made(n, r=RNG):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", " ", "s", "A"]
    texts = ["a.", "b!", "c?", "x", "y ", " ", "", "z.\n", "d.", "e.", "f", "g."]
    rows = [(None if r.random() < .1 else r.randint(0, 9), r.choice(roles), r.choice(texts)) for _ in range(n)]
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))


def test_program_against_brute_force():
    for _ in range(6000):
        rows = made(RNG.randint(0, 9))
        assert summary(fed(rows)) == brute(rows), rows


def test_ties_over_long_conversations():
    for seed in range(30):
        r = random.Random(seed)
        rows = [(i, r.choice(["user", "assistant"]), f"{i}.") for i in range(120)]
        assert summary(fed(rows)) == brute(rows)


def test_backpointers_are_spilled(monkeypatch):
    monkeypatch.setattr(cr, "SPILL_BYTES", 64)
    rows = [(i, RNG.choice(["system", "user", "assistant"]), f"{i}{RNG.choice('.x')}") for i in range(150)]
    c = fed(rows)
    assert c.back.spilled > 300 and summary(c) == brute(rows)


def test_state_crosses_batches():
    rows = [("a", i, RNG.choice(["user", "assistant"]), f"{i}.") for i in range(57)] + [("b", 0, "user", "x."), (None, 1, "user", "y.")]
    frame = pd.DataFrame([(k, str(t), r, x, "", True) for k, t, r, x in rows], columns=["key", "turn", "role", "text", "fault", "there"])
    for size in (1, 7, 100):
        got = [c for c in cr.conversations_of(frame[i:i + size] for i in range(0, len(frame), size)) if c is not None]
        assert [c.key for c in got] == ["a", "b", None]
        assert summary(got[0]) == brute([r[1:] for r in rows[:57]])


def brute_query(table):
    """The contract's damage and digest of (conv_id, turn, role, text) rows."""
    groups = {}
    for conv, turn, role, text in table:
        rows = groups.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows.extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return {c: brute(sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))) for c, rows in groups.items()}


@pytest.fixture
def talk(spark):
    def make(rows):
        schema = "conv_id long, turn long, role string, text string, key long, fault string, there long, _seen long"
        return spark.createDataFrame([(*r, 1, "x", 0, 5) for r in rows], schema)
    return make


ODD = ([(c, t, RNG.choice(["system", "user", "assistant", None]), RNG.choice(["a.", "b", None, "", "long text. " * 9000, "a."]))
        for c in [None, *range(60)] for t in [None, *range(RNG.randint(0, 9))]] +
       [(70, 3, "user", "same."), (70, 3, "user", "same."), (71, -2 ** 63, "user", "low."), (71, 2 ** 63 - 1, "assistant", "high.")])


def test_query_against_brute_force(talk):
    got = cr.repair_report(cr.damaged(talk(ODD))).collect()
    want = brute_query(ODD)
    want[71] = (min(want[71][0], 2 ** 63 - 1), *want[71][1:])
    assert {None if r.key is None else int(r.key): tuple(r)[1:] for r in got} == want and len(got) == len(want)
    assert cr.repair_report(cr.damaged(talk([]))).count() == 0


def test_dropped_conversations_are_returned(talk):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    got = cr.repair_report(cr.damaged(talk([(c, 0, "user", "hello.") for c in gone]))).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted(tuple(r) for r in got) == sorted((str(c), 0, 0, 0, 0, 0, 0, "", nothing) for c in gone)


def test_repaired_rows(talk, monkeypatch):
    monkeypatch.setattr(cr, "EDIT_ROWS", 5)
    rows = [(c, t, role, text) for c, t, role, text in ODD if c != 71]
    got = {}
    for r in cr.repair_conversations(talk(rows)).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t, *(" " if x is None else x for x in (role, text))))
    for c, g in groups.items():
        want = brute(sorted(g, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])))[-1]
        assert hashlib.sha256("\n".join(got.get(c, [])).encode()).hexdigest() == want
