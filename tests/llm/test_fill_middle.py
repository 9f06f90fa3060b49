"""Operator 13: rotation against plain slicing, exact round trips, odd tables."""

import hashlib
import random
import re

import numpy as np

from quarry.llm import fill_middle as fm

RNG = random.Random(13)


def brute(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_rotation_exchanges_segments(monkeypatch):
    for block in (1, 3, 1 << 16):
        monkeypatch.setattr(fm, "BLOCK", block)
        for _ in range(300):
            data = RNG.randbytes(RNG.randint(0, 40))
            a, b, c = sorted(RNG.randint(0, len(data)) for _ in range(3))
            buf = bytearray(data)
            fm.rotate(buf, a, b, c)
            assert bytes(buf) == data[:a] + data[b:c] + data[a:b] + data[c:]
            view = np.frombuffer(bytearray(data), np.uint8).copy()
            fm.reverse(view)
            assert view.tobytes() == data[::-1]


def test_forms_against_slicing():
    pieces = ["\n", "\n\n", "a", "é中", "𝄞", "<", "P>", "<P", "<S>", "<M>", " x y", "S>", ">"]
    for i in range(4000):
        text = "".join(RNG.choice(pieces) for _ in range(RNG.randint(0, 14)))
        plan = fm.Plan(seed=RNG.choice([7, 8]), rate=RNG.choice([0, 50, 100]), spm_rate=RNG.choice([0, 50, 100]))
        m = fm.make(i, text, plan)
        assert (m.units, m.form, m.prefix_chars, m.middle_chars, m.output.decode()) == brute(i, text, plan.rate, plan.spm_rate, plan.seed)
        fm.restore(m.output, m.form)
        assert m.output.decode() == text


def test_long_texts_and_both_forms_occur():
    text = "".join(f"line {i} é\n" * (i % 3) for i in range(60_000))
    seen = set()
    for i in range(12):
        m = fm.make(i, text, fm.Plan())
        seen.add(m.form)
        assert m.output.decode() == brute(i, text)[4]
        fm.restore(m.output, m.form)
        assert m.output.decode() == text
    assert seen == {"psm", "spm"}


def test_query_against_brute_force(odd):
    def row(i, t):
        n, form, pre, mid, out = brute(i, t)
        return i, n, form, pre, mid, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()
    got = sorted((tuple(r) for r in fm.fim_digest(odd).collect()), key=repr)
    assert got == sorted((row(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()), key=repr)
    assert fm.fim_digest(odd.limit(0)).count() == 0


def test_documents_survive_the_round_trip(odd):
    made = fm.fim_transform(odd, fm.Plan(rate=70))
    assert made.columns == [*odd.columns, "fim_form"]
    back = fm.fim_restore(made)
    assert back.columns == odd.columns
    clean = odd.fillna({"text": ""})
    assert sorted(map(repr, back.collect())) == sorted(map(repr, clean.collect()))
    assert fm.fim_transform(odd.limit(0)).count() == 0
