"""Operator 6, language identification by cross-parsing entropy.

For each language a suffix automaton is built from labelled text.  A document is cross-parsed with
it: the longest stretch that occurs in the labelled text is one phrase, the next phrase starts where
it ended.  Text of the same language falls into few long phrases; the language that needs the fewest
phrases per symbol wins.

The labelled sample is bounded (TRAIN_CHARS for all languages together, TRAIN_DOCS documents each).
Scoring takes whole texts: they are folded to symbols (letters, and one space for everything between
them) and parsed in lanes of LANE symbols that step through the automata's transition table together
in numpy; a phrase does not cross from one lane to the next.

Defined results: a null text and a text without a letter get ``und`` and score 0; without any labelled row
every document does; ties go to the language that sorts first; rows are scored one by one, so repeated
rows agree; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import crc_col, crc_of, map_rows, table

TRAIN_DOCS = 100               # labelled documents of each language in the sample
TRAIN_CHARS = 120_000          # characters of labelled text of all languages together
OWN_SYMBOLS = 200              # most frequent letters that keep a symbol of their own
FOLDED = 55                    # symbols that the other letters share, by Unicode block
LANE = 2048
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def symbols(text: str, symbol_of: np.ndarray) -> np.ndarray:
    """The text as symbols: letters by the table, one 0 for each stretch of anything else."""
    s = symbol_of[code_points(text)]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    return s[keep]


def suffix_automaton(seq: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the substrings of ``seq``; state 0 is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in seq:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


class Parser:
    """The automata of all languages in one transition table.

    An entry is the next state shifted left by two, plus the phrases that end with the step: none while
    the match goes on, one where it stops and the next starts with this symbol, two where the symbol is
    unknown to the language and is a phrase of its own.
    """

    def __init__(self, texts: dict[str, str]) -> None:
        self.languages = sorted(texts)
        letters = letter_table()
        seen = np.concatenate([code_points(t) for t in texts.values()]) if texts else np.zeros(0, "<u4")
        own, counts = np.unique(seen[letters[seen]], return_counts=True)
        own = own[np.lexsort((own, -counts))][:OWN_SYMBOLS]
        every = np.arange(0x110000)
        self.symbol_of = np.where(letters, 1 + len(own) + (every >> 8) % FOLDED, 0).astype(np.int16)
        self.symbol_of[own] = 1 + np.arange(len(own))
        self.width = 1 + len(own) + FOLDED
        tables, self.roots, base = [], [], 0
        for language in self.languages:
            step = suffix_automaton(symbols(texts[language], self.symbol_of).tolist())
            self.roots.append(base)
            t = np.full((len(step), self.width), base << 2 | 2, np.int64)
            t[0] = base << 2 | 1                           # at the root there is no phrase to end
            for c, to in step[0].items():
                t[1:, c] = (base + to) << 2 | 1
            for state, out in enumerate(step):
                for c, to in out.items():
                    t[state, c] = (base + to) << 2
            tables.append(t.astype(np.int32))
            base += len(step)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (a row) in each language (a column)."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        size = np.array([len(t) for t in texts], np.int64)
        if not size.sum() or not self.languages:
            return total
        flat = np.concatenate(texts).astype(np.int64)
        lanes = -(-size // LANE)
        owner = np.repeat(np.arange(len(texts)), lanes)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = (np.cumsum(size) - size)[owner] + within * LANE
        length = np.minimum(LANE, size[owner] - within * LANE)
        order = np.argsort(-length, kind="stable")         # the lanes still running are always the first ones
        owner, start, length = owner[order], start[order], length[order]
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(owner), axis=1)
        count = np.zeros(state.shape, np.int64)
        running = len(owner) - np.searchsorted(length[::-1], np.arange(length[0]), side="right")
        for at, m in enumerate(running.tolist()):
            entry = self.table[state[:, :m] * self.width + flat[start[:m] + at]]
            state[:, :m] = entry >> 2
            count[:, :m] += entry & 3
        count += state != roots                            # the phrase that the end cuts off
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(owner, count[k], len(texts)).astype(np.int64)
        return total

    def classify(self, texts: list[str | None]) -> list[tuple[str, float]]:
        seqs = [symbols(t or "", self.symbol_of) for t in texts]
        rates = self.phrases(seqs) / np.maximum(1, [len(s) for s in seqs])[:, None]
        out = []
        for s, r in zip(seqs, rates, strict=True):
            if not len(self.languages) or not s.any():
                out.append(("und", 0.0))
                continue
            best = int(np.argmin(r))
            rest = np.delete(r, best)
            out.append((self.languages[best], float(rest.min() / (rest.min() + r[best])) if len(rest) else 1.0))
        return out


def training_texts(docs: DataFrame) -> dict[str, str]:
    """A bounded sample of labelled text for each language; the choice depends on no row's position."""
    rows = docs.where((crc_col() % 3 != 1) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("_order", F.xxhash64("doc_id", "text"))
    best = Window.partitionBy("lang").orderBy("_order", "doc_id")
    # Narrow rows first: the window keeps TRAIN_DOCS of each language in every task before it shuffles.
    chosen = (rows.select("doc_id", "lang", "_order").withColumn("_n", F.row_number().over(best))
              .where(F.col("_n") <= TRAIN_DOCS).select("doc_id", "lang", "_order").distinct())
    langs = max(1, chosen.select("lang").distinct().count())
    share = TRAIN_CHARS // langs
    picked = rows.join(F.broadcast(chosen), ["doc_id", "lang", "_order"], "left_semi")
    texts: dict[str, list] = {}
    for row in picked.select("lang", "_order", F.substring("text", 1, share).alias("t")).collect():
        texts.setdefault(row["lang"], []).append((row["_order"], row["t"]))
    return {k: "\n".join(t for _, t in sorted(v))[:share] for k, v in texts.items()}


def identify(docs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """doc_id, held_out, predicted language and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(Parser(texts))

    def rows(ids: list, texts: list) -> dict:
        made = []
        at = 0
        while at < len(texts):                             # some MB of text at a time
            to, size = at, 0
            while to < len(texts) and size < 4 << 20:
                size += len(texts[to] or "")
                to += 1
            made += shared.value.classify(texts[at:to])
            at = to
        return {"doc_id": ids, "held_out": [crc_of(i) % 3 == 1 for i in ids], "lang_pred": [m[0] for m in made],
                "score": [m[1] for m in made]}

    return map_rows(docs, rows, ["doc_id", "text"], SCHEMA)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, training_texts(docs.select("doc_id", "text", "lang")))
