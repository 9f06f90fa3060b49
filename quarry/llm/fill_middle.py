"""Fill-in-middle transformation by in-place block rotation, and its exact inverse.

A text is cut at two unit boundaries (a unit is one line with its newline) into prefix, middle and
suffix.  The UTF-8 bytes stand in one ``bytearray``: the cuts are found by a scan for newlines, the
sentinels are inserted at them, and neighbouring segments change places by three reversals (reverse
both, then the whole), each done in place with swaps of small blocks.  The inverse finds the sentinels,
turns the rotations back and deletes the sentinels, so it gives the input's bytes again.

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle
    plain the text itself: an empty text, one that holds a sentinel, or one the rate passes over

Every row is handled alone, whatever the size of the table: no shuffle, memory bounded by one batch and
one text.  The choice depends on the seed and the id only, so a rerun task gives the same rows.

Defined results: a null text counts as an empty one (``restored`` is then the empty text); a null id counts as the empty string in the
hash; repeated rows give repeated results; an empty table gives an empty one; other columns are not read
by the digest and are carried unchanged by ``fim_transform``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from quarry.llm.common import map_rows, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Bytes that one swap of a reversal holds twice.
BLOCK = 1 << 16


@dataclass(frozen=True)
class Plan:
    """How ids choose their cuts and forms: ``rate`` and ``spm_rate`` are percentages."""

    seed: int = 7
    rate: int = 100
    spm_rate: int = 50

    def draws(self, doc_id) -> tuple[int, int, int, int]:
        """Four unsigned 32-bit numbers of one id."""
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
        return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def reverse(view: np.ndarray) -> None:
    """Reverses the bytes of ``view`` in place, a block from either end at a time."""
    a, b = 0, len(view)
    while b - a > 1:
        n = min(BLOCK, (b - a) // 2)
        left = view[a:a + n][::-1].copy()
        view[a:a + n] = view[b - n:b][::-1]
        view[b - n:b] = left
        a, b = a + n, b - n


def rotate(buf: bytearray, start: int, cut: int, end: int) -> None:
    """Exchanges buf[start:cut] and buf[cut:end] by three reversals."""
    view = np.frombuffer(buf, np.uint8)
    reverse(view[start:cut])
    reverse(view[cut:end])
    reverse(view[start:end])


def unit_ends(data: bytes | bytearray) -> np.ndarray:
    """Byte offsets at which the units end."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    return ends


def transform(buf: bytearray, first: int, second: int, form: str) -> None:
    """Turns ``buf`` into the form, with the middle at [first, second)."""
    size = len(buf)
    buf[second:second] = SUFFIX
    buf[first:first] = MIDDLE
    buf[0:0] = PREFIX
    middle, suffix, end = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE), size + len(PREFIX) + len(MIDDLE) + len(SUFFIX)
    # <P>prefix <M>middle <S>suffix: the suffix moves before the middle, or before everything.
    rotate(buf, middle if form == "psm" else 0, suffix, end)


def restore(buf: bytearray, form: str) -> None:
    """Turns the form in ``buf`` back into the text: the rotation is undone, the sentinels go."""
    if form == "plain":
        return
    middle, end = buf.find(MIDDLE), len(buf)
    start = buf.find(SUFFIX) if form == "psm" else 0
    rest = middle if form == "psm" else buf.find(PREFIX)
    # [suffix][rest] from ``start`` on become [rest][suffix].
    rotate(buf, start, rest, end)
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buf.rfind(mark)
        del buf[at:at + len(mark)]


def code_points(data: bytes | bytearray, a: int, b: int) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8)[a:b] & 0xC0) != 0x80))


@dataclass
class Made:
    """One text in its form."""

    units: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytearray


def make(doc_id, text: str | None, plan: Plan) -> Made:
    data = bytearray((text or "").encode())
    ends = unit_ends(data)
    n = len(ends)
    h1, h2, h3, h4 = plan.draws(doc_id)
    if not data or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= plan.rate:
        return Made(n, "plain", None, None, data)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (int(ends[k - 1]) if k else 0 for k in (low, high))
    made = Made(n, "spm" if h4 % 100 < plan.spm_rate else "psm", code_points(data, 0, first), code_points(data, first, second), data)
    transform(data, first, second, made.form)
    return made


def fim_transform(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``docs`` with the text in its form, and a last column ``fim_form`` (any column of that name is replaced)."""
    docs = docs.drop("fim_form")
    names = docs.columns
    schema = StructType([*docs.schema.fields]).add("fim_form", StringType())
    at_id, at_text = names.index("doc_id"), names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [make(i.as_py(), t.as_py(), plan) for i, t in zip(batch.column(at_id), batch.column(at_text), strict=True)]
            columns = batch.columns
            columns[at_text] = pa.array([m.output.decode() for m in made], batch.schema.field(at_text).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([m.form for m in made], pa.string())], names=[*names, "fim_form"])

    return docs.mapInArrow(run, schema)


def fim_restore(made: DataFrame, form: str = "fim_form") -> DataFrame:
    """The texts again, from their forms; all other columns as they were, ``form`` dropped."""
    names = made.columns
    at_form, at_text = names.index(form), names.index("text")
    kept = [i for i in range(len(names)) if i != at_form]

    def back(text: str | None, kind: str) -> str:
        buf = bytearray((text or "").encode())
        restore(buf, kind)
        return buf.decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            columns[at_text] = pa.array([back(t.as_py(), k.as_py()) for t, k in zip(batch.column(at_text), batch.column(at_form), strict=True)],
                                        batch.schema.field(at_text).type)
            yield pa.RecordBatch.from_arrays([columns[i] for i in kept], names=[names[i] for i in kept])

    return made.mapInArrow(run, StructType([made.schema.fields[i] for i in kept]))


DIGEST = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def fim_digest(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Per document the form, the lengths and the digests of the output and of the text restored from it."""
    def rows(ids: list, texts: list) -> dict:
        out = {c: [] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")}
        for i, t in zip(ids, texts, strict=True):
            m = make(i, t, plan)
            digest = hashlib.sha256(m.output).hexdigest()
            restore(m.output, m.form)
            for c, v in zip(out, (i, m.units, m.form, m.prefix_chars, m.middle_chars, digest,
                                  hashlib.sha256(m.output).hexdigest()), strict=True):
                out[c].append(v)
        return out

    return map_rows(docs.withColumn("doc_id", F.col("doc_id").cast("long")), rows, ["doc_id", "text"], DIGEST)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digest(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS ln FROM d),
c AS (SELECT doc_id, t, ln, len(ln) AS n,
        CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(ln) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(ln) + 1) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
               OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
             WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(ln[1:least(a, b)], '') AS pre, array_to_string(ln[least(a, b) + 1:greatest(a, b)], '') AS mid,
        array_to_string(ln[greatest(a, b) + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""
