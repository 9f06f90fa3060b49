"""Tokenizers of the three dialects as Column expressions (JVM side, no Python UDF).

Dialects:
  * ``count``  - maximal ASCII-letter runs, lower-cased, with byte offsets; a run that reaches
                 the end of the text is not a word (the reference adds a word only when a
                 non-letter follows it).
  * ``cosine`` - lower-case, split on ASCII whitespace, delete ASCII punctuation, drop empties.
  * ``tfidf``  - split on Unicode whitespace, delete non-word characters, lower-case; empty
                 terms are kept and counted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (must equal the reference's character classes).
ASCII_WS = r"[ \t\n\x0B\f\r]+"
# Python's str.split() whitespace: ASCII whitespace, the separators \x1c-\x1f, NEL and Unicode Z.
UNICODE_WS = r"[ \t\n\x0B\f\r\x1c-\x1f\x85\p{Z}]+"
NON_WORD = r"[^\p{L}\p{N}_]+"
PUNCT = r"\p{Punct}"
NON_ASCII = r"[^\x00-\x7F]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- count dialect (STR-1, SRC-2)

def c_string(text) -> Column:
    """Content as a C string: everything after the first NUL is ignored."""
    return F.substring_index(_col(text), "\x00", 1)


def is_ascii(text) -> Column:
    """FLT-1: true when no character is above 0x7F (null-safe false for null text)."""
    t = _col(text)
    return F.coalesce(~t.rlike(NON_ASCII), F.lit(False))


def has_count_words(text) -> Column:
    """FLT-2: at least one letter run followed by a non-letter."""
    return F.coalesce(_col(text).rlike("[A-Za-z][^A-Za-z]"), F.lit(False))


def count_words(text) -> Column:
    """STR-1 words without offsets: array of lower-cased letter runs followed by a non-letter."""
    return F.transform(F.regexp_extract_all(_col(text), F.lit("([A-Za-z]+)[^A-Za-z]"), 1), F.lower)


def count_chunks(text) -> Column:
    """STR-1 chunks ``word + following non-letters``; they tile the text after its prefix."""
    return F.regexp_extract_all(_col(text), F.lit("([A-Za-z]+[^A-Za-z]+)"), 1)


def count_prefix_len(text) -> Column:
    """Length of the leading non-letter run (offset of the first chunk)."""
    return F.length(F.regexp_extract(_col(text), "^[^A-Za-z]*", 0))


def chunk_word(chunk) -> Column:
    return F.lower(F.regexp_extract(_col(chunk), "^[A-Za-z]+", 0))


# ---------------------------------------------------------------- cosine dialect (STR-2)

def cosine_words(text) -> Column:
    """STR-2: lower -> split on whitespace -> delete punctuation -> drop empties."""
    # One pattern over the whole text: punctuation is no white space, so its words are the same as piece by piece.
    cleaned = F.regexp_replace(F.lower(_col(text)), f"{PUNCT}+", "")
    return F.filter(F.split(cleaned, ASCII_WS), lambda x: x != "")


# ---------------------------------------------------------------- tfidf dialect (STR-3, STR-4)

def normalize_term(term) -> Column:
    """STR-4: delete non-word characters, lower-case."""
    return F.lower(F.regexp_replace(_col(term), NON_WORD, ""))


def tfidf_words(text) -> Column:
    """STR-3: Unicode-whitespace split, each piece normalised; empty terms stay.

    An all-blank text yields no tokens (not one empty token).
    """
    t = _col(text)
    trimmed = F.regexp_replace(t, f"^{UNICODE_WS}|{UNICODE_WS}$", "")
    # Patterns over the whole text: every gap becomes one blank, then all but words and blanks goes, so a piece
    # without a word character stays as an empty term between its blanks.
    spaced = F.regexp_replace(trimmed, UNICODE_WS, " ")
    pieces = F.split(F.lower(F.regexp_replace(spaced, r"[^\p{L}\p{N}_ ]+", "")), " ")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(pieces)


# ---------------------------------------------------------------- query tokenizers (STR-5)

def query_words(raw, dialect: str = "count") -> Column:
    """Words of a raw query string, in order, per dialect.

    count  : lower, split on single spaces, empty pieces dropped (shell dialect)
    cpp    : lower, split on whitespace runs
    web    : lower, trim, split on *each* space; empty words are kept (they match nothing)
    cosine : STR-2
    tfidf  : split on Unicode whitespace, each piece normalised (STR-3 / STR-4)
    """
    r = _col(raw)
    if dialect == "count":
        return F.filter(F.split(F.lower(r), " "), lambda x: x != "")
    if dialect == "cpp":
        return F.filter(F.split(F.lower(r), ASCII_WS), lambda x: x != "")
    if dialect == "web":
        trimmed = F.trim(F.lower(r))
        return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))
    if dialect == "cosine":
        return cosine_words(r)
    if dialect == "tfidf":
        return tfidf_words(r)
    raise ValueError(f"unknown query dialect {dialect!r}")


def words_of(text, dialect: str) -> Column:
    """Document tokenizer by dialect (UDF-5: the pluggable tokenizer is a Column builder)."""
    if dialect == "count":
        return count_words(c_string(text))
    if dialect == "cosine":
        return cosine_words(text)
    if dialect == "tfidf":
        return tfidf_words(text)
    raise ValueError(f"unknown dialect {dialect!r}")
