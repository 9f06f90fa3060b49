"""Inverted index of the count dialect: doc table, word positions and postings.

Long form throughout: ``postings(index_id, word, doc_id, n, positions)``.  A document's words, their numbers and offsets
need its own text only and are made where the text is read (``rows``); ids are joined to the texts before, so no token
or posting crosses the network for them.  Keys that stand over several texts go by windows and grouping.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import tokenize as tk
from quarry.operators import rows
from quarry.operators.ordinals import ordinal_within
from quarry.session import reliable_checkpoint, sized_side


@dataclass
class Index:
    """doc_table(index_id, doc_id, doc_name); postings(index_id, word, doc_id, n, positions).

    ``parts`` is set on indices opened from files: the postings of each with its bucket count."""

    doc_table: DataFrame
    postings: DataFrame
    parts: tuple[tuple[DataFrame, int], ...] = ()


def indexable_docs(docs: DataFrame, name: str = "doc_name", text: str = "text", index_id=None,
                   keep_last_word: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """SRC-2 + FLT-1 + FLT-2: C-string text, ASCII only, at least one word.

    Returns (index_id, doc_name, t, *carry) — ``carry`` columns ride along so callers never
    join the corpus back to itself.
    """
    iid = F.lit("0") if index_id is None else (F.col(index_id) if isinstance(index_id, str) else index_id)
    d = docs.select(iid.cast("string").alias("index_id"), F.col(name).cast("string").alias("doc_name"),
                    tk.c_string(text).alias("t"), *carry)
    has_words = F.col("t").rlike("[A-Za-z]") if keep_last_word else tk.has_count_words("t")
    return d.where(tk.is_ascii("t") & F.coalesce(has_words, F.lit(False)))


def positioned_tokens(docs: DataFrame, keys: list[str], text: str = "t", keep_last_word: bool = False) -> DataFrame:
    """STR-1 + WIN-2: (keys..., word, pos) with pos the byte offset of the word's first letter."""
    once, repeated = rows.split_repeated(docs.select(*keys, text), keys)
    tokens = rows.placed_words(once, keys, text, keep_last_word).select(*keys, "word", F.explode("positions").alias("pos"))
    return tokens if repeated is None else tokens.unionByName(_joined_tokens(repeated, keys, text, keep_last_word))


def _joined_tokens(docs: DataFrame, keys: list[str], text: str, keep_last_word: bool) -> DataFrame:
    """The tokens of keys with several texts: offsets run on over all chunks of a key."""
    chunk_re = "([A-Za-z]+[^A-Za-z]*)" if keep_last_word else "([A-Za-z]+[^A-Za-z]+)"
    # Prefix length and chunk array are projected before the explode so neither is re-evaluated
    # per exploded row.
    arr = docs.repartition(*keys).select(*keys, tk.count_prefix_len(text).alias("_pre"),
                                         F.regexp_extract_all(F.col(text), F.lit(chunk_re), 1).alias("_cs"))
    exploded = arr.select(*keys, "_pre", F.posexplode_outer("_cs").alias("_i", "_c")).where(F.col("_c").isNotNull())
    before = Window.partitionBy(*keys).orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    return exploded.select(
        *keys,
        tk.chunk_word("_c").alias("word"),
        (F.col("_pre") + F.coalesce(F.sum(F.length("_c")).over(before), F.lit(0))).cast("int").alias("pos"),
    )


def document_postings(docs: DataFrame, keys: list[str], text: str = "t", keep_last_word: bool = False) -> DataFrame:
    """AGG-4 / AGG-5 / ARR-1 / ARR-2 straight from the texts: (keys..., word, n, positions).  A document's postings need
    its own text only, so nothing is shuffled; keys with several texts are grouped."""
    once, repeated = rows.split_repeated(docs.select(*keys, text), keys)
    made = rows.placed_words(once, keys, text, keep_last_word)
    return made if repeated is None else made.unionByName(word_positions(_joined_tokens(repeated, keys, text, keep_last_word), keys))


def word_tokens(docs: DataFrame, keys: list[str], text: str = "t") -> DataFrame:
    """STR-1 words without offsets: (keys..., word), one row per occurrence."""
    # explode_outer + null filter: a plain explode adds an inferred size() filter that would run
    # the tokenizer twice.
    return docs.select(*keys, F.explode_outer(tk.count_words(text)).alias("word")).where(F.col("word").isNotNull())


def term_counts(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-1: occurrences of each word per document (map-side partial aggregation)."""
    return tokens.groupBy(*keys, "word").agg(F.count(F.lit(1)).cast("int").alias("n"))


def word_positions(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-4 / AGG-5 / ARR-1 / ARR-2: ascending positions and their count per (doc, word)."""
    return tokens.groupBy(*keys, "word").agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.sort_array(F.collect_list("pos")).alias("positions"),
    )


def assign_doc_ids(names: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """WIN-1 / SET-6: dense ids 1..N per index in path-component order.

    ``names`` has (index_id, doc_name).  Re-adding a known name keeps its id; new names continue
    after the largest id of their index.  Order is by the '/'-separated components of the name,
    so a directory's entries sit where the directory name sorts.
    """
    distinct = names.select("index_id", "doc_name").dropDuplicates(["index_id", "doc_name"])
    order = [F.split("doc_name", "/")]
    if existing is None:
        return ordinal_within(distinct, ["index_id"], order, "doc_id").select("index_id", "doc_id", "doc_name")
    old = existing.select("index_id", "doc_id", "doc_name")
    fresh = distinct.join(old.select("index_id", "doc_name"), ["index_id", "doc_name"], "left_anti")
    fresh = ordinal_within(fresh, ["index_id"], order, "_local")
    top = sized_side(old.groupBy("index_id").agg(F.max("doc_id").alias("_top")))
    fresh = (fresh.join(top, "index_id", "left")
             .select("index_id", (F.coalesce("_top", F.lit(0)) + F.col("_local")).alias("doc_id"), "doc_name"))
    return old.unionByName(fresh)


def build_index(docs: DataFrame, name: str = "doc_name", text: str = "text", index_id=None,
                keep_last_word: bool = False, existing: Index | None = None) -> Index:
    """SRC-1..2 -> FLT-1/2 -> WIN-1 -> STR-1 -> WIN-2 -> AGG-4/5: an in-memory (lazy) index."""
    key = ["index_id", "doc_name"]
    d = indexable_docs(docs, name, text, index_id, keep_last_word).select(*key, "t")
    if existing is not None:
        d = d.join(existing.doc_table.select(*key), key, "left_anti")
    # The names with their numbers of texts are written once: ids and repeated names both come from them.
    names = reliable_checkpoint(d.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), "names")
    doc_table = assign_doc_ids(names.select(*key), None if existing is None else existing.doc_table)
    # One document per name: of several texts under one name the smallest is indexed.
    one = d
    if not (repeated := names.where("_n > 1").select(*key)).isEmpty():
        first = Window.partitionBy(*key).orderBy("t")
        least = d.join(repeated, key, "left_semi").withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*key, "t")
        one = d.join(repeated, key, "left_anti").unionByName(least)
    # Texts get their ids before they become postings: a text is shuffled once, its postings only into their buckets.
    numbered = one.join(doc_table.hint("shuffle_hash"), key).select("index_id", "doc_id", "t")
    postings = rows.placed_words(numbered, ["index_id", "doc_id"], "t", keep_last_word).select("index_id", "word", "doc_id", "n", "positions")
    if existing is not None:
        postings = existing.postings.select("index_id", "word", "doc_id", "n", "positions").unionByName(postings)
    return Index(doc_table, postings)


def doc_ids(doc_table: DataFrame, names: DataFrame) -> DataFrame:
    """JN-4: name -> id, 0 when the name is not indexed.  ``names`` has (index_id, doc_name)."""
    return (names.join(doc_table, ["index_id", "doc_name"], "left")
            .withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast("long"))))


def doc_names(doc_table: DataFrame, ids: DataFrame) -> DataFrame:
    """JN-3: id -> name; unknown ids drop out (the reference requires them to exist)."""
    return ids.join(doc_table, ["index_id", "doc_id"])


def lookup_positions(postings: DataFrame, word: str, doc_id: int, index_id: str = "0") -> DataFrame:
    """JN-5 over postings in memory: positions of ``word`` in ``doc_id``; empty frame when absent.  For a written
    index use ``index_store.lookup_positions``, which reads the word's bucket only."""
    return postings.where((F.col("index_id") == index_id) & (F.col("word") == word) & (F.col("doc_id") == doc_id)) \
        .select("positions")
