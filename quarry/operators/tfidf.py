"""Term statistics and TF-IDF vectors (cosine and tfidf dialects), long form.

tf(doc, w) = occurrences / tokens of the doc; idf(w) = ln(N / df(w)) with N the number of all
documents (wordless ones included); vectors are tf * idf for every (doc, word), zeros kept;
norm(doc) = sqrt(sum of squared weights).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StringType, StructField, StructType

from quarry.functions import tokenize as tk
from quarry.operators import rows
from quarry.session import reliable_checkpoint


def doc_tokens(docs: DataFrame, key: str, text: str, dialect: str) -> DataFrame:
    """(key, len, word): one row per token; ``len`` is the document's token count (AGG-2),
    computed inside the row so no shuffle is needed for it."""
    # Array and its size are projected before the explode; written in one select, the size would be
    # re-evaluated on every exploded row (quadratic in the document length).
    arr = docs.select(F.col(key), tk.words_of(text, dialect).alias("_ws"))
    arr = arr.select(key, "_ws", F.size("_ws").alias("len"))
    # explode_outer: a plain explode makes Catalyst infer a size(array) > 0 filter that runs the
    # tokenizer a second time; the outer form plus a null filter tokenizes each text once.
    return arr.select(key, "len", F.explode_outer("_ws").alias("word")).where(F.col("word").isNotNull())


def term_frequency(tokens: DataFrame, key: str) -> DataFrame:
    """AGG-1/2/3: (key, word, cnt, len, tf)."""
    # len depends on the document only, so grouping on it costs nothing and avoids a first().
    return (tokens.groupBy(key, "len", "word")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .withColumn("tf", F.col("cnt") / F.col("len")))


def document_terms(docs: DataFrame, key: str, text: str, dialect: str) -> DataFrame:
    """AGG-1/2/3 straight from the texts: (key, word, cnt, len, tf).  A document's counts need its own text only, so nothing
    is shuffled; texts of one key and of one length are counted together."""
    once, repeated = rows.split_repeated(docs.select(key, text), [key])
    counted = (rows.counted_cosine_words(once, [key], text) if dialect == "cosine" else
               rows.counted_words(once.select(key, tk.words_of(text, dialect).alias("_ws")), [key], "_ws"))
    made = counted.select(key, "len", "word", "cnt", (F.col("cnt") / F.col("len")).alias("tf"))
    return made if repeated is None else made.unionByName(term_frequency(doc_tokens(repeated, key, text, dialect), key))


def document_count(docs: DataFrame) -> int:
    """AGG-9: number of documents, wordless ones included (a single scalar action)."""
    return docs.count()


def idf(tf: DataFrame, n_docs: int) -> DataFrame:
    """AGG-6/7: (word, df, idf) with idf = ln(N / df), no smoothing."""
    return (tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
            .withColumn("idf", F.log(F.lit(float(n_docs)) / F.col("df"))))


def tfidf_vectors(tf: DataFrame, idf_df: DataFrame, key: str) -> DataFrame:
    """AGG-12 / JN-6: (key, word, tf, w); Catalyst chooses the join by the sizes of the written tables."""
    return tf.join(idf_df.select("word", "idf"), "word").select(key, "word", "tf", (F.col("tf") * F.col("idf")).alias("w"))


def norms(vectors: DataFrame, key: str) -> DataFrame:
    """AGG-10: (key, norm)."""
    return vectors.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def norms_by_chunk(tf: DataFrame, idf_df: DataFrame, key: str) -> DataFrame:
    """AGG-10: (key, norm) as by ``norms``, but a word meets its idf once for a chunk of documents, not once for each of them:
    chunks are packed, their distinct words ask for idf, and what they get goes to the chunk."""
    schema = StructType([StructField("chunk", StringType()), StructField("word", StringType()), StructField("place", IntegerType()), StructField("docs", BinaryType())])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, table in enumerate(rows.tables(batches)):
            chunk = f"{TaskContext.get().partitionId()}-{n}"
            words = table.column("word").combine_chunks().dictionary_encode()
            many = len(words.dictionary)
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * many, pa.string()), words.dictionary, pa.array(range(many), pa.int32()), pa.nulls(many, pa.binary())], schema.names)
            # The chunk stands under its own name in place of a word, so chunks are dealt out too.
            docs = rows.packed(pa.table({"key": table.column(key), "place": words.indices, "tf": table.column("tf")}))
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([chunk]), pa.array([-1], pa.int32()), pa.array([docs], pa.binary())], schema.names)

    def squares(chunk: pa.Table) -> pa.Table:
        answers = chunk.filter(pc.greater_equal(chunk.column("place"), 0))
        idf = np.full(len(answers), np.nan)
        idf[answers.column("place").to_numpy()] = answers.column("idf").to_numpy()
        docs = rows.unpacked(chunk.filter(pc.less(chunk.column("place"), 0)).column("docs")[0].as_buffer())
        w = docs.column("tf").to_numpy() * idf[docs.column("place").to_numpy()]
        known = ~np.isnan(w)                # a word without idf counts for nothing
        found = pa.table({"key": docs.column("key"), "square": w * w}).filter(pa.array(known)).group_by("key").aggregate([("square", "sum")])
        return pa.table({"key": found.column("key"), "square": found.column("square_sum")})

    answered = tf.select(key, "word", "tf").mapInArrow(asked, schema).join(idf_df.select("word", "idf"), "word", "left").drop("word")
    made = StructType([StructField("key", tf.schema[key].dataType), StructField("square", DoubleType())])
    return answered.groupBy("chunk").applyInArrow(squares, made).groupBy(F.col("key").alias(key)).agg(F.sqrt(F.sum("square")).alias("norm"))


def vector_maps(vectors: DataFrame, key: str) -> DataFrame:
    """MAP-1: (key, vector MAP<word, weight>) built at the edge of the API."""
    return vectors.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias("vector"))


def vector_weight(vector, word, default: float = 0.0):
    """MAP-2: weight of ``word`` in a vector map, ``default`` when absent (get / getOrDefault)."""
    v = F.col(vector) if isinstance(vector, str) else vector
    w = F.lit(word) if isinstance(word, str) else word
    return F.coalesce(F.try_element_at(v, w), F.lit(default))


def unique_words(tokens: DataFrame, key: str) -> DataFrame:
    """AGG-11: distinct words per document."""
    return tokens.select(key, "word").distinct()


class Model:
    """TF-IDF model over a document frame (pages or documents), materialised on first use.

    ``tf``, ``idf`` and ``norms`` are written to the shared checkpoint folder the first time they
    are needed (the reference precomputes them too), so later size checks, joins and queries read
    files instead of tokenizing the corpus again; ``vectors`` is the tf x idf join over them.
    """

    def __init__(self, docs: DataFrame, key: str, text: str, dialect: str = "cosine", materialise: bool = True):
        self.key = key
        self.dialect = dialect
        self._docs, self._text = docs, text
        self._keep = reliable_checkpoint if materialise else (lambda df, **_: df)

    @cached_property
    def n_docs(self) -> int:
        return document_count(self._docs)

    @cached_property
    def tf(self) -> DataFrame:
        # tf is made when it is read: its eight bytes would be half of the table.
        terms = document_terms(self._docs, self.key, self._text, self.dialect).drop("tf")
        return self._keep(terms, compression="zstd").withColumn("tf", F.col("cnt") / F.col("len"))

    @cached_property
    def idf(self) -> DataFrame:
        return self._keep(idf(self.tf, self.n_docs))

    @cached_property
    def vectors(self) -> DataFrame:
        return tfidf_vectors(self.tf, self.idf, self.key)

    @cached_property
    def norms(self) -> DataFrame:
        return self._keep(norms_by_chunk(self.tf, self.idf, self.key))
