"""DQ-1..8: index and rank checks as DataFrames of (check, violations).

Each table is scanned by one aggregate; uniqueness and id resolution use a group-by and an anti
join.  Nothing is collected except inside ``approx_equal`` (a test helper over small results).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.urls import word_bucket
from quarry.operators.index import Index


def _stack(row_df: DataFrame, names: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names)
    return row_df.selectExpr(f"stack({len(names)}, {pairs}) AS (check, violations)")


def check_index(index: Index, buckets: int | None = None) -> DataFrame:
    """DQ-2..6 (+ DQ-4 bucket placement when ``buckets`` is given)."""
    dt, p = index.doc_table, index.postings
    per_index = dt.groupBy("index_id").agg(F.count(F.lit(1)).alias("c"), F.countDistinct("doc_id").alias("d"),
                                           F.max("doc_id").alias("m"), F.min("doc_id").alias("lo"))
    doc_ids = per_index.agg(
        F.coalesce(F.sum(F.col("c") - F.col("d")), F.lit(0)).alias("doc_id_unique"),
        F.coalesce(F.sum(F.when((F.col("m") != F.col("d")) | (F.col("lo") != 1), 1).otherwise(0)), F.lit(0))
        .alias("doc_id_dense"))
    docs = dt.agg(
        F.count_if(F.col("doc_name").rlike(r"[^\x00-\x7F]")).alias("doc_name_ascii"),
        F.count_if(F.length("doc_name") >= 1024).alias("doc_name_length"))
    post_cols = {
        "word_ascii_lower": F.count_if(F.col("word").rlike(r"[^\x00-\x7F]") | F.col("word").rlike("[A-Z]")),
        "word_length": F.count_if(F.length("word") >= 8192),
        "positions_count": F.count_if((F.col("n") >= 1000000) | (F.col("n") != F.size("positions"))),
        "positions_increasing": F.count_if(F.col("positions") != F.array_sort(F.array_distinct("positions"))),
    }
    if buckets is not None:
        post_cols["bucket_placement"] = F.count_if(F.col("bucket") != word_bucket("word", buckets))
    posts = p.agg(*[c.alias(n) for n, c in post_cols.items()])
    dup = (p.groupBy("index_id", "word", "doc_id").count().where(F.col("count") > 1)
           .agg(F.count(F.lit(1)).alias("posting_unique")))
    orphan = (p.select("index_id", "doc_id").join(dt.select("index_id", "doc_id"), ["index_id", "doc_id"], "left_anti")
              .agg(F.count(F.lit(1)).alias("posting_doc_resolves")))
    parts = [_stack(doc_ids, ["doc_id_unique", "doc_id_dense"]),
             _stack(docs, ["doc_name_ascii", "doc_name_length"]),
             _stack(posts, list(post_cols)),
             _stack(dup, ["posting_unique"]),
             _stack(orphan, ["posting_doc_resolves"])]
    return reduce(DataFrame.unionByName, parts)


def check_ranks(ranks: DataFrame, tol: float = 1e-9) -> DataFrame:
    """DQ-7: every rank positive, ranks sum to 1."""
    row = ranks.agg(F.count_if(F.col("rank") <= 0).alias("rank_positive"),
                    F.when(F.abs(F.sum("rank") - 1.0) > tol, 1).otherwise(0).alias("rank_sum"))
    return _stack(row, ["rank_positive", "rank_sum"])


def approx_equal(a: DataFrame, b: DataFrame, keys: list[str], col: str, tol: float = 1e-3) -> bool:
    """DQ-8: same keys on both sides and values within ``tol`` (full outer join, one count)."""
    j = a.select(*keys, F.col(col).alias("_a")).join(b.select(*keys, F.col(col).alias("_b")), keys, "full_outer")
    bad = j.where(F.col("_a").isNull() | F.col("_b").isNull() | (F.abs(F.col("_a") - F.col("_b")) > tol))
    return bad.limit(1).count() == 0
