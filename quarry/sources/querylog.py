"""SRC-10: query logs as tables ``query_log(query_id, raw)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import tokenize as tk
from quarry.functions import urls


def from_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A query per text row: the whole text's cosine-dialect tokens joined by single spaces
    (lower-case, punctuation removed), so every dialect's query tokenizer sees clean words."""
    return df.select(F.col(id_col).alias("query_id"),
                     F.array_join(tk.cosine_words(text_col), " ").alias("raw"))


def from_requests(df: DataFrame, id_col: str = "query_id", uri_col: str = "uri",
                  terms_key: str = "terms") -> DataFrame:
    """Web requests ``/query?terms=...``: the decoded, last-wins ``terms`` argument.

    Requests that are not ``query?terms=`` requests produce no row.
    """
    pairs = df.select(F.col(id_col).alias("query_id"), F.col(uri_col).alias("uri"),
                      F.explode(urls.url_arg_pairs(uri_col)).alias("a"))
    last = (pairs.where((F.col("a.key") == terms_key) & F.col("uri").contains("query?terms="))
            .groupBy("query_id").agg(F.max_by("a.value", "a.i").alias("raw")))
    return last


DEFAULT_RESULTS = 20


def from_search_requests(df: DataFrame, id_col: str = "query_id", uri_col: str = "uri", default: int = DEFAULT_RESULTS) -> DataFrame:
    """SRC-10 / LIM-2: requests ``/search?query=...&num_results=...`` -> (query_id, raw, k), both arguments decoded, the last one
    of a name counts.  A request without a query asks for ''; ``num_results`` that is missing or no whole number of 0 or
    more counts as ``default``.  Within the row: no shuffle."""
    pairs = urls.url_arg_pairs(uri_col)
    args = df.select(F.col(id_col).alias("query_id"), pairs.alias("_a"))

    def last(name: str):
        return F.element_at(F.filter("_a", lambda a: a["key"] == name), -1)["value"]
    wanted = F.when(F.size(F.filter("_a", lambda a: a["key"] == "num_results")) > 0, last("num_results"))
    number = F.when(F.trim(wanted).rlike("^[0-9]{1,9}$"), F.trim(wanted).cast("int"))
    raw = F.when(F.size(F.filter("_a", lambda a: a["key"] == "query")) > 0, last("query"))
    return args.select("query_id", F.coalesce(raw, F.lit("")).alias("raw"), F.coalesce(number, F.lit(default)).alias("k"))
