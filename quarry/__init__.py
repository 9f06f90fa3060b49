"""quarry: text retrieval and link analysis as Spark DataFrame jobs.

The public API (every function takes and returns DataFrames; queries are always DataFrames).
"""

from quarry.functions.tokenize import query_words, words_of
from quarry.functions.urls import escape_html, url_arg_pairs, url_decode, url_host, url_path
from quarry.operators.graph import bfs_order, link_graph, pagerank, rank_of
from quarry.operators.index import (Index, assign_doc_ids, build_index, doc_ids, doc_names, indexable_docs,
                                    positioned_tokens, term_counts, word_positions, word_tokens)
from quarry.operators.quality import approx_equal, check_index, check_ranks
from quarry.operators.search import (and_search, and_search_tokens, cosine_search, display_rank, query_tokens,
                                     ranked_search, result_headers, result_lines, tfidf_search, top_k_per_query)
from quarry.operators.tfidf import Model as TfIdfModel
from quarry.operators.topk import rounded_average, top_k, top_k_per
from quarry.operators.web import (content_type_filter, distinct_pages, extension_filter, host_allowed, page_links,
                                  parse_pages, parse_robots, read_raw_pages, robots_filter, save_raw_pages, summaries)
from quarry.session import get_spark, reliable_checkpoint, sized_side
from quarry.sources.files import (append_visited, load_parsed_pages, load_visited, read_tree, save_parsed_pages,
                                  write_columns_csv)
from quarry.sources.index_store import lookup_positions, lookup_words, open_index, open_indexes, write_index
from quarry.sources.querylog import from_requests as query_log_from_requests
from quarry.sources.querylog import from_texts as query_log_from_texts
from quarry.streaming.stream import read_stream_index, stream_index, stream_search

__all__ = [n for n in dir() if not n.startswith("_")]
