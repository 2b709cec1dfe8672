"""Retrieval for batches of queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtrawl.functions.stopwords import STOP_WORDS
from wordtrawl.operators import matching, scoring
from wordtrawl.operators.results import RESULT_DIR, assemble_results
from wordtrawl.operators.tokens import process_queries
from wordtrawl.session import PINNED_ROWS, Pinned, cut_lineage, pin
from wordtrawl.sources.index_store import SearchIndex
from wordtrawl.sources.result_pages import result_pages

# The queries of the batch report.
REPORT_QUERIES = ("cristina lopes", "machine learning", "ACM", "master of software engineering")


def prepare_queries(queries: DataFrame | Pinned, stop_words: Iterable[str] = STOP_WORDS, **token_options) -> Pinned:
    """(qid, query, tokens) of a batch of (qid, query); prepared queries pass."""
    if isinstance(queries, Pinned):
        return queries
    return pin(process_queries(queries, stop_words=list(stop_words), **token_options))


def score_documents(
    queries: DataFrame | Pinned,
    index: SearchIndex,
    stop_words: Iterable[str] = STOP_WORDS,
    unigram_weight: float = scoring.UNIGRAM_WEIGHT,
    bigram_weight: float = scoring.BIGRAM_WEIGHT,
    **token_options,
) -> DataFrame:
    """(qid, doc_id, score) of every document that matches a query of (qid, query).

    All queries run in one plan with one shuffle of hits.
    """
    words = list(stop_words)
    processed = prepare_queries(queries, words, **token_options)
    known = matching.known_terms(processed, index.terms)
    candidates = matching.find_candidates(known, index.postings)
    hits = matching.lookup_terms(known, index.postings, candidates)
    pair_hits = matching.lookup_bigrams(processed, index.bigrams, index.pairs, candidates)
    weights = scoring.bigram_tfidf(pair_hits, index.n_docs, words)
    return scoring.combine_scores(hits, weights, index.n_docs, unigram_weight, bigram_weight)


def retrieve(
    queries: DataFrame | Pinned,
    index: SearchIndex,
    k: int = scoring.TOP_K,
    stop_words: Iterable[str] = STOP_WORDS,
    unigram_weight: float = scoring.UNIGRAM_WEIGHT,
    bigram_weight: float = scoring.BIGRAM_WEIGHT,
    with_seq: bool = False,
    **token_options,
) -> DataFrame:
    """(qid, rank, doc_id, score, url, disk_loc[, seq]): the k best documents of each query of (qid, query)."""
    words = list(stop_words)
    prepared = prepare_queries(queries, words, **token_options)
    scores = score_documents(prepared, index, words, unigram_weight, bigram_weight)
    return scoring.resolve_docs(scoring.rank_top_k(scores, k), index.docs, few_results(prepared, k), with_seq)


def segment_of(index: SearchIndex, doc_id: str = "doc_id") -> Column:
    """The segment that a document id belongs to."""
    starts = F.array(*[F.lit(s).cast("bigint") for s in index.starts])
    return F.size(F.filter(starts, lambda s: s <= F.col(doc_id))) - 1


def few_results(queries: Pinned, k: int) -> bool:
    """Whether k results for each query are few enough to broadcast."""
    return queries.rows is not None and queries.rows.num_rows * k <= PINNED_ROWS


def search(
    queries: DataFrame,
    index: SearchIndex,
    pages: DataFrame,
    k: int = scoring.TOP_K,
    result_dir: str = RESULT_DIR,
    stop_words: Iterable[str] = STOP_WORDS,
    **token_options,
) -> tuple[DataFrame, DataFrame]:
    """Result lists (qid, query, rank, url, rel_path) and highlighted pages (qid, rank, rel_path, html).

    Retrieval runs once; both tables read its results. ``pages`` of an index with several segments must have a column
    ``segment`` (0, 1, ...) beside ``seq``, since segments may number their pages alike.
    """
    if len(index.starts) > 1 and "segment" not in pages.columns:
        raise ValueError("the index has several segments: pages need a column segment")
    prepared = prepare_queries(queries, stop_words, **token_options)
    results = retrieve(prepared, index, k, stop_words, with_seq=True)
    if len(index.starts) > 1:
        results = results.withColumn("segment", segment_of(index))
    results = pin(results, prepared) if few_results(prepared, k) else Pinned(cut_lineage(results), None)
    return assemble_results(results.df, prepared.df, result_dir), result_pages(results, pages, prepared.df, result_dir)


def report_queries(spark: SparkSession, texts: Iterable[str] = REPORT_QUERIES) -> DataFrame:
    """(qid, query) of the batch report."""
    texts = list(texts)
    table = F.posexplode(F.array(*[F.lit(t) for t in texts])).alias("qid", "query")
    return spark.range(1).select(table)


def query_batch_report(index: SearchIndex, queries: DataFrame | None = None, k: int = 5, **token_options) -> DataFrame:
    """Results of the fixed query batch, or of another one."""
    queries = report_queries(index.docs.sparkSession) if queries is None else queries
    prepared = prepare_queries(queries, **token_options)
    return assemble_results(retrieve(prepared, index, k), prepared.df)
