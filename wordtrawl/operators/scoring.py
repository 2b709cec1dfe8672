"""TF-IDF scores, their combination, and ranking."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordtrawl.functions.stopwords import STOP_WORDS, is_common
from wordtrawl.sources.index_store import doc_block

UNIGRAM_WEIGHT = 0.4
BIGRAM_WEIGHT = 0.6
TOP_K = 5


def tfidf(tf: Column, df: Column, n_docs: int) -> Column:
    """(1 + log10 tf) * log10(N / df)."""
    return (F.lit(1.0) + F.log10(tf)) * F.log10(F.lit(float(n_docs)) / df)


def unigram_tfidf(hits: DataFrame, n_docs: int) -> DataFrame:
    """(qid, doc_id, uni): AND and unigram score in one aggregate. Each distinct known term adds its TF-IDF."""
    scored = hits.groupBy("qid", "doc_id").agg(
        F.sum(tfidf(F.col("tf"), F.col("df"), n_docs)).alias("uni"),
        F.count(F.lit(1)).alias("hit"),
        F.max("n_known").alias("n_known"),
    )
    return scored.filter("hit = n_known").select("qid", "doc_id", "uni")


def bigram_tfidf(hits: DataFrame, n_docs: int, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """(qid, ord, t1, t2, doc_id, weight): pair TF-IDF, halved for each stop word in the pair."""
    words = list(stop_words)
    halves = [F.when(is_common(F.col(t), words), 0.5).otherwise(1.0) for t in ("t1", "t2")]
    weight = halves[0] * halves[1] * tfidf(F.col("tf"), F.col("df"), n_docs)
    return hits.select("qid", "ord", "t1", "t2", "doc_id", weight.alias("weight"))


def last_bigram_wins(weights: DataFrame) -> DataFrame:
    """(qid, doc_id, bi): a document keeps the weight of the last query pair it holds."""
    return weights.groupBy("qid", "doc_id").agg(F.max_by("weight", "ord").alias("bi"))


def combine_scores(
    hits: DataFrame,
    weights: DataFrame,
    n_docs: int,
    unigram_weight: float = UNIGRAM_WEIGHT,
    bigram_weight: float = BIGRAM_WEIGHT,
) -> DataFrame:
    """(qid, doc_id, score) from term hits and pair weights: AND, unigram score, last pair and weighted sum.

    Both kinds of rows meet in one aggregate, so a document's hits are shuffled once and nothing is joined. A document
    without a pair gets 0 for it; one without all known terms is left out, whatever its pairs.
    """
    none = F.lit(None)
    terms = hits.select(
        "qid", "doc_id", tfidf(F.col("tf"), F.col("df"), n_docs).alias("uni"), "n_known",
        none.cast("double").alias("weight"), none.cast("int").alias("ord"),
    )
    pairs = weights.select(
        "qid", "doc_id", none.cast("double").alias("uni"), none.cast("bigint").alias("n_known"), "weight", F.col("ord").cast("int").alias("ord")
    )
    scored = terms.unionByName(pairs).groupBy("qid", "doc_id").agg(
        F.sum("uni").alias("uni"), F.count("uni").alias("hit"), F.max("n_known").alias("n_known"), F.max_by("weight", "ord").alias("bi")
    )
    score = F.lit(unigram_weight) * F.col("uni") + F.lit(bigram_weight) * F.coalesce("bi", F.lit(0.0))
    return scored.filter("hit = n_known").select("qid", "doc_id", score.alias("score"))


def rank_top_k(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """(qid, rank, doc_id, score): the k best documents per query, ties to the lower document id.

    Scores are compared after rounding to 9 places, since sums of doubles depend on their order. Each task sorts out
    its own top k per query before the shuffle.
    """
    best_first = Window.partitionBy("qid").orderBy(F.round("score", 9).desc(), "doc_id")
    ranked = scores.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("qid", "rank", "doc_id", "score")


def resolve_docs(ranked: DataFrame, docs: DataFrame, small: bool = False, with_seq: bool = False) -> DataFrame:
    """Add url and disk_loc, and the page's seq if asked. ``small`` says that ``ranked`` is known to be bounded and may be broadcast.

    A stored document map is joined by block as well, so that only the blocks with hits are read.
    """
    keys = [key for key in ("doc_block", "doc_id") if key in docs.columns]
    hits = ranked.withColumn("doc_block", doc_block(F.col("doc_id"))) if "doc_block" in keys else ranked
    columns = ["url", "disk_loc", *(["seq"] if with_seq else [])]
    joined = docs.select(*keys, *columns).join(F.broadcast(hits) if small else hits, keys)
    return joined.select("qid", "rank", "doc_id", "score", *columns)
