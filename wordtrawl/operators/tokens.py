"""Token rows: positions, query terms and pairs, weights."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtrawl.functions import tokens as tok
from wordtrawl.functions.stopwords import STOP_WORDS, is_common


def explode_positions(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, term): one row per token with its 0-based ordinal in the filtered token list."""
    return docs.select(key, F.posexplode("tokens").alias("pos", "term"))


def explode_bigrams(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, t1, t2): adjacent pairs of the filtered list; built in the row, so no window and no shuffle."""
    pairs = docs.select(key, F.posexplode(tok.bigrams(F.col("tokens"))).alias("pos", "pair"))
    return pairs.select(key, "pos", F.col("pair.t1").alias("t1"), F.col("pair.t2").alias("t2"))


def token_weights(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, term, tf): bag-of-words counts, combined map-side before the shuffle."""
    terms = docs.select(key, F.explode("tokens").alias("term"))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def process_queries(queries: DataFrame, **token_options) -> DataFrame:
    """(qid, query, tokens): the token chain of the pages, applied to query texts."""
    return queries.select("qid", "query", tok.tokenize(F.col("query"), **token_options).alias("tokens"))


def query_terms(processed: DataFrame) -> DataFrame:
    """(qid, ord, term), repeats and unknown words kept."""
    return processed.select("qid", F.posexplode("tokens").alias("ord", "term"))


def query_pairs(processed: DataFrame) -> DataFrame:
    """(qid, ord, t1, t2): adjacent query tokens, unknown and repeated ones included."""
    return explode_bigrams(processed, "qid").withColumnRenamed("pos", "ord")


def flag_common(terms: DataFrame, stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """Add ``is_common``: whether ``term`` is on the stop list."""
    return terms.withColumn("is_common", is_common(F.col("term"), stop_words))
