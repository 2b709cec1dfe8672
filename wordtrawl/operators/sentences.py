"""Sentence ends learnt from a corpus: which words keep their period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtrawl.functions import sentences
from wordtrawl.functions.tokens import tokenize
from wordtrawl.session import Pinned, cut_lineage, pin


def period_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, with_period, without_period) of every word of the corpus, lower-cased, combined before the shuffle.

    An ellipsis is no period. Null texts have no words.
    """
    words = docs.select(F.explode(sentences.words_with_periods(F.col(text))).alias("found"))
    ends = F.endswith("found", F.lit(".")) & ~F.endswith("found", F.lit(".."))
    counted = words.groupBy(F.rtrim("found", F.lit(".")).alias("word"))
    return counted.agg(F.count_if(ends).alias("with_period"), F.count_if(~ends).alias("without_period"))


def scored_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, with_period, without_period, score) of the words that have a period somewhere.

    The counts are written once: the share of words with a period comes from all of them and goes into every score.
    """
    counts = cut_lineage(period_counts(docs, text))
    total = counts.agg(F.sum("with_period").alias("k"), F.sum(F.col("with_period") + F.col("without_period")).alias("n")).first()
    share = total["k"] / total["n"] if total["n"] else 0.0
    score = sentences.abbreviation_score(F.col("word"), F.col("with_period"), F.col("without_period"), float(share))
    return counts.filter("with_period > 0").withColumn("score", score)


def abbreviations(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word): the abbreviations of a corpus. Keep them as a table, to tokenise pages and queries by the same words."""
    return scored_words(docs, text).filter(F.col("score") >= sentences.LEAST_SCORE).select("word")


def tokenize_fitted(
    docs: DataFrame, words: DataFrame | Pinned, text: str = "text", key: str = "doc_id", **token_options
) -> DataFrame:
    """``docs`` with ``tokens`` of the Treebank chain, in which abbreviations keep their period.

    Abbreviations that can be at hand are part of the expression, and nothing is shuffled. More are joined with the words that
    have a period in each text, which wants a ``key`` that is distinct.
    """
    pinned = pin(words)
    known = pinned.values("word")
    if known is not None:
        return docs.withColumn("tokens", tokenize(F.col(text), abbreviations=sorted(known), **token_options))
    found = F.array_distinct(F.filter(sentences.words_with_periods(F.col(text)), lambda w: F.endswith(w, F.lit("."))))
    asked = docs.select(F.col(key).alias("_key"), F.explode(found).alias("_found"))
    asked = asked.select("_key", F.rtrim("_found", F.lit(".")).alias("word")).join(pinned.df.select("word").distinct(), "word")
    own = asked.groupBy("_key").agg(F.collect_set("word").alias("_own"))
    joined = docs.join(own, F.col(key).eqNullSafe(F.col("_key")), "left")
    own_or_none = F.coalesce("_own", F.array().cast("array<string>"))
    return joined.withColumn("tokens", tokenize(F.col(text), abbreviations=own_or_none, **token_options)).drop("_key", "_own")
