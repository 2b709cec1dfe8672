"""Stems of frequent words, worked out once and looked up in place of some forty patterns per occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtrawl.functions.stemming import stem_tokens, stem_word, stems_slot

#: Words of the table and bytes of a word at most, which bounds what tasks get to some ten MB; places the words are dealt to.
WORDS = 65_536
WORD_BYTES = 48
SLOTS = 65_536
#: Rows from which the frequent words are read. Others than these are stemmed where they occur, so no result depends on it.
SAMPLE_ROWS = 5_000


def frequent_stems(docs: DataFrame, words: int = WORDS, sample_rows: int = SAMPLE_ROWS) -> Column:
    """The stems of the most frequent words in ``tokens`` as one array of small maps (see ``stem_documents``).

    Frequencies come from about ``sample_rows`` rows; they only choose which words are remembered. The column is a scalar
    subquery, so it is worked out once per query and no row carries it.
    """
    rows = docs.count()
    some = docs.sample(min(1.0, sample_rows / rows), seed=1) if rows else docs
    found = some.select(F.explode("tokens").alias("word")).filter(F.octet_length("word") <= WORD_BYTES)
    frequent = found.groupBy("word").count().orderBy(F.desc("count"), "word").limit(words)
    pair = F.struct("word", stem_word(F.col("word")).alias("stem"))
    slots = frequent.groupBy(stems_slot(F.col("word"), SLOTS).alias("slot")).agg(F.collect_list(pair).alias("pairs"))
    every = docs.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot")).join(slots, "slot", "left")
    ordered = F.sort_array(F.collect_list(F.struct("slot", F.coalesce("pairs", F.array().cast(slots.schema["pairs"].dataType)).alias("pairs"))))
    return every.agg(F.transform(ordered, lambda s: F.map_from_entries(s["pairs"])).alias("known")).scalar()


def stem_documents(docs: DataFrame, words: int = WORDS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with every token of ``tokens`` stemmed: frequent words are looked up, all others stemmed on the spot.

    The result is that of ``stem_tokens`` for any table of words; nothing but that table is shuffled.
    """
    table = "known stems"
    with_table = docs.select("*", frequent_stems(docs, words, sample_rows).alias(table))
    stemmed = stem_tokens(F.col("tokens"), F.col(table))
    return with_table.select(*[stemmed.alias(c) if c == "tokens" else F.col(f"`{c}`") for c in docs.columns])
