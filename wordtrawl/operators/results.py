"""Result lists and highlighted result pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtrawl.functions.markup import highlight_html, highlight_words

RESULT_DIR = "generated_results"


def highlight_pages(hits: DataFrame, query: str = "query", html: str = "content") -> DataFrame:
    """Mark the words of each row's query in its page."""
    return hits.withColumn(html, highlight_html(F.col(html), highlight_words(F.col(query))))


def result_path(result_dir: str = RESULT_DIR):
    """Relative path of a result page: a folder per query, pages counted from 00 in rank order."""
    return F.format_string("%s/%s/result_%02d.html", F.lit(result_dir), F.col("qid").cast("string"), F.col("rank") - 1)


def assemble_results(results: DataFrame, queries: DataFrame, result_dir: str = RESULT_DIR) -> DataFrame:
    """(qid, query, rank, url, rel_path): what a result page lists for each query."""
    joined = results.join(queries.select("qid", "query"), "qid")
    return joined.select("qid", "query", "rank", "url", result_path(result_dir).alias("rel_path"))
