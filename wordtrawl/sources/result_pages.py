"""Contents of result pages: fetch and write as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtrawl.operators.results import RESULT_DIR, highlight_pages, result_path
from wordtrawl.session import Pinned, pin, prune_to_keys


def fetch_result_pages(results: DataFrame | Pinned, pages: DataFrame) -> DataFrame:
    """Add the page ``content`` of each hit, by ``seq``, and by ``segment`` if the results have one.

    Few hits are pushed into the scan of the pages as IN lists, which skips row groups of a table and files of a crawl tree,
    and are broadcast. More hits than can be at hand are joined by key; a filter on the hits' keys then runs before any
    content is moved, so what moves are the pages asked for.
    """
    results = pin(results)
    keys = ["seq", "segment"] if "segment" in results.df.columns else ["seq"]
    narrow = prune_to_keys(pages.select(*keys, "content"), results, "seq")
    if results.rows is None:
        wanted = results.df.select(*keys).distinct()
        narrow = narrow.join(wanted, keys, "left_semi")
    return narrow.join(results.df, keys)


def result_pages(results: DataFrame | Pinned, pages: DataFrame, queries: DataFrame | None, result_dir: str = RESULT_DIR) -> DataFrame:
    """(qid, rank, rel_path, html) of every hit with a ``seq``, highlighted where ``queries`` are given."""
    hits = fetch_result_pages(results, pages)
    if queries is not None:
        hits = highlight_pages(hits.join(queries.select("qid", "query"), "qid"))
    return hits.select("qid", "rank", result_path(result_dir).alias("rel_path"), F.col("content").alias("html"))


def write_result_pages(rendered: DataFrame, path: str) -> DataFrame:
    """Write result pages as a table, replacing those of the search before; returns (qid, rank, rel_path)."""
    rendered.select("qid", "rank", "rel_path", "html").write.mode("overwrite").parquet(path)
    return rendered.sparkSession.read.parquet(path).select("qid", "rank", "rel_path")
