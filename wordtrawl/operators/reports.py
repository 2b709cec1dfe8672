"""Index statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtrawl.operators.postings import posting_size


def index_stats(docs: DataFrame, postings: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(metric, value): documents, unique tokens, postings and the approximate index size."""
    totals = postings.agg(
        F.count(F.lit(1)).alias("postings"),
        F.coalesce(F.sum(posting_size(F.col("tf"))), F.lit(0)).alias("approximate_index_size"),
    )
    parts = [
        docs.agg(F.count(F.lit(1)).alias("value")).select(F.lit("documents").alias("metric"), "value"),
        frequencies.agg(F.count(F.lit(1)).alias("value")).select(F.lit("unique_tokens").alias("metric"), "value"),
        totals.unpivot([], ["postings", "approximate_index_size"], "metric", "value"),
    ]
    return reduce(DataFrame.unionByName, parts)


def stored_sizes(spark, path: str) -> DataFrame:
    """(metric, value): kilobytes of the tables of a stored index, from the file listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    table = F.regexp_extract("path", r"/(docs|postings|bigrams|terms|pairs)/", 1)
    sizes = files.filter(F.col("path").endswith(".parquet")).groupBy(table.alias("table"))
    sizes = sizes.agg((F.sum("length") / 1024).alias("value")).filter("table != ''")
    return sizes.select(F.concat("table", F.lit("_kb")).alias("metric"), F.round("value", 4).alias("value"))
