"""Crawled pages as tables with the columns seq, url, content, encoding, subdomain, disk_loc."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PAGE_SCHEMA = StructType([StructField(name, StringType()) for name in ("url", "content", "encoding")])


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Read a crawl tree ``folder/<subdomain>/<file>`` with one JSON object per file.

    The path of a file is its ingest order and its disk location. A missing folder and a broken file are errors.
    """
    raw = (
        spark.read.schema(PAGE_SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("mode", "FAILFAST")
        .json(folder)
    )
    path = F.col("_metadata.file_path")
    return raw.select(
        path.alias("seq"),
        *PAGE_SCHEMA.names,
        F.element_at(F.split(path, "/"), -2).alias("subdomain"),
        path.alias("disk_loc"),
    )


def pages_from_table(pages: DataFrame, seq: str = "page_id", content: str = "html") -> DataFrame:
    """Pages that already lie in a table with a sequence number, a URL and HTML."""
    return pages.select(
        F.col(seq).alias("seq"), "url", F.col(content).alias("content"), F.col(seq).cast("string").alias("disk_loc")
    )


def _is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its marker under ``path``; an interrupted write does not count."""
    try:
        spark.read.format("binaryFile").load(f"{path.rstrip('/')}/_SUCCESS")
    except AnalysisException:
        return False
    return True


def latest_pages(pages: DataFrame) -> DataFrame:
    """One row per exact URL: the content of its last page, the ``seq`` of its first.

    First and last are found on (url, seq); contents move once, in a join on ``seq``.
    """
    ends = pages.groupBy("url").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("seq"))
    latest = pages.join(ends.select("seq", "first_seq"), "seq")
    return latest.select("url", "content", F.col("first_seq").alias("seq"))


def snapshot_pages(pages: DataFrame, path: str) -> DataFrame:
    """Save ``latest_pages`` once; later calls read the saved copy."""
    spark = pages.sparkSession
    if not _is_complete(spark, path):
        latest_pages(pages).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
