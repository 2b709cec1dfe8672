"""What the operators share: folds, scratch tables, sending the code along, sums of arrays over partitions."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

import wordtrawl
from wordtrawl.session import scratch_folder

#: Largest table of ids, in bytes, that is broadcast; beyond it the same join shuffles. A row of a broadcast table takes some
#: ``ROW_BYTES`` besides its values.
BROADCAST_BYTES = 48 * 1024 * 1024
ROW_BYTES = 48

BATCH_ROWS = 500
#: Doubles of an array that travel in one row: a batch of rows is 32 MB at most.
SLICE = 8192

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package once per application, so that they need no copy of the repository on their path.

    Also keep the Arrow batches of this session at ``BATCH_ROWS``: whole texts are long, and a worker holds a batch at a time.
    """
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(wordtrawl.__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="wordtrawl-")), "wordtrawl.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.join("wordtrawl", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def stored(df: DataFrame, rows_a_file: int = 0) -> DataFrame:
    """Write a table next to the checkpoints and read it back: later jobs reread files instead of running it again.

    ``rows_a_file`` is for tables of few but large rows: it keeps what a reader or writer holds at a time small.
    """
    path = scratch_folder(df.sparkSession)
    few = {"maxRecordsPerFile": rows_a_file, "parquet.block.size.row.check.min": 4, "parquet.page.size.row.check.min": 4}
    df.write.options(**(few if rows_a_file else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(ids: DataFrame) -> DataFrame:
    """Mark a table for broadcast if its bytes, added up on the executors, allow it; else its joins sort and shuffle."""
    size = F.octet_length(F.to_json(F.struct("*"))) + ROW_BYTES
    taken = ids.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(ids) if taken <= BROADCAST_BYTES else ids.hint("merge")


def summed(df: DataFrame, partial: Callable, length: int) -> np.ndarray:
    """Add up an array of doubles of fixed ``length`` that ``partial`` makes of each partition's pandas batches.

    The arrays travel in slices of ``SLICE`` doubles. They meet in ``sum_groups`` tasks first, which add slice by slice as
    they come and hold one array each, however many partitions there are; the driver adds those arrays in the same way. The
    number of a partition decides where its array goes, so a task that runs again sends it to the same place.
    """
    groups = sum_groups(df.sparkSession)

    def slices(total):
        for start in range(0, length, SLICE):
            yield start, total[start : start + SLICE].astype("<f8").tobytes()

    def added(rows):
        total = np.zeros(length)
        for start, one in rows:
            found = np.frombuffer(one, "<f8")
            total[start : start + len(found)] += found
        return total

    def by_partition(batches):
        part = TaskContext.get().partitionId() % groups
        for start, one in slices(np.asarray(partial(batches), float)):
            yield pd.DataFrame({"part": [part], "start": [start], "sums": [one]})

    def together(batches):
        for start, one in slices(added(row for rows in batches for row in zip(rows["start"], rows["sums"]))):
            yield pd.DataFrame({"start": [start], "sums": [one]})

    parts = df.mapInPandas(by_partition, "part int, start int, sums binary").repartition(groups, "part")
    parts = parts.mapInPandas(together, "start int, sums binary")
    return added((row["start"], row["sums"]) for row in parts.toLocalIterator())


def sum_groups(spark: SparkSession) -> int:
    """Tasks that add up the arrays of all partitions: the square root of the shuffle partitions, sixteen at least."""
    return max(16, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def labels_of(labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """(key, y): the mean label of each key; null keys and labels are left out, repeated rows are averaged."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"))
    return known.filter("key is not null and y is not null").groupBy("key").agg(F.avg("y").alias("y"))
