"""Session helpers: lineage cuts, pinned small tables, key pruning."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

PINNED_ROWS = 100_000
PINNED_BYTES = 32 * 1024 * 1024
#: The setting by which Spark deletes the shuffle files of a query when it ends, and not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that are handed to Python at once; Spark's own limit is 10,000 rows, which token lists make large.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 5 << 20
#: Values of one pushed IN list, and of all lists for one column.
PUSHDOWN_VALUES = 1_000
PUSHDOWN_TOTAL = 20_000


def local_session(app: str = "wordtrawl", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; on a cluster use the session you are given."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        # Push long IN lists to Parquet value by value, not as one min/max range.
        "spark.sql.parquet.pushdown.inFilterThreshold": str(PUSHDOWN_VALUES),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the session names in ``spark.checkpoint.dir``; make a temporary one on a local master only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wordtrawl-checkpoint-")
    context.setCheckpointDir(folder)


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Inside the block the shuffle files of every query go when it ends, so that a chain of them needs the disk of one, and
    Python gets rows in small batches."""
    before = {name: spark.conf.get(name, None) for name in (SHUFFLE_CLEANUP, BATCH_LIMIT)}
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    if before[BATCH_LIMIT] is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder, so a lost executor costs a read and not a re-run.

    What was shuffled on the way is not needed again and goes at once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with lean(df.sparkSession):
        return df.checkpoint(eager=True)


@dataclass(frozen=True)
class Pinned:
    """A measured table: either held as literal rows on the driver (``rows`` set) or left as it was."""

    df: DataFrame
    rows: pa.Table | None

    def values(self, column: str) -> list | None:
        """Distinct values of a column or of its arrays, or None if they are unknown or too many for a literal list."""
        if self.rows is None:
            return None
        values = self.rows[column]
        distinct = pc.unique(pc.list_flatten(values) if pa.types.is_list(values.type) else values)
        return distinct.to_pylist() if len(distinct) <= PUSHDOWN_TOTAL else None


def literal_rows(spark: SparkSession, rows: pa.Table, schema: StructType) -> Pinned:
    """Rows at hand as a table marked for broadcast."""
    return Pinned(F.broadcast(spark.createDataFrame(rows, schema)), rows)


def pinned_rows(spark: SparkSession, rows: list[tuple], schema: str) -> Pinned:
    """Rows that were put together on the driver, held there and marked for broadcast."""
    struct = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(struct)
    types = [to_arrow_type(field.dataType) for field in struct]
    return literal_rows(spark, pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=struct.names), struct)


def pin(table: DataFrame | Pinned, source: Pinned | None = None) -> Pinned:
    """Measure a query-sized table and, if it is small, turn it into literal rows marked for broadcast.

    With a ``source`` that bounds it (no more rows than the source has values) the table needs no measuring: it is fetched
    if the source is at hand, and left as it is otherwise.

    Rows and bytes are added up on the executors first; only a table within both limits is fetched. A larger one stays a
    plan, its joins shuffle, and AQE splits skew.
    """
    if isinstance(table, Pinned):
        return table
    if source is not None:
        return Pinned(table, None) if source.rows is None else literal_rows(table.sparkSession, table.toArrow(), table.schema)
    size = F.octet_length(F.to_json(F.struct("*")))
    measured = table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    if measured["rows"] > PINNED_ROWS or measured["bytes"] > PINNED_BYTES:
        return Pinned(table, None)
    return literal_rows(table.sparkSession, table.toArrow(), table.schema)


def derived(side: DataFrame, source: Pinned) -> DataFrame:
    """Mark for broadcast what is computed from a pinned table and cannot have more rows than it has values."""
    return side if source.rows is None else F.broadcast(side)


def _in_list(column: str, values: list) -> Column:
    """``column`` IN values. Plain strings are written as SQL text, which is parsed far faster than literals are made."""
    plain = [v for v in values if isinstance(v, str) and not set(v) & set("'\\$")]
    others = [v for v in values if not isinstance(v, str) or set(v) & set("'\\$")]
    parts = [F.expr(f"`{column}` IN ({','.join(f"'{v}'" for v in plain)})")] if plain else []
    return reduce(Column.__or__, parts + ([F.col(column).isin(others)] if others else []))


def prune_to_keys(table: DataFrame, keys: Pinned, column: str, key: str | None = None) -> DataFrame:
    """Filter ``table`` to the values of a pinned table's ``key`` column, so that the scan skips row groups.

    Many values become several IN lists, each short enough to be pushed down exactly. Where the keys are not at hand, or so
    many that a scan finds some in every row group, the table is returned as it is, and the join that follows does the work.
    """
    values = keys.values(key or column)
    if values is None:
        return table
    values = sorted(v for v in values if v is not None)
    lists = [_in_list(column, values[i : i + PUSHDOWN_VALUES]) for i in range(0, len(values), PUSHDOWN_VALUES)]
    return table.filter(reduce(Column.__or__, lists, F.lit(False)) if len(lists) != 1 else lists[0])


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """Spread a table that comes in fewer splits than there are cores over all of them, by key; large inputs pass."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(2 * cores, *keys) if table.rdd.getNumPartitions() < cores else table


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder next to the checkpoints, on storage that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/wordtrawl-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever storage it lies."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder that is gone at the end of the block, whether it ends well or not."""
    folder = scratch_folder(spark)
    try:
        yield folder
    finally:
        remove_folder(spark, folder)
