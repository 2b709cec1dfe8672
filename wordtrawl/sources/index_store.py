"""A search index as Parquet tables, sorted by the keys that queries look up.

Cut points come from the frequencies of the terms and include the document id, so the postings of a very frequent term spread
over several files. Rows are sorted, so min/max statistics let a lookup skip nearly all row groups; positions are a column
that retrieval never reads. A large index also has its files in directories by key range, which lookups choose by name.

An index consists of segments, each under a path of its own and never rewritten. The segment that was added last holds the
dictionaries of all, and a manifest that names the others.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtrawl.operators.postings import BLOCK, PLACE, PLACE_RANGE, doc_frequency, unpacked
from wordtrawl.sources.key_ranges import KEY_RANGE, cut_points, place_among, range_keys, weighted_keys

DOC_BLOCK = 10_000_000
#: Rows that one task sorts and writes; some tens of megabytes of a shuffle, whatever the size of the index.
ROWS_PER_FILE = 2_000_000
#: Files that make up a key range, and so a directory.
FILES_PER_RANGE = 320
#: A table smaller than this times the cores is cut into fewer files than there are cores.
ROWS_PER_CORE = 50_000


@dataclass(frozen=True)
class SearchIndex:
    """The tables of one index.

    docs(doc_id, url, disk_loc, seq), postings(term, doc_id, tf, positions), bigrams(t1, t2, doc_id, tf, positions),
    terms(term, df), pairs(t1, t2, df); ``n_docs`` counts every indexed document. ``pages``(url, seq, sig, doc_id) has a row
    for every URL that was ever offered, with its signature, and without an id if the page fell as a near-duplicate.

    ``starts`` are the first document ids of the segments, ``paths`` where they are stored; a page is named by its segment and
    its ``seq``. Tables of a ranged index have the column ``key_range`` as well; ``term_ranges`` and ``pair_ranges`` cut it.
    """

    docs: DataFrame
    postings: DataFrame
    bigrams: DataFrame
    terms: DataFrame
    pairs: DataFrame
    n_docs: int
    pages: DataFrame | None = None
    near_threshold: float | None = None
    starts: tuple[int, ...] = (0,)
    paths: tuple[str, ...] = ()
    term_ranges: tuple[str, ...] = ()
    pair_ranges: tuple[str, ...] = ()


def doc_block(doc_id: Column) -> Column:
    """The partition of the stored document map that holds an id."""
    return F.floor(doc_id / F.lit(DOC_BLOCK)).cast("int")


def write_docs(docs: DataFrame, path: str) -> None:
    """Write the document map in blocks of ids, which a join with a result list prunes at run time."""
    blocked = docs.withColumn("doc_block", doc_block(F.col("doc_id")))
    blocked = blocked.repartitionByRange("doc_block", "doc_id").sortWithinPartitions("doc_block", "doc_id")
    blocked.write.mode("overwrite").partitionBy("doc_block").parquet(path)


def read_docs(spark: SparkSession, path: str, seq: str | None = None) -> DataFrame:
    """The document map; with the type of ``seq`` given it may have no rows."""
    reader = spark.read if seq is None else spark.read.schema(f"doc_id bigint, url string, disk_loc string, seq {seq}, doc_block int")
    return reader.parquet(path)


def parts_for(spark: SparkSession, rows: int, rows_per_file: int) -> int:
    """Files for a table: as many as their size asks for, and enough for the cores if there are rows enough."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-rows // rows_per_file), min(cores, rows // ROWS_PER_CORE))


def _write_ranged(
    table: DataFrame, path: str, keys: list[str], points: list[tuple[str, int]], ranges: tuple[str, ...], rows_per_file: int
) -> None:
    """One part between two cut points of (first key, doc_id) per task, sorted, in directories by key range if there are any.

    A table that was built for these points brings its places along. Packed, its rows are sorted as they are unpacked; only
    directories ask Spark for an order.
    """
    if BLOCK in table.columns:
        rows = unpacked(table.repartitionById(len(points) + 1, F.col(PLACE)), tuple(keys), ranges)
        if ranges:
            rows = rows.withColumnRenamed(PLACE_RANGE, KEY_RANGE).sortWithinPartitions(KEY_RANGE, *keys, "doc_id")
        writer = rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
        (writer.partitionBy(KEY_RANGE) if ranges else writer).parquet(path)
        return
    known = PLACE in table.columns
    place = F.col(PLACE) if known else place_among(points, F.col(keys[0]), F.col("doc_id"))
    placed = table.repartitionById(len(points) + 1, place)
    order = [*keys, "doc_id"]
    if ranges:
        placed = placed.withColumn(KEY_RANGE, F.col(PLACE_RANGE) if known else place_among(list(ranges), F.col(keys[0])))
        order.insert(0, KEY_RANGE)
    placed = placed.drop(PLACE, PLACE_RANGE)
    writer = placed.sortWithinPartitions(*order).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(KEY_RANGE) if ranges else writer).parquet(path)


@dataclass(frozen=True)
class Layout:
    """Where the rows of one table are cut: into parts by (key, id), and into ranges by key."""

    points: list[tuple[str, int]]
    ranges: tuple[str, ...] = ()


def plan_layout(
    dictionary: DataFrame, key: str, weight: str, ids: int, first_id: int = 0, rows_per_file: int = ROWS_PER_FILE,
    files_per_range: int = FILES_PER_RANGE,
) -> Layout:
    """Cut points from a dictionary of keys and the number of rows of each; approximate numbers do."""
    rows = dictionary.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("rows")).first()["rows"]
    parts = parts_for(dictionary.sparkSession, rows, rows_per_file)
    weights = weighted_keys(dictionary, key, weight, parts) if parts > 1 else []
    ranges = -(-rows // rows_per_file) // files_per_range
    return Layout(cut_points(weights, parts, ids, first_id), tuple(range_keys(weights, ranges)) if ranges > 1 else ())


def _own_layout(table: DataFrame, key: str, rows_per_file: int) -> Layout:
    frequencies = doc_frequency(table, key)
    ids = table.agg(F.coalesce(F.max("doc_id") + 1, F.lit(0)).alias("ids")).first()["ids"]
    return Layout(plan_layout(frequencies, key, "df", ids, rows_per_file=rows_per_file).points)


def write_postings(postings: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, layout: Layout | None = None) -> None:
    layout = layout or _own_layout(postings, "term", rows_per_file)
    _write_ranged(postings, path, ["term"], layout.points, layout.ranges, rows_per_file)


def _read_sorted(spark: SparkSession, schema: str | None, *paths: str) -> DataFrame:
    """Sorted tables are pruned by the minima and maxima of row groups; finer filters would test every value of a list again."""
    finer = {f"parquet.filter.{kind}.enabled": "false" for kind in ("dictionary", "columnindex", "bloom")}
    reader = spark.read.options(**finer) if schema is None else spark.read.options(**finer).schema(schema)
    if schema is None or KEY_RANGE not in schema:
        return reader.parquet(*paths)
    return reduce(DataFrame.unionByName, [reader.parquet(path) for path in paths])


def read_postings(spark: SparkSession, path: str, with_positions: bool = True) -> DataFrame:
    postings = _read_sorted(spark, None, path)
    return postings if with_positions else postings.drop("positions")


def write_bigrams(bigrams: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, layout: Layout | None = None) -> None:
    layout = layout or _own_layout(bigrams, "t1", rows_per_file)
    _write_ranged(bigrams, path, ["t1", "t2"], layout.points, layout.ranges, rows_per_file)


def read_bigrams(spark: SparkSession, path: str) -> DataFrame:
    return _read_sorted(spark, None, path)


def _write_dictionary(table: DataFrame, path: str, keys: list[str]) -> None:
    table.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_dictionary(postings: DataFrame, path: str, keys: list[str], known: DataFrame | None = None) -> None:
    """Count the rows of stored ``postings`` by key, add the dictionary ``known`` (keys, df), and write the sums sorted.

    Rows go to their range of keys as they are and are counted there: stored sorted, they take fewer bytes in one shuffle than
    partial counts in two, one by hash and one by range.
    """
    rows = postings.select(*keys, F.lit(1).cast("bigint").alias("df"))
    rows = rows if known is None else known.select(*keys, "df").unionByName(rows)
    counted = rows.repartitionByRange(*keys).groupBy(*keys).agg(F.sum("df").alias("df"))
    counted.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_terms(terms: DataFrame, path: str) -> None:
    _write_dictionary(terms, path, ["term"])


def write_pairs(pairs: DataFrame, path: str) -> None:
    _write_dictionary(pairs, path, ["t1", "t2"])


def write_pages(pages: DataFrame, path: str) -> None:
    """Write what is known of every URL, sorted by URL, so that a later batch finds its own."""
    pages.select("url", "seq", "sig", "doc_id").repartitionByRange("url").sortWithinPartitions("url").write.mode("overwrite").parquet(path)


def write_manifest(
    spark: SparkSession, path: str, n_docs: int, near_threshold: float | None = None, paths: tuple[str, ...] = (),
    starts: tuple[int, ...] = (0,), term_ranges: tuple[str, ...] = (), pair_ranges: tuple[str, ...] = (),
) -> None:
    """Write the manifest; it comes last and makes the index readable. ``paths`` are the segments before this one."""
    row = (n_docs, near_threshold, list(paths), list(starts), list(term_ranges), list(pair_ranges))
    schema = "n_docs bigint, near_threshold double, paths array<string>, starts array<bigint>, term_ranges array<string>, pair_ranges array<string>"
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def write_index(index: SearchIndex, path: str) -> None:
    """Write all tables of an index under ``path`` as one table each, the manifest last.

    The segments are remembered as ranges of ids; key ranges are not kept.
    """
    flat = lambda table: table.drop(KEY_RANGE)
    write_docs(index.docs.drop("doc_block"), f"{path}/docs")
    write_postings(flat(index.postings), f"{path}/postings")
    write_bigrams(flat(index.bigrams), f"{path}/bigrams")
    write_terms(flat(index.terms), f"{path}/terms")
    write_pairs(flat(index.pairs), f"{path}/pairs")
    write_pages(index.pages, f"{path}/pages")
    write_manifest(index.docs.sparkSession, path, index.n_docs, index.near_threshold, starts=index.starts)


def read_index(spark: SparkSession, path: str) -> SearchIndex:
    """Open a stored index with all its segments. Without a manifest (an unfinished write) this fails."""
    manifest = spark.read.parquet(f"{path}/manifest").first()
    paths = (*manifest["paths"], path)
    pages = spark.read.parquet(*[f"{p}/pages" for p in paths])
    seq = pages.schema["seq"].dataType.simpleString()
    terms, pairs = _read_sorted(spark, None, f"{path}/terms"), _read_sorted(spark, None, f"{path}/pairs")
    ranged = []
    for ranges in (manifest["term_ranges"], manifest["pair_ranges"]):
        ranged.append(f", {KEY_RANGE} int" if ranges else "")
    if manifest["term_ranges"]:
        terms = terms.withColumn(KEY_RANGE, place_among(manifest["term_ranges"], F.col("term")))
    if manifest["pair_ranges"]:
        pairs = pairs.withColumn(KEY_RANGE, place_among(manifest["pair_ranges"], F.col("t1")))
    posting = "doc_id bigint, tf int, positions array<int>"
    return SearchIndex(
        docs=reduce(DataFrame.unionByName, [read_docs(spark, f"{p}/docs", seq) for p in paths]),
        postings=_read_sorted(spark, f"term string, {posting}{ranged[0]}", *[f"{p}/postings" for p in paths]),
        bigrams=_read_sorted(spark, f"t1 string, t2 string, {posting}{ranged[1]}", *[f"{p}/bigrams" for p in paths]),
        terms=terms,
        pairs=pairs,
        n_docs=manifest["n_docs"],
        pages=pages,
        near_threshold=manifest["near_threshold"],
        starts=tuple(manifest["starts"]),
        paths=paths,
        term_ranges=tuple(manifest["term_ranges"]),
        pair_ranges=tuple(manifest["pair_ranges"]),
    )
