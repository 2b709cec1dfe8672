"""Join of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, by a MinHash LSH forest.

* Texts with equal shingle sets are one node, so copies cost one entry however many there are.
* A node's signature has ``TREES`` labels of ``DEPTH`` minima. A tree is the list of its labels in sorted order, stored with the
  longest prefix that each label shares with a neighbour: the branches of a prefix trie are runs of that list, and a label
  takes part in a branch of length ``depth`` only if it shares so much.
* Whole labels are matched first; then the matched prefix is shortened by one minimum at a time, for pairs not seen before,
  until the estimated recall reaches ``RECALL``. The estimate weighs every link verified so far below ``SIMILARITY`` +
  ``BAND`` by the chance of finding it at this length, plus one link at exactly the similarity asked for: without any evidence
  that is the recall of the hardest links.
* A bucket is dealt into blocks of about ``BLOCK`` nodes and worked on by pairs of blocks, so that no task gets a whole large
  bucket. A pair is looked at only in the first tree that it shares, and only if its signatures agree enough for the
  similarity to be possible. What remains is verified on the full shingle sets.
* A pair of blocks returns the number of links of each of its nodes and a star per connected group, never the pairs. The
  stars are joined to classes by alternating large-star and small-star steps.

Words are lower-cased runs of visible characters. Defined cases: a text of one to four words is one shingle; a null or empty
text has none, links with nothing and is a class of its own; repeated rows are copies of each other; a class has the
smallest non-null id of its rows, or null.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtrawl.llm.common import ship, small_or_shuffled, stored

SHINGLE = 5
SIMILARITY = 0.8
TREES, DEPTH = 16, 6
RECALL = 0.999
BAND = 0.05
BLOCK = 256
#: Rows of pairs of blocks that one task gets at a time, and shingles.
TASK_ROWS, TASK_SHINGLES = 4096, 2_000_000
REMEMBERED = 200_000
#: Standard deviations by which agreeing minima may fall short of the similarity before a pair is given up.
SLACK = 5.0
_RANDOM = np.random.default_rng(17)
_FACTORS = (_RANDOM.integers(0, 2**31, TREES * DEPTH, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_WORDS: dict[bytes, int] = {}


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    words = (text or "").lower().encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = list(map(_WORDS.get, words))
    if None in hashes:
        if len(_WORDS) > REMEMBERED:
            _WORDS.clear()
        for word in words:
            if word not in _WORDS:
                _WORDS[word] = xxhash.xxh64_intdigest(word)
        hashes = list(map(_WORDS.__getitem__, words))
    h = np.array(hashes, np.uint64)
    width = min(SHINGLE, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k : len(h) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _forget() -> None:
    """Free what a Python worker would otherwise hold after its task."""
    _WORDS.clear()
    pa.default_memory_pool().release_unused()


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of all hash functions."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 2048):
        np.minimum(out, (low[start : start + 2048, None] * _FACTORS + _SHIFTS).min(axis=0), out=out)
    # Spread the minima, whose first bits are all alike.
    out *= np.uint32(0x85EBCA6B)
    return out ^ out >> np.uint32(15)


def found_share(similarity, depth: int):
    """Probability that a pair shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def unfound(similarity, depth: int):
    """Pairs expected to share no prefix of ``depth`` for each pair that shares one."""
    return 1 / found_share(similarity, depth) - 1


def estimated_recall(links: list[DataFrame], similarity: float, depth: int) -> float:
    """Share of the links found by prefixes down to ``depth``, judged by those found that are hardest to find."""
    weak, missed = 1.0, unfound(similarity, depth)
    for one in links:
        sums = one.agg(F.sum("weak"), F.sum(F.get("missed", F.lit(depth - 1)))).first()
        weak, missed = weak + (sums[0] or 0), missed + (sums[1] or 0.0)
    return weak / (weak + missed)


def signed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(key, node, sig) of every row, stored; the node is a hash of the shingle set, null for an empty one."""
    ship(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()

    def sign(batches):
        for batch in batches:
            found = [shingles(body.as_py()) for body in batch.column("body")]
            nodes = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in found]
            sigs = [signature(s).astype("<u4").tobytes() if len(s) else None for s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())], names=["key", "node", "sig"]
            )
        _forget()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    return stored(rows.mapInArrow(sign, f"key {key_type}, node binary, sig binary"))


def shared_prefixes(batches):
    """Add to sorted (tree, label, node) the longest prefix, in minima, that a label shares with the one before or after.

    The neighbours of a task's first and last row are in other tasks, so these two count as sharing all.
    """

    def measured(rows: pa.Table, left: int, right: int | None) -> np.ndarray:
        labels = np.frombuffer(b"".join(rows.column("label").to_pylist()), "<u4").reshape(-1, DEPTH)
        trees = rows.column("tree").to_numpy()
        same = (labels[1:] == labels[:-1]) & (trees[1:] == trees[:-1])[:, None]
        between = np.logical_and.accumulate(same, axis=1).sum(axis=1)
        return np.maximum(np.append(left, between), np.append(between, 0 if right is None else right))

    # The last row of a batch waits for the next batch, and is put before it.
    waiting, left = None, DEPTH
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if waiting is None else pa.concat_tables([waiting, rows])
        found = measured(rows, left, None)
        waiting, left = rows.slice(rows.num_rows - 1), int(found[-1]) if rows.num_rows > 1 else left
        ready = rows.slice(0, rows.num_rows - 1).append_column("shared", pa.array(found[:-1], pa.int32()))
        yield from ready.combine_chunks().to_batches()
    if waiting is not None:
        yield from waiting.append_column("shared", pa.array([DEPTH], pa.int32())).combine_chunks().to_batches()


def forest(nodes: DataFrame) -> DataFrame:
    """(tree, label, node, shared): the sorted labels of all trees of nodes (node, sig), stored.

    Labels that share not even one minimum with another are left out: no prefix of theirs matches.
    """
    width = 4 * DEPTH
    labels = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(t.alias("tree"), F.substring(F.col("sig"), t * width + 1, F.lit(width)).alias("label")),
    )
    order = "tree", "label", "node"
    places = nodes.select("node", F.inline(labels)).select(*order)
    places = places.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(places.mapInArrow(shared_prefixes, "tree int, label binary, node binary, shared int").filter("shared > 0"))


def candidate_pairs(sigs: np.ndarray, tree: int, depth: int, before: int | None, similarity: float) -> np.ndarray:
    """Matrix of the pairs of a bucket that are first met in this tree and could be similar enough."""
    labels = sigs.reshape(len(sigs), TREES, DEPTH)
    ok = ~np.eye(len(sigs), dtype=bool)
    for t in range(tree):
        ok &= ~(labels[:, None, t, :depth] == labels[None, :, t, :depth]).all(axis=2)
    for t in range(TREES if before else 0):
        ok &= ~(labels[:, None, t, :before] == labels[None, :, t, :before]).all(axis=2)
    if ok.any():
        n = TREES * DEPTH
        least = similarity - SLACK * (similarity * (1 - similarity) / n) ** 0.5
        a, b = np.nonzero(np.triu(ok))
        for start in range(0, len(a), 20_000):
            x, y = a[start : start + 20_000], b[start : start + 20_000]
            far = (sigs[x] == sigs[y]).mean(axis=1) < least
            ok[x[far], y[far]] = ok[y[far], x[far]] = False
    return ok


def intersections(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the wanted pairs; other entries may be left at 0."""
    out = np.zeros(pairs.shape)
    a, b = np.nonzero(np.triu(pairs))
    if len(a) <= 2 * len(sets):
        for x, y in zip(a.tolist(), b.tolist()):
            out[x, y] = out[y, x] = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        return out
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        x = np.zeros((len(sets), 4096), np.float32)
        i, j = np.searchsorted(column, [first, first + 4096])
        x[owner[i:j], column[i:j] - first] = 1
        out += x @ x.T
    return out


def roots_of(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each node's connected group."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(root)).min(axis=1, initial=len(root))
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _bucket_runs(table: pa.Table):
    """Rows of each pair of blocks in a task's table."""
    table = table.sort_by([("bucket", "ascending"), ("low", "ascending"), ("high", "ascending")])
    marks = [table.column(c).to_numpy() for c in ("bucket", "low", "high")]
    changed = reduce(np.logical_or, [m[1:] != m[:-1] for m in marks], np.zeros(max(0, table.num_rows - 1), bool))
    starts = np.append(0, np.flatnonzero(changed) + 1)
    for a, b in zip(starts.tolist(), np.append(starts[1:], table.num_rows).tolist()):
        if b - a > 1:
            yield table.slice(a, b - a)


def _candidates(run: pa.Table, depth: int, before: int | None, similarity: float) -> np.ndarray:
    sigs = np.frombuffer(b"".join(run.column("sig").to_pylist()), "<u4").reshape(run.num_rows, -1)
    ok = candidate_pairs(sigs, run.column("tree")[0].as_py(), depth, before, similarity)
    if run.column("low")[0].as_py() != run.column("high")[0].as_py():
        block = run.column("block").to_numpy()
        ok &= block[:, None] != block[None, :]
    return ok


def matched(
    trees: DataFrame, nodes: DataFrame, depth: int, before: int | None, docs: DataFrame, similarity: float, text: str, key: str
) -> DataFrame:
    """(node, root, links, weak, missed): what prefixes of length ``depth`` match among nodes (node, rep, n, sig), stored.

    ``links`` counts rows linked to a row of the node; ``weak`` are links below ``similarity`` + ``BAND`` and ``missed``, for a
    prefix of each length, how many links go unfound for those that are found.
    """
    branch = F.xxhash64("tree", F.substring("label", 1, 4 * depth)).alias("bucket")
    places = trees.filter(F.col("shared") >= depth).select("node", "tree", branch)
    shared = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = places.join(shared, "bucket").withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = stored(
        members.select(
            "bucket", "tree", "node", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
        )
    )

    def dealt(rows: DataFrame, parts: int) -> DataFrame:
        return rows.withColumn("task", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(parts)))

    def promising(table: pa.Table) -> pa.Table:
        kept = []
        for run in _bucket_runs(table):
            some = _candidates(run, depth, before, similarity).any(axis=1)
            if some.any():
                kept.append(run.filter(pa.array(some)))
        kept = pa.concat_tables(kept) if kept else table.slice(0, 0)
        return kept.select(["bucket", "tree", "node", "block", "low", "high", "n", "sig"])

    columns = "bucket bigint, tree int, node binary, block int, low int, high int, n bigint, sig binary"
    rows = members.join(nodes.select("node", "n", "sig"), "node")
    rows = dealt(rows, max(1, members.count() // TASK_ROWS))
    rows = stored(rows.groupBy("task").applyInArrow(promising, columns))

    wanted = stored(rows.select("node").distinct().join(nodes.select("node", "rep"), "node"))
    reps = small_or_shuffled(wanted.select("rep").distinct())
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("body")).join(reps, F.col("key").eqNullSafe(F.col("rep")), "left_semi")

    def shingled(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                found = [shingles(body.as_py()) for body in batch.column("body").slice(start, 100)]
                found = [s for s in found if len(s)]
                nodes = pa.array([xxhash.xxh128_digest(s.tobytes()) for s in found], pa.binary())
                sizes = pa.array([len(s) for s in found], pa.int32())
                sets = pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())
                yield pa.RecordBatch.from_arrays([nodes, sizes, sets], names=["node", "n_shingles", "shingles"])
        _forget()

    sets = texts.select("body").mapInArrow(shingled, "node binary, n_shingles int, shingles binary")
    sets = sets.join(wanted.select("node"), "node", "left_semi")
    sets = stored(sets.groupBy("node").agg(F.any_value("n_shingles").alias("n_shingles"), F.any_value("shingles").alias("shingles")))

    def verified(table: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list, list] = [], [], [], [], []
        for run in _bucket_runs(table):
            ok = _candidates(run, depth, before, similarity)
            found = [np.frombuffer(s, "<u8") for s in run.column("shingles").to_pylist()]
            sizes = np.array([len(s) for s in found])
            both = intersections(found, ok)
            ratio = both / (sizes[:, None] + sizes[None, :] - both)
            linked = ok & (ratio >= similarity)
            some = linked.any(axis=1)
            if not some.any():
                continue
            node, n = run.column("node").to_pylist(), run.column("n").to_numpy()
            root = roots_of(linked)
            weak = linked & (ratio < similarity + BAND)
            for i in np.flatnonzero(some).tolist():
                out[0].append(node[i])
                out[1].append(node[root[i]])
                out[2].append(int(n[linked[i]].sum()))
                out[3].append(int(weak[i].sum()))
                out[4].append([float(unfound(ratio[i][weak[i]], d).sum()) for d in range(1, DEPTH + 1)])
        types = pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.float64())
        names = "node", "root", "links", "weak", "missed"
        return pa.table({name: pa.array(values, t) for name, values, t in zip(names, out, types)})

    rows = rows.join(sets, "node")
    load = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("n_shingles").alias("shingles")).first()
    parts = max(1, load["rows"] // TASK_ROWS, (load["shingles"] or 0) // TASK_SHINGLES)
    columns = "node binary, root binary, links bigint, weak bigint, missed array<double>"
    return stored(dealt(rows, parts).groupBy("task").applyInArrow(verified, columns))


def classes(edges: DataFrame) -> DataFrame:
    """(u, v): the smallest node of its connected group for every node that has a smaller one, from edges (u, v)."""
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        end = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = large.join(least, "u").select(end.alias("u"), F.col("m").alias("v"))
        new = stored(small.filter("u != v").distinct())
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            return new
        edges = new


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, class_id, set_id, n_links), one row per row of ``docs``.

    ``class_id`` is the smallest key of the connected group, ``set_id`` that of the rows with the same shingle set, ``n_links``
    the number of other rows at ``similarity`` or more.
    """
    rows = signed(docs, text, key)
    known = rows.filter("node is not null")
    nodes = known.groupBy("node").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("n"), F.any_value("sig").alias("sig"))
    nodes = stored(nodes)
    trees, found = forest(nodes), []
    for depth in range(DEPTH, 0, -1):
        found.append(matched(trees, nodes, depth, depth + 1 if found else None, docs, similarity, text, key))
        if estimated_recall(found, similarity, depth) >= recall:
            break
    links = reduce(DataFrame.union, found)
    group = classes(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = links.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = nodes.drop("sig").join(group.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "node")).join(links, "node", "left")
    least = nodes.groupBy("root").agg(F.min("rep").alias("class_id"))
    nodes = nodes.join(least, "root").select(
        "node", "class_id", F.col("rep").alias("set_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    joined = rows.select("key", "node").join(stored(nodes), "node", "left")
    return joined.select(
        F.col("key").alias(key),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("set_id")).alias("set_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )
