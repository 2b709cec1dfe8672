"""Approximate nearest neighbours by cosine: one hierarchical navigable small-world graph per shard.

Equal vectors are one node: a class with its smallest id and its few smallest members, so any number of copies neither
tears a graph apart nor fills an answer. Classes fall by hash into shards of about ``SHARD`` nodes. A shard's graph is built
in one task and stored as one row of flat arrays (vectors, links of the ground layer, links of the layers above); the table
of rows is the index. A search sends every query to every shard, in blocks of queries, and merges what the shards found.
The searched candidates are scored by the exact cosine in double precision.

Defined cases: null, zero, null-holding and non-finite vectors take no part, neither do vectors of another length than most
rows have (of equally many, the longer); a null id takes no part; repeated rows of one id are one candidate if their vectors
are equal, else one each; fewer candidates than asked for are all returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordtrawl.llm.common import ship, stored

SHARD = 8192
#: Links of a node above the ground and, twice as many, on it.
LINKS = 16
BUILD_WIDTH = 80
SEARCH_WIDTH = 96
QUERY_BLOCK = 2048


class Graph:
    """A navigable small world over the rows of ``vectors``, which have length 1."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS):
        self.vectors, self.links = vectors, links
        n = len(vectors)
        self.ground = np.full((n, 2 * links), -1, np.int32)
        self.upper: list[dict[int, np.ndarray]] = []
        self.entry = 0
        self.seen, self.round = np.zeros(n, np.int32), 0

    def _row(self, level: int, node: int) -> np.ndarray:
        return self.ground[node] if level == 0 else self.upper[level - 1][node]

    def _search(self, query: np.ndarray, start: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest nodes found on a layer, as (distance, node), nearest first."""
        self.round += 1
        seen, mark = self.seen, self.round
        seen[[node for _, node in start]] = mark
        open_, best = list(start), [(-d, node) for d, node in start]
        heapq.heapify(open_)
        heapq.heapify(best)
        while open_:
            distance, node = heapq.heappop(open_)
            if len(best) >= width and distance > -best[0][0]:
                break
            near = self._row(level, node)
            near = near[near >= 0]
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            for d, other in zip((1 - self.vectors[near] @ query).tolist(), near.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-d, other))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, other))
                else:
                    continue
                heapq.heappush(open_, (d, other))
        return sorted((-d, node) for d, node in best)

    def _spread(self, found: list[tuple[float, int]], count: int) -> list[int]:
        """Nearest first, those that are nearer to the node than to any kept one; then the nearest of the rest."""
        nodes = [node for _, node in found]
        if len(nodes) <= count:
            return nodes
        rows = self.vectors[nodes]
        between = 1 - rows @ rows.T
        kept: list[int] = []
        nearest = np.full(len(nodes), np.inf)
        for i, (distance, _) in enumerate(found):
            if distance < nearest[i]:
                kept.append(i)
                if len(kept) == count:
                    break
                np.minimum(nearest, between[i], out=nearest)
        chosen = set(kept)
        kept += [i for i in range(len(nodes)) if i not in chosen][: count - len(kept)]
        return [nodes[i] for i in kept]

    def _link(self, level: int, node: int, other: int) -> None:
        row = self._row(level, node)
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = other
            return
        nodes = np.append(row, other)
        distance = 1 - self.vectors[nodes] @ self.vectors[node]
        order = np.argsort(distance, kind="stable")
        row[:] = self._spread([(float(distance[i]), int(nodes[i])) for i in order], len(row))

    def build(self, seed: int, width: int = BUILD_WIDTH) -> Graph:
        n = len(self.vectors)
        levels = np.minimum((-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(self.links)).astype(int), 16)
        for node in range(n):
            level, query = int(levels[node]), self.vectors[node]
            top = len(self.upper)
            for k in range(1, level + 1):
                if k > top:
                    self.upper.append({})
                self.upper[k - 1][node] = np.full(self.links, -1, np.int32)
            if node == 0:
                continue
            found = [(float(1 - self.vectors[self.entry] @ query), self.entry)]
            for k in range(top, level, -1):
                found = self._search(query, found, 1, k)
            for k in range(min(level, top), -1, -1):
                found = self._search(query, found, width, k)
                chosen = self._spread(found, self.links)
                self._row(k, node)[: len(chosen)] = chosen
                for other in chosen:
                    self._link(k, other, node)
            if level > top:
                self.entry = node
        return self

    def nearest(self, query: np.ndarray, width: int = SEARCH_WIDTH) -> list[int]:
        found = [(float(1 - self.vectors[self.entry] @ query), self.entry)]
        for k in range(len(self.upper), 0, -1):
            found = self._search(query, found, 1, k)
        return [node for _, node in self._search(query, found, width, 0)]

    def flat(self) -> dict:
        """Entry and flat arrays: ground links; node numbers of each upper layer and their links."""
        sizes = [len(layer) for layer in self.upper]
        nodes = np.array([n for layer in self.upper for n in layer], "<i4")
        links = np.array([row for layer in self.upper for row in layer.values()], "<i4").reshape(-1, self.links)
        return {
            "entry": self.entry, "links": self.links, "layer_sizes": np.array(sizes, "<i4").tobytes(),
            "layer_nodes": nodes.tobytes(), "layer_links": links.tobytes(), "ground": self.ground.astype("<i4").tobytes(),
        }

    @classmethod
    def from_flat(cls, vectors: np.ndarray, row: dict) -> Graph:
        graph = cls(vectors[:0], row["links"])
        graph.vectors, graph.entry = vectors, row["entry"]
        graph.seen = np.zeros(len(vectors), np.int32)
        graph.ground = np.frombuffer(row["ground"], "<i4").reshape(len(vectors), -1)
        nodes = np.frombuffer(row["layer_nodes"], "<i4").tolist()
        links, at = np.frombuffer(row["layer_links"], "<i4").reshape(-1, row["links"]), 0
        for size in np.frombuffer(row["layer_sizes"], "<i4").tolist():
            graph.upper.append(dict(zip(nodes[at : at + size], links[at : at + size])))
            at += size
        return graph


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def exact_cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision, each row added up in the same order."""
    top = np.abs(rows).max(axis=1, keepdims=True)
    rows, query = rows / top, query / np.abs(query).max()
    return (rows * query).sum(axis=1) / np.sqrt((rows * rows).sum(axis=1)) / np.sqrt((query * query).sum())


def classes_of(table: DataFrame, key: str, vector: str, members: int) -> tuple[DataFrame, DataFrame]:
    """(class, rep, vec) of distinct valid vectors, and (class, id) of their smallest ids, at most ``members`` each."""
    valid = table.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    valid = valid.filter("id is not null and size(vec) > 0")
    valid = valid.filter(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    )
    length = valid.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    valid = valid.filter(F.size("vec") == (length["n"] if length else 0))
    text = F.concat_ws(",", F.transform("vec", lambda x: (x + 0.0).cast("string")))
    valid = stored(valid.withColumn("class", F.md5(text)))
    classes = valid.groupBy("class").agg(F.min("id").alias("rep"), F.any_value("vec").alias("vec"))
    place = F.row_number().over(Window.partitionBy("class").orderBy("id"))
    smallest = valid.select("class", "id").distinct().withColumn("place", place).filter(F.col("place") <= members)
    return classes, smallest.drop("place")


_INDEX = (
    "shard int, reps binary, vectors binary, entry int, links int, layer_sizes binary, layer_nodes binary, layer_links binary, ground binary"
)


def build_index(classes: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """One row of flat arrays per shard, stored; every class is indexed."""
    ship(classes.sparkSession)
    shards = max(1, -(-classes.count() // shard_size))

    def built(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        reps = table.column("rep").to_numpy()
        vectors = table.column("vec").combine_chunks().flatten().to_numpy().reshape(len(reps), -1)
        row = Graph(unit(vectors)).build(int(reps[0])).flat()
        shard = table.column("shard")[0].as_py()
        row = {"shard": shard, "reps": reps.astype("<i8").tobytes(), "vectors": vectors.astype("<f8").tobytes()} | row
        types = {"shard": pa.int32(), "entry": pa.int32(), "links": pa.int32()}
        return pa.table({name: pa.array([value], types.get(name, pa.binary())) for name, value in row.items()})

    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))
    return stored(dealt.select("shard", "rep", "vec").groupBy("shard").applyInArrow(built, _INDEX))


def search_index(index: DataFrame, queries: DataFrame, count: int, width: int = SEARCH_WIDTH, block: int = QUERY_BLOCK) -> DataFrame:
    """(query, rep, score): of every query (query, vec), each shard's ``count`` nearest classes by exact cosine."""
    ship(index.sparkSession)
    blocks = max(1, -(-queries.count() // block))
    shards = [row["shard"] for row in index.select("shard").collect()]

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = [], [], []
        if left.num_rows and right.num_rows:
            row = left.to_pylist()[0]
            reps = np.frombuffer(row["reps"], "<i8")
            vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(reps), -1)
            graph = Graph.from_flat(unit(vectors), row)
            wanted = right.column("vec").combine_chunks().flatten().to_numpy().reshape(right.num_rows, -1)
            for query, exact, near in zip(right.column("query").to_pylist(), wanted, unit(wanted)):
                nodes = np.array(graph.nearest(near, width))
                scores = exact_cosine(exact, vectors[nodes])
                for i in np.lexsort((reps[nodes], -scores))[:count]:
                    found[0].append(query)
                    found[1].append(int(reps[nodes[i]]))
                    found[2].append(float(scores[i]))
        types = {"query": pa.int64(), "rep": pa.int64(), "score": pa.float64()}
        return pa.table({name: pa.array(values, t) for (name, t), values in zip(types.items(), found)})

    by_block = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.array(*[F.lit(s).cast("int") for s in shards]) if shards else F.expr("array(0)")))
    keys = "shard", "block"
    return by_block.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(searched, "query bigint, rep bigint, score double")


def nearest(table: DataFrame, is_query: F.Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest other rows of every row that ``is_query`` (of ``id``) selects."""
    classes, members = classes_of(table, key, vector, k + 1)
    classes, members = stored(classes), stored(members)
    index = build_index(classes)
    valid = table.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    text = F.concat_ws(",", F.transform("vec", lambda x: (x + 0.0).cast("string")))
    asking = valid.filter("id is not null").filter(is_query).select(F.col("id").alias("query_id"), F.md5(text).alias("class")).distinct()
    asking = stored(asking.join(classes.select("class", "rep"), "class"))
    queries = stored(asking.select("rep").distinct().join(classes, "rep").select(F.col("rep").alias("query"), "vec"))
    # k + 1 classes and k + 1 members each hold the k nearest rows besides the query's own, ties included.
    order = F.desc("score"), F.col("rep")
    found = search_index(index, queries, k + 1)
    found = found.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("place") <= k + 1)
    ids = found.join(classes.select("rep", "class"), "rep").join(members, "class").select("query", "id", "score")
    order = F.desc("score"), F.col("id")
    ids = ids.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("place") <= k + 1)
    answers = asking.select("query_id", F.col("rep").alias("query")).join(ids, "query").filter("id != query_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
