"""Best-fit packing planned over a histogram of lengths.

A document becomes its byte-level BPE ids and an end id. Documents up to ``LENGTH`` are one piece; longer ones are cut into
pieces of ``LENGTH`` of which the first takes what is left. Pieces are written down with the number of the task that made them
and their place among that task's pieces of the same length. Counts per length, at most ``LENGTH`` numbers, are all that the
driver sees. It plans best fit by descending length over counts: sequences with the same room are one group, a length goes to
the groups with the least room that holds it, as often into each sequence as it fits, and opens new sequences when no group
has room. That is what best fit does with single documents, and the plan is a short list of runs of equal slots. Then every
piece finds its rank within its length (place plus what earlier tasks have of it, a join on task and length) and takes the
slot of that rank.

Every length's slots are shared by rank, so a length with a third of all pieces is spread like any other. The plan has at
most about ``LENGTH`` x 30 runs, whatever the corpus: a length adds at most three groups, and each use of a group at least
halves its room.

Defined cases: a null or empty text has the end id only; texts of any length are packed whole; special strings in a text become
their ids; repeated rows are packed each; equal lengths are in any order; a null id is kept; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.taskcontext import TaskContext

from wordtrawl.llm.byte_tokens import tokenizer
from wordtrawl.llm.common import ship, stored

LENGTH = 2048
END_ID = 0
ROWS = 500


def plan_slots(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Runs (size, first rank, first sequence, pieces a sequence, offset), sorted by size and rank.

    A piece of a size with rank r in a run lies in sequence ``first + (r - rank) // pieces``, at
    ``offset + size * ((r - rank) % pieces)``. Works on counts alone: its cost does not grow with the number of pieces.
    """
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    runs, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if not groups[room]:
                insort(rooms, room)
            groups[room].append((first, n))

    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
            else:
                room, first, n = length, opened, -(-left // (length // size))
                opened += n
            each = room // size
            full = min(n, left // each)
            if full:
                runs.append((size, rank, first, each, length - room))
                put(room - each * size, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n:
                if left:
                    runs.append((size, rank, first + full, each, length - room))
                    put(room - left * size, first + full, 1)
                    put(room, first + full + 1, n - full - 1)
                    left = 0
                else:
                    put(room, first + full, n - full)
    return sorted(runs)


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, size) of a document's pieces: only documents longer than a sequence are cut, the first piece may be shorter."""
    head = n % length
    return [(0, head)] * (head > 0) + [(start, length) for start in range(head, n, length)]


def tokenized_pieces(
    docs: DataFrame, ranks: bytes, pattern: str, special: tuple = (), text: str = "text", key: str = "doc_id",
    length: int = LENGTH, with_ids: bool = True,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, part, place, ids): pieces as they come, written down.

    ``place`` counts a task's pieces of one length; the written rows are what later steps go by, so a task that runs again
    cannot change a place.
    """
    key_type = docs.schema[key].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()
    names = ("piece", "start", "length", "ids_crc32", "part", "place")

    def tokenize(batches):
        worker = tokenizer(ranks, pattern, special)
        part = TaskContext.get().partitionId()
        places: dict[int, int] = defaultdict(int)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                some = batch.slice(first, ROWS)
                owner, rows, kept = [], [], []
                for i, body in enumerate(some.column("body")):
                    ids = worker.encode(body.as_py() or "") + end
                    for piece, (start, size) in enumerate(cut(len(ids) // 4, length)):
                        own = ids[4 * start : 4 * (start + size)]
                        rows.append((piece, start, size, zlib.crc32(own), part, places[size]))
                        places[size] += 1
                        owner.append(i)
                        kept.append(own if with_ids else None)
                columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * len(names))]
                keys = some.column("key").take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, *columns, pa.array(kept, pa.binary())], names=["key", *names, "ids"])
        del worker
        tokenizer.cache_clear()
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    fields = ", ".join(f"{n} bigint" for n in names)
    return stored(rows.mapInArrow(tokenize, f"key {key_type}, {fields}, ids binary"))


def take_slots(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Plan over the counts of all pieces, then give each piece (part, length, place, ...) its sequence_id and offset."""
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(counts.select("length", "part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    histogram = {row["length"]: row["n"] for row in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(plan_slots(histogram, length), np.int64).reshape(-1, 5)
    # A row per task and length: it grows with the corpus, so it is never broadcast.
    ranked = pieces.join(before.select("length", "part", "before").hint("merge"), ["length", "part"])
    names = [c for c in pieces.columns if c not in ("part", "place")]
    schema = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in names)

    def seated(batches):
        keys = runs[:, 0] << 48 | runs[:, 1]
        for batch in batches:
            size = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("before").to_numpy(zero_copy_only=False) + batch.column("place").to_numpy(zero_copy_only=False)
            run = runs[np.searchsorted(keys, size << 48 | rank, "right") - 1]
            nth = rank - run[:, 1]
            seat = [pa.array(run[:, 2] + nth // run[:, 3]), pa.array(run[:, 4] + size * (nth % run[:, 3]))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *seat], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(seated, f"{schema}, sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, ranks: bytes, pattern: str, special: tuple = (), text: str = "text", key: str = "doc_id",
    length: int = LENGTH, with_ids: bool = True,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset[, ids]): one row per piece, in as few sequences as best fit takes.

    ``ids`` holds little-endian unsigned 32-bit ids; without it only narrow rows move.
    """
    ship(docs.sparkSession)
    rows = take_slots(tokenized_pieces(docs, ranks, pattern, special, text, key, length, with_ids), length)
    rows = rows if with_ids else rows.drop("ids")
    return rows.select(F.col("key").alias(key), "piece", *[c for c in rows.columns if c not in ("key", "piece")]).withColumn(
        "piece", F.col("piece").cast("int")
    )
