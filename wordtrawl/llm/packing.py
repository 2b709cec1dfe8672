"""Cost-balanced packing of tokenised documents into sequences of bounded length.

A document becomes its byte-level BPE ids and an end id. Its pieces are written down once, numbered by task and place. Every
full sequence length of a document is a sequence of its own, with a negative number, and moves no further. What is left over,
shorter than a sequence, goes with its ids to one of the blocks of about ``BLOCK`` leftovers that its place hashes to, so equal
rows spread like any others. A block opens as many sequences as its tokens fill, takes its leftovers by descending cost
(``LINEAR`` x length + ``QUADRATIC`` x length squared) and gives each to the cheapest sequence that can still hold it whole;
where none of the cheapest few can, the cheapest one with room takes what fits and the rest is cut off and goes on. So only
the last sequence of a block can need padding.

Defined cases: a null text counts as empty and has the end id only; documents of any length are packed whole; special strings
in a text become their ids, as the library does it; repeated rows are packed each, in any order; a null id is kept; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from wordtrawl.llm.byte_tokens import tokenizer
from wordtrawl.llm.common import ship, stored

LENGTH = 1024
END_ID = 0
BLOCK = 1024
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Cheapest sequences that are tried before a leftover is cut.
TRIED = 8


def balanced(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(item, start, size, sequence, offset) of a block's leftovers, all shorter than ``length``."""
    cost = lambda n: LINEAR * n + QUADRATIC * n * n
    open_ = [(0.0, s) for s in range(-(-sum(sizes) // length))]
    filled = [0] * len(open_)
    placed = []

    def put(item: int, start: int, size: int, total: float, sequence: int) -> None:
        placed.append((item, start, size, sequence, filled[sequence]))
        filled[sequence] += size
        if filled[sequence] < length:
            heapq.heappush(open_, (total + cost(size), sequence))

    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        start, left = 0, sizes[item]
        while left:
            tried = []
            while open_ and len(tried) < TRIED:
                tried.append(heapq.heappop(open_))
                if filled[tried[-1][1]] + left <= length:
                    break
            *too_full, (total, sequence) = tried
            if filled[sequence] + left > length:
                (total, sequence), *too_full = tried
            for one in too_full:
                heapq.heappush(open_, one)
            size = min(left, length - filled[sequence])
            put(item, start, size, total, sequence)
            start, left = start + size, left - size
    return placed


def pack(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    with_ids: bool = True,
    special: tuple[tuple[str, int], ...] = (),
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]): one row per piece.

    ``ids`` holds little-endian unsigned 32-bit ids; without it only the leftovers' ids move. ``special`` are the strings with
    ids of their own.
    """
    spark = docs.sparkSession
    ship(spark)
    key_type = docs.schema[key].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()
    longs = ("start", "length", "ids_crc32", "doc_tokens", "place", "sequence_id")

    def tokenized(batches):
        worker = tokenizer(ranks, pattern, special)
        place = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                owner, rows, kept = [], [], []
                for i, body in enumerate(part.column("body")):
                    ids = worker.encode(body.as_py() or "") + end
                    for at in range(0, len(ids), 4 * length):
                        piece = ids[at : at + 4 * length]
                        whole = len(piece) == 4 * length
                        place += 1
                        rows.append((at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, place, -place if whole else None))
                        owner.append(i)
                        kept.append(piece if with_ids or not whole else None)
                columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * len(longs))]
                keys = part.column("key").take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, *columns, pa.array(kept, pa.binary())], names=["key", *longs, "ids"])
        # Workers outlive their tasks: what they hold would stay while other stages need the memory.
        del worker
        tokenizer.cache_clear()
        pa.default_memory_pool().release_unused()

    def packed(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        order = pc.sort_indices(rows.column("place"))
        keys, totals = rows.column("key").take(order), rows.column("doc_tokens").take(order)
        before, tails = rows.column("start").take(order).to_pylist(), rows.column("ids").take(order).to_pylist()
        out = []
        for i, start, size, sequence, offset in balanced([len(t) // 4 for t in tails], length):
            ids = tails[i][4 * start : 4 * (start + size)]
            out.append((i, before[i] + start, size, zlib.crc32(ids), block << 32 | sequence, offset, ids))
        owner, start, size, crc, sequence, offset, ids = zip(*out)
        table = {"key": keys.take(pa.array(owner))}
        table |= {k: pa.array(v, pa.int64()) for k, v in {"start": start, "length": size, "ids_crc32": crc}.items()}
        table |= {"doc_tokens": totals.take(pa.array(owner))}
        table |= {"sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}
        return pa.table(table | ({"ids": pa.array(ids, pa.binary())} if with_ids else {}))

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    fields = ", ".join(f"{c} bigint" for c in longs)
    pieces = stored(rows.mapInArrow(tokenized, f"key {key_type}, {fields}, ids binary"))
    leftovers = pieces.filter("sequence_id IS NULL")
    blocks = max(1, -(-leftovers.count() // BLOCK))
    leftovers = leftovers.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)))
    columns = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    balanced_rows = leftovers.drop("sequence_id").groupBy("block").applyInArrow(packed, f"key {key_type}, {columns}" + ", ids binary" * with_ids)
    whole = pieces.filter("sequence_id IS NOT NULL").withColumn("offset", F.lit(0).cast("bigint")).select(balanced_rows.columns)
    return whole.unionByName(balanced_rows).withColumnRenamed("key", key)
