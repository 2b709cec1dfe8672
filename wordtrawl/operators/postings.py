"""Positional inverted indexes as tables with one row per posting."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_DOCS = 16_384
#: Tokens that are sorted at once; a longer document is a slice of its own.
SLICE_TOKENS = 1 << 19
#: Columns of planned places: the part of the table, and its range of keys; and postings that are packed for the way there.
PLACE, PLACE_RANGE, BLOCK = "_place", "_range", "_block"
#: Unpacked rows that are sorted at once (two planned parts), and that are handed on at once.
RUN_ROWS, SEND_ROWS = 1 << 22, 1 << 16


@dataclass(frozen=True)
class KeptPages:
    """The ascending numbers of the pages that are indexed, in every task; a page's id is its place among them from ``first`` on."""

    numbers: Broadcast
    first: int


def _numbered(kept: KeptPages | None) -> Callable:
    """Function from an Arrow batch (doc_id, tokens) to (ids, token lists): those of kept pages, if doc_id is a page's number."""
    if kept is None:
        return lambda batch: (batch.column("doc_id"), batch.column("tokens"))
    numbers, first = kept.numbers, kept.first

    def own(batch):
        known, ids, lists = numbers.value, batch.column("doc_id"), batch.column("tokens")
        values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.searchsorted(known, values)
        found = known[np.minimum(at, len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)
        found &= ids.is_valid().to_numpy(zero_copy_only=False)
        return pa.array(first + at[found]), lists if found.all() else lists.filter(pa.array(found))

    return own


def _sorted_slices(width: int, kept: KeptPages | None = None) -> Callable:
    """Function from Arrow batches (doc_id, tokens) to the grams of ``width`` tokens of some documents, in order.

    A slice is (words, codes, doc, bounds, ids, positions): ascending words, a row per (gram, document) as its words' numbers
    and its document's, sorted by them, the bounds of its positions, and the slice's ids. Sorted slices make the rows of a
    word neighbours, which packs them well in a shuffle, and give the sort after it runs to merge.
    """
    numbered = _numbered(kept)

    def slices(batches):
        for batch in batches:
            ids, lists = numbered(batch)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(sizes), 0
            while at < len(sizes):
                limit = (ends[at - 1] if at else 0) + SLICE_TOKENS
                to = max(at + 1, int(np.searchsorted(ends, limit, "right")))
                own, n_docs = sizes[at:to], to - at
                found = lists.slice(at, n_docs).flatten().dictionary_encode(null_encoding="encode")
                ranked = pc.sort_indices(found.dictionary, null_placement="at_start").to_numpy()
                words = found.dictionary.take(pa.array(ranked))
                rank = np.empty(len(ranked), np.int64)
                rank[ranked] = np.arange(len(ranked))
                gram = rank[found.indices.to_numpy()]
                doc = np.repeat(np.arange(n_docs), own)
                position = np.arange(len(gram)) - np.repeat(np.cumsum(own) - own, own)
                if width == 2:
                    left = np.flatnonzero(doc[1:] == doc[:-1])
                    gram, doc, position = gram[left] * len(words) + gram[left + 1], doc[left], position[left]
                n = max(1, len(gram))
                if len(words) ** width * n < 1 << 62:  # the gram and its place in one number sort several times faster
                    gram, order = np.divmod(np.sort(gram * n + np.arange(len(gram))), n)
                else:
                    order = np.argsort(gram, kind="stable")
                    gram = gram[order]
                doc = doc[order]
                changes = np.flatnonzero((gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])) + 1
                bounds = np.concatenate([np.zeros(min(1, len(gram)), np.int64), changes, [len(gram)]])
                first = bounds[:-1]
                codes = list(divmod(gram[first], len(words))) if width == 2 else [gram[first]]
                if len(first):
                    yield words, codes, doc[first], bounds, ids.slice(at, n_docs), position[order]
                at = to

    return slices


def _in_ranges(ranges: tuple[str, ...]) -> Callable:
    """Function from ascending words to their key ranges; made on the driver, so that tasks need no module of this package."""

    def numbers(words):
        plain = [word or "" for word in words.to_pylist()]
        firsts = np.array([bisect_left(plain, key) for key in ranges], np.int64)
        return np.searchsorted(firsts, np.arange(len(plain)), "right").astype(np.int32)

    return numbers


def _packing(width: int) -> tuple[Callable, Callable]:
    """Functions (pack, unpack) for sorted rows of (words, document, positions) on their way through a shuffle.

    A block has its distinct words once, and per row their places, the document and the number of positions, each in as few
    bytes as the block needs, column by column, compressed. Made on the driver, so that tasks need no module of this package.
    """
    kinds = {size: np.dtype(f"<u{size}") for size in (1, 2, 4, 8)}

    def small(values, most):
        size = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
        return size, values.astype(kinds[size]).tobytes()

    def distinct(run, codes, n_runs, n_words):
        """The words of each run in order, where a run's begin, and for each row the place of its word among those of its run."""
        n = len(codes)
        keyed = run * n_words + codes
        if n_runs * n_words * n < 1 << 62:  # the key and its place in one number sort several times faster
            keyed, order = np.divmod(np.sort(keyed * n + np.arange(n)), n)
        else:
            order = np.argsort(keyed, kind="stable")
            keyed = keyed[order]
        new = np.concatenate([[True], keyed[1:] != keyed[:-1]])
        found, at = keyed[new], np.empty(n, np.int64)
        at[order] = np.cumsum(new) - 1
        starts = np.searchsorted(found, np.arange(n_runs + 1) * n_words)
        return found % n_words, starts, at - starts[run]

    def pack(words, codes, ids, tf, positions, starts):
        """Blocks of the rows from one of ``starts`` to the next."""
        sizes = np.diff(starts, append=len(ids))
        run, ends = np.repeat(np.arange(len(starts)), sizes), np.concatenate([[0], np.cumsum(tf)])
        listed = []
        for code in codes:
            found, word_starts, at = distinct(run, code, len(starts), len(words))
            named = words.take(pa.array(found))
            lengths = pc.fill_null(pc.binary_length(named), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            data = memoryview(named.buffers()[2] or b"")
            listed.append((word_starts, lengths + 1, np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))]), data, at))
        least = np.minimum.reduceat(ids, starts)
        spans, most_tf = np.maximum.reduceat(ids, starts) - least, np.maximum.reduceat(tf, starts)
        for i, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
            own, held = slice(a, a + n), positions[ends[a] : ends[a + n]]
            columns = [small(ids[own] - least[i], spans[i]), small(tf[own], most_tf[i]), small(held, held.max())]
            header = [n, int(least[i]), *[size for size, _ in columns], len(held)]
            parts = [part for _, part in columns]
            for word_starts, lengths, offsets, data, at in listed:
                b, e = word_starts[i], word_starts[i + 1]
                columns = [small(lengths[b:e], lengths[b:e].max()), small(at[own], e - b)]
                header += [int(e - b), int(offsets[e] - offsets[b]), *[size for size, _ in columns]]
                parts += [columns[0][1], data[offsets[b] : offsets[e]], columns[1][1]]
            raw = b"".join([np.array(header, "<i8").tobytes(), *parts])
            yield len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    def unpack(block):
        """(documents, numbers of positions, positions, and for each key lengths plus one, bytes and places of its words)."""
        raw = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
        n, least, id_size, tf_size, position_size, n_positions, *rest = np.frombuffer(raw, "<i8", 6 + 4 * width).tolist()
        at = 8 * (6 + 4 * width)

        def column(size, count):
            nonlocal at
            at += size * count
            return np.frombuffer(raw, kinds[size], count, at - size * count)

        rows = [column(id_size, n).astype(np.int64) + least, column(tf_size, n), column(position_size, n_positions)]
        for n_words, n_bytes, length_size, place_size in zip(*[iter(rest)] * 4):
            lengths = column(length_size, n_words)
            at += n_bytes
            rows.append((lengths, raw[at - n_bytes : at], column(place_size, n)))
        return rows

    return pack, unpack


def _postings(
    docs: DataFrame, keys: tuple[str, ...], points: list[tuple[str, int]] | None, ranges: tuple[str, ...], packed: bool,
    kept: KeptPages | None,
) -> DataFrame:
    """Group the grams of each document where they are, a slice of documents at a time, one row per gram and document.

    Building postings needs no shuffle and knows no hot term. With ``points`` rows say where they belong, as ``place_among``
    does, in a look at each distinct word instead of each row. ``packed`` gives (place, block) instead: the rows of a slice that
    belong to one place, in order, as one block, which takes a fraction of the bytes and of the time in a shuffle.
    """
    slices = _sorted_slices(len(keys), kept)
    place, place_range, block, in_ranges, (pack, _) = PLACE, PLACE_RANGE, BLOCK, _in_ranges(ranges), _packing(len(keys))

    def places_of(words, codes, number):
        cut, plain = [key for key, _ in points], [word or "" for word in words.to_pylist()]
        # Words are sorted: each cut is looked up among them, as there are far fewer cuts.
        at_word, each = np.array([bisect_left(plain, key) for key in cut], np.int64), np.arange(len(plain))
        after_word = np.array([bisect_right(plain, key) for key in cut], np.int64)
        lows, highs = np.searchsorted(after_word, each, "right"), np.searchsorted(at_word, each, "right")
        places = lows[codes[0]]
        for split in np.flatnonzero(highs > lows):
            own = slice(*np.searchsorted(codes[0], [split, split + 1]))
            inner = np.array([i for _, i in points[lows[split] : highs[split]]])
            places[own] += np.searchsorted(inner, number[own], "right")
        return places

    def blocks(batches):
        for words, codes, doc, bounds, ids, positions in slices(batches):
            number, tf = ids.to_numpy().astype(np.int64)[doc], np.diff(bounds)
            places = places_of(words, codes, number)
            if (places[1:] < places[:-1]).any():  # a word that is cut at ids
                order = np.argsort(places, kind="stable")
                first, tf = bounds[:-1][order], tf[order]
                positions = positions[np.repeat(first - (np.cumsum(tf) - tf), tf) + np.arange(len(positions))]
                codes, number, places = [code[order] for code in codes], number[order], places[order]
            starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
            made = pa.array(pack(words, codes, number, tf, positions, starts), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(places[starts].astype(np.int32)), made], names=[place, block])

    def rows(batches):
        for words, codes, doc, bounds, ids, positions in slices(batches):
            ids = ids.take(pa.array(doc))
            columns = {key: words.take(pa.array(code)) for key, code in zip(keys, codes)} | {
                "doc_id": ids,
                "tf": pa.array(np.diff(bounds).astype(np.int32)),
                "positions": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(positions.astype(np.int32))),
            }
            if points is not None:
                columns[place] = pa.array(places_of(words, codes, ids.to_numpy()).astype(np.int32))
                columns[place_range] = pa.array(in_ranges(words)[codes[0]])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    if packed:
        return docs.select("doc_id", "tokens").mapInArrow(blocks, f"{place} int, {block} binary")
    schema = [*[f"{key} string" for key in keys], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", "tf int", "positions array<int>"]
    schema += [f"{place} int", f"{place_range} int"] if points is not None else []
    return docs.select("doc_id", "tokens").mapInArrow(rows, ", ".join(schema))


def unpacked(blocks: DataFrame, keys: tuple[str, ...], ranges: tuple[str, ...] = ()) -> DataFrame:
    """(keys, doc_id, tf, positions), and the key range if there are ``ranges``, of the packed postings of each task.

    Rows come sorted by keys and document. A task with more than ``RUN_ROWS`` rows gives several sorted runs.
    """
    block, place_range, in_ranges, (_, unpack) = BLOCK, PLACE_RANGE, _in_ranges(ranges), _packing(len(keys))
    run_rows, send_rows = RUN_ROWS, SEND_ROWS

    def run(held):
        documents, numbers, listed, *named = zip(*held)
        held.clear()
        doc, tf, coded = np.concatenate(documents), np.concatenate(numbers), []
        positions = pa.array(np.concatenate(listed).astype(np.int32))
        del documents, numbers, listed
        for parts in named:
            lengths = np.concatenate([part[0] for part in parts]).astype(np.int64) - 1
            offsets = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))]).astype(np.int32)
            there = pa.array(lengths >= 0).buffers()[1] if (lengths < 0).any() else None
            words = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(b"".join([part[1] for part in parts])), there)
            found = words.dictionary_encode(null_encoding="encode")
            ranked = pc.sort_indices(found.dictionary, null_placement="at_start").to_numpy()
            rank = np.empty(len(ranked), np.int32)
            rank[ranked] = np.arange(len(ranked))
            starts = np.cumsum([0, *[len(part[0]) for part in parts]])
            places = np.concatenate([part[2].astype(np.int64) + at for part, at in zip(parts, starts.tolist())])
            coded.append((found.dictionary.take(pa.array(ranked)), rank[found.indices.to_numpy()][places]))
        least = int(doc.min())
        span = int(doc.max()) - least + 1
        sizes = [len(words) for words, _ in coded]
        if span * int(np.prod([float(size) for size in sizes])) < 1 << 62:  # one number sorts several times faster
            number = coded[0][1].astype(np.int64)
            for size, (_, code) in zip([*sizes[1:], span], [*coded[1:], (None, doc - least)]):
                number *= size
                number += code
            order = np.argsort(number, kind="stable")
            del number
        else:
            order = np.lexsort([doc, *[code for _, code in reversed(coded)]])
        bounds = np.concatenate([[0], np.cumsum(tf, dtype=np.int64)]).astype(np.int32)
        positions = pa.ListArray.from_arrays(pa.array(bounds), positions)
        numbers = in_ranges(coded[0][0])
        for at in range(0, len(order), send_rows):
            own = order[at : at + send_rows]
            lists = positions.take(pa.array(own))
            columns = {key: words.take(pa.array(code[own])) for key, (words, code) in zip(keys, coded)}
            columns |= {"doc_id": pa.array(doc[own]), "tf": pc.list_value_length(lists), "positions": lists}
            if ranges:
                columns[place_range] = pa.array(numbers[coded[0][1][own]])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def rows(batches):
        held, n = [], 0
        for batch in batches:
            for packed in batch.column(block):
                held.append(unpack(packed.as_py()))
                n += len(held[-1][0])
                if n >= run_rows:
                    yield from run(held)
                    held, n = [], 0
        if held:
            yield from run(held)

    schema = [*[f"{key} string" for key in keys], "doc_id bigint", "tf int", "positions array<int>", *[f"{place_range} int"] * bool(ranges)]
    return blocks.select(block).mapInArrow(rows, ", ".join(schema))


def unigram_postings(
    docs: DataFrame, points: list[tuple[str, int]] | None = None, ranges: tuple[str, ...] = (), packed: bool = False,
    kept: KeptPages | None = None,
) -> DataFrame:
    """(term, doc_id, tf, positions) with ascending positions; with ``points`` (may be empty) their places as well.

    ``packed`` postings are (place, block) rows for ``write_postings``; ``unpacked`` gives their rows. With ``kept`` doc_id is the
    number of a page: other pages are left out, and ids are given.
    """
    return _postings(docs, ("term",), points, ranges, packed, kept)


def bigram_postings(
    docs: DataFrame, points: list[tuple[str, int]] | None = None, ranges: tuple[str, ...] = (), packed: bool = False,
    kept: KeptPages | None = None,
) -> DataFrame:
    """(t1, t2, doc_id, tf, positions); a position is the ordinal of the left token. Places and packing as for unigrams."""
    return _postings(docs, ("t1", "t2"), points, ranges, packed, kept)


def word_counts(docs: DataFrame, kept: KeptPages | None = None) -> DataFrame:
    """(term, occurrences, pages): how often a term occurs, and in how many documents; counted by slice before the shuffle."""
    numbered, limit = _numbered(kept), SLICE_TOKENS

    def counts(batches):
        for batch in batches:
            _, lists = numbered(batch)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(sizes), 0
            while at < len(sizes):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
                found = lists.slice(at, to - at).flatten().dictionary_encode(null_encoding="encode")
                codes = found.indices.to_numpy().astype(np.int64)
                if len(codes):
                    # Only numbers are sorted: a word and its document.
                    held = np.sort(codes * (to - at) + np.repeat(np.arange(to - at), sizes[at:to]))
                    once = held[np.concatenate([[True], held[1:] != held[:-1]])] // (to - at)
                    columns = [np.bincount(each, minlength=len(found.dictionary)) for each in (codes, once)]
                    yield pa.RecordBatch.from_arrays([found.dictionary, *map(pa.array, columns)], names=["term", "occurrences", "pages"])
                at = to

    counted = docs.select("doc_id", "tokens").mapInArrow(counts, "term string, occurrences bigint, pages bigint")
    return counted.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("pages").alias("pages"))


def posting_lists(postings: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(term, block, postings): postings of a term in ascending doc order, cut every ``block_docs`` document ids.

    The list of a term is the concatenation of its blocks. A block is bounded whatever the term's frequency.

    Rows are dealt by term and block first: a list gathered in each task before the shuffle would be sorted and spilled for nothing.
    """
    blocks = postings.withColumn("block", F.floor(F.col("doc_id") / F.lit(block_docs))).repartition("term", "block")
    posting = F.struct("doc_id", "tf", "positions")
    return blocks.groupBy("term", "block").agg(F.sort_array(F.collect_list(posting)).alias("postings"))


def doc_only_index(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(term, block, docs): the documents of each term, in blocks as in ``posting_lists``; no frequencies."""
    rows = docs.select("doc_id", F.explode(F.array_distinct("tokens")).alias("term"))
    block = F.floor(F.col("doc_id") / F.lit(block_docs)).alias("block")
    return rows.groupBy("term", block).agg(F.sort_array(F.collect_list("doc_id")).alias("docs"))


def doc_frequency(postings: DataFrame, *keys: str) -> DataFrame:
    """(keys, df): number of documents per term, or per pair with keys ``t1``, ``t2``."""
    return postings.groupBy(*(keys or ("term",))).agg(F.count(F.lit(1)).alias("df"))


def posting_size(tf: Column) -> Column:
    """Approximate size of a posting."""
    return (F.lit(3) * (F.lit(2) + tf)).cast("bigint")


def merge_postings(first: DataFrame, second: DataFrame, offset: int = 0) -> DataFrame:
    """Postings of two segments; document ids of the second are shifted by ``offset`` (the size of the first)."""
    return first.unionByName(second.withColumn("doc_id", F.col("doc_id") + F.lit(offset).cast("bigint")))


def merge_frequencies(first: DataFrame, second: DataFrame, *keys: str) -> DataFrame:
    """Document frequencies of two merged segments, from the segments' own dictionaries."""
    return first.unionByName(second).groupBy(*(keys or ("term",))).agg(F.sum("df").alias("df"))


def without_frequencies(frequencies: DataFrame, gone: DataFrame, *keys: str) -> DataFrame:
    """Document frequencies less those of deleted documents; keys that no document has any more drop out."""
    both = frequencies.unionByName(gone.withColumn("df", -F.col("df")))
    return both.groupBy(*keys).agg(F.sum("df").alias("df")).filter("df > 0")
