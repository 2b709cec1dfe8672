"""From pages or documents to an index."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from wordtrawl.functions.markup import page_text
from wordtrawl.functions.tokens import tokenize
from wordtrawl.functions.urls import defragment
from wordtrawl.operators.duplicates import assign_doc_ids, kept_signatures, near_kept, simhash64
from wordtrawl.operators.postings import (
    KeptPages,
    bigram_postings,
    doc_frequency,
    merge_frequencies,
    merge_postings,
    unigram_postings,
    without_frequencies,
    word_counts,
)
from wordtrawl.sources import index_store
from wordtrawl.sources.index_store import Layout, SearchIndex, plan_layout
from wordtrawl.sources.key_ranges import KEY_RANGE
from wordtrawl.session import cut_lineage, lean, owned_scratch

#: Numbers of pages that are broadcast to the token lists, eight bytes each. Beyond, the lists are shuffled, once.
BROADCAST_IDS = 1 << 23
#: The same for a lazy index, whose lists are joined with their ids, some 50 bytes each.
LAZY_BROADCAST_IDS = 1 << 21


def tokenize_pages(pages: DataFrame, sep: str = "", **token_options) -> DataFrame:
    """(seq, url, disk_loc, tokens) of HTML pages; no shuffle."""
    tokens = tokenize(page_text(F.col("content"), sep), **token_options)
    return pages.select("seq", defragment(F.col("url")).alias("url"), "disk_loc", tokens.alias("tokens"))


def tokenize_documents(documents: DataFrame, **token_options) -> DataFrame:
    """(seq, url, disk_loc, tokens) of plain-text documents with the columns doc_id and text."""
    key = F.col("doc_id").cast("string")
    return documents.select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("doc:"), key).alias("url"),
        key.alias("disk_loc"),
        tokenize(F.col("text"), **token_options).alias("tokens"),
    )


def _first_pages(tokenized: DataFrame, known: SearchIndex | None) -> DataFrame:
    """(url, seq): the first page of every URL that the index ``known`` has not seen; reads no text."""
    firsts = tokenized.groupBy("url").agg(F.min("seq").alias("seq"))
    if known is not None:
        # Of the many URLs of the index only those asked for are brought together with the batch.
        asked = firsts.select(F.col("url").alias("asked"))
        seen = known.pages.select(F.col("url").alias("seen"))
        seen = seen.join(asked, F.col("seen").eqNullSafe(F.col("asked")), "left_semi")
        firsts = firsts.join(seen, F.col("url").eqNullSafe(F.col("seen")), "left_anti")
    return cut_lineage(firsts)


def judge_pages(
    tokenized: DataFrame, near_threshold: float | None = 0.98, known: SearchIndex | None = None, firsts: DataFrame | None = None
) -> DataFrame:
    """(url, seq, sig, doc_id): the first page of every URL that is new, its signature, and its id if it is indexed.

    First page per URL, then near-duplicates among those (so a page that falls still blocks its URL), then ids. All pages come
    after those of the index ``known``: a URL that it has seen falls, then a page near one that it keeps, then the same rule
    decides among the rest, and ids go on from there. So adding pages in batches gives what one build over all of them gives.
    Only keys and signatures are shuffled. ``near_threshold=None`` keeps near-duplicates and computes no signatures. ``firsts``
    are the first pages of new URLs, if they have been found already.
    """
    firsts = _first_pages(tokenized, known) if firsts is None else firsts
    if near_threshold is None:
        kept = firsts.select("seq")
        signatures = None
    else:
        signatures = cut_lineage(simhash64(tokenized).join(firsts.select("seq"), "seq", "left_semi"))
        fresh = signatures
        if known is not None:
            near = near_kept(signatures, known.pages.filter("doc_id IS NOT NULL").select("seq", "sig"), near_threshold)
            fresh = cut_lineage(signatures.join(near, "seq", "left_anti"))
        kept = kept_signatures(fresh, near_threshold).select("seq")
    start = F.lit(0 if known is None else known.n_docs).cast("bigint")
    ids = assign_doc_ids(kept).withColumn("doc_id", F.col("doc_id") + start)
    none = F.lit(None).cast("bigint").alias("sig")
    pages = firsts.select("url", "seq", none) if signatures is None else firsts.join(signatures, "seq", "left")
    return cut_lineage(pages.join(ids, "seq", "left").select("url", "seq", "sig", "doc_id"))


def index_documents(tokenized: DataFrame, near_threshold: float | None = 0.98) -> DataFrame:
    """(seq, doc_id): which tokenised pages are indexed, and under which ids."""
    return _kept(judge_pages(tokenized, near_threshold))


def _kept(pages: DataFrame) -> DataFrame:
    return pages.filter("doc_id IS NOT NULL").select("seq", "doc_id")


def _page_numbers(pages: DataFrame, n: int | None = None) -> np.ndarray | None:
    """The ascending ``seq`` of pages, or None if they are no integers or too many to be in every task."""
    whole = isinstance(pages.schema["seq"].dataType, IntegralType)
    if not whole or (pages.count() if n is None else n) > BROADCAST_IDS:
        return None
    return np.sort(pages.select(F.col("seq").cast("bigint").alias("seq")).toArrow()["seq"].drop_null().to_numpy())


def _kept_pages(pages: DataFrame, n_docs: int) -> KeptPages | None:
    """The numbers of the kept pages for tasks that give ids, or None if the ids have to be joined."""
    numbers = _page_numbers(_kept(pages), n_docs)
    if numbers is None or (numbers[1:] == numbers[:-1]).any():
        return None
    first = _kept(pages).agg(F.coalesce(F.min("doc_id"), F.lit(0)).alias("id")).first()["id"]
    return KeptPages(pages.sparkSession.sparkContext.broadcast(numbers), first)


def _new_pages(tokenized: DataFrame, firsts: DataFrame) -> DataFrame:
    """The pages among ``firsts``. Others are left out before their text is read; nothing is shuffled if the numbers fit a broadcast."""
    numbers = _page_numbers(firsts)
    if numbers is None:
        return tokenized.join(firsts.select("seq").hint("shuffle_hash"), "seq", "left_semi").select(*tokenized.columns)
    numbers = firsts.sparkSession.sparkContext.broadcast(numbers)

    @F.arrow_udf("boolean")
    def asked(seq: pa.Array) -> pa.Array:
        known = numbers.value
        values = seq.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        found = known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)
        return pa.array(found & seq.is_valid().to_numpy(zero_copy_only=False))

    return tokenized.filter(asked("seq"))


def _kept_tokens(tokenized: DataFrame, pages: DataFrame, kept: KeptPages | None) -> DataFrame:
    """(doc_id, tokens) of the kept pages; token lists are long, so they are neither shuffled without need nor sorted.

    With ``kept`` these are the lists of all pages under their ``seq``, which tasks that get ``kept`` turn into ids.
    """
    if kept is not None:
        return tokenized.select(F.col("seq").cast("bigint").alias("doc_id"), "tokens")
    return tokenized.select("seq", "tokens").join(_kept(pages).hint("shuffle_hash"), "seq").select("doc_id", "tokens")


def _docs(tokenized: DataFrame, pages: DataFrame) -> DataFrame:
    return tokenized.select("seq", "url", "disk_loc").join(_kept(pages), "seq").select("doc_id", "url", "disk_loc", "seq")


def assemble_index(
    tokenized: DataFrame, near_threshold: float | None = 0.98, known: SearchIndex | None = None
) -> SearchIndex:
    """An index as lazy tables over ``tokenized``, for use within one job; large corpora take ``build_index``.

    With ``known`` the pages are added to that index, whose threshold counts.
    """
    threshold = near_threshold if known is None else known.near_threshold
    # Parsed and tokenised once: signatures, postings and documents all read this.
    tokenized = cut_lineage(tokenized)
    pages = judge_pages(tokenized, threshold, known)
    n_docs = _kept(pages).count()
    ids = _kept(pages).hint("broadcast" if n_docs <= LAZY_BROADCAST_IDS else "shuffle_hash")
    tokens = cut_lineage(tokenized.select("seq", "tokens").join(ids, "seq").select("doc_id", "tokens"))
    postings, bigrams = unigram_postings(tokens), bigram_postings(tokens)
    own = SearchIndex(
        docs=_docs(tokenized, pages),
        postings=postings,
        bigrams=bigrams,
        terms=doc_frequency(postings),
        pairs=doc_frequency(bigrams, "t1", "t2"),
        n_docs=n_docs,
        pages=pages,
        near_threshold=threshold,
    )
    return own if known is None else _united(known, own, shift=0)


def _united(first: SearchIndex, second: SearchIndex, shift: int) -> SearchIndex:
    """Both indexes as one, without looking for repeats; ids of the second move by ``shift``."""
    moved = lambda table: table.drop(KEY_RANGE, "doc_block").withColumn("doc_id", F.col("doc_id") + F.lit(shift).cast("bigint"))
    plain = lambda table: table.drop(KEY_RANGE)
    return SearchIndex(
        docs=first.docs.drop("doc_block").unionByName(moved(second.docs)),
        postings=merge_postings(plain(first.postings), plain(second.postings), shift),
        bigrams=merge_postings(plain(first.bigrams), plain(second.bigrams), shift),
        terms=merge_frequencies(plain(first.terms), plain(second.terms)),
        pairs=merge_frequencies(plain(first.pairs), plain(second.pairs), "t1", "t2"),
        n_docs=first.n_docs + second.n_docs,
        pages=first.pages.unionByName(moved(second.pages)),
        near_threshold=first.near_threshold,
        starts=(*first.starts, *(first.n_docs + start for start in second.starts)),
    )


def build_index(
    tokenized: DataFrame,
    path: str,
    near_threshold: float | None = 0.98,
    rows_per_file: int = index_store.ROWS_PER_FILE,
    files_per_range: int = index_store.FILES_PER_RANGE,
) -> SearchIndex:
    """Build and store an index under ``path``; returns it opened.

    Tokens are written once, to a scratch folder beside the checkpoints that is removed at the end, so parsing and tokenising
    happen once although signatures, unigrams and bigrams all read them; shuffle files go as soon as a step has ended. The postings go straight to where they stay: their
    layout is planned from the frequencies of the terms, without a look at the postings.
    """
    return _store_segment(tokenized, path, None, near_threshold, rows_per_file, files_per_range)


def extend_index(index: SearchIndex, tokenized: DataFrame, path: str, rows_per_file: int = index_store.ROWS_PER_FILE) -> SearchIndex:
    """Add pages to a stored index as a new segment under ``path``; returns the whole index, opened.

    Equal to one build over the pages of all segments in their order. Pages whose URL the index has seen, and near-duplicates
    of its pages, are not indexed; pages of known URLs are not even tokenised. What is stored stays as it is, and the index opened from its old path still works; new are
    the segment's own postings and documents, and the dictionaries of all segments together. ``seq`` may repeat numbers of
    earlier segments: a page is named by its segment and its ``seq``.
    """
    if not index.paths:
        raise ValueError("the index is not stored; use assemble_index(..., known=index) or write_index first")
    if path in index.paths:
        raise ValueError(f"{path} already holds a segment of the index")
    return _store_segment(tokenized, path, index, index.near_threshold, rows_per_file, 0)


def _store_segment(
    tokenized: DataFrame, path: str, known: SearchIndex | None, threshold: float | None, rows_per_file: int, files_per_range: int
) -> SearchIndex:
    spark = tokenized.sparkSession
    start = 0 if known is None else known.n_docs
    with owned_scratch(spark) as scratch, lean(spark):
        firsts = None
        if known is not None:
            firsts = _first_pages(tokenized, known)
            tokenized = _new_pages(tokenized, firsts)
        tokenized.write.parquet(f"{scratch}/tokens")
        stored = spark.read.schema(tokenized.schema).parquet(f"{scratch}/tokens")
        index_store.write_pages(judge_pages(stored, threshold, known, firsts), f"{path}/pages")
        pages = spark.read.parquet(f"{path}/pages")
        n_docs = _kept(pages).count()
        index_store.write_docs(_docs(stored, pages), f"{path}/docs")

        kept = _kept_pages(pages, n_docs)
        tokens = _kept_tokens(stored, pages, kept)
        if kept is None:
            # Shuffled once for both kinds of postings.
            tokens.write.parquet(f"{scratch}/kept")
            tokens = spark.read.schema(tokens.schema).parquet(f"{scratch}/kept")
        words = word_counts(tokens, kept)
        words.write.parquet(f"{scratch}/words")
        words = spark.read.parquet(f"{scratch}/words")
        layouts = [
            plan_layout(words, "term", weight, n_docs, start, rows_per_file, files_per_range or index_store.FILES_PER_RANGE)
            for weight in ("pages", "occurrences")
        ]
        if known is not None:
            layouts = [Layout(own.points, ranges) for own, ranges in zip(layouts, (known.term_ranges, known.pair_ranges))]
        unigrams = unigram_postings(tokens, layouts[0].points, layouts[0].ranges, True, kept)
        bigrams = bigram_postings(tokens, layouts[1].points, layouts[1].ranges, True, kept)
        index_store.write_postings(unigrams, f"{path}/postings", rows_per_file, layouts[0])
        index_store.write_bigrams(bigrams, f"{path}/bigrams", rows_per_file, layouts[1])

    with lean(spark):
        postings = spark.read.schema("term string").parquet(f"{path}/postings")
        bigrams = spark.read.schema("t1 string, t2 string").parquet(f"{path}/bigrams")
        index_store.write_dictionary(postings, f"{path}/terms", ["term"], known and known.terms)
        index_store.write_dictionary(bigrams, f"{path}/pairs", ["t1", "t2"], known and known.pairs)
    before = () if known is None else known.paths
    starts = (0,) if known is None else (*known.starts, start)
    ranges = layouts[0].ranges, layouts[1].ranges
    index_store.write_manifest(spark, path, start + n_docs, threshold, before, starts, *ranges)
    return index_store.read_index(spark, path)


def merge_segments(first: SearchIndex, second: SearchIndex) -> SearchIndex:
    """One index over two that were built apart; document ids of the second follow those of the first, without gaps.

    Documents of the second that repeat a URL of the first, or are near-duplicates of a page that it keeps, are deleted, and the
    others are renumbered. What either index had left out stays out, so where repeats are to be judged page by page, as in one
    build, pages are added with ``extend_index``.
    """
    kept = second.pages.filter("doc_id IS NOT NULL")
    seen = first.pages.select(F.col("url").alias("seen"))
    repeated = kept.join(seen, F.col("url").eqNullSafe(F.col("seen")), "left_semi").select("doc_id")
    if first.near_threshold is not None and second.near_threshold is not None:
        ours = first.pages.filter("doc_id IS NOT NULL").select("seq", "sig")
        near = near_kept(kept.select(F.col("doc_id").alias("seq"), "sig"), ours, first.near_threshold)
        repeated = repeated.union(near)
    deleted = cut_lineage(repeated.distinct())
    known_url = second.pages.join(seen, F.col("url").eqNullSafe(F.col("seen")), "left_anti")
    if deleted.isEmpty():
        return _united(first, replace(second, pages=known_url), first.n_docs)
    left = second.docs.select("doc_id").join(deleted, "doc_id", "left_anti")
    renamed = cut_lineage(assign_doc_ids(left.withColumnRenamed("doc_id", "seq")).select(F.col("seq").alias("old"), "doc_id"))
    below = renamed.agg(*[F.count(F.when(F.col("old") < s, 1)).alias(f"s{i}") for i, s in enumerate(second.starts)]).first()

    def renumbered(table: DataFrame) -> DataFrame:
        columns = [c for c in table.columns if c not in (KEY_RANGE, "doc_block")]
        return table.withColumnRenamed("doc_id", "old").join(renamed, "old").select(*columns)

    def gone(table: DataFrame, *keys: str) -> DataFrame:
        return doc_frequency(table.join(deleted, "doc_id", "left_semi"), *keys)

    pages = known_url.withColumnRenamed("doc_id", "old").join(renamed, "old", "left").select("url", "seq", "sig", "doc_id")
    second = replace(
        second,
        docs=renumbered(second.docs),
        postings=renumbered(second.postings),
        bigrams=renumbered(second.bigrams),
        terms=without_frequencies(second.terms.drop(KEY_RANGE), gone(second.postings, "term"), "term"),
        pairs=without_frequencies(second.pairs.drop(KEY_RANGE), gone(second.bigrams, "t1", "t2"), "t1", "t2"),
        n_docs=renamed.count(),
        pages=pages,
        starts=tuple(below),
    )
    return _united(first, second, first.n_docs)
