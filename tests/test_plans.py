"""The plans behind the operators: what is shuffled, pushed down, pruned."""

import contextlib
import io
import re

import pytest

from wordtrawl.operators import duplicates, matching, postings, scoring
from wordtrawl.operators.tokens import process_queries
from wordtrawl.plans import build, search
from wordtrawl.session import pin, prune_to_keys
from wordtrawl.sources import crawl
from wordtrawl.sources.result_pages import fetch_result_pages


def plan(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = [(i, f"u{i}", f"d{i}", ["the", f"w{i % 7}", "of"]) for i in range(50)]
    tokenized = spark.createDataFrame(rows, "seq bigint, url string, disk_loc string, tokens array<string>")
    return build.build_index(tokenized, str(tmp_path_factory.mktemp("index")), near_threshold=None)


def test_postings_and_text_need_no_shuffle(spark):
    docs = spark.createDataFrame([(0, ["a"])], "doc_id bigint, tokens array<string>")
    for frame in (postings.unigram_postings(docs), postings.bigram_postings(docs)):
        assert "Exchange" not in plan(frame)
    pages = spark.createDataFrame([(0, "u", "<p>", "d")], "seq bigint, url string, content string, disk_loc string")
    assert "Exchange" not in plan(build.tokenize_pages(pages))


def test_retrieval_prunes_scans_and_never_crosses(spark, index):
    queries = spark.createDataFrame([(0, "the w1 of")], "qid bigint, query string")
    text = plan(search.retrieve(queries, index, tokenizer="regex"))
    assert "In(term, [of,the,w1])" in text and "In(t1, [the,w1])" in text
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert "positions" not in text
    assert "WindowGroupLimit" in text
    assert "dynamicpruning" in text.lower()


def test_only_asked_pairs_are_shuffled_to_many_candidates(spark, index, monkeypatch):
    """(w1, of) is asked for and (the, w2) is not, though a query has "the" and another one w2."""
    monkeypatch.setattr(matching, "CANDIDATE_ROWS", 0)
    texts = spark.createDataFrame([(0, "the w1 of"), (1, "w2 of")], "qid bigint, query string")
    processed = pin(process_queries(texts, tokenizer="regex"))
    candidates = matching.find_candidates(matching.known_terms(processed, index.terms), index.postings)
    hits = matching.lookup_bigrams(processed, index.bigrams, index.pairs, candidates)
    assert "LeftSemi" in plan(hits)
    rows = {(r.qid, r.t1, r.t2, r.doc_id) for r in hits.collect()}
    expected = {(0, *pair, i) for i in range(1, 50, 7) for pair in (("the", "w1"), ("w1", "of"))}
    assert rows == expected | {(1, "w2", "of", i) for i in range(2, 50, 7)}


def test_top_k_is_limited_before_the_shuffle(spark):
    scores = spark.createDataFrame([(0, 1, 0.5)], "qid bigint, doc_id bigint, score double")
    text = plan(scoring.rank_top_k(scores))
    assert text.count("WindowGroupLimit") >= 2


def test_duplicate_detection_has_no_cross_join(spark):
    signatures = spark.createDataFrame([(0, 1), (1, 3)], "seq bigint, sig bigint")
    for bits in (1, 2):
        text = plan(duplicates.signature_edges(signatures, bits))
        assert "Cartesian" not in text and "NestedLoop" not in text


def test_url_dedupe_shuffles_keys_before_contents(spark, tmp_path):
    pages = spark.createDataFrame([(0, "u", "c", "d")], "seq bigint, url string, content string, disk_loc string")
    pages.write.parquet(str(tmp_path / "pages"))
    text = plan(duplicates.dedupe_url_first(spark.read.parquet(str(tmp_path / "pages"))))
    assert "ReadSchema: struct<seq:bigint,url:string>" in text and "partial_min" in text.lower()
    latest = plan(crawl.latest_pages(spark.read.parquet(str(tmp_path / "pages"))))
    assert "ReadSchema: struct<seq:bigint,url:string>" in latest


def test_result_pages_are_fetched_by_key(spark, tmp_path):
    pages = spark.range(100).selectExpr("id AS page_id", "concat('u', id) AS url", "concat('<p>', id) AS html")
    pages.write.parquet(str(tmp_path / "pages"))
    pages = crawl.pages_from_table(spark.read.parquet(str(tmp_path / "pages")))
    results = spark.createDataFrame([(0, 1, 7), (0, 2, 9)], "qid bigint, rank int, seq bigint")
    fetched = fetch_result_pages(results, pages)
    text = plan(fetched)
    assert "In(page_id, [7,9])" in text
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert sorted((r.rank, r.content) for r in fetched.collect()) == [(1, "<p>7"), (2, "<p>9")]


def test_large_batches_still_prune(spark, index):
    words = " ".join(f"w{i}" for i in range(5_000))
    queries = spark.createDataFrame([(0, words), (1, "the of")], "qid bigint, query string")
    processed = pin(process_queries(queries, tokenizer="regex"))
    known = matching.known_terms(processed, index.terms)
    assert {r.term for r in known.df.collect()} == {"the", "of", *(f"w{i}" for i in range(7))}
    pruned = plan(prune_to_keys(index.postings, processed, "term", "tokens"))
    assert any("Or(" in p or "In(term" in p for p in re.findall(r"PushedFilters: \[(.*)", pruned))


def test_a_search_takes_few_jobs(spark, index):
    context, group = spark.sparkContext, "jobs of one search"
    queries = spark.createDataFrame([(0, "the w1 of")], "qid bigint, query string")
    search.retrieve(queries, index, tokenizer="regex").collect()
    context.setJobGroup(group, group)
    try:
        search.retrieve(queries, index, tokenizer="regex").collect()
        jobs = len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setJobGroup("other", "other")
    assert jobs <= 13


def test_fifty_thousand_words_read_only_their_ranges(spark, tmp_path):
    """Too many words for IN lists: lookups still choose directories of postings and pairs."""
    rows = [(i, f"u{i}", f"d{i}", [f"{c}{(i * 7 + j) % 40}" for c in "abxyz" for j in range(6)]) for i in range(60)]
    tokenized = spark.createDataFrame(rows, "seq bigint, url string, disk_loc string, tokens array<string>")
    index = build.build_index(tokenized, str(tmp_path), None, rows_per_file=150, files_per_range=1)
    assert len(index.term_ranges) > 6 and len(index.pair_ranges) > 6
    queries = spark.createDataFrame([(0, " ".join(f"a{i}" for i in range(50_000))), (1, "b1 b2")], "qid bigint, query string")
    processed = pin(process_queries(queries, tokenizer="regex"))
    assert processed.values("tokens") is None
    known = matching.known_terms(processed, index.terms)
    looked_up = {
        "postings": matching.lookup_terms(known, index.postings),
        "bigrams": matching.lookup_bigrams(processed, index.bigrams, index.pairs),
    }
    for name, hits in looked_up.items():
        filters = [p for p in re.findall(r"PartitionFilters: \[(.*)\]", plan(hits)) if "key_range" in p]
        assert filters, name
        files = {f for f in getattr(index, name).select("_metadata.file_path").distinct().toPandas()["file_path"]}
        read = {f.split("key_range=")[1].split("/")[0] for f in files}
        asked = set(re.findall(r"\d+", filters[0].split("IN", 1)[1])) if " IN " in filters[0] else set(re.findall(r"= (\d+)", filters[0]))
        assert asked and asked < read, name
    hits = {(r.qid, r.term) for r in looked_up["postings"].select("qid", "term").distinct().collect()}
    assert hits == {(0, f"a{i}") for i in range(40)} | {(1, "b1"), (1, "b2")}
