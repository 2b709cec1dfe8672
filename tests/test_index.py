import pathlib
import random

import pytest
from pyspark.sql import functions as F

from tests import plain
from wordtrawl import session
from wordtrawl.functions.stopwords import STOP_WORDS
from wordtrawl.operators import matching, postings, reports, scoring
from wordtrawl.operators.tokens import process_queries, query_terms
from wordtrawl.plans import build, search
from wordtrawl.sources import index_store, key_ranges

WORDS = "the of and to is alpha beta gamma delta rare".split()
QUERIES = ["the alpha", "of the is", "to the to", "beta unknownword gamma", "unknownword", "", "alpha alpha", "rare the"]
REGEX = {"tokenizer": "regex"}


def corpus(seed=3, n=80):
    rng = random.Random(seed)
    docs = {i: [rng.choice(WORDS[:-1]) for _ in range(rng.randint(0, 25))] for i in range(n)}
    docs[5] = docs[5] + ["rare", "the", "rare"]
    docs[9] = ["the", "rare"]
    docs[11] = []
    return docs


def tokenized(spark, docs):
    rows = [(i, f"u{i}", f"loc{i}", tokens) for i, tokens in docs.items()]
    return spark.createDataFrame(rows, "seq bigint, url string, disk_loc string, tokens array<string>").repartition(3)


def queries(spark, texts=QUERIES):
    return spark.createDataFrame(list(enumerate(texts)), "qid bigint, query string")


@pytest.fixture(scope="module")
def docs():
    return corpus()


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    return build.build_index(tokenized(spark, docs), str(tmp_path_factory.mktemp("index")), near_threshold=None)


def ranking(frame):
    out = {}
    for row in frame.orderBy("qid", "rank").collect():
        out.setdefault(row.qid, []).append((row.doc_id, round(row.score, 6)))
    return out


def expected(docs, texts=QUERIES, stop=STOP_WORDS, **options):
    ranked = {q: plain.rank(text.split(), docs, stop, **options) for q, text in enumerate(texts)}
    return {q: [(d, round(s, 6)) for d, s in hits] for q, hits in ranked.items() if hits}


def test_posting_invariants(docs, index):
    rows = index.postings.collect()
    assert all(r.tf == len(r.positions) and r.positions == sorted(r.positions) for r in rows)
    assert sum(r.tf for r in rows) == sum(map(len, docs.values()))
    assert {(r.term, r.doc_id): r.positions for r in rows} == {
        (t, d): [i for i, x in enumerate(tokens) if x == t] for d, tokens in docs.items() for t in set(tokens)
    }


def test_bigram_postings(docs, index):
    rows = index.bigrams.collect()
    assert {((r.t1, r.t2), r.doc_id): r.positions for r in rows} == {
        (p, d): [i for i, x in enumerate(zip(t, t[1:])) if x == p] for d, t in docs.items() for p in set(zip(t, t[1:]))
    }


def test_posting_lists_are_blocked_and_whole(docs, index):
    lists = postings.posting_lists(index.postings, block_docs=16).filter("term = 'the'").orderBy("block").collect()
    assert len(lists) == 5 and all(p.doc_id // 16 == r.block for r in lists for p in r.postings)
    assert [p.doc_id for r in lists for p in r.postings] == [d for d, t in docs.items() if "the" in t]


def test_doc_only_index(spark, docs):
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, tokens array<string>")
    rows = postings.doc_only_index(frame, block_docs=50).filter("term = 'rare'").collect()
    assert [(r.block, r.docs) for r in rows] == [(0, [5, 9])]


def test_posting_size(spark):
    assert spark.range(1).select(postings.posting_size(F.lit(5))).first()[0] == 21


def test_frequencies_and_stats(docs, index):
    df = {r.term: r.df for r in index.terms.collect()}
    assert df == {t: sum(t in tokens for tokens in docs.values()) for t in WORDS}
    assert index.n_docs == len(docs)
    stats = {r.metric: r.value for r in reports.index_stats(index.docs, index.postings, index.terms).collect()}
    assert stats["documents"] == 80 and stats["unique_tokens"] == len(WORDS)
    assert stats["approximate_index_size"] == sum(3 * (2 + t.count(w)) for t in docs.values() for w in set(t))


def test_merging_halves_equals_building_whole(spark, docs, index):
    halves = [{d: t for d, t in docs.items() if low <= d < low + 40} for low in (0, 40)]
    merged = build.merge_segments(*[build.assemble_index(tokenized(spark, h), None) for h in halves])
    assert merged.n_docs == index.n_docs
    for name in ("docs", "postings", "bigrams", "terms", "pairs"):
        whole = getattr(index, name).drop("doc_block")
        part = getattr(merged, name).select(whole.columns)
        assert sorted(map(repr, part.collect())) == sorted(map(repr, whole.collect()))


def test_retrieve_equals_plain_python(spark, docs, index):
    assert ranking(search.retrieve(queries(spark), index, **REGEX)) == expected(docs)


def test_stop_list_and_weights_are_arguments(spark, docs, index):
    got = search.retrieve(queries(spark), index, stop_words=["alpha"], **REGEX)
    assert ranking(got) == expected(docs, stop={"alpha"})
    heavy = search.retrieve(queries(spark, ["the alpha"]), index, unigram_weight=0.0, bigram_weight=1.0, **REGEX)
    assert heavy.count() == 5


def test_query_tables_too_large_to_pin_give_the_same(spark, docs, index, monkeypatch):
    monkeypatch.setattr(session, "PINNED_ROWS", 0)
    assert ranking(search.retrieve(queries(spark), index, **REGEX)) == expected(docs)


@pytest.mark.parametrize("gain", [0, 10**6])
def test_every_lookup_strategy_gives_the_same(spark, docs, index, monkeypatch, gain):
    """Candidates shuffled, and none at all; the other tests broadcast them."""
    monkeypatch.setattr(matching, "CANDIDATE_ROWS", 0)
    monkeypatch.setattr(matching, "PROBE_GAIN", gain)
    assert ranking(search.retrieve(queries(spark), index, **REGEX)) == expected(docs)


def test_candidates_are_found_by_frequency(spark, index):
    known = matching.known_terms(process_queries(queries(spark, ["rare the of"]), **REGEX), index.terms)
    candidates = matching.find_candidates(known, index.postings)
    assert candidates.small(known) and {r.doc_id for r in candidates.df.collect()} == {5, 9}
    single = matching.known_terms(process_queries(queries(spark, ["the", "of"]), **REGEX), index.terms)
    assert matching.find_candidates(single, index.postings) is None


def test_rebuild_from_shuffled_input(spark, docs, index):
    again = build.assemble_index(tokenized(spark, docs).orderBy(F.hash("url")).repartition(5), None)
    assert ranking(search.retrieve(queries(spark), again, **REGEX)) == ranking(search.retrieve(queries(spark), index, **REGEX))


def test_unknown_words_are_ignored_and_empty_queries_find_nothing(spark, index):
    got = ranking(search.retrieve(queries(spark, ["beta gamma", "", "unknownword", "zzz beta"]), index, **REGEX))
    assert set(got) == {0, 3}


def test_last_pair_wins(spark, docs, index):
    processed = process_queries(queries(spark, ["to the to"]), **REGEX)
    weights = scoring.bigram_tfidf(matching.lookup_bigrams(processed, index.bigrams, index.pairs), index.n_docs)
    rows = {(r.doc_id, r.t1): r.weight for r in weights.collect()}
    for row in scoring.last_bigram_wins(weights).collect():
        assert row.bi == rows.get((row.doc_id, "the"), rows.get((row.doc_id, "to")))


def test_ties_go_to_the_lower_id(spark):
    scores = spark.createDataFrame([(0, 7, 0.1 + 0.2), (0, 3, 0.3), (0, 5, 0.9)], "qid bigint, doc_id bigint, score double")
    assert [r.doc_id for r in scoring.rank_top_k(scores, 2).orderBy("rank").collect()] == [5, 3]


@pytest.mark.parametrize(
    "text,use_full,budgets",
    [
        ("the machine learning", False, {"the": 50, "machine": 100, "learning": 100}),
        ("the of", False, {"the": 25, "of": 25}),
        ("the of", True, {"the": 125, "of": 125}),
        ("machine learning machine", False, {"machine": 125, "learning": 125}),
    ],
)
def test_term_budget(spark, text, use_full, budgets):
    terms = query_terms(process_queries(queries(spark, [text]), **REGEX))
    assert {r.term: r.budget for r in matching.term_budget(terms, 250, use_full=use_full).collect()} == budgets


def test_batch_report(spark, docs, index):
    assert search.query_batch_report(index).columns == ["qid", "query", "rank", "url", "rel_path"]
    rows = search.query_batch_report(index, queries(spark, ["the alpha"])).orderBy("rank").collect()
    assert [r.rel_path for r in rows] == [f"generated_results/0/result_0{i}.html" for i in range(5)]


def test_pair_dictionary(docs, index):
    pairs = {(r.t1, r.t2): r.df for r in index.pairs.collect()}
    assert pairs == {p: sum(p in set(zip(t, t[1:])) for t in docs.values()) for p in pairs} and ("rare", "the") in pairs


def test_few_but_huge_rows_are_measured_and_not_fetched(spark, monkeypatch):
    monkeypatch.setattr(session, "PINNED_BYTES", 1_000_000)
    huge = spark.range(20).select("id", F.expr("repeat('x', 100000)").alias("query"))
    assert session.pin(huge).rows is None
    assert session.pin(huge.limit(5)).rows.num_rows == 5
    assert session.pin(huge, session.pin(huge)).rows is None


def test_unfinished_index_does_not_open(spark, index, tmp_path):
    index_store.write_postings(index.postings, str(tmp_path / "postings"))
    with pytest.raises(Exception, match="manifest"):
        index_store.read_index(spark, str(tmp_path))


def test_stored_index_round_trip(spark, index, tmp_path):
    index_store.write_index(index, str(tmp_path))
    again = index_store.read_index(spark, str(tmp_path))
    assert again.n_docs == index.n_docs
    assert sorted(map(repr, again.postings.collect())) == sorted(map(repr, index.postings.collect()))
    assert "positions" not in index_store.read_postings(spark, str(tmp_path / "postings"), with_positions=False).columns
    sizes = {r.metric: r.value for r in reports.stored_sizes(spark, str(tmp_path)).collect()}
    assert set(sizes) == {"docs_kb", "postings_kb", "bigrams_kb", "terms_kb", "pairs_kb"} and min(sizes.values()) > 0


def test_rows_per_file(spark, docs, tmp_path):
    build.build_index(tokenized(spark, docs), str(tmp_path), near_threshold=None, rows_per_file=50)
    files = list((tmp_path / "postings").glob("*.parquet"))
    assert len(files) >= 4 and max(spark.read.parquet(str(f)).count() for f in files) <= 50
    assert not (tmp_path / "tokens").exists()


@pytest.fixture(scope="module")
def ranged(spark, docs, tmp_path_factory):
    """The same index in several key ranges of a file each."""
    path = str(tmp_path_factory.mktemp("ranged"))
    return build.build_index(tokenized(spark, docs), path, near_threshold=None, rows_per_file=60, files_per_range=1)


def test_ranges_hold_the_same_rows(index, ranged):
    assert len(ranged.term_ranges) > 3 and len(ranged.pair_ranges) > 3
    for name in ("docs", "postings", "bigrams", "terms", "pairs"):
        whole = getattr(index, name).drop("doc_block")
        assert sorted(map(repr, getattr(ranged, name).select(whole.columns).collect())) == sorted(map(repr, whole.collect()))
    rows = ranged.postings.select("term", "key_range").distinct().collect()
    assert len(rows) == len({r.term for r in rows}) and {r.term: r.key_range for r in rows} == {
        r.term: r.key_range for r in ranged.terms.collect()
    }


@pytest.mark.parametrize("pinned", [100_000, 0])
@pytest.mark.parametrize("candidates", [1_000_000, 0])
def test_ranged_lookups_give_the_same(spark, docs, ranged, monkeypatch, pinned, candidates):
    monkeypatch.setattr(session, "PINNED_ROWS", pinned)
    monkeypatch.setattr(matching, "CANDIDATE_ROWS", candidates)
    assert ranking(search.retrieve(queries(spark), ranged, **REGEX)) == expected(docs)


def test_cut_points_follow_the_frequencies():
    weights = [("a", 10), ("b", 400), ("c", 10), ("d", 90), ("e", 90)]
    points = key_ranges.cut_points(weights, 6, 1000)
    assert [k for k, _ in points] == ["b", "b", "b", "b", "d"] and [i for k, i in points if k == "b"] == sorted({i for k, i in points if k == "b"})
    assert key_ranges.range_keys(weights, 6) == ["b", "d"] and key_ranges.cut_points([], 4, 10) == []


def test_places_are_found_by_binary_search(spark):
    r = random.Random(4)
    points = sorted({(r.choice("abcdef'\\é") * r.randint(1, 2), r.randint(0, 9)) for _ in range(23)})
    rows = [(r.choice("abcdefgé'") * r.randint(1, 2), r.randint(0, 9)) for _ in range(200)] + points
    frame = spark.createDataFrame(rows, "k string, i bigint")
    got = frame.select("k", "i", key_ranges.place_among(points, F.col("k"), F.col("i")).alias("p"),
                       key_ranges.place_among(sorted({k for k, _ in points}), F.col("k")).alias("q")).collect()
    for row in got:
        assert row.p == sum(p <= (row.k, row.i) for p in points) and row.q == sum(k <= row.k for k in {k for k, _ in points})


def test_scratch_is_empty_after_a_build(spark, docs, tmp_path, monkeypatch):
    left = lambda: {f.name for f in pathlib.Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).glob("wordtrawl-*")}
    before = left()
    build.build_index(tokenized(spark, docs), str(tmp_path / "a"), near_threshold=None)
    assert left() == before
    monkeypatch.setattr(index_store, "write_docs", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build.build_index(tokenized(spark, docs), str(tmp_path / "b"), near_threshold=None)
    assert left() == before


# Growing an index ------------------------------------------------------------------------------------------------------


def batches(seed=11):
    """Three batches of pages (seq, url, loc, tokens) whose numbers, URLs and texts overlap."""
    r = random.Random(seed)
    texts = [[r.choice(WORDS) for _ in range(30)] for _ in range(12)]

    def text():
        tokens = list(r.choice(texts))
        for _ in range(r.choice([0, 0, 1, 2, 8])):
            tokens[r.randrange(30)] = r.choice(WORDS)
        return tokens

    return [[(i, r.choice([f"u{r.randrange(60)}", f"only{b}-{i}", None] if i % 9 == 0 else [f"u{r.randrange(60)}", f"only{b}-{i}"]), f"{b}/{i}", text())
             for i in range(30)] for b in range(3)]


PAGE_SCHEMA = "seq bigint, url string, disk_loc string, tokens array<string>"


def contents(index):
    """Everything an index says, without sequence numbers (which differ between one build and several)."""
    tables = {"docs": ["doc_id", "url", "disk_loc"], "postings": ["term", "doc_id", "tf", "positions"], "terms": ["term", "df"],
              "bigrams": ["t1", "t2", "doc_id", "tf", "positions"], "pairs": ["t1", "t2", "df"], "pages": ["url", "sig", "doc_id"]}
    return {name: sorted(map(repr, getattr(index, name).select(columns).collect())) for name, columns in tables.items()}


@pytest.mark.parametrize("threshold", [0.98, None])
def test_adding_batches_equals_one_build(spark, tmp_path, threshold):
    parts = batches()
    at_once = [(1000 * b + seq, *rest) for b, rows in enumerate(parts) for seq, *rest in rows]
    frames = [spark.createDataFrame(rows, PAGE_SCHEMA).repartition(3) for rows in (*parts, at_once)]
    whole = build.assemble_index(frames[3], threshold)
    assert 10 < whole.n_docs < 90

    grown = build.build_index(frames[0], str(tmp_path / "0"), threshold, rows_per_file=200, files_per_range=1)
    for b in (1, 2):
        grown = build.extend_index(grown, frames[b], str(tmp_path / str(b)), rows_per_file=150)
    assert grown.n_docs == whole.n_docs and len(grown.starts) == 3 and len(grown.paths) == 3
    assert contents(grown) == contents(whole)
    again = index_store.read_index(spark, str(tmp_path / "2"))
    assert ranking(search.retrieve(queries(spark), again, **REGEX)) == ranking(search.retrieve(queries(spark), whole, **REGEX))
    assert index_store.read_index(spark, str(tmp_path / "0")).n_docs == grown.starts[1]

    lazy = build.assemble_index(frames[0], threshold)
    lazy = build.assemble_index(frames[1], known=lazy)
    assert contents(lazy) == contents(index_store.read_index(spark, str(tmp_path / "1")))


def test_a_batch_without_news_and_wrong_paths(spark, tmp_path):
    frame = spark.createDataFrame(batches()[0], PAGE_SCHEMA)
    index = build.build_index(frame, str(tmp_path / "0"), rows_per_file=100, files_per_range=1)
    again = build.extend_index(index, frame, str(tmp_path / "1"))
    assert contents(again) == contents(index) and again.n_docs == index.n_docs
    none = build.extend_index(again, spark.createDataFrame([], PAGE_SCHEMA), str(tmp_path / "2"))
    assert contents(none) == contents(index) and none.starts == (0, index.n_docs, index.n_docs)
    with pytest.raises(ValueError, match="already holds"):
        build.extend_index(index, frame, str(tmp_path / "0"))
    with pytest.raises(ValueError, match="not stored"):
        build.extend_index(build.assemble_index(frame), frame, str(tmp_path / "3"))


def test_one_page_per_rank_although_numbers_repeat(spark, tmp_path):
    """Two batches that number their pages alike: each hit shows the page of its own segment."""
    first = spark.createDataFrame([(0, "http://a", "x", ["alpha", "beta"]), (1, "http://b", "y", ["gamma"])], PAGE_SCHEMA)
    second = spark.createDataFrame([(0, "http://c", "z", ["alpha", "delta"]), (1, "http://a", "w", ["alpha"])], PAGE_SCHEMA)
    index = build.extend_index(build.build_index(first, str(tmp_path / "0")), second, str(tmp_path / "1"))
    pages = spark.createDataFrame(
        [(0, 0, "<p>alpha beta"), (1, 0, "<p>gamma"), (0, 1, "<p>alpha delta"), (1, 1, "<p>alpha")], "seq bigint, segment int, content string"
    )
    listed, rendered = search.search(queries(spark, ["alpha"]), index, pages)
    assert [(r.rank, r.url) for r in listed.orderBy("rank").collect()] == [(1, "http://a"), (2, "http://c")]
    assert [r.html for r in rendered.orderBy("rank").collect()] == ["<p><mark>alpha</mark> beta", "<p><mark>alpha</mark> delta"]
    with pytest.raises(ValueError, match="segment"):
        search.search(queries(spark, ["alpha"]), index, pages.drop("segment"))


def test_merging_deletes_repeats_and_renumbers(spark, tmp_path):
    a, b, c = (spark.createDataFrame(rows, PAGE_SCHEMA) for rows in batches(5))
    first = build.build_index(a, str(tmp_path / "a"))
    second = build.extend_index(build.build_index(b, str(tmp_path / "b")), c, str(tmp_path / "c"))
    merged = build.merge_segments(first, second)
    urls = [r.url for r in merged.docs.collect()]
    assert len(urls) == len(set(urls)) == merged.n_docs < first.n_docs + second.n_docs
    assert sorted(r.doc_id for r in merged.docs.collect()) == list(range(merged.n_docs))
    kept = {r.doc_id: r.sig for r in merged.pages.filter("doc_id is not null").collect()}
    assert plain.greedy(kept) == set(kept) == set(range(merged.n_docs))
    tokens = {}
    for rows in batches(5):
        tokens |= {loc: t for _, _, loc, t in rows}
    docs = {r.doc_id: tokens[r.disk_loc] for r in merged.docs.collect()}
    assert {(r.term, r.doc_id): r.tf for r in merged.postings.collect()} == {(t, d): w.count(t) for d, w in docs.items() for t in set(w)}
    assert {r.term: r.df for r in merged.terms.collect()} == {t: sum(t in w for w in docs.values()) for t in WORDS}
    pairs = {(r.t1, r.t2): r.df for r in merged.pairs.collect()}
    assert pairs == {p: sum(p in set(zip(w, w[1:])) for w in docs.values()) for p in {p for w in docs.values() for p in zip(w, w[1:])}}
    starts = [sum(r.disk_loc.startswith(f"{s}/") for r in merged.docs.collect() for s in range(n)) for n in range(3)]
    assert list(merged.starts) == starts
    index_store.write_index(merged, str(tmp_path / "merged"))
    assert index_store.read_index(spark, str(tmp_path / "merged")).starts == merged.starts
