import collections
import math
import re

import pytest
from pyspark.sql import functions as F

from wordtrawl import session
from wordtrawl.functions import sentences
from wordtrawl.functions import tokens as tok
from wordtrawl.operators.sentences import abbreviations, period_counts, scored_words, tokenize_fitted
from wordtrawl.plans import build, search

PROSE = [
    "Mr. Smith met Mr. Jones in town. They had tea, e.g. 3 cups. Then Mr. Smith left the town.",
    "The town has walls. It has a mill, e.g. 2 wheels, and a church. Nobody knows.",
    "Tea is good. Mr. Smith likes tea in the mill. In town one drinks it, e.g. Assam.",
    "Wait... The cups fell. A church and a mill stood there. Mr. Jones left",
] * 5


def frame(spark, texts, extra="x"):
    return spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], f"doc_id bigint, text string, {extra} string")


def plain_scores(texts):
    counts = collections.defaultdict(lambda: [0, 0])
    for text in texts:
        for word in re.findall(r"[^\W\d_]+(?:\.[^\W\d_]+)*\.*", text or ""):
            counts[word.rstrip(".").lower()][not (word.endswith(".") and not word.endswith(".."))] += 1
    p = sum(k for k, _ in counts.values()) / max(1, sum(map(sum, counts.values())))
    scores = {}
    for word, (k, rest) in counts.items():
        if k:
            letters = len(word.replace(".", ""))
            ratio = 2 * (k * math.log(0.99 / p) + rest * math.log(0.01 / (1 - p)))
            scores[word] = (k, rest, ratio * math.exp(-letters) * (1 + word.count(".")) / letters**rest)
    return scores


def test_scores_equal_a_plain_version(spark):
    texts = PROSE + [None, "", "A.B.C. x", "1. 2.", "ÉTÉ. été. Ünder", "end.Next", "tea.. tea..."]
    rows = scored_words(frame(spark, texts)).collect()
    expected = plain_scores(texts)
    assert {r.word: (r.with_period, r.without_period) for r in rows} == {w: s[:2] for w, s in expected.items()}
    assert all(math.isclose(r.score, expected[r.word][2], abs_tol=1e-9) for r in rows)


def test_abbreviations_keep_their_period_after_fitting(spark):
    words = abbreviations(frame(spark, PROSE))
    assert sorted(r.word for r in words.collect()) == ["e.g", "mr"]
    texts = ["Mr. Smith has e.g. 3 mills. The town", "(Mr. X) is here, Mr. He left e.g.", "in town. Mr.", None, "", "a mr. b", "»E.G. A«"]
    rows = tokenize_fitted(frame(spark, texts), words).orderBy("doc_id").collect()
    assert [r.tokens for r in rows] == [
        ["mr.", "smith", "has", "e.g.", "3", "mills", "the", "town"],
        ["mr.", "x", "is", "here", "mr.", "he", "left", "e.g"],
        ["in", "town", "mr"],
        [],
        [],
        ["a", "mr.", "b"],
        ["e.g.", "a"],
    ]
    unfitted = frame(spark, texts).select(tok.tokenize(F.col("text")).alias("t")).first()[0]
    assert unfitted == ["mr", "smith", "has", "e.g", "3", "mills", "the", "town"]


def test_many_abbreviations_are_joined(spark, monkeypatch):
    words, docs = abbreviations(frame(spark, PROSE)), frame(spark, PROSE + [None, "", "no abbreviation. Here", "Mr. Mr. Mr. X"], "word")
    at_hand = {r.doc_id: r.tokens for r in tokenize_fitted(docs, words).collect()}
    monkeypatch.setattr(session, "PINNED_ROWS", 0)
    joined = tokenize_fitted(docs, words)
    assert joined.columns == ["doc_id", "text", "word", "tokens"]
    assert {r.doc_id: r.tokens for r in joined.collect()} == at_hand


@pytest.mark.parametrize("texts", [[], [None], ["no period at all"], ["all. have. one."]])
def test_corpora_without_abbreviations(spark, texts):
    docs = frame(spark, texts)
    assert abbreviations(docs).count() == 0
    assert tokenize_fitted(docs, abbreviations(docs)).count() == len(texts)


def test_stand_in_for_periods_counts_as_a_blank(spark):
    text = f"a{sentences.KEPT_PERIOD}b Mr. C"
    row = frame(spark, [text]).select(tok.tokenize(F.col("text"), abbreviations=["mr"]).alias("t")).first()
    assert row.t == ["a", "b", "mr.", "c"]


def test_fitting_combines_before_its_only_shuffle(spark):
    text = period_counts(frame(spark, PROSE))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("partial_count") >= 1


def test_pages_and_queries_share_the_fitted_words(spark, tmp_path):
    docs = frame(spark, PROSE[:4])
    known = [r.word for r in abbreviations(frame(spark, PROSE)).collect()]
    index = build.build_index(build.tokenize_documents(docs, abbreviations=known), str(tmp_path / "index"), near_threshold=None)
    queries = spark.createDataFrame([(0, "Mr. Smith")], "qid bigint, query string")
    assert sorted(r.doc_id for r in search.retrieve(queries, index, abbreviations=known).collect()) == [0, 2]
    assert index.terms.filter("term = 'mr.'").count() == 1 and index.terms.filter("term = 'mr'").count() == 0
