"""Published word/stem pairs of the Snowball English stemmer."""

import pytest
from pyspark.sql import functions as F

from wordtrawl.functions.stemming import stem_tokens, stem_word
from wordtrawl.operators import stems

PAIRS = """
consign consign, consigned consign, consigning consign, consignment consign, consist consist, consisted consist,
consistency consist, consistently consist, consolation consol, consolatory consolatori, console consol,
consolidate consolid, consolidating consolid, consolingly consol, consonant conson, consort consort,
conspicuous conspicu, conspicuously conspicu, conspiracy conspiraci, conspirators conspir, conspire conspir,
constable constabl, constance constanc, constancy constanc, constant constant, knack knack, knackeries knackeri,
knag knag, knaves knave, knavish knavish, kneaded knead, kneeled kneel, knees knee, knell knell, knew knew,
knick knick, knife knife, knightly knight, knitted knit, knitting knit, knives knive, knocker knocker, knots knot,
generate generat, generously generous, communication communic, dying die, hopping hop, hoping hope, cries cri,
ties tie, gas gas, this this, gaps gap, kiwis kiwi, by by, say say, happy happi, enjoyed enjoy, luxuriated luxuri,
falling fall, agreed agre, relational relat, skies sky, news news, herring herring, proceed proceed, only onli
"""


def test_published_pairs(spark):
    pairs = [tuple(p.split()) for p in PAIRS.split(",")]
    frame = spark.createDataFrame(pairs, "word string, stem string")
    got = frame.select("word", "stem", stem_word(F.col("word")).alias("got")).collect()
    assert [(r.word, r.got) for r in got] == [(r.word, r.stem) for r in got]


def test_apostrophes_and_short_words(spark):
    words = ["dog's", "dogs'", "'tis", "don’t", "it", "", "x''s", "yes", "boyish", "生活", "ies", "sses", "ll"]
    frame = spark.createDataFrame([(words,), (None,)], "words array<string>").coalesce(1)
    rows = [r[0] for r in frame.select(stem_tokens(F.col("words"))).collect()]
    assert rows == [["dog", "dog", "tis", "don't", "it", "", "x'", "yes", "boyish", "生活", "ie", "ss", "ll"], None]


def test_stemming_needs_no_python(spark):
    frame = spark.createDataFrame([(["a"],)], "words array<string>").select(stem_tokens(F.col("words")))
    assert "Python" not in frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("words", [1, 3, stems.WORDS])
def test_known_stems_change_no_result(spark, words):
    rows = [(i, [w for pair in PAIRS.split(",")[i::7] for w in pair.split()] + ["running"] * i) for i in range(7)]
    rows += [(8, None), (9, []), (10, [None, "running", "x" * 500 + "ing", "dog's", "生活", ""])]
    docs = spark.createDataFrame(rows, "`doc.id` bigint, tokens array<string>")
    want = docs.select("`doc.id`", stem_tokens(F.col("tokens")).alias("tokens"))
    got = stems.stem_documents(docs, words, sample_rows=6)
    assert got.columns == docs.columns
    assert sorted(got.collect()) == sorted(want.collect())
    assert stems.stem_documents(docs.limit(0)).collect() == []


def test_known_stems_are_bounded_and_move_no_text(spark):
    docs = spark.createDataFrame([(0, ["running"])], "doc_id bigint, tokens array<string>")
    stemmed = stems.stem_documents(docs)
    plan = stemmed._jdf.queryExecution().executedPlan().toString()
    outside = [line for line in plan.splitlines() if not line.lstrip().startswith(":")]
    assert any("Subquery" in line for line in outside) and not any("Exchange" in line for line in outside)
    assert "Python" not in plan and "NestedLoop" not in plan
