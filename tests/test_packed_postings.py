import random

import pytest

from wordtrawl.operators import postings
from wordtrawl.plans import build
from wordtrawl.sources import index_store

WORDS = ["", "a", "b", "ba", "é", "zz", "0", None]


@pytest.mark.parametrize("slice_tokens, run_rows", [(1, 1 << 22), (40, 25), (1 << 19, 1 << 22)])
def test_packed_postings_are_the_same_and_sorted(spark, monkeypatch, slice_tokens, run_rows):
    """Null, empty and one-word documents, null and empty words, words that are cut at ids, ids far apart, and several runs."""
    monkeypatch.setattr(postings, "SLICE_TOKENS", slice_tokens)
    monkeypatch.setattr(postings, "RUN_ROWS", run_rows)
    monkeypatch.setattr(postings, "SEND_ROWS", 7)
    r = random.Random(8)
    rows = [(i, [r.choice(WORDS) for _ in range(r.choice([0, 1, 2, 30]))]) for i in range(80)] + [(80, None), (1 << 61, ["a", "b", "a", "b"])]
    frame = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>").repartition(3)
    points, ranges = sorted([("a", 0), ("b", 20), ("b", 50), ("zz", 7)]), ("a", "zz")
    for made, keys in ((postings.unigram_postings, ("term",)), (postings.bigram_postings, ("t1", "t2"))):
        plain = {tuple(row[: len(keys) + 1]): (row["tf"], row["positions"]) for row in made(frame).collect()}
        blocks = made(frame, points, ranges, packed=True)
        assert blocks.columns == [postings.PLACE, postings.BLOCK]
        got = {}
        dealt = blocks.repartitionById(len(points) + 1, postings.PLACE)
        for place, part in enumerate(postings.unpacked(dealt, keys, ranges).rdd.glom().collect()):
            order = [tuple((row[k] is not None, row[k] or "") for k in keys) + (row["doc_id"],) for row in part]
            assert run_rows == 25 or order == sorted(order)
            for row in part:
                assert place == sum(p <= (row[0] or "", row["doc_id"]) for p in points)
                assert row[postings.PLACE_RANGE] == sum(p <= (row[0] or "") for p in ranges)
                assert tuple(row[: len(keys) + 1]) not in got
                got[tuple(row[: len(keys) + 1])] = (row["tf"], row["positions"])
        assert got == plain


def test_a_build_shuffles_blocks_and_no_rows(spark, tmp_path, monkeypatch):
    """Every posting went through the shuffle and Spark's sort as a row of a hundred bytes and more."""
    r = random.Random(9)
    rows = [(i, f"u{i}", f"{i}", [r.choice(["a", "b", "c", "d"]) for _ in range(50)]) for i in range(60)]
    pages = spark.createDataFrame(rows, "seq bigint, url string, disk_loc string, tokens array<string>").repartition(2)
    shuffled, real = [], index_store._write_ranged

    def seen(table, *args):
        shuffled.append(table.count())
        return real(table, *args)

    monkeypatch.setattr(index_store, "_write_ranged", seen)
    index = build.build_index(pages, str(tmp_path / "index"), near_threshold=None)
    assert len(shuffled) == 2 and max(shuffled) <= 8
    assert index.postings.count() > 200 and index.bigrams.count() > 500


def test_packed_postings_take_few_bytes(spark):
    """A block held whole strings, offsets and ids of eight bytes for every row."""
    r = random.Random(10)
    words = [f"{r.choice(['re', 'un', 'over'])}word{i}" for i in range(3_000)]
    rows = [(i, r.choices(words, k=400)) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>").repartition(1)
    points = [(words[i * 60], 0) for i in range(50)]
    blocks = postings.bigram_postings(frame, sorted(points), (), packed=True)
    taken = sum(len(row[postings.BLOCK]) for row in blocks.collect())
    assert taken < 12 * 100 * 399
    got = {tuple(row)[:3]: row["positions"] for row in postings.unpacked(blocks, ("t1", "t2")).collect()}
    assert got == {(row.t1, row.t2, row.doc_id): row.positions for row in postings.bigram_postings(frame).collect()}


def test_dictionaries_of_a_build_are_shuffled_once(spark, tmp_path, monkeypatch):
    """Frequencies were added up by hash and then dealt by range, in two shuffles."""
    known = spark.createDataFrame([("a", None, 5), ("c", "c", 1)], "t1 string, t2 string, df bigint")
    plans, real = [], type(known).sortWithinPartitions

    def seen(self, *args):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return real(self, *args)

    rows = [("b", "a"), ("a", None), ("b", "a"), (None, "a"), ("", "")] * 20
    monkeypatch.setattr(type(known), "sortWithinPartitions", seen)
    index_store.write_dictionary(spark.createDataFrame(rows, "t1 string, t2 string"), str(tmp_path / "pairs"), ["t1", "t2"], known)
    assert len(plans) == 1 and plans[0].count("Exchange") == 1
    got = {(row.t1, row.t2): row.df for row in spark.read.parquet(str(tmp_path / "pairs")).collect()}
    assert got == {("b", "a"): 40, ("a", None): 25, (None, "a"): 20, ("", ""): 20, ("c", "c"): 1}
