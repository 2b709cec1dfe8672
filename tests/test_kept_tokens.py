import pytest
from pyspark.sql import functions as F

from wordtrawl.plans import build


@pytest.mark.parametrize("limit", [1 << 21, 3])
def test_token_lists_are_not_sorted_and_at_most_shuffled_once(spark, tmp_path, monkeypatch, limit):
    """Token lists were shuffled and sorted for either kind of postings once their ids were too many for Spark's own broadcast."""
    rows = [(3 * i, f"u{i % 30}", f"{i}", [f"w{(i * k) % 11}" for k in range(i % 6)]) for i in range(40)]
    pages = spark.createDataFrame(rows, "seq bigint, url string, disk_loc string, tokens array<string>")
    expected = build.assemble_index(pages, None)
    expected = [sorted(t.collect()) for t in (expected.terms, expected.pairs, expected.postings, expected.bigrams)]
    monkeypatch.setattr(build, "BROADCAST_IDS", limit)
    joins, real = [], build._kept_tokens

    def seen(*args):
        joins.append(real(*args)._jdf.queryExecution().executedPlan().toString())
        return real(*args)

    monkeypatch.setattr(build, "_kept_tokens", seen)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = build.build_index(pages, str(tmp_path / "index"), near_threshold=None)
        assert [sorted(t.collect()) for t in (index.terms, index.pairs, index.postings, index.bigrams)] == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(joins) == 1 and "Sort" not in joins[0]
    assert ("Exchange hashpartitioning" in joins[0]) == (limit == 3)
    assert index.docs.agg(F.count("*")).first()[0] == index.n_docs == 30
