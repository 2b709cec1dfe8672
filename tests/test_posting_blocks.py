from collections import Counter

from pyspark.sql import functions as F

from wordtrawl.operators import postings


def test_posting_lists_are_gathered_after_the_shuffle_only(spark):
    """Lists that were gathered before the shuffle too were sorted and sent with their overhead."""
    rows = [(d, [f"w{(d * k) % 7}" for k in range(d % 5)]) for d in range(60)]
    made = postings.unigram_postings(spark.createDataFrame(rows, "doc_id bigint, tokens array<string>").repartition(4))
    lists = postings.posting_lists(made, 16)
    got = {(r.term, r.block): [(p.doc_id, p.tf, list(p.positions)) for p in r.postings] for r in lists.collect()}
    expected = {}
    for d, tokens in rows:
        for term, tf in Counter(tokens).items():
            expected.setdefault((term, d // 16), []).append((d, tf, [i for i, t in enumerate(tokens) if t == term]))
    assert got == expected
    assert postings.posting_lists(made, 16).select(F.size("postings").alias("n")).agg(F.sum("n")).first()[0] == made.count()
    plan = postings.posting_lists(made, 16)._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("partial_collect_list") < plan.index("Exchange" if "Exchange" in plan else "RepartitionBy")
