import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_a_statement():
    """Queries of the optional package that SQL cannot express have none."""
    optional = {name for name in contract.queries() if name.startswith("op") and name[2].isdigit()} | {"pipeline"}
    assert set(contract.oracle_sql()) - optional == set(contract.queries()) - optional


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
@pytest.mark.parametrize(
    "name", ["page_text", "tokens_treebank", "highlight", "simhash64", "drop_near_duplicates", "unigram_postings", "rank_top_k"]
)
def test_query_equals_statement(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    theirs = duck.sql(contract.oracle_sql()[name])
    ours = contract.queries()[name](spark, SF_DIR)
    order = sorted(ours.columns)
    assert order == sorted(theirs.columns)
    assert sorted(map(repr, ours.select(order).toPandas().values.tolist())) == sorted(
        map(repr, theirs.df()[order].values.tolist())
    )


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
def test_scored_hits_lie_in_documents_of_the_rarest_term(spark):
    """Far fewer rows than a full lookup gives, and the same documents after the AND."""
    index = contract._index(spark, SF_DIR)
    every, kept = (hits(spark, SF_DIR, index) for hits in (contract._hits, contract._hits_to_score))
    assert 0 < 2 * kept.count() < every.count()
    documents = [sorted(map(tuple, contract.matching.boolean_and(hits).collect())) for hits in (every, kept)]
    assert documents[0] and documents[0] == documents[1]
