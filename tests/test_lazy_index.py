from pyspark.sql import functions as F

from wordtrawl.plans import build


def test_pages_of_a_lazy_index_are_tokenised_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def split(text):
        calls.add(1)
        return text.split()

    rows = [(i, f"u{i}", f"{i}", f"a b{i} c{i * i}") for i in range(12)]
    pages = spark.createDataFrame(rows, "seq bigint, url string, disk_loc string, text string")
    index = build.assemble_index(pages.select("seq", "url", "disk_loc", split("text").alias("tokens")))
    assert index.postings.count() == 3 * index.n_docs and index.docs.count() == index.n_docs
    assert calls.value == len(rows)
