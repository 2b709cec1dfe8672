"""The registered queries of this package and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtrawl.llm import best_fit, byte_tokens, centroids, common, jaccard_join, language_id, language_model, neighbours, packing, periodic_runs
from wordtrawl.llm import quality_classifier, quality_rules, sentencepieces, statements, toxicity, url_filter
from wordtrawl.session import spread


def table(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(read, *keys) if keys else read


RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op1_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings", "vec_id"), F.col("id") % 50 == 0)


def op2_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id").select("page_id", "url")
    model = url_filter.fit(url_filter.default_table(spark))
    return pages.select("page_id", url_filter.judge(pages, RULES, model).alias("x")).select("page_id", "x.*")


def op3_sentencepieces(spark, sf_dir):
    model = sentencepieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepieces.encode(table(spark, sf_dir, "documents", "doc_id"), model, digests=True)


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    docs = common.stored(docs.select("doc_id", quality_classifier.statistics(docs).alias("stats")))
    labels = common.labels_of(table(spark, sf_dir, "labels"), "quality")
    train = docs.filter(common.fold("doc_id", 5) != 0).join(labels, F.col("doc_id") == F.col("key")).select("stats", "y")
    model = quality_classifier.fit(train)
    scored = docs.select(
        "doc_id", (common.fold("doc_id", 5) == 0).alias("held_out"), quality_classifier.score(model, F.col("stats")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= quality_classifier.THRESHOLD).cast("int"))


def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(common.fold("doc_id", 4) != 2))
    judged = docs.select("doc_id", (common.fold("doc_id", 4) == 2).alias("held_out"), language_id.predict(docs, model).alias("x"))
    return judged.select("doc_id", "held_out", "x.lang_pred", "x.score", "x.rejected")


def byte_vocabulary():
    """Ranks and special strings of the byte-level vocabulary of 50,257 ids."""
    ranks = byte_tokens.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, byte_tokens.read_special(public_tokenizers.path("byte_bpe_50k.json"))


def op6_packing(spark, sf_dir):
    ranks, special = byte_vocabulary()
    docs = table(spark, sf_dir, "documents", "doc_id")
    return packing.pack(docs, ranks, public_tokenizers.PATTERN, with_ids=False, special=special)


def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text"))


def op8_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules.quality_rules(docs, trusted)


def op9_language_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    scored = language_model.score(docs, common.fold("doc_id", 5) != 1)
    return scored.withColumn("held_out", common.fold("doc_id", 5) == 1)


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", "lang")
    train = docs.filter(common.fold("doc_id", 5) != 0)
    model = toxicity.fit(train, common.labels_of(table(spark, sf_dir, "labels"), "toxic"), language_id.fit(train))
    scored = docs.select("doc_id", (common.fold("doc_id", 5) == 0).alias("held_out"), toxicity.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def with_planted_periods(docs, text="text", key="doc_id"):
    """(key, text): texts of one key in ten go on periodically from some word on, as the key's crc32 says; others stay."""
    h = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))

    def periodic(words):
        n, g = F.size(words), F.floor(h / 10)
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(words, lambda w, i: F.get(words, place(i))), " ")

    rewritten = quality_rules.let(quality_rules.words_of(F.col(text)), lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise(F.lit("")))
    return docs.select(key, F.when(h % 10 == 0, rewritten).otherwise(F.col(text)).alias(text))


def run_digests(docs):
    rows = periodic_runs.periodic_runs(with_planted_periods(docs))
    rows = rows.withColumn("top", periodic_runs.greatest(F.col("runs")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.*",
        F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        sha(periodic_runs.written(F.col("runs"))).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark, sf_dir):
    return run_digests(table(spark, sf_dir, "documents", "doc_id"))


def op12_best_fit(spark, sf_dir):
    ranks, special = byte_vocabulary()
    docs = table(spark, sf_dir, "documents", "doc_id")
    return best_fit.pack(docs, ranks, public_tokenizers.PATTERN, special, with_ids=False)


def op13_centroids(spark, sf_dir):
    vectors = centroids.integer_vectors(table(spark, sf_dir, "embeddings", "vec_id"))
    return centroids.described(centroids.cluster(vectors))


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_urls": op2_urls,
    "op3_sentencepieces": op3_sentencepieces,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_packing": op6_packing,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_model": op9_language_model,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_best_fit": op12_best_fit,
    "op13_centroids": op13_centroids,
}

STATEMENTS: dict[str, str] = {"op13_centroids": statements.centroid_rounds()}
