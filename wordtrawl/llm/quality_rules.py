"""Quality rules: base counts, and the log-likelihood ratio of hashed n-grams between trusted texts and the whole corpus.

Everything here is a DataFrame expression. Words are runs of anything but ASCII white space. Unigrams and bigrams fall into
``BUCKETS`` hash buckets; two multinomials over the buckets are counted, one over the trusted texts and one over all texts,
the latter scaled to the size of the former, both with add-``SMOOTHING``. A text is judged by the others: its own n-grams are
taken out of the corpus counts, and out of the trusted ones if it is trusted itself. Its score is the mean over its n-grams of
log(trusted / all), and it passes from ``THRESHOLD`` on.

Defined cases: a null text counts as empty; a text without words scores 0 and fails the base rules; without any other trusted
text every score is 0; a text of any length is counted whole; ties cannot arise, each text is judged by itself; repeated rows are
counted and judged each; a null id is kept as null and is never trusted; an empty table gives no rows; input columns other
than the id and the text are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtrawl.llm.common import small_or_shuffled

#: Hash buckets of the two multinomials, and so the bound of what is collected and sent along.
BUCKETS = 8192
#: Added to the trusted count of a bucket and to the one expected from the corpus.
SMOOTHING = 2.0
#: Nats per n-gram: trusted text lies within a few hundredths of 0, text made of other words lies below.
THRESHOLD = -0.05
MIN_WORDS = 10
WINDOW = 5
WHITE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def n_grams(hashes: Column, buckets: int) -> Column:
    """Buckets of all unigrams and bigrams of a list of word hashes."""
    pairs = F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.concat(F.transform(hashes, lambda h: F.pmod(F.xxhash64(h), F.lit(buckets)).cast("int")), pairs)


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of ``window`` words that the text holds twice or more."""

    def windows(h):
        starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (window - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, window)]))

    def covered(ranked):
        twin = lambda s, k: F.coalesce(F.get(ranked, k)["h"] == s["h"], F.lit(False))
        starts = F.sort_array(F.transform(F.filter(ranked, lambda s, k: twin(s, k - 1) | twin(s, k + 1)), lambda s: s["i"]))
        steps = lambda p: F.transform(
            p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))
        )
        return let(starts, lambda p: F.aggregate(steps(p), F.lit(0).cast("long"), lambda a, x: a + x))

    def count(w):
        ranked = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(ranked, covered))

    return let(windows(hashes), count)


def base_counts(text: Column, words: Column, hashes: Column) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), all long."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    duplicates = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        duplicates.cast("long").alias("n_dup_lines"),
        repeated_words(hashes).alias("n_repeat_words"),
    )


def _hashed(text: Column, body: Callable[[Column, Column], Column]) -> Column:
    return let(words_of(text), lambda words: let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: body(words, h)))


def flagged(docs: DataFrame, trusted: DataFrame, text: str, key: str) -> DataFrame:
    """(key, body, t): every row of ``docs`` with 1 if its key is in ``trusted``, else 0."""
    ids = trusted.select(F.col(key).alias("trusted_key")).filter("trusted_key is not null").distinct()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = rows.join(small_or_shuffled(ids), F.col("key") == F.col("trusted_key"), "left")
    return rows.select("key", "body", F.col("trusted_key").isNotNull().cast("long").alias("t"))


def bucket_counts(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, corpus, trusted): n-gram counts over all texts and over those whose key is in ``trusted``."""
    rows = flagged(docs, trusted, text, key)
    grams = rows.select("t", F.explode(_hashed(F.col("body"), lambda words, h: n_grams(h, buckets))).alias("bucket"))
    return grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("corpus"), F.sum("t").alias("trusted"))


def totals(counts: DataFrame, buckets: int = BUCKETS) -> tuple[list[int], list[int]]:
    """Corpus and trusted counts of every bucket; at most ``buckets`` rows come to the driver."""
    corpus, trusted = [0] * buckets, [0] * buckets
    for row in counts.toLocalIterator():
        corpus[row["bucket"]], trusted[row["bucket"]] = row["corpus"], row["trusted"]
    return corpus, trusted


def _table(counts: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, counts))), ",").cast("array<double>")


def mean_ratio(grams: Column, own_trust: Column, corpus: list[int], trusted: list[int], smoothing: float = SMOOTHING) -> Column:
    """Mean log(trusted / all) over the n-grams of a text, with the text itself left out of both counts."""
    every, good = _table(corpus), _table(trusted)
    n_corpus, n_trusted = F.lit(sum(corpus)), F.lit(sum(trusted))

    def over_runs(ranked):
        size = F.size(ranked)
        others = n_corpus - size
        share = F.when(others > 0, (n_trusted - own_trust * size) / others).otherwise(F.lit(0.0))
        starts = F.array_compact(F.transform(ranked, lambda b, i: F.when(b.eqNullSafe(F.get(ranked, i - 1)), F.lit(None)).otherwise(i)))

        def bucket_runs(starts):
            # What a later step needs more than once is worked out once: a lambda would compute it at each mention.
            times = lambda start, k: (F.coalesce(F.get(starts, k + 1), size) - start).cast("double")
            return F.transform(starts, lambda start, k: F.struct(F.get(ranked, start).alias("b"), times(start, k).alias("m")))

        def total(fixed):
            def add(sum_, run):
                above = F.get(good, run["b"]) - fixed["trust"] * run["m"] + F.lit(smoothing)
                below = (F.get(every, run["b"]) - run["m"]) * fixed["share"] + F.lit(smoothing)
                return sum_ + run["m"] * F.log(above / below)

            return F.aggregate(let(starts, bucket_runs), F.lit(0.0), add) / size

        fixed = F.struct(share.alias("share"), own_trust.cast("double").alias("trust"))
        return F.when(size > 0, let(fixed, total)).otherwise(F.lit(0.0))

    return let(F.sort_array(grams), over_runs)


def judge(rows: DataFrame, corpus: list[int], trusted: list[int], threshold: float = THRESHOLD, key: str = "doc_id") -> DataFrame:
    """Base counts, score and verdict of every row of ``flagged`` rows (key, body, t)."""

    def both(words, hashes):
        score = mean_ratio(n_grams(hashes, len(corpus)), F.col("t"), corpus, trusted)
        return F.struct(base_counts(F.col("body"), words, hashes).alias("base"), score.alias("score"))

    judged = rows.select("key", _hashed(F.col("body"), both).alias("x"))
    judged = judged.select(F.col("key").alias(key), "x.base.*", F.col("x.score").alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def quality_rules(
    docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS
) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept), one row per row.

    Both multinomials are counted over all of ``docs``, then every one of its rows is judged.
    """
    counts = totals(bucket_counts(docs, trusted, text, key, buckets), buckets)
    return judge(flagged(docs, trusted, text, key), *counts, threshold, key)
