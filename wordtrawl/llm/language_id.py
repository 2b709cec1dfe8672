"""Language identification by nearest centroid over hashed character trigrams.

Letters are lower-cased, marks that combine with them stay, everything else becomes one blank, and the trigrams of the
resulting codes fall into ``DIMENSIONS`` buckets. A text's vector is log(1 + count) times the inverse document
frequency, normalised to length 1. Document frequencies are summed over all training texts; ``CENTROIDS`` centroids per
language come from spherical k-means over a sample of at most ``SAMPLE`` texts of each language (those with the smallest
hash of their id, one text of each id). A text gets the language of the centroid with the largest cosine; it is rejected
if that cosine is below ``SHARE`` of the one which all but a hundredth of the language's sampled texts reach with as
many distinct trigrams. For this the sampled texts are cut to the beginnings with 1, 2, 4, ... distinct buckets; a text
is held to the largest such number it has. So few trigrams have a loose limit and many a strict one, and repeating a
short text does not make it a long one. A number that no sampled text reaches has the limit of the one below it.

A task each learns the centroids of a language, from counts whose size does not depend on the lengths of the texts; the
driver gets ``CENTROIDS`` vectors a language and at most ``SIZES`` cosines a sampled text.

Defined cases: a null text or one without any letter is ``und`` with score 0 and is rejected; rows without a language are
not learnt from; of rows with the same id and language one is sampled, and any other repeated row counts as often as it
occurs; very long texts count whole; with equal cosines the language first in order wins; without any training text, as
from an empty table, everything is ``und``. Other columns are not looked at.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtrawl.llm.common import ship, small_or_shuffled, stored, summed

DIMENSIONS = 4096
CENTROIDS = 4
#: Texts per language from which centroids are made.
SAMPLE = 250
SLICES = 32
SHARE = 0.8
#: Powers of two up to ``DIMENSIONS`` distinct buckets.
SIZES = DIMENSIONS.bit_length()
UNKNOWN = "und"
_SHIFT = 32 - 12


def _letter(code: int) -> int:
    """Lower-case code of a letter (the first of several), a combining mark as it is, 32 for anything else."""
    char = chr(code)
    if char.isalpha():
        return ord(char.lower()[0])
    return code if unicodedata.category(char)[0] == "M" else 32


def _letters() -> np.ndarray:
    """``_letter`` of every code of the Basic Multilingual Plane."""
    return np.fromiter(map(_letter, range(0x10000)), np.uint32, 0x10000)


_LETTER = _letters()


def trigrams(text: str | None) -> np.ndarray:
    """The buckets of the trigrams of the whole text, in order."""
    codes = np.frombuffer(f" {text or ''} ".encode("utf-32-le", "surrogatepass"), "<u4")
    high = codes >= 0x10000
    if high.any():
        found, place = np.unique(codes[high], return_inverse=True)
        beyond = np.fromiter(map(_letter, found.tolist()), np.uint32, len(found))[place]
        codes = _LETTER[np.where(high, 0, codes)]
        codes[high] = beyond
    else:
        codes = _LETTER[codes]
    codes = codes[(codes != 32) | np.concatenate([[True], codes[:-1] != 32])]
    if len(codes) < 3:
        return np.zeros(0, np.uint32)
    mixed = codes[:-2] * np.uint32(2654435761) + codes[1:-1] * np.uint32(2246822519) + codes[2:] * np.uint32(3266489917)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(668265263)
    return mixed >> np.uint32(_SHIFT)


def trigram_counts(text: str | None) -> np.ndarray:
    """How often each bucket's trigrams occur in the whole text."""
    return np.bincount(trigrams(text), minlength=DIMENSIONS)


def size_of(counts: np.ndarray) -> np.ndarray:
    """Whole logarithm to base 2 of the number of distinct buckets of each row."""
    return np.frexp(np.maximum(1, np.count_nonzero(counts, axis=-1)))[1] - 1


def beginnings(buckets: np.ndarray) -> np.ndarray:
    """Counts of the shortest beginnings that have 1, 2, 4, ... distinct buckets, a row each."""
    first = np.sort(np.unique(buckets, return_index=True)[1])
    ends = [first[(1 << k) - 1] + 1 for k in range(len(first).bit_length())]
    return np.array([np.bincount(buckets[:end], minlength=DIMENSIONS) for end in ends]).reshape(-1, DIMENSIONS)


def packed_beginnings(buckets: np.ndarray) -> bytes:
    """``beginnings`` as (row, bucket, count) triples: fewer than 2 * ``DIMENSIONS``, however long the text."""
    rows = beginnings(buckets)
    row, bucket = np.nonzero(rows)
    return np.stack([row, bucket, rows[row, bucket]]).astype("<i4").tobytes()


def unpacked_beginnings(packed: bytes) -> np.ndarray:
    row, bucket, count = np.frombuffer(packed, "<i4").reshape(3, -1)
    rows = np.zeros((row.max(initial=-1) + 1, DIMENSIONS), np.int64)
    rows[row, bucket] = count
    return rows


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as vectors of length 1."""
    v = np.log1p(counts, dtype=np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    idf: np.ndarray
    languages: tuple[str, ...]
    centroids: np.ndarray
    owner: np.ndarray
    #: Largest distance by language and ``size_of`` a text.
    limits: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores, and whether each text is rejected."""
        names, scores, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for start in range(0, len(known), 64):
            block = known[start : start + 64]
            counts = np.stack([trigram_counts(texts[i]) for i in block])
            cosines = weighted(counts, self.idf) @ self.centroids.T
            best = cosines.argmax(axis=1)
            top = np.clip(cosines[np.arange(len(block)), best], 0, 1)
            for i, b in zip(block, best):
                names[i] = self.languages[self.owner[b]]
            scores[block] = top
            rejected[block] = 1 - top > self.limits[self.owner[best], size_of(counts)]
        return names, scores, rejected


def spherical_means(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means by cosine with farthest-first seeds; deterministic."""
    centres = [vectors.mean(axis=0)]
    while len(centres) < min(k, len(vectors)):
        centres.append(vectors[(vectors @ np.array(centres).T).max(axis=1).argmin()])
    centres = np.array(centres)
    for _ in range(rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        nearest = (vectors @ centres.T).argmax(axis=1)
        for j in range(len(centres)):
            if (nearest == j).any():
                centres[j] = vectors[nearest == j].mean(axis=0)
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def limits_of(found: list[np.ndarray]) -> np.ndarray:
    """Largest distance of each size, from the cosines that the ``beginnings`` of a language's sampled texts reach."""
    cosines = [[of[k] for of in found if len(of) > k] for k in range(SIZES)]
    return 1 - SHARE * np.maximum.accumulate([np.quantile(of, 0.01) if of else 0.0 for of in cosines])


def fit(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Fit on the rows of ``train`` that have a language and a letter."""
    spark = train.sparkSession
    ship(spark)
    rows = train.select(F.col(key).alias("key"), F.col(text).alias("body"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter("lang is not null and body is not null")

    def frequencies(batches):
        total = np.zeros(DIMENSIONS + 1)
        for batch in batches:
            for body in batch["body"]:
                if has_letter(body):
                    total[:-1] += trigram_counts(body) > 0
                    total[-1] += 1
        return total

    df = summed(rows.select("body"), frequencies, DIMENSIONS + 1)
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)

    # The smallest hashes of each slice of a language first, then of the language: no task gets all rows of a common one.
    order = F.col("hash"), F.col("key")
    ranked = rows.select("key", "lang", F.xxhash64(F.col("key").cast("string")).alias("hash")).distinct()
    for place in (Window.partitionBy("lang", F.pmod("hash", F.lit(SLICES))), Window.partitionBy("lang")):
        ranked = ranked.withColumn("place", F.row_number().over(place.orderBy(*order))).filter(F.col("place") <= SAMPLE).drop("place")
    chosen = ranked.select(F.col("key").alias("chosen"), F.col("lang").alias("of"))

    @F.pandas_udf("counts binary, starts binary")
    def vectors(texts: pd.Series) -> pd.DataFrame:
        found = [trigrams(t) if has_letter(t) else None for t in texts]
        counts = [None if b is None else np.bincount(b, minlength=DIMENSIONS).astype("<i4").tobytes() for b in found]
        return pd.DataFrame({"counts": counts, "starts": [None if b is None else packed_beginnings(b) for b in found]})

    def learnt(texts: pd.DataFrame) -> pd.DataFrame:
        texts = texts.sort_values(["key", "counts"], kind="stable")
        own = spherical_means(weighted(np.stack([np.frombuffer(c, "<i4") for c in texts["counts"]]), idf), CENTROIDS)
        own = own.astype("<f4")
        cosines = [(weighted(unpacked_beginnings(s), idf) @ own.T).max(axis=1).astype(float) for s in texts["starts"]]
        centroid = [one.tobytes() for one in own] + [None] * (len(texts) - len(own))
        return pd.DataFrame({"lang": texts["lang"], "place": range(len(texts)), "cosines": cosines, "centroid": centroid})

    # At most SAMPLE keys a language. Of the rows of a key one is kept, with letters if there is one, so that a task gets no
    # more than SAMPLE rows of a language.
    chosen = small_or_shuffled(stored(chosen))
    sample = rows.join(chosen, F.col("key").eqNullSafe(F.col("chosen")) & (F.col("lang") == F.col("of")), "left_semi")
    one = F.min(F.struct((~F.col("body").rlike(r"\p{L}")).alias("bare"), F.xxhash64("body").alias("hash"), "body"))
    sample = sample.groupBy("lang", "key").agg(one.alias("one")).withColumn("body", F.col("one.body"))
    sample = sample.select("lang", "key", vectors("body").alias("x")).select("lang", "key", "x.*").filter("counts is not null")
    # A row per sampled text: the cosines of its beginnings, and in the first rows of a language a centroid each.
    found = sample.groupBy("lang").applyInPandas(learnt, "lang string, place int, cosines array<double>, centroid binary")
    found = found.toPandas().sort_values(["lang", "place"], kind="stable")
    languages = tuple(sorted(found["lang"].unique()))
    if not languages:
        return LanguageModel(idf, (), np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), np.zeros((0, SIZES)))
    limits = np.array([limits_of([np.asarray(c) for c in found["cosines"][found["lang"] == name]]) for name in languages])
    held = found[found["centroid"].notna()]
    centroids = np.stack([np.frombuffer(c, "<f4") for c in held["centroid"]])
    return LanguageModel(idf, languages, centroids, np.searchsorted(languages, held["lang"]), limits)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """struct(lang_pred, score, rejected) of a column of texts."""
    ship(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores, rejected = model.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores, "rejected": rejected})

    return predicted(F.col(text))
