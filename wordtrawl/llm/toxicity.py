"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

Words are lower-cased, stripped of punctuation and hashed twice, as a whole and by their first ``STEM`` letters; a word's
vector is a row of each of two tables, so unseen forms of a word are known by their beginning. Filters of widths 1 to 3 run
over the whole text, each is max-pooled, and a logistic unit joins them. A quarter of the labelled rows, by a hash of their
id, is kept apart; all others train the network. It starts on the driver, from a sample of at most ``SAMPLE``
labelled texts of either label (those with the smallest hash of their id, one text of each id) and, of them, as many as
have ``SAMPLE_WORDS`` words together, without texts that have a 32nd of that alone. From there every training row is learnt
from once, in tasks of about ``TRAINER_ROWS`` rows that start alike, and what they changed is averaged by rows; the vector of
a word over the tasks that met it. On all rows kept apart, each
language gets the threshold with the best balanced accuracy, and scores are shifted so that it lies at 0.5. Their logits are
counted in steps of 1 / ``LOGIT_STEPS``. The
language of a text is the one predicted from its letters, never a column; a language with fewer than ``MIN_CALIBRATION``
texts of either label has the threshold of all.

Defined cases: a null text counts as empty; a text without words has nothing to pool and gets the bias; repeated label rows
are averaged and toxic from 0.5 on, repeated texts of an id count as often as they occur; without both labels, as from empty tables, every score is the share of toxic labels (0
without any). Very long texts are scored whole. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from copy import deepcopy
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtrawl.llm.common import ship, small_or_shuffled, stored, summed
from wordtrawl.llm.language_id import LanguageModel

#: Labelled texts of either label that training starts from on the driver.
SAMPLE = 3000
#: Words of the sampled texts of either label that are brought to the driver, eight bytes each.
SAMPLE_WORDS = 1 << 22
BUCKETS = 1 << 16
STEM = 4
DIMENSION = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
#: Passes over the sample, and steps that small samples get at least.
EPOCHS = 10
STEPS = 1500
BATCH = 32
RATE = 0.05
#: Rows that a task learns from, and words of one step there (a longer text is a step of its own).
TRAINER_ROWS = 8192
STEP_WORDS = 1 << 17
MIN_CALIBRATION = 15
#: Steps of a logit that are told apart, and the largest logit.
LOGIT_STEPS = 64
LOGIT_LIMIT = 32
REMEMBERED = 200_000
THRESHOLD = 0.5
_PUNCTUATION = ".,;:!?\"'()[]{}<>|#*$%&-_/\\«»„“”…"
_POOLED = FILTERS * len(WIDTHS)
_PAD = max(WIDTHS) - 1
_ARRAYS = "first", "second", "kernel", "shift", "out"


@lru_cache(maxsize=1)
def worker_words() -> Words:
    """The word memory of a Python worker."""
    return Words()


class Words:
    """Bucket pairs of words, remembered per distinct word up to a bound."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def buckets(self, text: str | None) -> np.ndarray:
        """For each word of the whole text the buckets of the word and of its beginning, in one number."""
        words = (text or "").split()
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for word in set(words):
                if word not in self.known:
                    bare = word.lower().strip(_PUNCTUATION) or word
                    stem = bare[:STEM]
                    self.known[word] = zlib.crc32(bare.encode()) % BUCKETS << 32 | zlib.crc32(b"^" + stem.encode()) % BUCKETS
            found = list(map(self.known.__getitem__, words))
        return np.array(found, np.int64)


@dataclass
class Network:
    first: np.ndarray
    second: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: float

    @classmethod
    def random(cls, seed: int = 11) -> Network:
        r = np.random.default_rng(seed)
        tables = [r.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32) for _ in range(2)]
        kernel = r.normal(0, 0.3, (2 * DIMENSION, sum(WIDTHS) * FILTERS)).astype(np.float32)
        return cls(*tables, kernel, np.zeros(_POOLED, np.float32), np.abs(r.normal(0, 0.3, _POOLED)).astype(np.float32), 0.0)

    def layout(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of several texts with padding behind each, a mask of real words, and where each text starts."""
        gap = np.full(_PAD + 1, -1, np.int64)
        flat = np.concatenate([part for text in texts for part in (text, gap)])
        starts = np.append(0, np.cumsum([len(text) + _PAD + 1 for text in texts])[:-1])
        return np.maximum(flat, 0), flat >= 0, starts

    def vectors(self, flat: np.ndarray, real: np.ndarray) -> np.ndarray:
        x = np.hstack([self.first[flat >> 32], self.second[flat & 0xFFFFFFFF]])
        x[~real] = 0
        return x

    def activations(self, x: np.ndarray) -> np.ndarray:
        """Filter outputs at each place, before pooling."""
        y = x @ self.kernel
        z = np.tile(self.shift, (len(x), 1))
        column = 0
        for i, width in enumerate(WIDTHS):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            for j in range(width):
                z[: len(x) - j, own] += y[j:, column : column + FILTERS]
                column += FILTERS
        return np.maximum(z, 0)

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        flat, real, starts = self.layout(texts)
        return np.maximum.reduceat(self.activations(self.vectors(flat, real)), starts) @ self.out + self.bias

    def squares(self) -> dict:
        """What Adagrad starts from."""
        return {name: np.full(getattr(self, name).shape, 1e-3, np.float32) for name in _ARRAYS} | {"bias": 1e-3}

    def train(self, texts: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> dict:
        """Adagrad on the balanced logistic loss; returns its sums of squares."""
        r = np.random.default_rng(seed)
        squares = self.squares()
        weight = balanced(labels, labels.mean())
        batches = -(-len(texts) // BATCH)
        for _ in range(max(EPOCHS, -(-STEPS // batches))):
            order = r.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                batch = order[at : at + BATCH]
                self.learn([texts[i] for i in batch], labels[batch], weight[batch], squares)
        return squares

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, squares: dict) -> None:
        """One step; the gradient of a pooled filter goes to the place of its maximum."""

        def step(name, place, gradient):
            squares[name][place] += gradient**2
            getattr(self, name)[place] -= RATE * gradient / np.sqrt(squares[name][place])

        flat, real, starts = self.layout(texts)
        x = self.vectors(flat, real)
        a = self.activations(x)
        ends = np.append(starts[1:], len(a))
        places = np.array([s + a[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
        pooled = np.take_along_axis(a, places, 0)
        p = 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.bias, -30, 30)))
        error = ((p - labels) * weight / len(texts)).astype(np.float32)
        back = error[:, None] * self.out * (pooled > 0)
        kernel, dx = np.zeros_like(self.kernel), np.zeros_like(x)
        column = 0
        for i, width in enumerate(WIDTHS):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            for j in range(width):
                at_word = np.minimum(places[:, own] + j, len(x) - 1)
                columns = slice(column, column + FILTERS)
                kernel[:, columns] = np.einsum("bf,bfd->df", back[:, own], x[at_word])
                np.add.at(dx, at_word, back[:, own, None] * self.kernel[:, columns].T[None])
                column += FILTERS
        step("out", slice(None), error @ pooled)
        step("shift", slice(None), back.sum(axis=0))
        step("kernel", slice(None), kernel)
        squares["bias"] += float(error.sum()) ** 2
        self.bias -= RATE * float(error.sum()) / squares["bias"] ** 0.5
        touched = np.flatnonzero(dx.any(axis=1) & real)
        for name, rows, part in (
            ("first", flat[touched] >> 32, slice(DIMENSION)),
            ("second", flat[touched] & 0xFFFFFFFF, slice(DIMENSION, None)),
        ):
            distinct, inverse = np.unique(rows, return_inverse=True)
            gradient = np.zeros((len(distinct), DIMENSION), np.float32)
            np.add.at(gradient, inverse, dx[touched, part])
            step(name, distinct, gradient)

    def flat(self) -> np.ndarray:
        """All parameters in a row, the tables of words first."""
        return np.concatenate([*[getattr(self, name).ravel() for name in _ARRAYS], [self.bias]]).astype(float)

    def moved(self, change: np.ndarray) -> Network:
        """This network with a change added to ``flat``."""
        values, at, parts = self.flat() + change, 0, []
        for name in _ARRAYS:
            old = getattr(self, name)
            parts.append(values[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return Network(*parts, float(values[at]))


def balanced(labels: np.ndarray, share: float) -> np.ndarray:
    """Weights by which both labels count alike, given the share of toxic ones."""
    return np.where(labels > 0.5, 0.5 / share, 0.5 / (1 - share))


def steps_of(sizes: list[int]) -> Iterator[slice]:
    """Slices of at most ``BATCH`` texts with at most ``STEP_WORDS`` words, or of one longer text."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start == BATCH or held + size > STEP_WORDS):
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def refined(rows: DataFrame, network: Network, squares: dict, share: float, tasks: int) -> Network:
    """The network after every row (key, body, y) was learnt from once, in ``tasks`` tasks whose changes are averaged by rows."""
    start = network.flat()
    in_tables = 2 * BUCKETS * DIMENSION

    def learnt(batches: Iterable[pd.DataFrame]) -> np.ndarray:
        own, sums, words, n = deepcopy(network), deepcopy(squares), worker_words(), 0
        for rows in batches:
            y, texts = rows["y"].to_numpy(float), [words.buckets(t) for t in rows["body"]]
            weight = balanced(y, share)
            for part in steps_of([len(t) for t in texts]):
                own.learn(texts[part], y[part], weight[part], sums)
            n += len(rows)
        change = own.flat() - start
        met = change[:in_tables].reshape(-1, DIMENSION).any(axis=1)
        return np.concatenate([n * change, n * met, [n]])

    dealt = rows.repartition(tasks, "key").sortWithinPartitions("key", F.xxhash64("body"))
    total = summed(dealt.select("body", "y"), learnt, len(start) + 2 * BUCKETS + 1)
    n = np.full(len(start), total[-1])
    n[:in_tables] = np.repeat(total[len(start) : -1], DIMENSION)
    return network.moved(total[: len(start)] / np.maximum(n, 1))


def counted_logits(rows: DataFrame, network: Network, languages: LanguageModel) -> pd.DataFrame:
    """(lang, y, logit, n): how many of the rows (body, y) have a logit, rounded to steps; a table of bounded size."""

    def counts(batches):
        found, words = Counter(), worker_words()
        for rows in batches:
            texts = rows["body"].tolist()
            buckets = [words.buckets(t) for t in texts]
            logits = [network.logits(buckets[part]) for part in steps_of([len(b) for b in buckets])]
            step = np.rint(np.clip(np.concatenate([np.zeros(0), *logits]), -LOGIT_LIMIT, LOGIT_LIMIT) * LOGIT_STEPS).astype(int)
            found.update(zip(languages.predict(texts)[0], rows["y"].tolist(), step.tolist()))
        yield pd.DataFrame([(*key, n) for key, n in found.items()], columns=["lang", "y", "step", "n"])

    table = rows.select("body", "y").mapInPandas(counts, "lang string, y int, step int, n bigint")
    found = table.groupBy("lang", "y", "step").agg(F.sum("n").alias("n")).collect()
    table = pd.DataFrame([tuple(r) for r in found], columns=["lang", "y", "step", "n"]).sort_values(["lang", "step", "y"])
    return table.assign(logit=table["step"] / LOGIT_STEPS)


@dataclass
class ToxicityModel:
    network: Network | None
    constant: float
    languages: LanguageModel
    common: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def scores(self, texts: list[str | None], words: Words) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.constant)
        out = np.zeros(len(texts))
        start = 0
        buckets: list[np.ndarray] = []
        held = 0
        for i, text in enumerate(texts):
            buckets.append(words.buckets(text))
            held += len(buckets[-1])
            if held > 20_000 or i + 1 == len(texts):
                out[start : i + 1] = self.network.logits(buckets)
                start, held = i + 1, 0
                buckets = []
        found, _, _ = self.languages.predict(texts)
        out -= [self.thresholds.get(lang, self.common) for lang in found]
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def best_threshold(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """Middle of the gap between distinct logits that gives the best balanced accuracy (of equal ones, the widest)."""
    s, place = np.unique(logits, return_inverse=True)
    n = np.ones(len(logits)) if counts is None else counts
    ones, zeros = (np.bincount(place, n * side, len(s)) for side in (labels > 0.5, labels <= 0.5))
    if len(s) < 2:
        return float(s[0])
    right = 1 - np.cumsum(ones)[:-1] / max(1, ones.sum()) + np.cumsum(zeros)[:-1] / max(1, zeros.sum())
    gap = np.diff(s)
    best = np.flatnonzero(right >= right.max() - 1e-12)
    i = best[gap[best].argmax()]
    return float((s[i] + s[i + 1]) / 2)


def fit(
    docs: DataFrame, labels: DataFrame, languages: LanguageModel, text: str = "text", key: str = "doc_id", sample: int = SAMPLE, sample_words: int = SAMPLE_WORDS
) -> ToxicityModel:
    """Fit on all labelled rows (key, y) whose texts are in ``docs``; the driver gets a sample bounded in rows and in words."""
    ship(docs.sparkSession)
    order = F.xxhash64(F.col("key").cast("string")), F.col("key")
    toxic = labels.withColumn("y", (F.col("y") >= 0.5).cast("int"))
    chosen = [toxic.filter(F.col("y") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))

    @F.pandas_udf("binary")
    def buckets(texts: pd.Series) -> pd.Series:
        words = worker_words()
        return pd.Series([words.buckets(t).astype("<i8").tobytes() for t in texts])

    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("body")).join(chosen, F.col("doc") == F.col("key"))
    # One row of each chosen key, so that no more than two samples are collected whatever ids are repeated.
    one = F.min(F.struct(F.col("body").isNull().alias("none"), F.xxhash64("body").alias("hash"), "body"))
    rows = rows.groupBy("key", "y").agg(one.alias("one")).withColumn("body", F.col("one.body"))
    # A different hash than that of the order, so that the sample has its share of either part.
    kept_apart = F.pmod(F.hash(F.col("key").cast("string")), F.lit(4)) == 3
    rows = stored(rows.select("key", "y", kept_apart.alias("apart"), buckets("body").alias("words")))
    rows = within_words(rows, order, sample_words).drop("n").toPandas().sort_values(["key", "words"], kind="stable", ignore_index=True)
    y = rows["y"].to_numpy(float)
    if not len(rows) or y.min() == y.max():
        return ToxicityModel(None, float(y.mean()) if len(rows) else 0.0, languages)
    texts = [np.frombuffer(w, "<i8") for w in rows["words"]]
    apart = rows["apart"].to_numpy(bool)
    split = len(set(y[~apart])) == 2 and len(set(y[apart])) == 2
    if not split:
        apart[:] = False
    network = Network.random()
    squares = network.train([t for t, a in zip(texts, apart) if not a], y[~apart])

    known = small_or_shuffled(toxic.select("key", "y", kept_apart.alias("apart")))
    known = docs.select(F.col(key).alias("doc"), F.col(text).alias("body")).join(known, F.col("doc") == F.col("key"))
    training, held = (known.filter("not apart"), known.filter("apart")) if split else (known, known)
    n, toxic_rows = training.agg(F.count(F.lit(1)), F.sum("y")).first()
    network = refined(training.select("key", "body", "y"), network, squares, toxic_rows / n, -(-n // TRAINER_ROWS))
    counts = counted_logits(held, network, languages)
    thresholds = {}
    for name, own in counts.groupby("lang"):
        of_label = own.groupby("y")["n"].sum()
        if min(of_label.get(0, 0), of_label.get(1, 0)) >= MIN_CALIBRATION:
            thresholds[name] = best_threshold(*(own[c].to_numpy(float) for c in ("logit", "y", "n")))
    return ToxicityModel(network, 0.0, languages, best_threshold(*(counts[c].to_numpy(float) for c in ("logit", "y", "n"))), thresholds)


def within_words(rows: DataFrame, order: tuple[Column, ...], words: int) -> DataFrame:
    """Rows of each label, in order, while their words fit; one text has a 32nd of them at most."""
    sizes = rows.select("key", "y", (F.octet_length("words") / 8).alias("n")).filter(F.col("n") <= words / 32)
    before = Window.partitionBy("y").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumn("total", F.sum("n").over(before)).filter(F.col("total") <= words)
    return rows.join(F.broadcast(sizes.select("key", "y", "n")), ["key", "y"])


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """Score column of a column of texts."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist(), worker_words()), dtype="float64")

    return scored(F.col(text))
