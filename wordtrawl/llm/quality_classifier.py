"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Twenty-two statistics of a text (lengths, character classes, repetition) are standardised and mapped to ``FEATURES`` cosines
that approximate a Gaussian kernel. Each partition sums its normal equations; their total is solved once. The ridge output
falls into fixed bins, whose label means are made monotone by pooling adjacent violators; between the pools the score is
interpolated. Nothing but a text goes into a score.

Defined cases: a null text counts as empty; an empty text has the statistics 0 and gets a score like any other; without
labelled rows, or with one label only, every score is that label's mean (0.5 without any); repeated label rows are averaged.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtrawl.llm.common import ship, summed

FEATURES = 256
RIDGE = 1.0
#: Bandwidth of the kernel in standard deviations per square root of the number of statistics.
BANDWIDTH = 1.5
BINS = 1024
THRESHOLD = 0.3
SEED = 7

_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _MARK, _OTHER = range(8)
N_STATISTICS = 22


def _classes() -> np.ndarray:
    """The class of each code below 0x250; higher codes count as 0x24F."""
    table = np.full(0x250, _OTHER, np.uint8)
    for code in range(0x250):
        char = chr(code)
        if char.islower():
            table[code] = _LOWER
        elif char.isupper():
            table[code] = _UPPER
        elif char.isdigit():
            table[code] = _DIGIT
        elif char == "\n":
            table[code] = _LINE
        elif char.isspace():
            table[code] = _SPACE
        elif char in ".,;:'\"()-?":
            table[code] = _STOP
        elif char in "#*$%&|<>!@^~=+_/\\{}[]":
            table[code] = _MARK
    return table


_CLASS = _classes()


def statistics_of(text: str | None) -> np.ndarray:
    """The statistics of one text; all are finite."""
    out = np.zeros(N_STATISTICS)
    words = (text or "").split()
    n = len(words)
    if not n:
        return out
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 0x24F)
    kinds = np.bincount(_CLASS[codes], minlength=8)
    chars = len(codes)
    times = Counter(words)
    distinct = len(times)
    top = times.most_common(2)
    pairs = len(set(zip(words, words[1:])))
    repeats = sum(map(eq, words, words[1:]))
    lines = [line for line in text.split("\n") if line.strip()]
    marked = sum(count for word, count in times.items() if not word.isalpha()) / n
    letters = max(1, kinds[_LOWER] + kinds[_UPPER])
    out[:8] = kinds / chars
    out[8] = np.log1p(n)
    out[9] = np.log1p(chars)
    out[10] = min(chars / n, 50.0)
    out[11] = distinct / n
    out[12] = np.log1p(n) * (distinct / n)
    out[13] = repeats / n
    out[14] = pairs / max(1, n - 1)
    out[15] = top[0][1] / n
    out[16] = (top[1][1] if len(top) > 1 else 0) / n
    out[17] = kinds[_UPPER] / letters
    out[18] = 1 - len(set(lines)) / max(1, len(lines))
    out[19] = np.log1p(n / max(1, len(lines)))
    out[20] = marked
    out[21] = kinds[_MARK] / n
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores; a thousandth of the ridge output keeps texts of one pool in order."""
        raw = self.raw(stats)
        return 0.999 * np.interp(raw, self.knots, self.values) + 0.001 * np.clip(raw, 0, 1)


def pooled(sums: np.ndarray, counts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of bin means by pooling adjacent violators: places and values of the pools."""
    pools: list[list[float]] = []
    for total, count, place in zip(sums, counts, places):
        if not count:
            continue
        pools.append([total, count, place * count])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    at = np.array([p[2] / p[1] for p in pools])
    value = np.array([p[0] / p[1] for p in pools])
    return at, value


def statistics(docs: DataFrame, text: str = "text") -> Column:
    """Array column of the statistics of ``text``."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics_of(t) for t in texts])

    return stats(F.col(text))


def fit(rows: DataFrame) -> QualityModel:
    """Fit on (stats, y): all labelled rows, three passes, fixed-size sums to the driver."""
    ship(rows.sparkSession)
    moments = rows.select(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.avg("y"), F.lit(0.5)).alias("y"),
        F.array(*[F.avg(F.get("stats", F.lit(i))) for i in range(N_STATISTICS)]).alias("mean"),
        F.array(*[F.stddev_pop(F.get("stats", F.lit(i))) for i in range(N_STATISTICS)]).alias("scale"),
    ).first()
    random = np.random.default_rng(SEED)
    directions = random.normal(size=(N_STATISTICS, FEATURES)) / (BANDWIDTH * np.sqrt(N_STATISTICS))
    phases = random.uniform(0, 2 * np.pi, FEATURES)
    mean = np.array([x or 0.0 for x in moments["mean"]])
    scale = np.array([x or 1.0 for x in moments["scale"]])
    constant = QualityModel(mean, scale, directions, phases, np.zeros(FEATURES + 1), np.zeros(1), np.array([moments["y"]]))
    if not moments["n"] or moments["y"] in (0.0, 1.0):
        return constant
    size = FEATURES + 1

    def equations(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                z = constant.features(np.stack(batch["stats"].to_numpy()))
                total += z.T @ np.hstack([z, batch["y"].to_numpy()[:, None]])
        return total.ravel()

    total = summed(rows.select("stats", "y"), equations, size * (size + 1)).reshape(size, size + 1)
    penalty = np.diag([RIDGE] * FEATURES + [1e-6])
    weights = np.linalg.solve(total[:, :size] + penalty, total[:, size])
    model = QualityModel(mean, scale, directions, phases, weights, np.zeros(1), np.zeros(1))
    edges = np.linspace(-0.5, 1.5, BINS + 1)

    def binned(batches):
        sums = np.zeros((3, BINS))
        for batch in batches:
            if len(batch):
                raw = np.clip(model.raw(np.stack(batch["stats"].to_numpy())), -0.5, 1.5)
                place = np.clip(np.digitize(raw, edges) - 1, 0, BINS - 1)
                y = batch["y"].to_numpy()
                for k, weight in enumerate((np.ones(len(y)), y, raw)):
                    sums[k] += np.bincount(place, weight, BINS)
        return sums.ravel()

    counts, labels, places = summed(rows.select("stats", "y"), binned, 3 * BINS).reshape(3, BINS)
    knots, values = pooled(labels, counts, places / np.maximum(counts, 1))
    return QualityModel(mean, scale, directions, phases, weights, knots, values)


def score(model: QualityModel, stats: Column) -> Column:
    """Score column of a column of statistics."""

    @F.pandas_udf("double")
    def scored(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(rows.to_numpy())) if len(rows) else [], dtype="float64")

    return scored(stats)


def score_text(docs: DataFrame, model: QualityModel, text: str = "text") -> Column:
    """Score column of a column of texts, for tables whose statistics are not stored."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack([statistics_of(t) for t in texts])) if len(texts) else [], dtype="float64")

    return scored(F.col(text))
