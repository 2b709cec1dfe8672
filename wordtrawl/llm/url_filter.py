"""URL filter: host and path rules, and logistic regression on hashed character n-grams where no rule fits.

The host runs from behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path goes on
to the next ``?`` or ``#``. A rule names a host and the beginning of a path; it fits the host, its subdomains and all paths
that begin so, and the longest fitting rule decides. Everything else is judged by a logistic model over the n-grams of 3 to
5 characters of the host and, apart from them, of the path, hashed into ``BUCKETS`` weights; it blocks from ``THRESHOLD`` on.

The model is trained on a small labelled table of URLs (``LABELLED`` unless the caller has another; at most
``MAX_LABELLED`` rows of it, those with the smallest hash of the URL). Rules are a list in the caller's hands; they and the
fixed-size weights travel with the tasks, so judging moves no rows.

Defined cases: a null URL or one without ``://`` has an empty host and path, which no rule fits and the model judges by its
bias; a very long URL is judged whole; ties between rules of one length go to the first; repeated rows are judged each; a null id
is kept; an empty table gives no rows; without labels, or with one label only, the model allows everything or says that label.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtrawl.llm.common import ship

BUCKETS = 1 << 15
SIZES = (3, 4, 5)
MAX_LABELLED = 20_000
ROUNDS = 300
RATE = 0.5
PENALTY = 1e-4
THRESHOLD = 0.8
_PARTS = re.compile(r"([^/?#]*)([^?#]*)")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Hosts and paths of the kinds that public block lists name (gambling, pharmacy, adult, spam, advertising, fraud), and
#: ordinary ones: the default training table. The names are made up of words of these subjects and taken from no data.
BLOCKED_HOSTS = (
    "casino-royal.example", "online-casino.example", "mega-slots.example", "poker-tables.example", "sports-bets.example",
    "betting-tips.example", "bets-today.example", "lotto-jackpot.example", "win-big-now.example", "roulette-win.example",
    "cheap-meds.example", "diet-pills.example", "pills-shop.example", "generic-viagra.example", "cheapest-rx.example",
    "adult-chat.example", "adults-only.example", "live-cams-xxx.example", "sexy-dates.example", "porn-clips.example",
    "escort-list.example", "spam-mailer.example", "link-spam.example", "content-farm.example", "farm-links.example",
    "bulk-seo.example", "buy-backlinks.example", "ads-server.example", "adserver-click.example", "track-pixel.example",
    "tracker-stats.example", "popup-ads.example", "banner-track.example", "quick-cash-free.example", "free-gift-now.example",
    "double-your-coins.example", "cracked-warez.example", "torrent-rips.example", "fake-watches.example", "payday-cash.example",
    "phish-bank.example", "malware-drop.example",
)
ALLOWED_HOSTS = (
    "news.example", "daily-news.example", "library.example", "city-library.example", "university.example", "physics.example",
    "history.example", "museum.example", "art-museum.example", "weather.example", "recipes.example", "home-recipes.example",
    "gardening.example", "travel-notes.example", "books.example", "open-books.example", "science.example", "chemistry.example",
    "school.example", "music.example", "jazz-music.example", "football.example", "cycling.example", "parliament.example",
    "statistics.example", "health.example", "hospital.example", "docs.example", "python-docs.example", "forum.example",
    "linux-forum.example", "photo.example", "nature-photo.example", "blog.example", "research.example", "archive.example",
    "maps.example", "encyclopedia.example", "farm-museum.example", "winter-sports.example", "railway-tracks.example",
    "free-software.example",
)
BLOCKED_PATHS = ("/buy-now.html", "/cheap/pills", "/casino/bonus", "/xxx/video", "/track?id=1", "/ads/click", "/win/prize", "/de/1873")
ALLOWED_PATHS = ("/en/48213", "/about.html", "/fr/55120", "/articles/2019/05", "/es/3018", "/wiki/history", "/de/9871", "/")
PREFIXES = ("", "www.", "m.", "blog.")
LABELLED = tuple(
    (f"https://{prefix}{host}{end}{path}", label)
    for label, hosts, paths in ((1, BLOCKED_HOSTS, BLOCKED_PATHS), (0, ALLOWED_HOSTS, ALLOWED_PATHS))
    for i, host in enumerate(hosts)
    for j, (prefix, end) in enumerate(zip(PREFIXES, (".com", ".net", ".org", ".com")))
    for path in (paths[(i + j) % len(paths)], ALLOWED_PATHS[(i + 3 * j) % len(ALLOWED_PATHS)])
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path."""
    _, _, rest = (url or "").partition("://")
    host, path = _PARTS.match(rest).groups()
    return host.translate(_LOWER), path


def features(host: str, path: str) -> np.ndarray:
    """Distinct buckets of the n-grams of host and path."""
    found = set()
    for kind, text in ((b"h", f"^{host}$"), (b"p", f"^{path}$")):
        raw = text.encode()
        for n in SIZES:
            for i in range(len(raw) - n + 1):
                found.add(zlib.crc32(kind + raw[i : i + n]) % BUCKETS)
    return np.fromiter(sorted(found), np.int64, len(found))


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        """Probability that the URL belongs blocked; n-grams count by the root of their number."""
        found = features(host, path)
        total = self.bias + self.weights[found].sum() / np.sqrt(max(1, len(found)))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def fit(labelled: DataFrame, url: str = "url", label: str = "label", max_rows: int = MAX_LABELLED) -> UrlModel:
    """Full-batch gradient descent on the bounded table."""
    rows = labelled.select(F.col(url).alias("url"), F.col(label).cast("double").alias("y")).filter("url is not null and y is not null")
    rows = rows.orderBy(F.xxhash64("url"), "url", "y").limit(max_rows).collect()
    if not rows:
        return UrlModel(np.zeros(BUCKETS), -1.0)
    found = [features(*split_url(row["url"])) for row in rows]
    sizes = np.array([len(f) for f in found])
    column, row = np.concatenate(found), np.repeat(np.arange(len(rows)), sizes)
    value = 1 / np.sqrt(np.maximum(sizes, 1))[row]
    y = np.array([r["y"] for r in rows])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    weights, bias = np.zeros(BUCKETS), float(np.log(share / (1 - share)))
    balance = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(y)
    for _ in range(ROUNDS if 1e-6 < share < 1 - 1e-6 else 0):
        total = bias + np.bincount(row, value * weights[column], len(rows))
        error = (1 / (1 + np.exp(-total)) - y) * balance
        weights -= RATE * len(SIZES) * (10 * np.bincount(column, value * error[row], BUCKETS) + PENALTY * weights)
        bias -= RATE * error.sum()
    return UrlModel(weights, bias)


def default_table(spark: SparkSession) -> DataFrame:
    """(url, label): the built-in training table."""
    return spark.createDataFrame(list(LABELLED), "url string, label int")


class Rules:
    """Rules by host; the longest rule that fits an URL decides, and of equal ones the first."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, rest = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + rest, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best, size = None, -1
        while True:
            for start, rule, verdict in self.by_host.get(host, ()):
                if path.startswith(start) and len(rule) > size:
                    best, size = (rule, verdict), len(rule)
            _, dot, host = host.partition(".")
            if not dot:
                return best


def judge(docs: DataFrame, rules: Sequence[tuple[str, str]], model: UrlModel, url: str = "url", threshold: float = THRESHOLD) -> Column:
    """struct(host, path, rule, score, verdict) of a column of URLs; ``rules`` are (allow or block, host/path) pairs."""
    ship(docs.sparkSession)
    known = Rules(rules)

    @F.pandas_udf("host string, path string, rule string, score double, verdict string")
    def judged(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for one in urls:
            host, path = split_url(one)
            rule, score = known.find(host, path), model.score(host, path)
            verdict = rule[1] if rule else "block" if score >= threshold else "allow"
            rows.append((host, path, rule[0] if rule else None, score, verdict))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "score", "verdict"])

    return judged(F.col(url))
