import random
from collections import Counter

import pytest

from wordtrawl.operators import postings
from wordtrawl.sources import key_ranges

WORDS = "the of and to is alpha beta gamma delta rare".split()


# Parts of equal size ---------------------------------------------------------------------------------------------------


def test_weights_of_rare_keys_are_exact_sums(spark):
    """Rare keys of very different weights: no key stands for more than a run, and the parts come out even."""
    r = random.Random(5)
    frequencies = {f"{r.getrandbits(40):010x}": r.choice([1] * 50 + [60]) for _ in range(6000)} | {"m": 1500, "q": 900}
    dictionary = spark.createDataFrame(list(frequencies.items()), "k string, n bigint").repartition(4)
    weights = key_ranges.weighted_keys(dictionary, "k", "n", 8)
    total = sum(frequencies.values())
    assert sum(w for _, w in weights) == total and {("m", 1500), ("q", 900)} <= set(weights)
    assert len(weights) <= 2 * key_ranges.KEYS_PER_PART * 8 + 2
    points = [key for key, _ in key_ranges.cut_points(weights, 8, 1)]
    sizes = Counter()
    for key, n in frequencies.items():
        sizes[sum(p <= key for p in points)] += n
    assert len(points) == 7 and max(sizes.values()) < 1.3 * total / 8


@pytest.mark.parametrize("slice_tokens", [1, 40, 1 << 19])
def test_postings_bring_the_places_of_their_layout(spark, monkeypatch, slice_tokens):
    """In slices of any size; null, empty and one-word documents, and words that are cut at document ids."""
    monkeypatch.setattr(postings, "SLICE_TOKENS", slice_tokens)
    r = random.Random(6)
    rows = [(i, [r.choice(WORDS) for _ in range(r.choice([0, 1, 2, 30]))]) for i in range(80)] + [(80, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>").repartition(3)
    words = sorted(WORDS)
    points = sorted([(words[1], 0), (words[2], 20), (words[2], 50), (words[-1], 7)])
    for made, keys in ((postings.unigram_postings, 1), (postings.bigram_postings, 2)):
        expected = {}
        for doc, tokens in rows:
            for at in range(len(tokens or ()) - keys + 1):
                expected.setdefault((*tokens[at : at + keys], doc), []).append(at)
        plain_rows = {tuple(row[: keys + 1]): (row["tf"], row["positions"]) for row in made(frame).collect()}
        assert plain_rows == {key: (len(at), at) for key, at in expected.items()}
        placed = made(frame, points, (words[1], words[2])).collect()
        assert len(placed) == len(expected)
        for row in placed:
            key = (row[0], row["doc_id"])
            assert row[postings.PLACE] == sum(p <= key for p in points)
            assert row[postings.PLACE_RANGE] == sum(p <= row[0] for p in (words[1], words[2]))
