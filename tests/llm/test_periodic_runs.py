import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm import odd

from wordtrawl.llm import periodic_runs, queries


def plain_runs(words, power=4, shortest=6):
    """All runs by walking every period."""
    n, found = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i if j > i else 0
            if length >= max(shortest, power * q):
                block = words[i : i + q]
                if not any(q % d == 0 and block == block[:d] * (q // d) for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def batch(texts):
    return [([tuple(r) for r in runs.tolist()], out.decode()) for runs, out in periodic_runs._answers([t.encode() for t in texts], 4, 6)]


def repetitive(r, size, alphabet):
    """Random words with powers of random blocks put in, and powers of those."""
    words = []
    while len(words) < size:
        block = [r.choice(alphabet) for _ in range(r.randint(1, 12))]
        if r.random() < 0.3:
            block = (block * r.randint(2, 5) + [r.choice(alphabet)] * r.randint(0, 2)) * r.randint(1, 4)
        words += block * r.choice([1, 1, 2, 4, 5, 9]) + block[: r.randint(0, len(block))]
    return words[:size]


def test_runs_equal_every_period_walked():
    r = random.Random(5)
    for _ in range(25):
        many = [repetitive(r, r.randint(0, 300), "abcdefgh"[: r.randint(1, 8)]) for _ in range(12)]
        for words, (runs, out) in zip(many, batch([" ".join(w) for w in many])):
            assert runs == plain_runs(words)
            assert out == " ".join(plain_collapsed(words, runs))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=60), max_size=6))
def test_short_alphabets(texts):
    assert [runs for runs, _ in batch([" ".join(t) for t in texts])] == [plain_runs(list(t)) for t in texts]


def test_extensions_equal_comparison():
    r = random.Random(2)
    for size in (1, 20, 500, 3000):
        inner = np.array([ord(c) for c in repetitive(r, size, "abc")])
        words = np.concatenate([[1000], inner, [1001]])
        grammar = periodic_runs.Grammar(words)
        x, y = (np.array([r.randint(1, size) for _ in range(400)]) for _ in range(2))
        apart = x != y
        x, y = x[apart], y[apart]
        for step in (1, -1):
            for a, b, n in zip(x.tolist(), y.tolist(), grammar.extend(x, y, step).tolist()):
                expected = 0
                while words[a + step * expected] == words[b + step * expected]:
                    expected += 1
                assert n == expected
        assert len(grammar.text[-1]) <= max(periodic_runs.FEW, 3)
        assert any(grammar.blocks) or size < 20


def test_candidates_looked_at_in_parts_change_nothing(monkeypatch):
    r = random.Random(8)
    texts = [" ".join(repetitive(r, 400, "abcd")) for _ in range(5)]
    whole = batch(texts)
    monkeypatch.setattr(periodic_runs, "AT_ONCE", 50)
    assert batch(texts) == whole


def test_long_periodic_texts():
    one = "a " * 60_000
    long = " ".join(f"w{i % 9973}" for i in range(9973 * 5 + 11))
    (first, out), (second, kept) = batch([one, long])
    assert first == [(0, 60_000, 1)] and out == "a"
    assert second == [(0, 9973 * 5 + 11, 9973)] and kept == " ".join(f"w{i}" for i in range(9973))


ROWS = odd.ROWS + [
    (30, "x\x1cy\xa0z " * 9, "en"),
    (31, "\x0b\x0c a\ta\na a\r a  a  a ", "en"),
    (32, "the end " + "a b a b c " * 8 + "fin", "en"),
    (33, "p q " * 6 + "r s t " * 4, "en"),
    (33, "p q " * 6 + "r s t " * 4, "en"),
]


def planted(doc, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc is None else str(doc)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def digest(words):
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *top, sha(lines), sha(" ".join(plain_collapsed(words, runs))))


def digests(docs):
    rows = queries.run_digests(docs).collect()
    names = "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    return sorted(repr((r.doc_id, *[r[n] for n in names])) for r in rows)


def test_digests_equal_plain_python(spark):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    rows = [r for r in ROWS if r[1] != odd.LONG] + [(i, odd.prose(i, 4 + i % 150), "en") for i in ids] + [(ids[3], None, "en"), (ids[4], " ", "en")]
    assert digests(odd.documents(spark, rows)) == sorted(repr((d, *digest(planted(d, t)))) for d, t, _ in rows)
    assert queries.run_digests(odd.empty(spark)).count() == 0


def test_operator_gives_runs_and_text_of_every_row(spark):
    got = periodic_runs.periodic_runs(odd.documents(spark, ROWS)).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(d) for d, *_ in ROWS)
    odd_one = next(r for r in got if r.doc_id == 32)
    assert [tuple(r) for r in odd_one.runs] == [(2, 40, 5)] and odd_one.collapsed == "the end a b a b c fin"
    assert next(r for r in got if r.doc_id == 30).collapsed == "x\x1cy\xa0z"
    assert {(len(r.runs), r.collapsed) for r in got if r.doc_id in (2, 3, 4)} == {(0, "")}


def test_greatest_is_exact(spark):
    runs = spark.createDataFrame([([(5, 12, 3), (7, 16, 4), (9, 8, 2)],), ([(1, 10**9 * 4 + 1, 10**9), (2, 10**9 * 4 + 2, 10**9)],), ([],), (None,)],
                                 "runs array<struct<start:bigint,length:bigint,period:bigint>>")
    got = [r.x and r.x.start for r in runs.select(periodic_runs.greatest(F.col("runs")).alias("x")).collect()]
    assert got == [5, 2, None, None]
