import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm import odd
from tokenizers import Tokenizer

from wordtrawl.llm import best_fit, queries

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
RANKS, SPECIAL = queries.byte_vocabulary()


def plain_best_fit(sizes, length):
    """Sequences that best fit by descending size opens, one piece after another."""
    rooms, opened = [], 0
    for size in sorted(sizes, reverse=True):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms.pop(at)
        else:
            room, opened = length, opened + 1
        insort(rooms, room - size)
    return opened


def seats(sizes, length):
    runs, out = best_fit.plan_slots(Counter(sizes), length), []
    for size, n in Counter(sizes).items():
        own = [r for r in runs if r[0] == size]
        for rank in range(n):
            _, first, sequence, each, offset = max(r for r in own if r[1] <= rank)
            out.append((sequence + (rank - first) // each, offset + size * ((rank - first) % each), size))
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 64), st.sampled_from([1, 31, 32, 33, 64])), max_size=200))
def test_plan_is_best_fit(sizes):
    placed = seats(sizes, 64)
    filled = {}
    for sequence, offset, size in placed:
        assert offset == filled.get(sequence, 0)
        filled[sequence] = offset + size
    assert all(f <= 64 for f in filled.values()) and sorted(s for *_, s in placed) == sorted(sizes)
    assert len(filled) == plain_best_fit(sizes, 64) and set(filled) == set(range(len(filled)))


def test_plan_does_not_grow_with_the_counts():
    rng = np.random.default_rng(3)
    counts = {size: int(n) for size, n in enumerate(rng.integers(0, 1000, 2049)) if size}
    small, large = best_fit.plan_slots(counts), best_fit.plan_slots({s: n * 10**9 + 7 for s, n in counts.items()})
    assert max(len(small), len(large)) < 30 * 2048


def test_only_long_documents_are_cut():
    assert best_fit.cut(2048) == [(0, 2048)] and best_fit.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]
    assert best_fit.cut(1) == [(0, 1)] and best_fit.cut(4096) == [(0, 2048), (2048, 2048)]


@pytest.mark.parametrize("with_ids", [True, False])
def test_documents_are_packed_whole(spark, with_ids):
    rows = odd.ROWS + [(100 + i, odd.prose(i, 5 + i * 7 % 900), "en") for i in range(80)] + [(99, "a <|endoftext|> b", "en")]
    docs = odd.documents(spark, rows)
    got = best_fit.pack(docs, RANKS, public_tokenizers.PATTERN, SPECIAL, with_ids=with_ids).collect()
    expected = {}
    for doc, text, _ in rows:
        expected.setdefault(doc, []).append(LIBRARY.encode(text or "", add_special_tokens=False).ids + [0])
    pieces = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]
    plain = []
    for doc, copies in expected.items():
        for ids in copies:
            for piece, (start, size) in enumerate(best_fit.cut(len(ids))):
                plain.append((doc, piece, start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())))
    assert Counter(pieces) == Counter(plain)
    assert not with_ids or all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048 and len(filled) == plain_best_fit([r.length for r in got], 2048)


def test_no_rows_and_one_length_in_many_tasks(spark):
    assert best_fit.pack(odd.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    docs = odd.documents(spark, [(None, "one two three", "en")] * 3000).repartition(7)
    got = best_fit.pack(docs, RANKS, public_tokenizers.PATTERN, with_ids=False).collect()
    assert len(got) == 3000 and len({(r.sequence_id, r.offset) for r in got}) == 3000
    assert len({r.sequence_id for r in got}) == plain_best_fit([4] * 3000, 2048)
