"""Plain-Python restatements of the semantics, to test against."""

import hashlib
import math
from collections import Counter


def simhash(tokens):
    votes = [0] * 64
    for token, n in Counter(tokens).items():
        bits = int.from_bytes(hashlib.md5(token.encode()).digest()[-8:], "big")
        for i in range(64):
            votes[i] += n if bits >> i & 1 else -n
    value = sum(1 << i for i in range(64) if votes[i] > 0)
    return value - (1 << 64) if value >= 1 << 63 else value


def distance(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count()


def greedy(signatures, bits=1):
    """Kept seqs of {seq: signature}."""
    kept = {}
    for seq, sig in sorted(signatures.items()):
        if all(distance(sig, other) > bits for other in kept.values()):
            kept[seq] = sig
    return set(kept)


def rank(query, docs, stop, k=5):
    """[(doc, score)] of a token-list query over {doc: token list}."""
    n = len(docs)
    lists = {}
    for term in set(query):
        found = sorted(d for d, tokens in docs.items() if term in tokens)
        if found:
            lists[term] = found
    if not lists:
        return []
    scores = {}
    for doc in set.intersection(*(set(found) for found in lists.values())):
        uni = sum((1 + math.log10(docs[doc].count(t))) * math.log10(n / len(lists[t])) for t in lists)
        bi = 0.0
        for pair in zip(query, query[1:]):
            counts = {d: list(zip(t, t[1:])).count(pair) for d, t in docs.items()}
            counts = {d: c for d, c in counts.items() if c}
            if doc in counts:
                halves = 0.5 ** sum(t in stop for t in pair)
                bi = halves * (1 + math.log10(counts[doc])) * math.log10(n / len(counts))
        scores[doc] = 0.4 * uni + 0.6 * bi
    return sorted(scores.items(), key=lambda item: (-round(item[1], 9), item[0]))[:k]
