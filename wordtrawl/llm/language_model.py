"""Bigram language model by deleted interpolation, counted and applied in chunks of documents.

1. Documents become chunks of about ``CHUNK`` tokens, stored once: local token numbers, and a 64-bit hash per distinct word.
2. Every chunk sends its distinct words and word pairs with their training counts to hash ranges, sorted and packed; a range
   adds up what all chunks sent and answers each chunk in the same order. So a word pair moves once per chunk however often
   it occurs, and no key gathers more than one entry per chunk. Within a range, words are told apart by 48 further bits of
   their hash and pairs by 40, sent as differences of 32 bits; about one pair in a million is taken for another.
3. The answers are stored with their chunks, so all that follows moves no tokens. Every training token, its own occurrence
   deleted from the counts, falls into a bin of (bucket of the context's frequency, pair estimate, word estimate); the bins
   are added up over all chunks.
4. Expectation-maximisation over the bins finds, for each bucket of context frequencies, the weights of the pair estimate
   c(h, w) / c(h), the word estimate c(w) / N and the uniform 1 / (V + 1).
5. Each chunk scores its documents. The context of a first word is the end token.

Defined cases: a null text counts as empty and is one end token; without any training text the uniform decides; repeated rows
are scored each; a null id is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from wordtrawl.llm.common import ship, stored, summed

CHUNK = 1 << 19
#: Tokens whose distinct words and pairs one hash range takes, on average.
RANGE_TOKENS = 1 << 21
CONTEXTS, PAIR_BINS, WORD_BINS = 22, 50, 66
ROUNDS = 40
_END = xxhash.xxh64_intdigest(b" ")


def squeezed(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, or of 64 with one byte more behind them if one of them needs it."""
    wide = len(numbers) and numbers.max() >= 2**32
    return zstandard.ZstdCompressor(3).compress(numbers.astype("<u8").tobytes() + b"w" if wide else numbers.astype("<u4").tobytes())


def unsqueezed(packed: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.frombuffer(raw[:-1], "<u8").astype(np.int64) if len(raw) % 4 else np.frombuffer(raw, "<u4").astype(np.int64)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of pairs of hashes."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


_CHUNK_TYPE = "chunk bigint, n_tokens bigint, keys array<{key}>, train array<boolean>, lengths array<int>, tokens binary, words binary"


def chunked(docs: DataFrame, train: Column, text: str = "text", key: str = "doc_id", size: int = CHUNK) -> DataFrame:
    """Chunks of whole documents, stored."""
    ship(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"), F.coalesce(train, F.lit(False)).alias("train"))

    def cut(batches):
        part, done = TaskContext.get().partitionId(), 0
        numbers: dict[bytes, int] = {}
        tokens: list[int] = []
        keys, flags, lengths = [], [], []

        def chunk(keys):
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
            row = {
                "chunk": pa.array([part << 32 | done], pa.int64()),
                "n_tokens": pa.array([sum(lengths)], pa.int64()),
                "keys": pa.ListArray.from_arrays([0, len(keys)], keys),
                "train": pa.array([flags], pa.list_(pa.bool_())),
                "lengths": pa.array([lengths], pa.list_(pa.int32())),
                "tokens": pa.array([squeezed(np.array(tokens, "<u4"))], pa.binary()),
                "words": pa.array([np.append(np.uint64(_END), hashes).astype("<u8").tobytes()], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

        for batch in batches:
            first = 0
            for i, (body, flag) in enumerate(zip(batch.column("body"), batch.column("train").to_pylist())):
                words = (body.as_py() or "").encode().lower().split()
                tokens += [numbers.setdefault(w, len(numbers) + 1) for w in words]
                tokens.append(0)
                flags.append(flag)
                lengths.append(len(words) + 1)
                if len(tokens) >= size:
                    keys.append(batch.column("key").slice(first, i + 1 - first))
                    first = i + 1
                    yield chunk(pa.concat_arrays(keys))
                    done += 1
                    numbers.clear()
                    for held in (tokens, keys, flags, lengths):
                        held.clear()
            keys.append(batch.column("key").slice(first))
        if lengths:
            yield chunk(pa.concat_arrays(keys))

    return stored(rows.mapInArrow(cut, _CHUNK_TYPE.format(key=key_type)), rows_a_file=16)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending 40-bit keys as differences of 32 bits, or as they are if a difference is larger."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return (steps.astype("<u4") if steps.max() < 2**32 else keys.astype("<u8")).tobytes()


def unpacked_keys(packed: bytes, count: int) -> np.ndarray:
    if len(packed) == 8 * count:
        return np.frombuffer(packed, "<u8")
    return np.cumsum(np.frombuffer(packed, "<u4"), dtype=np.uint64)


class Chunk:
    """A chunk's tokens, their contexts, and the place of each token's pair among the distinct pairs."""

    def __init__(self, row: dict):
        self.tokens = unsqueezed(row["tokens"])
        self.lengths = np.array(row["lengths"], np.int64)
        self.train = np.repeat(np.array(row["train"], bool), self.lengths)
        self.context = np.append(np.int64(0), self.tokens[:-1])
        self.pairs, self.pair = np.unique(self.context << 32 | self.tokens, return_inverse=True)
        self.places = self.tokens, self.pair

    def keys(self, words: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the distinct words and pairs."""
        words = np.frombuffer(words, "<u8")
        return words, _mixed(words[self.pairs >> 32], words[self.pairs & 0xFFFFFFFF])

    def sent(self, kind: int, keys: np.ndarray, bits: int):
        """(range, packed keys, packed training counts) of the chunk's words (0) or pairs (1), by ascending key."""
        counts = np.bincount(self.places[kind][self.train], minlength=len(keys))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        ranges = (keys >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
        # The range holds the first bits of a key; of the others 48 or 40 are sent.
        rest = keys << np.uint64(bits) >> np.uint64(16 if kind == 0 else 24)
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(keys)).tolist()):
            if kind == 0:
                low = np.ascontiguousarray(rest[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
            else:
                low = packed_keys(rest[a:b])
            yield int(ranges[a]), low, squeezed(counts[a:b])


def answered(keys: np.ndarray, rows: list[tuple[int, bytes]]) -> np.ndarray:
    """Corpus counts in the order of a chunk's own keys."""
    counts = np.concatenate([unsqueezed(c) for _, c in sorted(rows)])
    out = np.empty_like(counts)
    out[np.argsort(keys)] = counts
    return out


def counted(chunks: DataFrame) -> DataFrame:
    """(chunk, kind, range, counts, n_types, n_tokens): the answers to all chunks, stored.

    ``n_types`` and ``n_tokens`` add up to the distinct and all training tokens.
    """
    ship(chunks.sparkSession)
    total = chunks.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
    bits = max(1, int(total // RANGE_TOKENS).bit_length())
    schema = pa.schema([("kind", pa.int32()), ("range", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                for kind, keys in enumerate(chunk.keys(row["words"])):
                    rows = [(kind, r, row["chunk"], k, c) for r, k, c in chunk.sent(kind, keys, bits)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def add(table: pa.Table) -> pa.Table:
        packed = table.column("keys").to_pylist()
        counts = [unsqueezed(c) for c in table.column("counts").to_pylist()]
        sizes = np.array([len(c) for c in counts])
        words = table.column("kind")[0].as_py() == 0
        if words:
            wide = np.zeros((sizes.sum(), 8), np.uint8)
            wide[:, :6] = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
            keys = wide.view("<u8").ravel()
        else:
            keys = np.concatenate([unpacked_keys(k, n) for k, n in zip(packed, sizes.tolist())])
        distinct, place = np.unique(keys, return_inverse=True)
        sums = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
        answers = np.split(sums[place], np.cumsum(sizes)[:-1])
        first = [1] + [0] * (len(packed) - 1)
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "kind": table.column("kind"),
                "range": table.column("range"),
                "counts": pa.array([squeezed(a) for a in answers], pa.binary()),
                "n_types": pa.array([x * words * int((sums > 0).sum()) for x in first], pa.int64()),
                "n_tokens": pa.array([x * words * int(sums.sum()) for x in first], pa.int64()),
            }
        )

    sent = chunks.mapInArrow(send, "kind int, range bigint, chunk bigint, keys binary, counts binary")
    answers = "chunk bigint, kind int, range bigint, counts binary, n_types bigint, n_tokens bigint"
    return stored(sent.groupBy("kind", "range").applyInArrow(add, answers))


def _bins(p: np.ndarray, count: int) -> np.ndarray:
    """0 for 0, else half powers of two from 1 downwards."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.rint(-2 * np.log2(p)), 0, count - 2) + 1, 0).astype(np.int64)


def _values(count: int) -> np.ndarray:
    return np.append(0.0, 2.0 ** (-np.arange(count - 1) / 2))


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the whole logarithm of its frequency to base 2."""
    return np.minimum(np.frexp(counts.astype(float))[1], CONTEXTS - 1)


def mixture_weights(bins: np.ndarray, n_types: int) -> np.ndarray:
    """Weights (pair, word, uniform) of each bucket, by expectation-maximisation over the deleted counts."""
    parts = np.stack(np.broadcast_arrays(_values(PAIR_BINS)[:, None], _values(WORD_BINS)[None, :], 1.0 / (n_types + 1)))
    weights = np.tile([0.3, 0.6, 0.1], (CONTEXTS, 1))
    for b in range(CONTEXTS):
        held = bins[b] + 0.0
        if not held.sum():
            continue
        for _ in range(ROUNDS):
            shares = weights[b][:, None, None] * parts
            weights[b] = (shares / shares.sum(axis=0) * held).sum(axis=(1, 2)) / held.sum()
        weights[b] = (weights[b] + 1e-6) / (1 + 3e-6)
    weights[0] = [0, *(weights[0, 1:] / weights[0, 1:].sum())]
    return weights


def with_counts(chunks: DataFrame, answers: DataFrame, key_type: str) -> DataFrame:
    """Chunks with the corpus counts of their words and pairs in place of the words, stored."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        row, rows = left.to_pylist()[0], right.to_pylist()
        keys = Chunk(row).keys(row["words"])
        counts = [answered(keys[kind], [(r["range"], r["counts"]) for r in rows if r["kind"] == kind]) for kind in (0, 1)]
        table = left.select(["keys", "train", "lengths", "tokens"])
        for name, found in zip(("word_counts", "pair_counts"), counts):
            table = table.append_column(name, pa.array([squeezed(found)], pa.binary()))
        return table

    answers = answers.select("chunk", "kind", "range", "counts")
    columns = f"keys array<{key_type}>, train array<boolean>, lengths array<int>, tokens binary, word_counts binary, pair_counts binary"
    return stored(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(both, columns), rows_a_file=16)


def _each(body):
    """A function over Arrow batches that gives ``body(keys, chunk, word counts, pair counts)`` of every chunk."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = one.select(["train", "lengths", "tokens", "word_counts", "pair_counts"]).to_pylist()[0]
                keys = one.column("keys").flatten()
                yield body(keys, Chunk(row), unsqueezed(row["word_counts"]), unsqueezed(row["pair_counts"]))

    return run


def score(docs: DataFrame, train: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every row, learning from the rows where ``train`` holds.

    ``base_score`` is the smoothed unigram log10 probability, ``score`` that of the interpolated model.
    """
    key_type = docs.schema[key].dataType.simpleString()
    chunks = chunked(docs, train, text, key)
    answers = counted(chunks)
    sums = answers.agg(F.sum("n_types").alias("types"), F.sum("n_tokens").alias("tokens")).first()
    n_types, n_tokens = sums["types"] or 0, sums["tokens"] or 0

    chunks = with_counts(chunks, answers, key_type)

    def deleted(keys, chunk, words, pairs):
        own = chunk.train
        word, pair, context = words[chunk.tokens[own]] - 1, pairs[chunk.pair[own]] - 1, words[chunk.context[own]] - 1
        place = context_bucket(context) * (PAIR_BINS * WORD_BINS)
        place += _bins(pair / np.maximum(context, 1), PAIR_BINS) * WORD_BINS + _bins(word / max(n_tokens - 1, 1), WORD_BINS)
        found, times = np.unique(place, return_counts=True)
        return pa.RecordBatch.from_pydict({"bin": pa.array(found, pa.int64()), "times": pa.array(times, pa.int64())})

    def added(batches):
        total = np.zeros(CONTEXTS * PAIR_BINS * WORD_BINS)
        for batch in batches:
            total[batch["bin"].to_numpy()] += batch["times"].to_numpy()
        return total

    held = chunks.mapInArrow(_each(deleted), "bin bigint, times bigint").groupBy("bin").agg(F.sum("times").alias("times"))
    bins = summed(held, added, CONTEXTS * PAIR_BINS * WORD_BINS).reshape(CONTEXTS, PAIR_BINS, WORD_BINS)
    weights = mixture_weights(bins, n_types)

    def scored(keys, chunk, words, pairs):
        word, context = words[chunk.tokens], words[chunk.context]
        base = np.log10((words + 0.5) / (n_tokens + 0.5 * (n_types + 1)))[chunk.tokens]
        mix = weights[context_bucket(context)]
        model = mix[:, 0] * (pairs[chunk.pair] / np.maximum(context, 1)) + mix[:, 1] * (word / max(n_tokens, 1))
        model += mix[:, 2] / (n_types + 1)
        if not n_tokens:
            model = np.full(len(word), 1.0)
        starts = np.append(0, np.cumsum(chunk.lengths)[:-1])
        out = {
            "n_tokens": pa.array(chunk.lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat((word > 0).astype(np.int64), starts), pa.int64()),
            "train_tokens": pa.array(np.full(len(starts), n_tokens), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, starts), pa.float64()),
            "score": pa.array(np.add.reduceat(np.log10(model), starts), pa.float64()),
        }
        return pa.RecordBatch.from_pydict({"key": keys} | out)

    columns = f"key {key_type}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return chunks.mapInArrow(_each(scored), columns).withColumnRenamed("key", key)
