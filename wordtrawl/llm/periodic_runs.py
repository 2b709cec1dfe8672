"""Periodic runs of words, found with a recompression grammar.

A text is its words, runs of anything but ASCII white space. A run is a stretch of consecutive words with smallest period q, at
least ``POWER`` periods and ``SHORTEST`` words long, that no neighbouring word extends keeping the period.

**Grammar.** The texts of a batch are one sequence of word numbers with a number of its own between any two texts, so nothing
reaches across. Rounds alternate: *block compression* replaces every maximal repetition of a symbol by one symbol for (symbol,
length), the run-length rule; *pair compression* splits the symbols into left and right ones and replaces every left-right
pair by a symbol. What a round does at a place depends on the symbols there alone, so equal stretches are compressed alike
except at their margins. Rounds go on until a few symbols are left; they are kept as arrays (symbols, parents, first children).

**Extensions.** How far two places match, to the right or to the left, is answered by climbing: on each level at most one
step is needed until both places stand at the edge of a parent; where the parents differ, the way leads down again, with at
most one step per level. All queries of a batch climb together, as arrays. Answers are exact, no hashes are compared.

**Candidates.** A run of period q holds at least ``(POWER - 1) q`` places that equal the place q further on, so one of them
lies on the grid of multiples of that number. The grids of all periods have n log n / 3 places together. Each place whose word
equals the one q on is extended both ways, which gives the whole stretch. A stretch whose period is a multiple of a shorter
one is dropped, by asking the same grammar for the period divided by each of its prime factors.

No suffix array is built. A worker holds one batch of about ``BATCH_WORDS`` words, or one text if that is longer, at some
hundred bytes a word.

Defined cases: a null or empty text, or one of white space, has no runs and collapses to the empty text; a text of any length
is taken whole; a very long word is one word; ties do not arise, as a stretch has one smallest period; repeated rows are
answered each; a null key is kept; an empty table gives no rows; columns other than key and text are not looked at.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtrawl.llm.common import ship

POWER = 4
SHORTEST = 6
BATCH_WORDS = 150_000
#: Candidates that are looked at together.
AT_ONCE = 1 << 20
#: Symbols at which compression stops, and rounds of pairs at most.
FEW = 16
MAX_ROUNDS = 200


def _mixed(symbols: np.ndarray, level: int) -> np.ndarray:
    """A bit per symbol that looks random and depends on symbol and level alone."""
    x = (symbols.astype(np.uint64) + np.uint64(level * 0x9E3779B9 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)) & np.uint64(1) == 1


class Grammar:
    """Levels of a compressed sequence. ``up[l]`` is the parent on level l + 1 of each symbol, ``low[l]`` the first child on
    level l of each symbol of level l + 1 (and one past the end), ``blocks[l]`` whether that round compressed blocks."""

    def __init__(self, sequence: np.ndarray):
        symbols = sequence.astype(np.int64)
        self.text, self.up, self.low, self.blocks = [symbols], [], [], []
        fresh = int(symbols.max(initial=0)) + 1
        for level in range(MAX_ROUNDS):
            if len(symbols) <= FEW:
                break
            same = symbols[1:] == symbols[:-1]
            if same.any():
                starts = np.concatenate([[True], ~same])
                symbols, fresh = self._replace(symbols, starts, fresh, True)
            right = _mixed(symbols, level)
            pairs = ~right[:-1] & right[1:]
            other = right[:-1] & ~right[1:]
            if np.count_nonzero(other) > np.count_nonzero(pairs):
                pairs = other
            if pairs.any():
                symbols, fresh = self._replace(symbols, np.concatenate([[True], ~pairs]), fresh, False)

    def _replace(self, symbols: np.ndarray, starts: np.ndarray, fresh: int, blocks: bool) -> tuple[np.ndarray, int]:
        low = np.flatnonzero(starts)
        size = np.diff(np.append(low, len(symbols)))
        parents = symbols[low]
        joined = np.flatnonzero(size > 1)
        second = size[joined] if blocks else symbols[low[joined] + 1]
        _, number = np.unique(parents[joined] << 32 | second, return_inverse=True)
        parents[joined] = fresh + number
        self.up.append((np.cumsum(starts) - 1).astype(np.int32))
        self.low.append(np.append(low, len(symbols)).astype(np.int32))
        self.blocks.append(blocks)
        self.text.append(parents)
        return parents, fresh + int(number.max(initial=-1)) + 1

    def _left(self, level: int, x: np.ndarray, step: int) -> np.ndarray:
        """Symbols from ``x`` to the far edge of its parent, with itself."""
        parent = self.up[level][x]
        return self.low[level][parent + 1] - x if step > 0 else x - self.low[level][parent] + 1

    def _edge(self, level: int, x: np.ndarray, step: int) -> np.ndarray:
        """Whether ``x`` is the child of its parent that is met first."""
        parent = self.up[level][x]
        return x == (self.low[level][parent] if step > 0 else self.low[level][parent + 1] - 1)

    def extend(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many symbols match from ``x`` and ``y`` on, to the right (step 1) or to the left (step -1).

        The sequence must have numbers of their own at both ends, so that every match ends within it.
        """
        begin, x, y = x, x.astype(np.int64), y.astype(np.int64)
        top = len(self.up)
        stopped = np.full(len(x), top)
        alive = np.arange(len(x))
        for level in range(top + 1):
            text = self.text[level]
            a, b = x[alive], y[alive]
            equal = text[a] == text[b]
            if level == top:
                # Few symbols are left here: walk.
                while equal.any():
                    a, b = a + step * equal, b + step * equal
                    equal &= text[a] == text[b]
                x[alive], y[alive] = a, b
                break
            stopped[alive[~equal]] = level
            alive, a, b = alive[equal], a[equal], b[equal]
            inside = ~(self._edge(level, a, step) & self._edge(level, b, step))
            move = np.where(inside, step * np.minimum(self._left(level, a, step), self._left(level, b, step)), 0)
            a, b = a + move, b + move
            equal = text[a] == text[b]
            x[alive], y[alive] = a, b
            stopped[alive[~equal]] = level
            alive = alive[equal]
            x[alive], y[alive] = self.up[level][a[equal]], self.up[level][b[equal]]
            if not len(alive):
                break
        for level in range(int(stopped.max(initial=0)) - 1, -1, -1):
            down = np.flatnonzero(stopped > level)
            low, text = self.low[level], self.text[level]
            a, b = (low[x[down]], low[y[down]]) if step > 0 else (low[x[down] + 1] - 1, low[y[down] + 1] - 1)
            a, b = a.astype(np.int64), b.astype(np.int64)
            move = np.ones(len(down), np.int64)
            if self.blocks[level]:
                move = np.minimum(self._left(level, a, step), self._left(level, b, step))
            move = np.where(text[a] == text[b], step * move, 0)
            x[down], y[down] = a + move, b + move
        return (x - begin) * step


def _primes(n: int) -> list[int]:
    sieve = np.ones(n + 1, bool)
    for p in range(2, int(n**0.5) + 1):
        if sieve[p]:
            sieve[p * p :: p] = False
    return np.flatnonzero(sieve)[2:].tolist()


def _grid(begin: np.ndarray, size: np.ndarray, periods: range, power: int):
    """Blocks of (place, period): all places of the grids of ``periods`` in texts that are long enough."""
    for first in range(periods.start, periods.stop, 4096):
        some = np.arange(first, min(first + 4096, periods.stop))
        texts = np.flatnonzero(size >= power * some[0])
        for at in range(0, len(texts), max(1, AT_ONCE // (64 * len(some)))):
            own = texts[at : at + max(1, AT_ONCE // (64 * len(some)))]
            text, period = (m.ravel() for m in np.meshgrid(own, some, indexing="ij"))
            fits = size[text] >= power * period
            text, period = text[fits], period[fits]
            stride = (power - 1) * period
            # Multiples of the stride from 0 whose partner one period on still lies in the text.
            number = (size[text] - period - 1) // stride + 1
            ends = np.cumsum(number)
            for lo in range(0, int(ends[-1]) if len(ends) else 0, AT_ONCE):
                n = np.arange(lo, min(lo + AT_ONCE, int(ends[-1])))
                which = np.searchsorted(ends, n, "right")
                yield begin[text[which]] + (n - ends[which] + number[which]) * stride[which], period[which]


def find_runs(words: np.ndarray, begin: np.ndarray, size: np.ndarray, power: int = POWER, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, length, period), by start and period, of all runs of the texts that lie at ``begin`` in ``words``.

    Between texts, before the first and after the last, ``words`` has numbers that occur once.
    """
    longest = int(size.max(initial=0)) // power
    if not longest:
        return np.zeros((0, 3), np.int64)
    grammar = None
    found = [np.zeros((0, 3), np.int64)]
    # The longest stretch found so far over each place: its start, end and period.
    over = np.zeros((3, len(words)), np.int32)
    primes = _primes(longest)
    low = 1
    while low <= longest:
        high = min(2 * low, longest + 1)
        stretches = []
        for place, period in _grid(begin, size, range(low, high), power):
            hit = words[place] == words[place + period]
            place, period = place[hit], period[hit]
            # Within a stretch of a period that divides this one there is nothing new.
            s, e, p = over[:, place]
            known = (p > 0) & (s <= place) & (place + period <= e)
            known[known] = period[known] % p[known] == 0
            place, period = place[~known], period[~known]
            if not len(place):
                continue
            grammar = grammar or Grammar(words)
            right = grammar.extend(place, place + period, 1)
            left = grammar.extend(place - 1, place + period - 1, -1)
            length = left + right + period
            long = length >= np.maximum(shortest, power * period)
            stretches.append(np.stack([(place - left)[long], length[long], period[long]], 1))
        if stretches:
            rows = np.unique(np.concatenate(stretches), axis=0)
            rows = rows[_primitive(grammar, rows, primes)]
            found.append(rows)
            for start, length, period in rows[np.argsort(rows[:, 1], kind="stable")].tolist():
                if length > over[1, start] - over[0, start]:
                    over[:, start : start + length] = np.array([[start], [start + length], [period]])
        low = high
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _primitive(grammar: Grammar | None, rows: np.ndarray, primes: list[int]) -> np.ndarray:
    """Whether no shorter period divides the period of a stretch: asked for each of the period's prime factors."""
    good = np.ones(len(rows), bool)
    largest = int(rows[:, 2].max(initial=1))
    for prime in primes:
        if prime > largest:
            break
        asked = np.flatnonzero(good & (rows[:, 2] % prime == 0))
        if len(asked):
            start, period = rows[asked, 0], rows[asked, 2]
            part = period // prime
            good[asked] = grammar.extend(start, start + part, 1) < period - part
    return good


def _answers(texts: list[bytes | None], power: int, shortest: int):
    """(runs, collapsed text) of each text of a batch."""
    split = [(t or b"").split() for t in texts]
    size = np.array([len(w) for w in split], np.int64)
    begin = np.cumsum(size + 1) - size
    number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
    words = np.empty(int(size.sum()) + len(split) + 1, np.int64)
    ends = np.append(begin - 1, len(words) - 1)
    for at, text in zip(begin.tolist(), split):
        words[at : at + len(text)] = list(map(number.__getitem__, text))
    words[ends] = len(number) + np.arange(len(ends))
    runs = find_runs(words, begin, size, power, shortest)
    dropped = np.zeros(len(words) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(dropped)[:-1] == 0
    first = np.searchsorted(runs[:, 0], begin)
    last = np.searchsorted(runs[:, 0], begin + size)
    for i, text in enumerate(split):
        own = runs[first[i] : last[i]]
        if len(own):
            at = int(begin[i])
            stays = kept[at : at + len(text)]
            text = [w for w, stay in zip(text, stays.tolist()) if stay]
            own = own - [at, 0, 0]
        yield own, b" ".join(text)


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", power: int = POWER, shortest: int = SHORTEST) -> DataFrame:
    """(key, runs, collapsed) of every row: its runs as structs (start, length, period) in word numbers from 0, by start and
    period, and its words joined by one blank without those that a run repeats (all of the run but its first period)."""
    ship(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def answered(batches):
        for batch in batches:
            bodies = batch.column("body").cast(pa.binary())
            # About six bytes a word: batches are cut by size, so that a few very long texts do not meet in one.
            bytes_ = np.cumsum(pc.fill_null(pc.binary_length(bodies), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = int(bytes_[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(bytes_, before + 6 * BATCH_WORDS, "right")))
                rows = list(_answers(bodies.slice(at, stop - at).to_pylist(), power, shortest))
                counts = np.cumsum([0] + [len(r) for r, _ in rows])
                flat = np.concatenate([r for r, _ in rows])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run))
                lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), structs)
                texts = pa.array([t for _, t in rows], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(at, stop - at), lists, texts], names=["key", "runs", "collapsed"])
                at = stop

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    schema = f"key {key_type}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(answered, schema).withColumnRenamed("key", key)


def greatest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties to the smaller start, then period; null without runs."""

    def better(best: Column, one: Column) -> Column:
        mine, theirs = one["length"] * best["period"], best["length"] * one["period"]
        # Runs come by start and period, so of equal ones the first stays.
        return F.when(best.isNull() | (mine > theirs), one).otherwise(best)

    return F.reduce(runs, F.get(runs, F.lit(0)), better)


def written(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
