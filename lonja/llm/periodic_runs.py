"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q and at least max(``LEAST_LENGTH``, ``LEAST_PERIODS`` * q) words that no neighbouring
word extends. Per group of texts, joined with a separator of its own behind each text:

1. Prefix doubling names all factors of 2, 4, 8, ... words and gives the suffix array. Two factors are equal if their names are; the
   longest common extension of two places, to the right or to the left, is a descent over the lengths.
2. A wavelet tree over the suffix array answers range successor queries: of the suffixes that start with a block, the first (second,
   last) that lies in a window of places.
3. Texts are cut into dyadic blocks of m = 8, 16, 32, ... words. In a run of period q the first length - q words are followed by a copy
   at distance q and are at least max(24 - q, 2q) many, so they hold a whole block of 8 words (q < 16) or of m words (m <= q < 2m).
   Each block is looked up in the neighbouring window of places [m, 2m) behind it, blocks of 8 words in [1, 8) too.
4. Such places form an arithmetic progression. Its first two places give candidate periods. If its difference d is at most m / 2, the
   block itself has period d and lies in a d-periodic stretch, as do the copies; a longer period q moves one end of the block's stretch
   to the same end of the copies', so these two distances are the only other candidates.
5. A candidate (block, q) is extended both ways; what is long enough is a run. Of equal stretches the smallest period stays.

Words are compared by number, not by hash; the sieve before step 1 drops only texts in which no factor of 16 words occurs twice, and
every run has one (of length - q words two equal copies; hash collisions only let more texts through).

Memory: a group is at most ``GROUP_WORDS`` words or a single longer text; it takes some 4 bytes for each word and doubling, that is for
each binary digit of the longest repeated factor's length, and as much for the wavelet tree. No text is cut.

Defined cases: a null text has no words and no runs; words are runs of characters other than ASCII white space, compared exactly; a
row with a null id is treated as any other, but is not rewritten by the query; repeated rows give repeated results; an empty table
gives an empty result; runs that overlap are all reported; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import batches, table, texts

LEAST_LENGTH = 24
LEAST_PERIODS = 3
FIRST_LEVEL = 3  # blocks of 8 words: the largest that fits into every run's first 16 words whatever their place
SIEVE = 4  # factors of 16 words
GROUP_WORDS = 250_000


class Wavelet:
    """Counts and order statistics of slices of an array of numbers below 2 ** ``bits``, for many queries at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~ones], values[ones]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each slice are smaller than ``bound``."""
        count = np.zeros(len(low), np.int64)
        for bit, zeros, all_zeros in self.levels:
            low0, high0, one = zeros[low], zeros[high], (bound >> bit & 1).astype(bool)
            count += np.where(one, high0 - low0, 0)
            low, high = np.where(one, all_zeros + low - low0, low0), np.where(one, all_zeros + high - high0, high0)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value of each slice that has ``n`` smaller ones."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros, all_zeros in self.levels:
            low0, high0 = zeros[low], zeros[high]
            one = n >= high0 - low0
            n = np.where(one, n - (high0 - low0), n)
            value |= one.astype(np.int64) << bit
            low, high = np.where(one, all_zeros + low - low0, low0), np.where(one, all_zeros + high - high0, high0)
        return value


class Factors:
    """Suffix array of a sequence that ends with a value of its own, and the names of its factors of 1, 2, 4, ... values."""

    def __init__(self, sequence: np.ndarray):
        self.n = n = len(sequence)
        self.order = np.argsort(sequence, kind="stable")
        places = np.arange(n)
        ordered = sequence[self.order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        self.names: list[np.ndarray] = []
        while True:
            name = np.empty(n, np.int32)
            name[self.order] = np.maximum.accumulate(np.where(new, places, 0))
            self.names.append(name)
            slots = np.flatnonzero(~(new & np.append(new[1:], True)))  # of names that several factors have
            if not len(slots):
                return
            step = 1 << (len(self.names) - 1)
            of = self.order[slots]
            behind = np.where(of + step < n, name[np.minimum(of + step, n - 1)] + 1, 0)
            key = name[of].astype(np.int64) * (n + 1) + behind
            sort = np.argsort(key, kind="stable")
            self.order[slots], key = of[sort], key[sort]
            new[slots] = np.concatenate([[True], key[1:] != key[:-1]])

    def right(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many values from ``one`` on equal those from ``other`` on; one < other."""
        one, start = one.copy(), one
        shift = other - one
        for level in reversed(range(len(self.names))):
            name = self.names[level]
            inside = one + shift < self.n
            equal = inside & (name[one] == name[np.where(inside, one + shift, 0)])
            one = one + (equal.astype(np.int64) << level)
        return one - start

    def left(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many values before ``one`` equal those before ``other``; one < other."""
        one, start = one.copy(), one
        shift = other - one
        for level in reversed(range(len(self.names))):
            name, back = self.names[level], one - (1 << level)
            equal = (back >= 0) & (name[np.maximum(back, 0)] == name[np.maximum(back, 0) + shift])
            one = np.where(equal, back, one)
        return start - one


def _candidates(factors: Factors, tree: Wavelet, level: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of 2 ** level values and candidate periods, from the block's occurrences in the places [first, last) behind it."""
    size, name, n = 1 << level, factors.names[level], factors.n
    block = np.arange(0, n, size)
    low = name[block].astype(np.int64)
    high = low + np.bincount(name, minlength=n)[low]
    several = high - low > 1
    block, low, high = block[several], low[several], high[several]
    before = tree.below(low, high, np.minimum(block + first, n))
    number = tree.below(low, high, np.minimum(block + last, n)) - before
    found = number > 0
    block, low, high, before, number = block[found], low[found], high[found], before[found], number[found]
    one = tree.nth(low, high, before)
    blocks, periods = [block], [one - block]
    more = number > 1
    block, one, two = block[more], one[more], tree.nth(low[more], high[more], before[more] + 1)
    blocks.append(block)
    periods.append(two - block)
    dense = 2 * (two - one) <= size
    block, one, step = block[dense], one[dense], (two - one)[dense]
    at_left = (one - factors.left(one, one + step)) - (block - factors.left(block, block + step))
    at_right = (one + factors.right(one, one + step)) - (block + factors.right(block, block + step))
    return np.concatenate([*blocks, block, block, block]), np.concatenate([*periods, step, at_left, at_right])


def runs_of(sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of a sequence that ends with a value of its own, by start, then period."""
    factors = Factors(sequence)
    tree = Wavelet(factors.order, int(factors.n).bit_length())
    blocks, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for level in range(FIRST_LEVEL, len(factors.names) - 1):  # the last names are all different
        for first in (1, 1 << level) if level == FIRST_LEVEL else (1 << level,):
            block, period = _candidates(factors, tree, level, first, first + (1 << level) - (first == 1))
            blocks.append(block)
            periods.append(period)
    block, period = np.concatenate(blocks), np.concatenate(periods)
    useful = (period > 0) & (block + period < factors.n)
    block, period = np.unique(np.stack([block[useful], period[useful]]), axis=1)
    start = block - factors.left(block, block + period)
    length = block + period + factors.right(block, block + period) - start
    long = length >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _suspects(numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Texts, as places in ``ends``, in which a factor of 16 words seems to occur twice."""
    if len(numbers) < 2 << SIEVE:
        return np.arange(len(ends)) if len(numbers) >= LEAST_LENGTH else np.empty(0, np.int64)
    mixed = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    for level in range(SIEVE):
        step = 1 << level
        mixed = mixed[:-step] * np.uint64(0xBF58476D1CE4E5B9) + mixed[step:]
        mixed ^= mixed >> np.uint64(31)
    text = np.searchsorted(ends, np.arange(len(mixed)), side="right")
    whole = ends[np.minimum(text, len(ends) - 1)] - np.arange(len(mixed)) >= 1 << SIEVE
    mixed, text = mixed[whole] + text[whole].astype(np.uint64) * np.uint64(0x94D049BB133111EB), text[whole]
    order = np.argsort(mixed)
    twice = mixed[order][1:] == mixed[order][:-1]
    return np.unique(text[order][1:][twice])


def group_runs(group: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, length, period), by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in group]
    vocabulary: dict[bytes, int] = {}
    numbers = np.array([vocabulary.setdefault(word, len(vocabulary)) for words in group for word in words], np.int64)
    ends = np.cumsum([len(words) for words in group])
    suspects = _suspects(numbers, ends)
    if not len(suspects):
        return found
    parts, begins, at = [], [], 0
    for i, text in enumerate(suspects.tolist()):
        words = numbers[ends[text] - len(group[text]) : ends[text]]
        parts += [words, [len(vocabulary) + i]]
        begins.append(at)
        at += len(words) + 1
    start, length, period = runs_of(np.concatenate(parts))
    owner = np.searchsorted(begins, start, side="right") - 1
    for i, s, n, q in zip(owner.tolist(), (start - np.array(begins)[owner]).tolist(), length.tolist(), period.tolist()):
        found[suspects[i]].append((s, n, q))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without what repeats in a run, joined by one space."""
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, runs (array of start, length and period, by start, then period) and text (the words outside repetitions) for every row.
    ``prepare`` may change the words of a text before they are looked at."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, values = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
        first, group, size = 0, [], 0
        for place, doc_id in enumerate(ids):
            words = (values[place].as_py() or b"").split()  # of bytes: ASCII white space alone
            group.append(prepare(doc_id, words) if prepare else words)
            size += len(words)
            if size >= GROUP_WORDS or place + 1 == len(ids):
                found = group_runs(group)
                left = [collapsed(words, runs) for words, runs in zip(group, found)]
                columns = [[[run[i] for run in runs] for runs in found] for i in range(3)]
                yield {"doc_id": ids[first : place + 1], "text": pa.array(left, pa.binary()), **dict(zip(("starts", "lengths", "periods"), columns))}
                first, group, size = place + 1, [], 0

    rows = texts(docs).select("doc_id", "text")
    made = batches(rows, work, "doc_id long, text string, starts array<bigint>, lengths array<bigint>, periods array<bigint>")
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return made.select("doc_id", runs.alias("runs"), "text")


def _with_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's texts: one in ten gets a periodic end."""
    h = crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), _with_tail)
    better = "reduce(slice(runs, 2, size(runs)), runs[0], (a, x) -> IF(x.length * a.period > a.length * x.period, x, a))"
    best = F.when(F.size("runs") > 0, F.expr(better))
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )
