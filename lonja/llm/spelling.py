"""Spelling variants: words that differ by one code point, found by permuterm rotations.

Counting. Tasks count the runs of letters of their texts and send (word, count) pairs; what is added up are sums per word.

Numbering. The words that are frequent enough are numbered by descending count, then in code-point order, so that the better of two
words is the one with the smaller number, and rotations carry a number instead of a word.

Rotations. A word w with a terminator has the rotations w[i:] $ w[:i]. An edit at place i stands at the end of the rotation that starts
behind it, so leaving out that last code point gives the prefix w[i+1:] $ w[:i]:

* two words with the same prefix differ by a replacement (the terminator's place gives i and the length);
* a word whose prefix is a whole rotation of another one is that word with one code point more.

A code point that can be deleted from either of two equal neighbours is skipped once only (the first of its run), so every insertion
or deletion is met exactly once. The rotations are dealt out by text and sorted; a scan of neighbouring rows sees each group in one
piece. A group holds at most one whole rotation and one prefix for each letter of the alphabet (90), whatever the data are. A
member gets the number of its near words in the group and the best of them; no pair is written. Rotations of more than ``EXPLICIT``
code points are replaced by a digest that follows from prefix sums, so a word of n letters makes 2n + 1 short rows in linear time.

Forms. A word's form is its best near word if that is ``TIMES`` as frequent. Counts grow along a chain of forms, so following them to
the last by doubling takes a number of joins that grows with the logarithm of the logarithm of the largest count.

Defined cases: a null text has no runs; a null id counts as the empty text in the query's hash; repeated rows count as often as they
occur; equal counts are settled by code-point order; a word without near words has n_near 0 and is its own root; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import table, texts
from lonja.operators.ranking import number_rows
from lonja.operators.staging import Stage

LETTERS = 6
OCCURRENCES = 5
TIMES = 5
HELD = 100_000  # distinct words a task holds before it sends them
EXPLICIT = 48
PIECE = 50_000
WHOLE, SKIP, SKIP_AGAIN = 0, 1, 2  # a whole rotation; one without its last letter; the same, where the letter repeats the one before

_OTHER = bytes(b if chr(b).isascii() and chr(b).isalpha() or b >= 0xC0 else 0x20 for b in range(256)).lower()
_PRIME, _BASES = (1 << 61) - 1, (0x1F3D5B79A7C6E5D1 % ((1 << 61) - 1), 0x0B4C8E2F6A1D3957)
_ROTATION = pa.schema([("key", pa.string()), ("kind", pa.int8()), ("number", pa.int64())])
_NEAR = pa.schema([("number", pa.int64()), ("near", pa.int64()), ("best", pa.int64())])
_COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])


def letter_runs(text: str | None) -> list[bytes]:
    """Runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, one byte per code point."""
    return (text or "").encode("latin-1", "replace").translate(_OTHER).split()


def count_words(docs: DataFrame, change: Callable[[int | None, bytes], bytes] | None = None) -> DataFrame:
    """word, n: the runs of at least ``LETTERS`` letters of all texts. ``change`` may replace a run, given the row's id."""

    def work(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def sent() -> pa.RecordBatch:
            words, counts = list(held), list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array(counts, pa.int64())], schema=_COUNT)

        for batch in incoming:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in Counter(letter_runs(text.as_py())).items():
                    if len(word) >= LETTERS:
                        word = change(doc_id, word) if change else word
                        if len(word) >= LETTERS:
                            held[word] += n
                if len(held) >= HELD:
                    yield sent()
        yield sent()

    rows = texts(docs).select("doc_id", "text").mapInArrow(work, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _long_rotations(word: str) -> Iterator[tuple[int, str]]:
    """Kind and digest of all rotations of a long word."""
    ends = word + "$"
    n, sums, powers = len(ends), [[0], [0]], [[1], [1]]
    for base, total, power in zip(_BASES, sums, powers):
        for letter in ends:
            total.append((total[-1] * base + ord(letter)) % _PRIME)
            power.append(power[-1] * base % _PRIME)

    def digest(start: int, head: int) -> str:
        parts = []
        for total, power in zip(sums, powers):
            tail = total[n] - total[start] * power[n - start]
            parts.append((tail * power[head] + total[head]) % _PRIME)
        return "#{:x}.{:x}".format(*parts)

    for i in range(n):
        yield WHOLE, digest(i, i)
        if i + 1 < n:
            yield SKIP_AGAIN if i and word[i] == word[i - 1] else SKIP, digest(i + 1, i)


def rotations(word: str) -> Iterator[tuple[int, str]]:
    """Kind and text (of long ones the digest) of all rotations of a word. Which of both it is depends on the rotation's length alone."""
    n, ends = len(word), word + "$"
    if n >= EXPLICIT:
        if n > EXPLICIT:
            yield from _long_rotations(word)
        else:
            yield from ((kind, key) for kind, key in _long_rotations(word) if kind == WHOLE)
            yield from (((SKIP_AGAIN if i and word[i] == word[i - 1] else SKIP), ends[i + 1 :] + word[:i]) for i in range(n))
        return
    for i in range(n + 1):
        yield WHOLE, ends[i:] + word[:i]
        if i < n:
            yield SKIP_AGAIN if i and word[i] == word[i - 1] else SKIP, ends[i + 1 :] + word[:i]


def _rotated(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, kinds, numbers = [], [], []
    for batch in incoming:
        for number, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for kind, key in rotations(word):
                keys.append(key)
                kinds.append(kind)
                numbers.append(number)
                if len(keys) >= PIECE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((keys, kinds, numbers), _ROTATION)], schema=_ROTATION)
                    keys, kinds, numbers = [], [], []
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((keys, kinds, numbers), _ROTATION)], schema=_ROTATION)


def _group(kinds: list[int], numbers: list[int]) -> Iterator[tuple[int, int, int]]:
    """Number, near words and best near word of each member of a group."""
    whole = next((n for k, n in zip(kinds, numbers) if k == WHOLE), None)
    first, second = ([*sorted(n for k, n in zip(kinds, numbers) if k != WHOLE), None, None])[:2]
    skips = sum(k != WHOLE for k in kinds)
    for kind, number in zip(kinds, numbers):
        if kind == WHOLE:
            longer = [n for k, n in zip(kinds, numbers) if k == SKIP]
            near, best = len(longer), longer
        else:
            shorter = whole if kind == SKIP else None
            near, best = skips - 1 + (shorter is not None), [second if number == first else first, shorter]
        if near:
            yield number, near, min(n for n in best if n is not None)


def _scanned(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rotations in sorted order, groups of equal ones; the last group of a batch waits for the next."""
    key, kinds, numbers = None, [], []
    for batch in incoming:
        if not batch.num_rows:
            continue
        out: list[tuple[int, int, int]] = []
        column, kind, number = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        new = np.ones(batch.num_rows, bool)
        if batch.num_rows > 1:
            new[1:] = np.asarray(pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], batch.num_rows)
        if key is not None and column[0].as_py() == key:
            kinds, numbers = kinds + kind[: ends[0]].tolist(), numbers + number[: ends[0]].tolist()
            starts, ends = starts[1:], ends[1:]
        if len(starts):
            if len(kinds) > 1:
                out += _group(kinds, numbers)
            last = slice(starts[-1], ends[-1])
            key, kinds, numbers = column[int(starts[-1])].as_py(), kind[last].tolist(), number[last].tolist()
            several = np.flatnonzero(ends[:-1] - starts[:-1] > 1)
            for start, end in zip(starts[several].tolist(), ends[several].tolist()):
                out += _group(kind[start:end].tolist(), number[start:end].tolist())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_NEAR)
    if len(kinds) > 1:
        out = list(_group(kinds, numbers))
        yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in out], pa.int64()) for i in range(3)], schema=_NEAR)


def near_words(words: DataFrame) -> DataFrame:
    """number, n_near, best: for words (number, word; all different) that have a near word, how many and the smallest number of them."""
    turned = words.select("number", "word").mapInArrow(_rotated, "key string, kind byte, number long")
    found = turned.repartition("key").sortWithinPartitions("key").mapInArrow(_scanned, "number long, near long, best long")
    return found.groupBy("number").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _last_forms(forms: DataFrame, stage: Stage) -> DataFrame:
    """number, root for every word that has a form. Each step doubles what is followed."""
    root, step = stage.keep(forms.select("number", F.col("form").alias("root")), "roots_0"), 0
    while True:
        further = root.select(F.col("number").alias("root"), F.col("root").alias("further"))
        ahead = root.join(further, "root", "left")
        if ahead.where("further IS NOT NULL").isEmpty():
            return root
        step += 1
        root = stage.keep(ahead.select("number", F.coalesce("further", "root").alias("root")), f"roots_{step}")


def variants(counted: DataFrame, stage: Stage) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word that is long and frequent enough. ``counted`` has word and n, each word once."""
    often = counted.where((F.col("n") >= OCCURRENCES) & (F.char_length("word") >= LETTERS))
    words = stage.keep(number_rows(often, "n", ["word"], "number"), "words")
    near = stage.keep(near_words(words), "near")
    best = words.select(F.col("number").alias("best"), F.col("n").alias("form_n"), F.col("word").alias("form"))
    judged = words.join(near, "number", "left").join(best, "best", "left")
    good = F.col("form_n") >= TIMES * F.col("n")
    judged = stage.keep(
        judged.select(
            "number", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best")).alias("best"), F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n"),
        ),
        "judged",
    )
    roots = _last_forms(judged.where("best IS NOT NULL").select("number", F.col("best").alias("form")), stage)
    named = roots.join(words.select(F.col("number").alias("root"), F.col("word").alias("root_word")), "root").select("number", "root_word")
    found = judged.join(named, "number", "left")
    return found.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def _misspelt(doc_id: int | None, word: bytes) -> bytes:
    """The query's words: one in 199 loses a letter."""
    h = crc32(word.decode("latin-1").encode(), crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if h % 199:
        return word
    place = h % len(word)
    return word[:place] + word[place + 1 :]


def op11_permuterm_variants(spark, sf_dir: str) -> DataFrame:
    return variants(count_words(table(spark, sf_dir, "documents"), _misspelt), Stage(spark, "spelling"))
