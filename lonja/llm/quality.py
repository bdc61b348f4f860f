"""Text quality by a factorisation machine.

Inputs of a score: hashed words with the square roots of their counts, bands of structure statistics, and bands of numeric
metadata columns. Every input has a weight and a short vector; two inputs interact by the product of their vectors. All
pairs together cost no more than one pass, since their sum is half of (square of sums - sum of squares), per factor.

Learning takes at most ``most`` labelled texts, chosen by the hash of the id. Scoring reads every whole text and shuffles
nothing; what each task gets is the model, whose size is fixed.

Defined cases: a null text is the empty text; a null or negative metadata value has a band of its own; a null quality is
not learned from; an id with several labels has the lowest; ids without text are not learned from; if no row is labelled,
or all have one label, every score is that label's smoothed share; other columns are not looked at.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import batches, remainder, table

BUCKETS = 1 << 14
BANDS = 12
FACTORS = 8
_LETTERS = string.ascii_letters.encode() + bytes(range(128, 256))
_PLAIN = _LETTERS + string.digits.encode() + b" \t\n\r.,;:!?'\"()-"


class _Buckets(dict):
    """Bucket of a word, kept for the next time it is met."""

    def __missing__(self, word: str) -> int:
        bucket = crc32(word.encode()) % BUCKETS
        if len(self) < 500_000:
            self[word] = bucket
        return bucket


_buckets = _Buckets()


def _share_band(part: float, whole: float, finest: float = 1.0) -> int:
    """Shares in equal steps up to ``finest``."""
    return min(BANDS - 1, int(BANDS * part / (whole * finest))) if whole else 0


def _size_band(size: float | None) -> int:
    """Sizes by powers of two; the last band is for the unknown."""
    return BANDS - 1 if size is None or size < 0 else min(BANDS - 2, int(log2(1 + size) * 0.6))


def structure(text: str, words: list[str], counts: Counter) -> list[int]:
    """One band per statistic."""
    raw = text.encode()
    size = len(raw)
    lines = [line for line in text.split("\n") if line.strip()]
    ends = sum(map(text.count, ".!?"))
    return [
        _size_band(len(words)),
        min(BANDS - 1, int(len(text) / len(words))) if words else 0,
        _share_band(len(raw.translate(None, _LETTERS)), size),
        _share_band(len(raw.translate(None, _PLAIN)), size, 0.25),
        _share_band(size - len(raw.translate(None, string.digits.encode())), size, 0.25),
        _share_band(size - len(raw.translate(None, string.ascii_uppercase.encode())), size, 0.5),
        _share_band(len(counts), len(words)),
        _share_band(max(counts.values(), default=0), len(words), 0.5),
        _share_band(len(lines) - len(set(lines)), len(lines)),
        min(BANDS - 1, int(len(words) / len(lines) / 8)) if lines else 0,
        min(BANDS - 1, int(len(words) / (1 + ends) / 2)),
        _share_band(text.count("|") + text.count("http") + text.count("@"), len(words), 0.25),
        _share_band(sum(map(eq, words, words[1:])), len(words), 0.5),
        _share_band(sum(map(eq, words, words[2:])), len(words), 0.5),
    ]


STATISTICS = 14


def inputs(text: str | None, metadata: Sequence[float | None]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the inputs that are not zero: words of length 1 together, bands of length 1 together."""
    text = text or ""
    words = text.lower().split()
    counts = Counter(words)
    bands = [*structure(text, words, counts), *map(_size_band, metadata)]
    value = np.sqrt(np.fromiter(counts.values(), np.float32, len(counts)))
    value /= np.float32(max(1e-9, np.sqrt((value * value).sum())))
    place = np.fromiter(map(_buckets.__getitem__, counts), np.int64, len(counts))
    place, same = np.unique(place, return_inverse=True)
    value = np.bincount(same, value, len(place)).astype(np.float32)
    more = BUCKETS + BANDS * np.arange(len(bands)) + np.array(bands)
    return np.concatenate([place, more]), np.concatenate([value, np.full(len(bands), len(bands) ** -0.5, np.float32)])


@dataclass(frozen=True)
class Machine:
    base: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, place: np.ndarray, value: np.ndarray) -> float:
        parts = value[:, None] * self.vectors[place]
        sums = parts.sum(0)
        margin = self.base + value @ self.weights[place] + 0.5 * float((sums * sums).sum() - (parts * parts).sum())
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: Sequence[int], size: int, epochs: int = 10, seed: int = 7) -> Machine:
    random = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    share = (y.sum() + 1) / (len(y) + 2)
    base = np.float32(np.log(share / (1 - share)))
    weights, vectors = np.zeros(size, np.float32), random.normal(0, 0.05, (size, FACTORS)).astype(np.float32)
    if len(set(labels)) < 2:
        return Machine(float(base), weights, np.zeros_like(vectors))
    past_w, past_v = np.full_like(weights, 1e-3), np.full_like(vectors, 1e-3)
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(len(rows)), max(1, len(rows) // 128)):
            x = np.zeros((len(batch), size), np.float32)
            for row, i in zip(x, batch):
                row[rows[i][0]] = rows[i][1]
            squared = x * x
            sums = x @ vectors
            margin = base + x @ weights + 0.5 * ((sums * sums).sum(1) - (squared @ (vectors * vectors)).sum(1))
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[batch]) / len(batch)
            step = x.T @ slope + 1e-5 * weights
            past_w += step * step
            weights -= 0.2 * step / np.sqrt(past_w)
            step = x.T @ (slope[:, None] * sums) - (squared.T @ slope)[:, None] * vectors + 1e-5 * vectors
            past_v += step * step
            vectors -= 0.1 * step / np.sqrt(past_v)
            base -= np.float32(0.1 * slope.sum())
    return Machine(float(base), weights, vectors)


def _read(docs: DataFrame, metadata: Sequence[str]) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *[F.col(name).cast("double").alias(f"metadata_{i}") for i, name in enumerate(metadata)],
    )


def learn(docs: DataFrame, labels: DataFrame, metadata: Sequence[str] = (), most: int = 6000) -> Machine:
    """``labels`` has doc_id and quality (0 or 1), only of rows that may be learned from."""
    size = BUCKETS + BANDS * (STATISTICS + len(metadata))
    one_each = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    chosen = one_each.agg(F.min("quality").cast("int").alias("quality")).withColumn("id_hash", F.xxhash64("doc_id"))
    # At most ``most`` rows of three numbers: small enough for every task, whatever the tables hold.
    chosen = F.broadcast(chosen.orderBy("id_hash", "doc_id").limit(most))
    sample = _read(docs, metadata).where(F.col("text").isNotNull()).join(chosen, "doc_id")
    names = [f"metadata_{i}" for i in range(len(metadata))]

    def features(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = [inputs(text, more) for text, *more in zip(*[c.to_pylist() for c in batch.columns[2:]])]
        yield {
            "id_hash": batch.column(0), "quality": batch.column(1),
            "place": [place.astype("<u2").tobytes() for place, _ in rows], "value": [v.astype("<f4").tobytes() for _, v in rows],
        }

    found = batches(sample.select("id_hash", "quality", "text", *names), features, "id_hash long, quality int, place binary, value binary")
    rows = found.orderBy("id_hash", "place").limit(most).toArrow().to_pylist()
    vectors = [(np.frombuffer(r["place"], "<u2").astype(np.int64), np.frombuffer(r["value"], "<f4")) for r in rows]
    return fit(vectors, [r["quality"] for r in rows], size)


def judge(docs: DataFrame, machine: Machine, metadata: Sequence[str] = ()) -> DataFrame:
    """doc_id and score for every row."""

    def scored(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = zip(*[c.to_pylist() for c in batch.columns[1:]])
        yield {"doc_id": batch.column(0), "score": [machine.score(*inputs(text, more)) for text, *more in rows]}

    return batches(_read(docs, metadata), scored, "doc_id long, score double")


def op1_factorisation_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = learn(docs, labels.where(remainder(F.col("doc_id"), 3) != 1), ["n_chars"])
    held_out = remainder(F.col("doc_id"), 3) == 1
    return judge(docs, machine, ["n_chars"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
