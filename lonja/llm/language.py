"""Language identification by error-correcting output codes.

Each language gets a codeword of +1 and -1. For every bit a binary classifier over hashed byte n-grams learns which half of
the languages a text comes from. A text goes to the language whose codeword loses least against the margins of all bits;
a bit counts by how well it did on sampled texts that it did not learn from. Where the runner-up is close, the row is flagged.

Learning takes at most ``per_language`` texts of a language and ``most`` texts in all (one of each, if there are more languages than that),
chosen by the hash of the row. All languages are learned; they are counted over all rows. Scoring reads every whole text and shuffles nothing.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any labelled row everything is
``und``; with one language only, that language has score 1; a null ``lang`` is not learned from; ties of a decision go to
the alphabetically first language; repeated rows are scored each;
very long texts are counted piece by piece, whole; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.common import batches, give_back_memory, remainder, table, texts

BITS = 14
UNKNOWN = "und"
MOST_BROADCAST = 100_000
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Codes:
    languages: tuple[str, ...]
    words: np.ndarray  # one row of +1 and -1 per language
    weights: np.ndarray  # n-gram by bit
    bias: np.ndarray
    trust: np.ndarray  # per bit


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte n-grams of one, two and three bytes, and their weights: square roots of counts, of length 1."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    counts = np.zeros(1 << BITS, np.int64)
    for start in range(0, len(raw), _CHUNK):
        part = raw[start : start + _CHUNK + 2].astype(np.uint32)
        grams = [part[:_CHUNK], (part[:-1] << 8 | part[1:] | 1 << 24)[:_CHUNK], (part[:-2] << 16 | part[1:-1] << 8 | part[2:])[:_CHUNK]]
        for gram in grams:
            counts += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    found = np.flatnonzero(counts)
    values = np.sqrt(counts[found]).astype(np.float32)
    return found, values / np.float32(np.sqrt((values * values).sum()))


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """All distinct splits of up to six languages; for more, the widest apart of some random codes."""
    if languages < 2:
        return np.ones((languages, 0), np.float32)
    if languages <= 6:
        splits = [(1, *rest) for rest in product((1, -1), repeat=languages - 1) if -1 in rest]
        return np.array(splits, np.float32).T
    random, length, best, apart = np.random.default_rng(seed), int(np.ceil(10 * np.log2(languages))), None, -1
    for _ in range(50):
        code = random.choice(np.array([-1, 1], np.float32), (languages, length))
        code = code[:, np.abs(code.sum(0)) < languages]
        distances = (code.shape[1] - code @ code.T) / 2 + np.eye(languages) * length
        if distances.min() > apart:
            best, apart = code, distances.min()
    return best


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(rows), 1 << BITS), np.float32)
    for row, (found, values) in zip(out, rows):
        row[found] = values
    return out


def fit(rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str], epochs: int = 8, seed: int = 7) -> Codes:
    languages = tuple(sorted(set(langs)))
    words = codewords(len(languages))
    target = words[[languages.index(lang) for lang in langs]]
    weights, bias = np.zeros((1 << BITS, words.shape[1]), np.float32), np.zeros(words.shape[1], np.float32)
    steps = np.full_like(weights, 1e-3)
    random = np.random.default_rng(seed)
    order = random.permutation(len(rows))
    kept_out, learned = order[: len(rows) // 10], order[len(rows) // 10 :]
    for _ in range(epochs if words.shape[1] else 0):
        for batch in np.array_split(random.permutation(learned), max(1, len(learned) // 128)):
            x, y = _dense([rows[i] for i in batch]), target[batch]
            slope = -y / (1 + np.exp(np.clip(y * (x @ weights + bias), -30, 30))) / len(batch)
            step = x.T @ slope + 1e-6 * weights
            steps += step * step
            weights -= 0.5 * step / np.sqrt(steps)
            bias -= 0.5 * slope.sum(0)
    wrong = np.zeros(words.shape[1])
    for i in kept_out:
        wrong += target[i] * (rows[i][1] @ weights[rows[i][0]] + bias) <= 0
    error = (wrong + 1) / (len(kept_out) + 2)
    return Codes(languages, words, weights, bias, np.maximum(np.log((1 - error) / error), 0.05).astype(np.float32))


def decode(codes: Codes, margins: np.ndarray) -> tuple[int, float, float]:
    """Nearest language, its share, and how far the runner-up's share is behind."""
    if len(codes.languages) == 1:
        return 0, 1.0, 1.0
    losses = np.logaddexp(0, -codes.words * margins) @ codes.trust
    shares = np.exp(losses.min() - losses)
    shares /= shares.sum()
    best = int(shares.argmax())
    return best, float(shares[best]), float(shares[best] - np.partition(shares, -2)[-2])


def learn(docs: DataFrame, eligible: Column, per_language: int = 1200, most: int = 6000) -> Codes | None:
    """``docs`` has doc_id, text and lang. Every language gets its share of the sample, at least one row, chosen by the hash of the row."""
    labelled = docs.where(eligible & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    languages = counted.count()
    if not languages:
        return None
    quota = min(per_language, max(1, most // languages))
    # One short row per language: handed to all tasks up to a fixed number, joined by a shuffle beyond it.
    counted = F.broadcast(counted) if languages <= MOST_BROADCAST else counted
    # Thinned out by chance to somewhat more than the quota first, so that a frequent language does not meet whole in one task.
    whole = 1 << 30
    share = F.least(F.lit(float(whole)), F.lit(float(whole)) * (2 * quota + 20) / F.col("rows"))
    hashed = labelled.withColumn("row_hash", F.xxhash64("doc_id", "text")).join(counted, "lang")
    order = Window.partitionBy("lang").orderBy("row_hash", "doc_id")
    sample = hashed.where(F.pmod("row_hash", F.lit(whole)) < share).withColumn("place", F.row_number().over(order)).where(F.col("place") <= quota)

    def features(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = [ngrams(text) for text in batch.column(2).to_pylist()]
        yield {
            "row_hash": batch.column(0), "lang": batch.column(1),
            "found": [found.astype("<u2").tobytes() for found, _ in rows], "value": [v.tobytes() for _, v in rows],
        }

    found = batches(sample.select("row_hash", "lang", "text"), features, "row_hash long, lang string, found binary, value binary")
    rows = found.orderBy("row_hash", "lang").toArrow().to_pylist()
    rows = [r for r in rows if r["found"]]
    vectors = [(np.frombuffer(r["found"], "<u2").astype(np.int64), np.frombuffer(r["value"], np.float32)) for r in rows]
    return fit(vectors, [r["lang"] for r in rows]) if rows else None


def identify(docs: DataFrame, codes: Codes | None, ambiguous_below: float = 0.2) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every row."""

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        names, scores, unsure = [], [], []
        for text in batch.column(1).to_pylist():
            if codes is None or not has_letter(text):
                names.append(UNKNOWN)
                scores.append(0.0)
                unsure.append(True)
                continue
            found, values = ngrams(text)
            best, share, lead = decode(codes, values @ codes.weights[found] + codes.bias)
            names.append(codes.languages[best])
            scores.append(share)
            unsure.append(lead < ambiguous_below)
        yield {"doc_id": batch.column(0), "lang_pred": names, "score": scores, "ambiguous": unsure}

    return batches(texts(docs), judge, "doc_id long, lang_pred string, score double, ambiguous boolean")


def identified(docs: DataFrame, codes: Codes | None, ambiguous_below: float = 0.2) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known and not in doubt."""
    at = docs.columns.index("text")

    def sure(text: str | None) -> bool:
        if codes is None or not has_letter(text):
            return False
        found, values = ngrams(text)
        return decode(codes, values @ codes.weights[found] + codes.bias)[2] >= ambiguous_below

    def over(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in incoming:
                yield batch.filter(pa.array([sure(text.as_py()) for text in batch.column(at)], pa.bool_()))
        finally:
            give_back_memory()

    return docs.mapInArrow(over, docs.schema)


def op6_language_codes(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, learn(docs, remainder(F.col("doc_id"), 4) != 2))
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
