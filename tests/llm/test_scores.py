"""Quality, language and the language model: held-out accuracy, plain versions of the formulas, odd rows."""

import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

from lonja.llm import katz, language, quality
from lonja.llm.common import remainder

SF_DIR = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables here")


def test_the_sum_of_squares_counts_every_pair():
    random = np.random.default_rng(1)
    vectors = random.normal(size=(50, 4)).astype(np.float32)
    machine = quality.Machine(0.3, random.normal(size=50).astype(np.float32), vectors)
    place, value = np.array([3, 7, 20, 41]), np.array([0.5, 1.0, 2.0, 0.1], np.float32)
    margin = 0.3 + value @ machine.weights[place]
    margin += sum(value[i] * value[j] * (vectors[place[i]] @ vectors[place[j]]) for i in range(4) for j in range(i))
    assert machine.score(place, value) == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-5)


@data
def test_quality_on_held_out_rows(spark):
    found = quality.op1_factorisation_quality(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert np.mean([r.predicted == 1 for r in rows if r.quality == 1]) > 0.98


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (8, None), (9, 1), (None, 1), (99, 1)], "doc_id long, quality int")
    machine = quality.learn(odd, labels, ["n_chars"])
    rows = quality.judge(odd, machine, ["n_chars"]).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.judge(none, machine, ["n_chars"]).count() == 0
    unlabelled = quality.learn(odd, labels.where("false"))
    assert {round(r.score, 6) for r in quality.judge(odd, unlabelled).collect()} == {0.5}


@data
def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = language.op6_language_codes(spark, SF_DIR)
    rows = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert found.count() == docs.count()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_codewords_are_far_apart():
    assert language.codewords(4).shape == (4, 7)
    many = language.codewords(20)
    assert min((many[i] != many[j]).sum() for i in range(20) for j in range(i)) >= 8


def test_language_of_odd_rows(odd, none):
    codes = language.learn(odd, F.lit(True))
    rows = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(odd, codes).collect()}
    assert {r[1:] for r in rows if r[0] in (3, 4, 5, 8)} == {("und", 0.0)}
    assert {r[1:] for r in rows if r[0] in (1, 9, 11)} == {("en", 1.0)}
    assert language.learn(none, F.lit(True)) is None
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}
    kept = language.identified(odd, codes)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2, 6, 7, 9, 10, 11, None}


def plain_katz(documents, learned):
    """Dictionaries: the model of the docstring, word by word."""
    words, pairs, texts = Counter(), Counter(), 0
    tokens = [[*(text or "").encode().lower().split(), "end"] for text in documents]
    for one, use in zip(tokens, learned):
        if use:
            texts += 1
            words.update(one)
            pairs.update(zip(["start", *one], one))
    total = sum(words.values())

    def left_of(counts):
        types = Counter(counts.values())
        left = katz.discounts([0, *[types[r] for r in range(1, 7)]])
        return lambda c: left[c] if c <= katz.LARGEST else c - katz.TENTH

    of_words, of_pairs, histories = left_of(words), left_of(pairs), {**words, "start": texts}
    low = {w: of_words(c) / total for w, c in words.items()}
    unknown = 1 - sum(low.values())
    after = defaultdict(list)
    for (h, w), c in pairs.items():
        after[h].append((w, c))
    weight = {
        h: (1 - sum(of_pairs(c) for _, c in found) / histories[h]) / (1 - sum(low[w] for w, _ in found)) for h, found in after.items()
    }

    def probability(h, w):
        c = pairs.get((h, w), 0)
        return of_pairs(c) / histories[h] if c else weight.get(h, 1) * low.get(w, unknown)

    scores = [sum(math.log10(probability(h, w)) for h, w in zip(["start", *one], one)) for one in tokens]
    bases = [sum(math.log10((words.get(w, 0) + 1) / (total + len(words) + 1)) for w in one) for one in tokens]
    sums = [sum(probability(h, w) for w in words) + probability(h, b"never seen") for h in list(after)[:5]]
    return scores, bases, total, [(len(one), sum(w in words for w in one)) for one in tokens], sums


@pytest.mark.parametrize("chunk, part", [(2_000_000, 2_000_000), (300, 900)])
def test_katz_against_dictionaries(spark, stage, written, monkeypatch, chunk, part):
    """In one piece, and cut into many chunks and partitions with histories that are split."""
    monkeypatch.setattr(katz, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(katz, "PARTITION_TOKENS", part)
    random = np.random.default_rng(5)
    names = [f"w{i}" for i in range(60)]
    chance = 1 / np.arange(1, 61)
    texts = [" ".join(random.choice(names, random.integers(1, 40), p=chance / chance.sum())) for _ in range(150)] + [None, "", "NEW words"]
    docs = written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), f"katz_{chunk}")
    learned = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    scores, bases, total, sizes, sums = plain_katz(texts, learned)
    assert sums == pytest.approx([1.0] * len(sums))
    rows = {r.doc_id: r for r in katz.score(docs, remainder(F.col("doc_id"), 7) != 2, stage).collect()}
    assert len(rows) == len(texts)
    for i, row in rows.items():
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (not learned[i], *sizes[i], total)
        assert row.score == pytest.approx(scores[i], abs=1e-7) and row.base_score == pytest.approx(bases[i], abs=1e-7)


def test_katz_sends_a_pair_in_few_bytes():
    """Pairs go to their partitions as numbers of words, of which frequent ones are small, not as hashes."""
    random = np.random.default_rng(6)
    words = [np.uint64(xxhash.xxh3_64_intdigest(f"w{i}".encode())) for i in range(5000)]
    chance = 1 / np.arange(1, 5001)
    drawn = random.choice(words, 100_000, p=chance / chance.sum())
    drawn[999::1000] = katz.END
    chunk = katz._packed(*katz._columns([(i, True, tokens) for i, tokens in enumerate(np.split(drawn, 100))]))
    texts_of = pa.table({"chunk": pa.array([0], pa.int64()), "payload": pa.array([chunk], pa.binary())})
    sent = pa.Table.from_batches(list(katz._word_packets(2)(iter(texts_of.to_batches()))))
    totals = pa.concat_tables([katz._word_totals(sent.filter(pc.equal(sent["part"], part))) for part in (0, 1)])
    packets = katz._pair_packets(2, 2, 100_000, 5001, 1 << 40)(texts_of, totals.select(["chunk", "part", "counts", "numbers"]))
    pairs = len(np.unique(np.stack([drawn[:-1], drawn[1:]]), axis=1).T)
    assert sum(map(len, packets["payload"].to_pylist())) < 6 * pairs  # a hash of 48 bits alone is 6 bytes


def test_katz_of_odd_rows(odd, none, stage):
    rows = katz.score(odd, F.col("doc_id") < 9, stage).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}


def test_katz_without_training_or_rows(odd, none, stage):
    assert {(r.score, r.n_known, r.train_tokens) for r in katz.score(odd, F.lit(False), stage).collect()} == {(0.0, 0, 0)}


def test_katz_of_no_rows(none, stage):
    assert katz.score(none, F.lit(True), stage).count() == 0
