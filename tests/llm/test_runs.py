"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lonja.llm import periodic_runs

SF_DIR = "/root/testdata/sf0.001"


def plain(words):
    """Every maximal stretch for every period, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(24, 3 * q):
                found.setdefault((start, end + q - start), q)
            start = max(end, start) + 1
    return sorted([(s, n, q) for (s, n), q in found.items()], key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def case(rng):
    """Words of a small alphabet, with periodic stretches inside periodic stretches."""
    letters = [b"w%d" % i for i in range(rng.choice([1, 2, 3, 50]))]
    words = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 16, 17, 31, 40]))]
        if rng.random() < 0.4:
            unit = unit * rng.randint(2, 9) + [rng.choice(letters) for _ in range(rng.randint(0, 3))]
        words += unit * rng.randint(1, 5) + unit[: rng.randint(0, len(unit))]
        words += [rng.choice(letters) for _ in range(rng.randint(0, 4))]
    return words


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    group = [case(rng) for _ in range(40)]
    for words, runs in zip(group, periodic_runs.group_runs(group)):
        assert runs == plain(words)


def test_fibonacci_and_uniform_words():
    one, two = [b"a"], [b"a", b"b"]
    for _ in range(12):
        one, two = two, two + one
    for words in (two, [b"x"] * 1000, ([b"x"] * 30 + [b"y"]) * 9, [b"u", b"v"] * 12, [b"u", b"v"] * 11 + [b"u"]):
        assert periodic_runs.group_runs([words, [], words])[2] == plain(words)


def test_order_statistics_of_slices():
    rng = np.random.default_rng(3)
    values = rng.permutation(1000)
    tree = periodic_runs.Wavelet(values, 10)
    low = rng.integers(0, 1000, 200)
    high = np.minimum(1000, low + 1 + rng.integers(0, 300, 200))
    bound = rng.integers(0, 1001, 200)
    assert tree.below(low, high, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
    n = rng.integers(0, high - low)
    assert tree.nth(low, high, n).tolist() == [int(np.sort(values[a:b])[i]) for a, b, i in zip(low, high, n)]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        a = (h // 10) % len(words)
        p = 1 + (len(words) - a) // (3 + (h // 10) % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    sha = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(kept(words, runs)))]
    return (doc_id, len(runs), *best, milli, *sha)


def as_rows(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_the_query_on_whole_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) < 6000")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=repr)
    found = periodic_runs.op13_periodic_runs(spark, str(tmp_path))
    assert as_rows(found) == want and any(r[1] for r in want)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    kinds = dict(found.dtypes)
    assert all(kinds[c] == "bigint" for c in ("n_runs", "start", "length", "period", "exponent_milli"))


def test_odd_rows(spark, odd, none, tmp_path):
    short = odd.where("coalesce(length(text), 0) < 1000")
    short.write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted((expected(r.doc_id, r.text) for r in short.collect()), key=repr)
    assert as_rows(periodic_runs.op13_periodic_runs(spark, str(tmp_path))) == want
    long = {r.doc_id: r for r in periodic_runs.periodic_runs(odd).collect()}
    assert long[9].runs == [] and long[9].text.startswith("word0 of a very long text.")
    assert periodic_runs.periodic_runs(none).count() == 0


def test_a_text_longer_than_a_group(spark):
    words = [f"w{i}" for i in range(60_000)] * 5
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "a b")], "doc_id long, text string")
    rows = {r.doc_id: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(0, 300_000, 60_000)]
    assert rows[1].text == " ".join(words[:60_000]) and rows[2].text == "a b"
