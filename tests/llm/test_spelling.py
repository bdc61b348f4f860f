"""Spelling variants against a plain comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from lonja.llm import spelling

SF_DIR = "/root/testdata/sf0.001"


def near(one, other):
    """One inserted, deleted or replaced code point."""
    if len(one) == len(other):
        return sum(a != b for a, b in zip(one, other)) == 1
    if abs(len(one) - len(other)) != 1:
        return False
    short, long = sorted((one, other), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    rows, form = {}, {}
    for w, n in words.items():
        found = [x for d in (-1, 0, 1) for x in by_length.get(len(w) + d, []) if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
        rows[w] = len(found)
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, rows[w], words.get(form.get(w))))
    return sorted(out)


def counted(docs):
    """The contract's words, said with a regular expression."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def as_rows(found):
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("seed", range(3))
def test_random_words(spark, stage, seed):
    rng = random.Random(seed)
    words = set()
    for _ in range(120):
        word = "".join(rng.choice("aabcé") for _ in range(rng.randint(6, 8)))
        words |= {word, word[:3] + rng.choice("abcé") + word[3:], word[:2] + word[3:]}
    counts = {w: rng.choice([4, 5, 6, 24, 25, 125, 600, 3000]) for w in words}
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3), stage)
    assert as_rows(found) == plain(counts)


def test_rotations_around_the_explicit_length(spark, stage):
    rng, counts = random.Random(5), {}
    for n in (spelling.EXPLICIT - 2, spelling.EXPLICIT - 1, spelling.EXPLICIT, spelling.EXPLICIT + 1, spelling.EXPLICIT + 2, 3000):
        word = "".join(rng.choice("ab") for _ in range(n))
        counts |= {word: 5000 + n, word[: n // 2] + word[n // 2 + 1 :]: 700 + n, word[:4] + "c" + word[5:]: 100 + n, word + "z": 20 + n}
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), stage)
    assert as_rows(found) == plain(counts)


def test_chains_of_forms_end_at_the_root(spark, stage):
    words = ["abcdefg", "abcdefh", "abcdeih", "abcdjih", "abckjih", "abxkjih"]
    counts = {w: 5**i * 5 for i, w in enumerate(words)}
    rows = as_rows(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), stage))
    assert rows == plain(counts) and {r[2] for r in rows} == {"abxkjih"}


def test_letter_runs_are_those_of_the_pattern():
    rng = random.Random(9)
    letters = "abzAZ0_ '@[`{¿À×ßé÷ÿĀıK漢\U0001f600\n\t"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(60))
        plain_runs = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in re.findall("[A-Za-zÀ-ÿ]+", text)]
        assert [x.decode("latin-1") for x in spelling.letter_runs(text)] == plain_runs
    assert spelling.letter_runs(None) == []


def test_the_query_on_a_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert as_rows(spelling.op11_permuterm_variants(spark, SF_DIR)) == plain(counted(docs))


def test_odd_rows(spark, odd, none, stage, monkeypatch, tmp_path):
    monkeypatch.setattr(spelling, "HELD", 3)
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    found = spelling.op11_permuterm_variants(spark, str(tmp_path))
    assert as_rows(found) == plain(counted(docs))
    assert dict(found.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert spelling.variants(spelling.count_words(none), stage).count() == 0
