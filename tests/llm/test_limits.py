"""What has no limit: steps of the walk over hosts, number of languages, places in a text; and decoding against a plain version."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lonja.llm import hosts, language, order_minhash


def test_distrust_reaches_the_end_of_a_chain(spark, stage):
    """Forty hosts that link to one another up to one that a rule blocks: all are suspect."""
    hop = "<a href='http://h{}.net/'>x</a>"
    pages = [(i, f"http://h{i}.net/x", hop.format(i + 1)) for i in range(40)] + [(40, "http://h40.net/bad/", None)]
    pages += [(50, "http://good.org/", "<a href='http://friend.net/'>x</a>"), (51, "http://friend.net/", None), (51, "http://friend.net/", None)]
    rows = spark.createDataFrame([(*page, "clash", 1.0) for page in pages], "page_id long, url string, html string, host string, trust double")
    rules = [(hosts.BLOCK, "h40.net", "/bad/"), (hosts.ALLOW, "org", "/")]
    found = hosts.filter_urls(rows, stage, rules).collect()
    assert len(found) == len(pages)  # repeated pages too
    assert {r.page_id for r in found if r.verdict == hosts.BLOCK} == set(range(41))
    distrust = [next(r.distrust for r in found if r.page_id == i) for i in range(41)]
    assert all(far == pytest.approx(near * 0.85, rel=1e-2) for far, near in zip(distrust, distrust[1:]))


def test_every_language_is_learned(spark):
    """1,200 languages, one of them with most rows: each has words of its own and is a possible answer."""
    rows = [(i, f"lang{i:04d} " + chr(0x4E00 + i) * 30, f"l{i:04d}") for i in range(1200)]
    rows += [(2000 + i, "lang0007 " + chr(0x4E07) * (20 + i % 9), "l0007") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    codes = language.learn(docs, F.lit(True))
    assert codes.languages == tuple(f"l{i:04d}" for i in range(1200))
    again = language.learn(docs.repartition(2), F.lit(True))
    assert again.languages == codes.languages and np.array_equal(again.weights, codes.weights)


def test_a_sample_is_bounded_and_holds_rare_languages(spark, monkeypatch):
    rows = [(i, f"text number {i}", "often" if i % 100 else "rare") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    seen = {}
    monkeypatch.setattr(language, "fit", lambda rows, langs: seen.update(Counter(langs)))
    language.learn(docs, F.lit(True), per_language=50, most=60)
    assert seen == {"often": 30, "rare": 20}
    monkeypatch.setattr(language, "MOST_BROADCAST", 0)
    before, seen = dict(seen), {}
    monkeypatch.setattr(language, "fit", lambda rows, langs: seen.update(Counter(langs)))
    language.learn(docs, F.lit(True), per_language=50, most=60)
    assert seen == before


def plain_features(text):
    raw = f" {text.lower()} ".encode()
    counts = Counter()
    for i in range(len(raw)):
        for value, size in ((raw[i], 1), *([(raw[i] << 8 | raw[i + 1] | 1 << 24, 2)] if i + 1 < len(raw) else []),
                            *([(raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2], 3)] if i + 2 < len(raw) else [])):
            counts[(value * 2654435761 % (1 << 32)) >> (32 - language.BITS)] += 1
    norm = math.sqrt(sum(counts.values()))
    return {bucket: math.sqrt(n) / norm for bucket, n in counts.items()}


def plain_answer(codes, text, ambiguous_below=0.2):
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0, True
    features = plain_features(text)
    bits = range(codes.words.shape[1])
    margins = [sum(v * float(codes.weights[b][bit]) for b, v in features.items()) + float(codes.bias[bit]) for bit in bits]
    losses = [sum(float(codes.trust[bit]) * math.log1p(math.exp(-float(word[bit]) * margins[bit])) for bit in bits) for word in codes.words]
    shares = [math.exp(-loss) for loss in losses]
    shares = [share / sum(shares) for share in shares]
    best = min(range(len(losses)), key=lambda i: (losses[i], codes.languages[i]))
    second = sorted(shares)[-2]
    return codes.languages[best], shares[best], shares[best] - second < ambiguous_below


def test_answers_against_a_plain_version(spark, odd, monkeypatch):
    words = {"de": "und der nicht ein", "en": "and the not one", "es": "y el no uno", "fr": "et le pas un"}
    train = [(i, " ".join(text.split()[(i + k) % 4] for k in range(6)), lang) for i in range(60) for lang, text in words.items()]
    codes = language.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"), F.lit(True))
    mixed = [(100, "und the el un"), (101, "x"), (102, words["fr"]), (103, "uno y und et")]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(mixed, "doc_id long, text string"))
    monkeypatch.setattr(language, "_CHUNK", 1000)  # long texts in pieces
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    found = Counter((r.doc_id, r.lang_pred, round(r.score, 3), r.ambiguous) for r in language.identify(docs, codes).collect())
    plain = Counter()
    for (doc_id, text), n in texts.items():
        name, score, unsure = plain_answer(codes, text)
        plain[(doc_id, name, round(score, 3), unsure)] += n
    assert found == plain
    assert {unsure for _, _, _, unsure in found} == {True, False}


def test_ties_go_to_the_first_language():
    codes = language.Codes(("a", "b", "c"), language.codewords(3), None, None, np.ones(3, np.float32))
    best, share, lead = language.decode(codes, np.zeros(3, np.float32))
    assert (best, lead) == (0, 0.0) and share == pytest.approx(1 / 3)


def test_places_have_room(spark):
    rows = spark.createDataFrame([(v, p) for v in (-1, 0, 1 << 62, 12345 << 40) for p in (1, 1 << 24, (1 << 31) - 1)], "v long, p int")
    item = order_minhash._pack(F.col("v"), F.col("p"))
    mask = (1 << order_minhash.PLACE_BITS) - 1
    found = rows.select("v", "p", item.alias("item"), order_minhash._hash(item).alias("h"), item.bitwiseAND(mask).alias("at"))
    for r in found.collect():
        assert r.item >= 0 and r.at == r.p and r.h == (r.v % (1 << 64)) >> (64 - order_minhash.HASH_BITS)
