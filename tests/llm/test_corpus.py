"""Packing, near duplicates, fingerprints, hosts, shards, decontamination and repeated lines against plain versions."""

import hashlib
import zlib
from collections import Counter, defaultdict
from glob import glob

import numpy as np
import pytest

from lonja.llm import decontaminate, hosts, lines, near_dedup, order_minhash, packing, sharding
from lonja.llm.common import identified
from lonja.llm.components import stars

SF_DIR = "/root/testdata/sf0.001"
random = np.random.default_rng(11)
NAMES = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki") for b in ("lon", "mur", "nas", "pet", "rin", "sot", "tul", "vex")]


def prose(words):
    return " ".join(random.choice(NAMES, words))


# ---- packing


def test_cuts_cover_a_document_and_fit_their_class():
    for tokens in range(1, 5000):
        pieces = packing.cuts(tokens)
        assert sum(pieces) == tokens
        assert all(packing.class_of(n) * n <= packing.CAPACITY for n in pieces)


def test_packing_round_trip(odd, written, stage):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(written(odd), stage).collect()
    found = defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        found[r.doc_id, r.doc_tokens].append((r.start, r.ids))
    expected = Counter((d, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for d, t in odd.select("doc_id", "text").collect())
    for (doc_id, ids), times in expected.items():
        pieces = sorted(found[doc_id, len(ids) // 4])
        whole = [x for d, x in ((doc_id, ids),) for _ in range(sum(e == ids for (i, e) in expected if i == d))]
        if times == 1 and doc_id is not None:
            assert b"".join(p for _, p in pieces) == whole[0]
        else:
            assert sum(len(p) for _, p in pieces) >= times * len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_packing_pads_little(spark, stage, written):
    docs = written(spark.createDataFrame([(i, prose(int(n))) for i, n in enumerate(random.integers(1, 900, 400))], "doc_id long, text string"))
    sizes = defaultdict(int)
    for r in packing.pack(docs, stage).select("sequence_id", "length").collect():
        sizes[r.sequence_id] += r.length
    padding = sum(0 if n & (n - 1) == 0 else packing.CAPACITY - n for n in sizes.values())
    assert padding < 0.01 * sum(sizes.values())


def test_packing_nothing(none, stage):
    assert packing.pack(none, stage).count() == 0


# ---- near duplicates


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def plain_components(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return Counter((d, len(s), least.get(root(i)) if s else d) for i, (d, s) in enumerate(sets))


def changed(text, edits):
    words = text.split(" ")
    for at in random.integers(0, len(words), edits):
        words[at] = "new" + str(random.integers(1000))
    return " ".join(words)


def test_near_duplicates_against_all_pairs(spark, odd, written, stage, monkeypatch):
    """Short lists, and long ones over several rounds: a group of near copies in which not all are alike."""
    monkeypatch.setattr(near_dedup, "SHORT", 4)
    first = prose(120)
    texts = [first] + [changed(first, int(n)) for n in random.integers(1, 7, 60)] + [prose(50) for _ in range(40)]
    texts += [changed(texts[i], 2) for i in range(61, 90)] + [first, first.upper(), "A b", "a B"]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = written(odd.select("doc_id", "text").unionByName(extra))
    rows = near_dedup.near_duplicates(docs, stage).collect()
    expected = plain_components([(r.doc_id, r.text) for r in docs.collect()])
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    left = near_dedup.one_of_each(docs, stage).collect()
    assert len(left) == len({r.component for r in rows})
    assert Counter(r.doc_id for r in left if r.doc_id is not None) == Counter({r.doc_id for r in rows if r.kept and r.doc_id is not None})


def test_a_group_that_is_half_alike(spark, written, stage, monkeypatch):
    """Without rounds, so that the last step settles it: most members of the group are near the limit, on both sides of it."""
    monkeypatch.setattr(near_dedup, "SHORT", 2)
    monkeypatch.setattr(near_dedup, "ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "CHOSEN", 1)
    first = prose(120)
    texts = [first] + [changed(first, int(n)) for n in random.integers(1, 16, 120)] + [first + " " + prose(n) for n in range(1, 40)]
    docs = written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    reached = []
    possible = near_dedup._Graph.possible_pairs
    monkeypatch.setattr(near_dedup._Graph, "possible_pairs", lambda graph, members: reached.append(1) or possible(graph, members))
    rows = near_dedup.near_duplicates(docs, stage).collect()
    assert reached and Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == plain_components(list(enumerate(texts)))


def test_near_duplicates_of_nothing(none, stage):
    assert near_dedup.near_duplicates(none, stage).count() == 0


def test_stars_of_a_chain_and_a_hub(spark, stage):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 200)] + [(300, 300)]
    found = {r.a: r.b for r in stars(spark.createDataFrame(edges, "a long, b long"), stage, "s").collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 200)}}


# ---- fingerprints


def plain_hash(spark, values):
    """xxhash64 of lists of strings or numbers, by Spark itself."""
    from pyspark.sql import functions as F

    return [r.h for r in spark.createDataFrame([(v,) for v in values]).select(F.xxhash64("_1").alias("h")).collect()]


def plain_fingerprint(spark, text):
    import re

    tokens = re.findall(r"[^ \t\n\x0b\f\r]{1,16}", text)
    if not tokens:
        return []
    items, place = [], 0
    runs = [tokens[i : i + 3] for i in range(max(1, len(tokens) - 2))]
    hashes = [(h % 2**64) >> 32 for h in plain_hash(spark, runs)]
    from pyspark.sql import functions as F

    count = Counter()
    for place, h in enumerate(hashes, 1):
        if count[h]:
            again = spark.range(1).select(F.xxhash64(F.lit(h).cast("long"), F.lit(count[h])).alias("h")).first().h
            items.append(((again % 2**64) >> 32, place))
        else:
            items.append((h, place))
        count[h] += 1
    found = []
    for bucket in range(32):
        few = sorted(i for i in items if i[0] >> 27 == bucket)[:2]
        if few:
            ordered = [F.lit(h).cast("long") for h, _ in sorted(few, key=lambda x: x[1])]
            h = spark.range(1).select(F.xxhash64(*ordered).alias("h")).first().h % 2**64
            found.append(bucket << 32 | h >> 32)
    return found


@pytest.mark.parametrize("text", ["", "one", "one two", "a b c d e f g h", "x y z x y z x y z x y z", "same same same same same"])
def test_fingerprint_against_a_plain_one(spark, text):
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert order_minhash.with_fingerprint(rows, "text", "f").first().f == plain_fingerprint(spark, text)


def test_next_document_and_edited_text(spark, written, monkeypatch):
    monkeypatch.setattr(order_minhash, "ROWS_PER_BLOCK", 4)
    texts = [prose(int(n)) + "é" for n in random.integers(0, 30, 60)] + ["", None, "ab"]
    ids = [int(i) for i in random.permutation(1000)[: len(texts)]]
    docs = written(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"))
    rows = {r.doc_id: r for r in order_minhash.fingerprints(docs).collect()}
    order = sorted(zip(ids, texts), key=lambda x: -x[0])
    assert len(rows) == len(order)
    for (doc_id, text), (_, following) in zip(order, [*order[1:], order[0]]):
        text, following = text or "", following or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert rows[doc_id].n_chars == len(text)
        assert rows[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert all(rows[i].next_fingerprint == rows[j].fingerprint for (i, _), (j, _) in zip(order, order[1:]))


def test_fingerprints_of_odd_rows(odd, none):
    rows = order_minhash.fingerprints(odd).collect()
    assert len(rows) == odd.count()
    assert len({tuple(r.fingerprint) for r in rows if r.doc_id in (1, 2)}) == 1
    assert order_minhash.fingerprints(none).count() == 0
    assert order_minhash.fingerprints(odd.where("doc_id = 6")).first().edited_sha256 == hashlib.sha256(b"ono").hexdigest()


# ---- hosts


def test_addresses_and_rules(spark):
    urls = ["HTTP://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "http://x.com/fr/1", "x.com/fr/", None, "a://b", "http://xcom/fr/", "s://u.net?q://"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = hosts.address(rows.url)
    rule, kind = hosts.best_rule(host, path)
    assert [tuple(r) for r in rows.select(host, path, rule, kind).collect()] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("x.com", "/fr/1", "com/fr/", "allow"), ("", "", None, None), ("", "", None, None), ("b", "", None, None),
        ("xcom", "/fr/", None, None), ("u.net", "", None, None),
    ]


def plain_walk(edges, seeds, steps, damping=0.85):
    out = defaultdict(float)
    for (s, _), w in edges.items():
        out[s] += w
    held = dict(seeds)
    for _ in range(steps):
        after = defaultdict(float)
        for h, m in seeds.items():
            after[h] += (1 - damping) * m
        for (s, t), w in edges.items():
            after[t] += damping * held.get(s, 0) * w / out[s]
        held = after
    return held


def test_spread_against_a_plain_walk(spark, stage):
    edges = {("a", "b"): 2.0, ("b", "c"): 1.0, ("a", "c"): 1.0, ("c", "a"): 1.0, ("d", "c"): 3.0, ("c", "e"): 1.0}
    frame = spark.createDataFrame([(*k, w) for k, w in edges.items()], "source string, target string, weight double")
    seeds = spark.createDataFrame([("a", 0.7, 0.0), ("b", 0.3, 0.0), ("e", 0.0, 1.0)], "host string, trust double, distrust double")
    rows = {r.host: r for r in hosts.spread(frame, seeds, stage, 1e-9).collect()}
    trust = plain_walk(edges, {"a": 0.7, "b": 0.3}, 300)
    distrust = plain_walk({(t, s): w for (s, t), w in edges.items()}, {"e": 1.0}, 300)
    for host in "abcde":
        assert rows[host].trust == pytest.approx(trust.get(host, 0)) and rows[host].distrust == pytest.approx(distrust.get(host, 0))


def test_links_carry_distrust_backwards(spark, stage):
    pages = [(1, "http://bad.com/de/1", None), (2, "http://friend.net/1", '<a href="http://bad.com/x">'), (3, "http://good.net/", ""),
             (4, "http://fan.net/", "<A HREF='//Nice.com/y'>"), (5, "http://nice.com/fr/", None), (6, None, None), (None, "http://bad.com/", "")]
    rows = hosts.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), stage).collect()
    assert {r.page_id: r.verdict for r in rows} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", None: "block"}
    empty = hosts.filter_urls(spark.createDataFrame([], "page_id long, url string, html string"), stage)
    assert empty.count() == 0


# ---- shards


def test_shards_are_even_and_keep_groups(spark, odd, written, stage):
    texts = [f"group {i}" for i in range(80) for _ in range(1 + i % 4)] + ["hot"] * 150 + [f"single {i}" for i in range(200)]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = written(odd.select("doc_id", "text").unionByName(extra))
    rows = sharding.shard(docs, stage).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == docs.count() and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(16))
    for k in sizes:
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))
    raw = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(r.size == len(raw[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(raw[r.doc_id]) for r in rows if r.doc_id)
    where = defaultdict(set)
    for r in rows:
        where[r.hub].add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 16


def test_a_hub_of_a_third_of_the_rows_splits_no_others(spark, written, stage):
    texts = ["hot"] * 4000 + [f"group {i}" for i in range(1000) for _ in range(2 + i % 9)] + [f"single {i}" for i in range(2000)]
    docs = written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    where, rows = defaultdict(set), Counter()
    for r in sharding.shard(docs, stage).collect():
        where[r.hub].add(r.shard)
        rows[r.shard] += 1
    hot = where.pop(hashlib.md5(b"hot").hexdigest())
    assert len(hot) == -(-4000 // min(rows.values())) and max(rows.values()) - min(rows.values()) <= 1
    assert sum(len(s) > 1 for s in where.values()) <= 15


def test_shards_of_few_and_no_rows(odd, none, stage):
    rows = sharding.shard(odd.limit(3), stage).collect()
    assert sorted(r.shard for r in rows) == [0, 1, 2] and {r.slot for r in rows} == {0}
    assert sharding.shard(none, stage).count() == 0


# ---- decontamination


ITEM = "A train with 120 seats leaves the old town at 7 and meets Peter after 45 km near the river bridge"


def hits(spark, stage, texts, items=(ITEM,)):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, place string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, benchmark, stage).collect()}


def test_templates_catch_other_numbers_names_and_units(spark, stage):
    other = ITEM.replace("120", "85").replace("Peter", "Maria").replace("45 km", "30 miles")
    mixed = "Two of 5 and 5 apples cost 5 euros for the 9 people in the house today"
    found = hits(spark, stage, [f"so {prose(30)}. {ITEM.lower()}, {prose(20)}", f"{prose(9)}. {other}. {prose(9)}", prose(60), None, "", ITEM[:40],
                                mixed.replace("5", "7"), mixed.replace("5 and 5", "7 and 8")], (ITEM, mixed, None, "too short", ITEM))
    assert set(found) == {(0, 0), (0, 4), (1, 0), (1, 4), (6, 1)}
    assert found[1, 0].altered and found[1, 0].found == found[1, 0].all_windows


def test_decontamination_of_odd_rows(spark, odd, none, stage, written):
    benchmark = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    left = decontaminate.clean(written(odd), benchmark, stage)
    assert left.columns == odd.columns and Counter(r.doc_id for r in left.collect()) == Counter([3, 4, 5, 6, 7, 8, 9, 10, 11, None, None])


def test_decontamination_of_nothing(odd, none, spark, stage):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(odd, benchmark, stage).count() == 0


def test_decontamination_of_no_documents(none, spark, stage):
    assert decontaminate.contaminated(none, spark.createDataFrame([(1, ITEM)], "item_id long, text string"), stage).count() == 0


# ---- repeated lines


def test_units_cover_a_text_in_order():
    text = f"{prose(40)}. {prose(3)}! {prose(7)}?\n\n{prose(2)}\n{prose(90)}"
    spans = [(s, e) for s, e, _ in lines.units(text, 1)]
    assert all(e <= s for (_, e), (s, _) in zip(spans, spans[1:]))
    assert "".join(text[s:e] for s, e in spans).replace("\n", "") == text.replace("\n", "")


def test_later_occurrences_go_and_the_first_stays(spark, written, stage):
    passage = f"{prose(9).capitalize()}. {prose(25)}. {prose(8)}, {prose(12)}."
    texts = [f"{prose(20)} {i}.\n{passage}\n{prose(20)}" for i in range(5)] + [prose(30), None, "", "short line\nshort line"]
    docs = written(spark.createDataFrame([(50 - i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, start int"))
    rows = {r.doc_id: r for r in lines.drop_repeats(docs, stage).collect()}
    holding = [i for i, r in rows.items() if r.text and passage in r.text]
    assert holding == [46]
    raw = {r.doc_id: r.text for r in docs.collect()}
    for i, row in rows.items():
        if i in (47, 48, 49, 50):
            removed = "".join(raw[i][s.start : s.end] for s in row.removed_spans)
            assert removed == passage
        elif i == 42:  # a line is a unit however short it is
            assert row.text == "short line\n" and [tuple(s) for s in row.removed_spans] == [(11, 21)]
        else:
            assert row.text == raw[i] and row.removed_spans is None


def test_what_is_left_is_the_text_without_its_spans(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    raw = {r.doc_id: r.text or "" for r in docs.collect()}
    changed = 0
    for r in lines.op10_line_hashing(spark, SF_DIR).collect():
        left, at = "", 0
        for start, end in zip(r.removed_start, r.removed_end):
            assert at <= start < end
            left, at = left + raw[r.doc_id][at:start], end
        assert (r.text or "") == left + raw[r.doc_id][at:]
        changed += r.n_removed > 0
    assert changed


def test_rows_of_files_are_not_written_again(spark, written, stage, odd):
    plain = written(odd)
    assert identified(plain.where("doc_id > 2"), stage, "f", "r").select("f", "r").distinct().count() == 9
    assert not glob(f"{stage.path.removeprefix('file:')}/placed")
    joined = plain.join(plain.select("doc_id"), "doc_id")
    assert identified(joined, stage, "f", "r").select("f", "r").distinct().count() == joined.count()
    assert glob(f"{stage.path.removeprefix('file:')}/placed")


def test_repeats_against_a_plain_pass(odd, written, stage):
    docs = written(odd, parts=1)
    seen, expected = set(), Counter()
    rows = sorted(enumerate(docs.collect()), key=lambda x: (x[1].doc_id is None, x[1].doc_id or 0, x[0]))
    for _, r in rows:
        left, at = "", 0
        for start, end, digest in lines.units(r.text or ""):
            if digest in seen:
                left, at = left + r.text[at:start], end
            seen.add(digest)
        expected[r.doc_id, None if r.text is None else left + r.text[at:]] += 1
    found = lines.drop_repeats(docs, stage)
    assert Counter((r.doc_id, r.text) for r in found.collect()) == expected


def test_whole_lines_of_any_length_are_compared(spark, written, stage):
    lines_of = ["All rights reserved", "* * *", "QmFzZTY0QmFzZTY0QmFzZTY0", "今日は雨です", "  ", ""]
    first = "\n".join(lines_of)
    docs = written(spark.createDataFrame([(1, first), (2, "own\n" + first), (3, first.upper() + "\nmy own")], "doc_id long, text string"))
    assert {r.doc_id: r.text for r in lines.drop_repeats(docs, stage).collect()} == {1: first, 2: "own\n  \n", 3: "  \n\nmy own"}


def test_sentences_end_without_a_space_and_beside_short_ones():
    same = "昨日は友達と公園へ行きました。"
    one, other = f"今日は雨が降っています。{same}", f"明日は晴れると思います！{same}"
    digests = [{text[s:e]: d for s, e, d in lines.units(text)} for text in (one, other)]
    assert digests[0][same] == digests[1][same]
    long = "this is a sentence of eight words here."
    text = f"Yes. {long}"
    digests = {text[s:e]: d for s, e, d in lines.units(text)}
    assert list(digests) == ["Yes. ", long] and digests[long] == next(lines.units(long))[2]
    assert [text[s:e] for text in (long + " ***",) for s, e, _ in lines.units(text)] == [long + " ***"]


def test_repeats_of_nothing(none, stage):
    assert lines.drop_repeats(none, stage).count() == 0
