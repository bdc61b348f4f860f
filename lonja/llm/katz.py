"""Katz backoff language model over words, order two, and the scores of whole texts.

A text's tokens are its words and one end token; the first token's history is the start. With counts c from the training texts,

    P(w | h) = d(c(hw)) c(hw) / c(h)    if c(hw) > 0
             = a(h) P(w)                if c(hw) = 0 and c(h) > 0, with a(h) = (1 - sum of the above) / (1 - sum of P(w) of these w)
             = P(w)                     if h is unknown
    P(w)     = d(c(w)) c(w) / N, and what these leave for the one unknown word,

so every history's probabilities sum to 1. The discounts d of counts up to five are Good-Turing's (Katz's formula, one set per
order), or up to the count the counts of counts allow; where they allow none, half a count is taken off. Larger counts lose a tenth
of one, so that every history has something to hand down.

How it is computed. Tasks cut their input into chunks of texts. (1) A chunk's distinct words go with their counts to partitions by
word, which add them up, number the words, the most frequent first, and send each chunk its words' totals and numbers. (2) The chunk,
now with both, sends its distinct word pairs to partitions by history, as pairs of numbers with counts and the texts they stand in; a
history with very many tokens is split by word. A partition adds up the counts and gives each text the sum of its terms. The discounts of pairs are known only after all partitions are done, so a
text's terms are kept as a sum and as numbers of pairs seen once, twice, ... five times, and the weights a(h) come from sums per
history by a plain aggregation and a join. All exchanges carry what a chunk has once, packed in arrays; the number of partitions
follows the number of tokens, and so does everything that is gathered. What is stored are the chunks, the totals of words without the words, and the sums per text and
history; the counts of pairs live in a partition's task only. So the model is not kept: no text outside the call can be scored.

Defined cases: a null or empty text has the end token alone; repeated rows count and are scored as often as they occur; words are
told apart by 64-bit hashes; without any training text every token is the unknown word
and has probability 1; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial
from math import log10

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import Hashes, give_back_memory, remainder, smaller_batches, table, texts
from lonja.operators.staging import Stage

LARGEST = 5  # counts up to this have a Good-Turing discount
TENTH = 0.1  # taken off larger counts
END, START = np.uint64(1), np.uint64(2)  # in place of word hashes
NO_WORD = np.uint64(0)  # number of the start; those of words begin with 1
CHUNK_TOKENS = 1_200_000
PARTITION_TOKENS = 1_200_000
_W = np.uint64

PACKET = "part long, chunk long, payload binary"
TOTALS = "chunk long, part long, counts binary, numbers binary, tokens long, types long, r1 long, r2 long, r3 long, r4 long, r5 long, r6 long"
TERMS = (
    "kind int, place long, history long, total double, r1 double, r2 double, r3 double, r4 double, r5 double, r6 double, "
    "more double, lower double, doc_id long, learned int, n_tokens long, n_known long, base double"
)
SUM, HISTORY, OPEN, TYPES, TEXT = range(5)  # kinds of rows of TERMS


# ---- arrays in one binary value


def _packed(*arrays: np.ndarray) -> bytes:
    parts = []
    for array in arrays:
        # byte planes: the high bytes of small numbers lie together and vanish
        planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T.tobytes()
        parts.append(f"{array.dtype.str}:{len(array)};".encode() + planes)
    head = np.array([len(arrays), *map(len, parts)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def _unpacked(value: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    number = int(np.frombuffer(raw, "<u4", 1)[0])
    at, arrays = 4 * (number + 1), []
    for size in np.frombuffer(raw, "<u4", number, 4).tolist():
        head, _, planes = raw[at : at + size].partition(b";")
        kind, _, length = head.decode().partition(":")
        width = np.dtype(kind).itemsize
        arrays.append(np.frombuffer(planes, np.uint8).reshape(width, int(length)).T.copy().view(kind).reshape(-1))
        at += size
    return arrays


# ---- texts to tokens


def _tokens(text: str | None, hashes: Hashes) -> np.ndarray:
    """Hashes of the words, then the end."""
    found = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space alone
    values = np.empty(len(found) + 1, _W)
    values[:-1] = np.fromiter(map(hashes.__getitem__, found), _W, len(found))
    values[-1] = END
    return values


def _chunks(incoming: Iterator[pa.RecordBatch], hashes: Hashes) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Chunk number and [doc_id, has_id, learned, lengths, words, ids], for columns doc_id, learned, text. ``ids`` are the tokens as
    places in ``words``, the most frequent first."""
    chunk, held, size = TaskContext.get().partitionId() << 12, [], 0
    for batch in incoming:
        for doc_id, learned, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            tokens = _tokens(text.as_py(), hashes)
            held.append((doc_id, learned, tokens))
            size += len(tokens)
            if size >= CHUNK_TOKENS:
                yield chunk, _columns(held)
                chunk, held, size = chunk + 1, [], 0
    if held:
        yield chunk, _columns(held)


def _columns(held: list) -> list[np.ndarray]:
    doc_ids, learned, tokens = zip(*held)
    words, ids, often = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    order = np.argsort(-often, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return [
        np.array([d or 0 for d in doc_ids], np.int64), np.array([d is not None for d in doc_ids], np.uint8), np.array(learned, np.uint8),
        np.array([len(t) for t in tokens], np.uint32), words[order], rank[ids],
    ]


def _narrow(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype(np.uint32) if not len(numbers) or numbers.max() < 1 << 32 else numbers


def _part_of(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words * _W(0x9E3779B97F4A7C15)) >> _W(20)) % _W(parts)


def _split(owner: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Ranges of equal values in a sorted array."""
    edges = np.flatnonzero(np.diff(owner)) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(owner)]):
        if end > start:
            yield int(owner[start]), slice(start, end)


def _batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


# ---- (1) words


def _owners(words: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Partition and the places of its words in ``words``, the same for the sender and the receiver of totals."""
    owner = _part_of(words, parts)
    order = np.lexsort((words, owner))
    for part, span in _split(owner[order]):
        yield part, order[span]


def _word_packets(parts: int):
    def work(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(PACKET)
        for batch in incoming:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, _, learned, lengths, words, ids = _unpacked(payload.as_py())
                counts = np.bincount(ids[np.repeat(learned, lengths) > 0], minlength=len(words)).astype(np.uint32)
                for part, mine in _owners(words, parts):
                    yield _batch(schema, {"part": [part], "chunk": [chunk], "payload": [_packed(words[mine], counts[mine])]})

    return work


def _chunk_packets(incoming: Iterator[pa.RecordBatch], hashes: Hashes) -> Iterator[pa.RecordBatch]:
    schema = _arrow(PACKET)
    for chunk, columns in _chunks(incoming, hashes):
        yield _batch(schema, {"part": [0], "chunk": [chunk], "payload": [_packed(*columns)]})
    give_back_memory()


def _word_totals(packets: pa.Table) -> pa.Table:
    """Totals and numbers of the words of one partition, sent back to every chunk in the order it sent them. The words of a partition are
    numbered from 0, those with the largest totals first; with the partition that tells a word apart (see ``_number``)."""
    chunks, parts = packets.column("chunk").to_pylist(), packets.column("part").to_pylist()
    sent = [_unpacked(value) for value in packets.column("payload").to_pylist()]
    words, inverse = np.unique(np.concatenate([w for w, _ in sent]), return_inverse=True)
    totals = np.bincount(inverse, np.concatenate([c for _, c in sent]), len(words)).astype(np.uint64)
    ends = np.cumsum([len(w) for w, _ in sent])
    rank = np.empty(len(words), np.uint64)
    rank[np.lexsort((words, -totals.astype(np.int64)))] = np.arange(len(words), dtype=np.uint64)
    spans = [inverse[end - len(w) : end] for (w, _), end in zip(sent, ends)]
    back, ranks = [_packed(totals[span]) for span in spans], [_packed(_narrow(rank[span])) for span in spans]
    first = [i == 0 for i in range(len(chunks))]  # the sums stand in one row

    def once(value: float) -> list[int]:
        return [int(value) if f else 0 for f in first]

    columns = {"chunk": chunks, "part": parts, "counts": back, "numbers": ranks, "tokens": once(totals.sum()), "types": once((totals > 0).sum())}
    columns |= {f"r{r}": once((totals == r).sum()) for r in range(1, LARGEST + 2)}
    return pa.Table.from_batches([_batch(_arrow(TOTALS), columns)])


def _number(rank: np.ndarray, part: int, parts: int) -> np.ndarray:
    return rank.astype(np.uint64) * _W(parts) + _W(part + 1)


# ---- discounts


def discounts(types: list[int]) -> list[float]:
    """What is left of counts 0, 1, ... LARGEST; ``types[r]`` items occur r times. The formula holds for counts up to the largest k
    that the counts of counts allow; larger ones lose a tenth of one."""
    for k in range(LARGEST, 0, -1):
        if all(types[r] > 0 for r in range(1, k + 2)):
            tail = (k + 1) * types[k + 1] / types[1]
            if tail < 1:
                left = [((r + 1) * types[r + 1] / types[r] - r * tail) / (1 - tail) for r in range(1, k + 1)]
                if all(0 < x < r for r, x in enumerate(left, 1)):
                    return [0.0, *left, *[r - TENTH for r in range(k + 1, LARGEST + 1)]]
    return [0.0, *[r - 0.5 for r in range(1, LARGEST + 1)]]


def _left(counts: np.ndarray, discounted: list[float]) -> np.ndarray:
    small = np.array(discounted)[np.minimum(counts, LARGEST).astype(int)]
    return np.where(counts <= LARGEST, small, counts - TENTH)


# ---- (2) pairs


def _pair_packets(word_parts: int, parts: int, tokens_all: int, types_all: int, hot: int):
    """Of each chunk, given its texts and its words' totals: its pairs by partition, and a packet about the texts themselves."""

    def work(texts_of: pa.Table, totals: pa.Table) -> pa.Table:
        out = {"part": [], "chunk": [], "payload": []}

        def send(part: int, chunk: int, *arrays: np.ndarray) -> None:
            for name, value in zip(out, (part, chunk, _packed(*arrays))):
                out[name].append(value)

        if texts_of.num_rows:
            chunk = texts_of.column("chunk")[0].as_py()
            doc_ids, has_id, learned, lengths, words, ids = _unpacked(texts_of.column("payload")[0].as_py())
            sent = dict(zip(totals.column("part").to_pylist(), zip(*[totals.column(c).to_pylist() for c in ("counts", "numbers")])))
            known, number = np.empty(len(words), np.uint64), np.empty(len(words), np.uint64)
            for part, mine in _owners(words, word_parts):
                known[mine], rank = (_unpacked(value)[0] for value in sent[part])
                number[mine] = _number(rank, part, word_parts)
            count, tokens = known[ids], words[ids]
            text = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths)
            base = np.bincount(text, np.log10((count + 1.0) / (tokens_all + types_all + 1.0)), len(lengths))
            seen = np.bincount(text, count > 0, len(lengths)).astype(np.uint32)
            send(chunk % parts, -1 - chunk, doc_ids, has_id, learned, lengths, seen, base)
            begins = np.cumsum(lengths) - lengths
            history, before = np.empty_like(tokens), np.empty_like(count)
            history[1:], before[1:] = tokens[:-1], count[:-1]
            history[begins], before[begins] = START, known[words == END][0]
            part_of = np.where(before > hot, _part_of(history ^ (tokens << _W(1)), parts), _part_of(history, parts))
            word = number[ids]
            history[1:], history[begins] = word[:-1], NO_WORD
            order = np.lexsort((text, word, history, part_of))
            learned_at = learned[text]
            for part, span in _split(part_of[order]):
                mine = order[span]
                h, w = history[mine], word[mine]
                new_history = np.concatenate([[True], h[1:] != h[:-1]])
                new_pair = new_history | np.concatenate([[True], w[1:] != w[:-1]])
                at, h_at = np.flatnonzero(new_pair), np.flatnonzero(new_history)
                runs = np.diff(np.append(np.searchsorted(at, h_at), len(at))).astype(np.uint32)
                send(
                    part, chunk, _narrow(h[h_at]), before[mine[h_at]], runs, _narrow(w[at]), _narrow(count[mine[at]]),
                    np.add.reduceat(learned_at[mine].astype(np.uint32), at),
                    np.diff(np.append(at, len(mine))).astype(np.uint32), text[mine],
                )
        packets = pa.Table.from_batches([_batch(_arrow(PACKET), out)])
        give_back_memory()
        return packets

    return work


def _pair_terms(tokens_all: int, left_words: list[float], unknown: float, hot: int):
    """Of one partition's pairs: the texts' sums, its histories' sums, and the pairs that await a history's weight."""
    log_unknown = log10(unknown)

    def work(packets: pa.Table) -> pa.Table:
        schema = _arrow(TERMS)
        batches = []

        def emit(kind: int, size: int, **columns) -> None:
            columns["kind"] = np.full(size, kind, np.int32)
            arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema]
            batches.append(pa.RecordBatch.from_arrays(arrays, schema=schema))

        sent = []
        for chunk, payload in zip(packets.column("chunk").to_pylist(), packets.column("payload").to_pylist()):
            if chunk >= 0:
                sent.append((chunk, *_unpacked(payload)))
                continue
            doc_ids, has_id, learned, lengths, seen, base = _unpacked(payload)
            place = ((-1 - chunk) << 21) + np.arange(len(lengths))
            ids = pa.array(doc_ids, pa.int64(), mask=has_id == 0)
            emit(TEXT, len(place), place=place, doc_id=ids, learned=learned.astype(np.int32), n_tokens=lengths.astype(np.int64),
                 n_known=seen.astype(np.int64), base=base)
        if sent:
            h = np.concatenate([np.repeat(x[1], x[3]) for x in sent]).astype(np.int64)
            held = np.concatenate([np.repeat(x[2], x[3]) for x in sent])
            w = np.concatenate([x[4] for x in sent])
            word = np.concatenate([x[5] for x in sent])
            learned = np.concatenate([x[6] for x in sent])
            order = np.lexsort((w, h))
            new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])])
            number = np.cumsum(new) - 1
            sums = np.bincount(number, learned[order]).astype(np.int64)
            count = np.empty(len(h), np.int64)
            count[order] = sums[number]
            lower = np.where(word > 0, _left(word, left_words) / max(tokens_all, 1), 0.0)
            with np.errstate(divide="ignore"):
                value = np.where(word > 0, np.log10(lower), log_unknown)
                value = np.where(count > LARGEST, np.log10(np.maximum(count, 1) - TENTH), np.where(count > 0, 0.0, value))
                value -= np.where(count > 0, np.log10(held), 0.0)
            awaits = (count == 0) & (held > 0)
            # Histories: over distinct pairs that were seen.
            first = order[new][sums > 0]
            histories, inverse = np.unique(h[first], return_inverse=True)
            wanted = np.isin(histories, h[awaits]) | (held[first[np.unique(inverse, return_index=True)[1]]] > hot if len(first) else False)
            c = count[first]
            per = {f"r{r}": np.bincount(inverse, c == r, len(histories))[wanted] for r in range(1, LARGEST + 1)}
            more = np.bincount(inverse, np.where(c > LARGEST, c - TENTH, 0), len(histories))[wanted]
            below = np.bincount(inverse, lower[first], len(histories))[wanted]
            total = np.zeros(len(histories))
            total[inverse] = held[first]
            emit(HISTORY, int(wanted.sum()), history=histories[wanted], total=total[wanted], more=more, lower=below, **per)
            emit(TYPES, 1, **{f"r{r}": [float((sums == r).sum())] for r in range(1, LARGEST + 2)})
            at = 0
            for chunk, *_, occurs, text in sent:
                span = slice(at, at + len(occurs))
                at += len(occurs)
                texts_here, inverse = np.unique(text, return_inverse=True)
                c = np.repeat(count[span], occurs)
                per = {f"r{r}": np.bincount(inverse, c == r, len(texts_here)) for r in range(1, LARGEST + 1)}
                total = np.bincount(inverse, np.repeat(value[span], occurs), len(texts_here))
                emit(SUM, len(texts_here), place=(chunk << 21) + texts_here.astype(np.int64), total=total, **per)
                waits = np.repeat(awaits[span], occurs)
                of = np.repeat(h[span], occurs)[waits]
                emit(OPEN, len(of), place=(chunk << 21) + text[waits].astype(np.int64), history=of)
        return pa.Table.from_batches(batches, schema=schema)

    return work


def score(docs: DataFrame, learned: Column, stage: Stage) -> DataFrame:
    """doc_id, held_out (not ``learned``), n_tokens, n_known, train_tokens, base_score and score for every row of ``docs``."""
    rows = texts(docs, F.coalesce(learned, F.lit(False)).alias("learned")).select("doc_id", "learned", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // (6 * PARTITION_TOKENS)
    hot = PARTITION_TOKENS // 3
    # Stored, since both steps must see the same chunks: another scan of the input can be split differently. In buckets, so that they
    # do not move again to meet their totals.
    session, name = rows.sparkSession, "katz_chunks_" + uuid.uuid4().hex
    buckets = int(session.conf.get("spark.sql.shuffle.partitions"))
    made = rows.mapInArrow(partial(_chunk_packets, hashes=Hashes()), PACKET)
    with smaller_batches(session):
        made.write.bucketBy(buckets, "chunk").option("path", stage.at(name)).saveAsTable(name)
    chunks = session.table(name)
    sent = chunks.select("chunk", "payload").mapInArrow(_word_packets(parts), PACKET)
    totals = stage.keep(sent.groupBy("part").applyInArrow(_word_totals, TOTALS), "totals")
    names = ["tokens", "types", *[f"r{r}" for r in range(1, LARGEST + 2)]]
    tokens_all, types_all, *types = [x or 0 for x in totals.agg(*[F.sum(name) for name in names]).first()]
    left_words = discounts([0, *types])
    few = types[:LARGEST]
    kept = sum(n * left_words[r] for r, n in enumerate(few, 1))
    kept += tokens_all - sum(r * n for r, n in enumerate(few, 1)) - TENTH * (types_all - sum(few))
    unknown = 1 - kept / tokens_all if tokens_all else 1.0
    pairs = chunks.groupBy("chunk").cogroup(totals.select("chunk", "part", "counts", "numbers").groupBy("chunk")).applyInArrow(
        _pair_packets(parts, parts, tokens_all, types_all, hot), PACKET
    )
    terms = pairs.groupBy("part").applyInArrow(_pair_terms(tokens_all, left_words, unknown, hot), TERMS)
    terms = stage.keep(terms, "terms")
    session.sql(f"DROP TABLE IF EXISTS {name}")  # its files stay in the stage's folder and go with it
    numbers = [f"r{r}" for r in range(1, LARGEST + 2)]
    types = terms.where(F.col("kind") == TYPES).agg(*[F.coalesce(F.sum(r), F.lit(0)) for r in numbers]).first()
    left = discounts([0, *map(int, types)])
    each = [F.sum(r) * F.lit(x) for r, x in zip(numbers, left[1:])]
    history = terms.where(F.col("kind") == HISTORY).groupBy("history").agg(
        ((F.sum("more") + sum(each)) / F.max("total")).alias("seen"), F.sum("lower").alias("lower")
    )
    weight = history.select("history", F.log10((1 - F.col("seen")) / (1 - F.col("lower"))).alias("weight"))
    waiting = terms.where(F.col("kind") == OPEN).groupBy("history", "place").agg(F.count(F.lit(1)).alias("n"))
    late = waiting.join(weight, "history").groupBy("place").agg(F.sum(F.col("n") * F.col("weight")).alias("total"))
    small = sum(F.coalesce(F.col(r), F.lit(0.0)) * F.lit(log10(x)) for r, x in zip(numbers, left[1:]))
    sums = terms.where(F.col("kind") == SUM).select("place", (F.col("total") + small).alias("total"))
    sums = sums.unionByName(late).groupBy("place").agg(F.sum("total").alias("score"))
    about = terms.where(F.col("kind") == TEXT).join(sums, "place")
    return about.select(
        "doc_id", (F.col("learned") == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(int(tokens_all)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )


def op4_katz_backoff(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, remainder(F.col("doc_id"), 7) != 2, Stage(spark, "katz"))
