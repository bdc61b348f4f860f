"""Harmonic packing of token sequences.

Each document's ids (its own, then an end id) are cut into full sequences and a tail. A piece of length n belongs to the
reciprocal class j if n <= capacity / j, and a bin of class j takes exactly j pieces, so it can never overflow and needs
no search. A tail that would fill less than ``tight`` of its class's bin is cut at the next smaller reciprocal, where it
fits exactly, and what remains is classed again.

Every worker (input partition) fills its own bins while it reads; nothing is shuffled for them. Pieces in bins that a
worker leaves open are few (less than j per class). They meet in groups of ``workers_per_group`` workers, where they
are laid end to end and cut at the capacity; what is left there is cut into sequences whose lengths are powers of two.

Defined cases: a null text is the empty text and has the end id alone; repeated rows are packed as often as they occur;
an empty table gives an empty result; a text of any length is encoded whole; other columns are not looked at.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.llm.common import give_back_memory, texts
from lonja.operators.staging import Stage

CAPACITY = 1024
# Reciprocal classes in use: dense where a step matters, sparse for small pieces.
CLASSES = (*range(1, 17), 18, 20, 24, 28, 32, 40, 48, 64, 96, 128, 192, 256, 512, 1024)
END_ID = 0
SPECIAL = "<|endoftext|>"
MOST_CACHED = 100_000  # by a task; with 60,000, 8,000 documents took 3.1 s, with all of their 426,000 words 2.8 s

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, kind int, worker long, sequence_id long, offset long"
)


def class_of(length: int, capacity: int = CAPACITY) -> int:
    """The largest class in use whose share of the capacity still holds ``length``."""
    return CLASSES[bisect_right(CLASSES, capacity // length) - 1]


def cuts(tokens: int, capacity: int = CAPACITY, tight: float = 31 / 32, smallest: int = 64) -> list[int]:
    """Lengths of the pieces of a document of ``tokens`` ids, in text order."""
    lengths = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        kind = class_of(rest, capacity)
        if rest < smallest or kind * rest >= tight * capacity:
            lengths.append(rest)
            break
        exact = capacity // CLASSES[CLASSES.index(kind) + 1]
        lengths.append(exact)
        rest -= exact
    return lengths


class Encoder:
    """Ids of whole texts. Words between single spaces do not influence each other, so each is encoded once and kept, as long as the
    encoder is."""

    def __init__(self, ranks_file: str, tokenizer_file: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._tokenizer_file = tokenizer_file
        self._sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._sizes[rank] = len(token)
        self._words: dict[str, bytes | None] = {}

    @cached_property
    def _whole(self):
        """The tokenizer file, for the few texts that need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._tokenizer_file)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if SPECIAL in text:
            return _packed(self._whole.encode(text, add_special_tokens=False).ids)
        first, *words = text.split(" ")
        if not first or first[-1].isspace():
            return _packed(self._fast.encode_ordinary(text))
        known = list(map(self._words.get, words))
        if None in known:
            new = self._encode([word for word, ids in zip(words, known) if ids is None])
            if new is None:
                return _packed(self._fast.encode_ordinary(text))
            known = [ids if ids is not None else new[word] for word, ids in zip(words, known)]
        return _packed(self._fast.encode_ordinary(first)) + b"".join(known)

    def _encode(self, words: list[str]) -> dict[str, bytes] | None:
        """Ids of words after a space, or None if white space beside a space makes them depend on each other."""
        words = list(dict.fromkeys(words))
        if any(not word or word[0].isspace() or word[-1].isspace() for word in words):
            return None
        ids = np.array(self._fast.encode_ordinary(" " + " ".join(words)), "<u4")
        ends = np.cumsum([1 + len(word.encode()) for word in words])
        cut = np.searchsorted(np.cumsum(self._sizes[ids]), ends, "left") + 1
        raw = ids.tobytes()
        new, before = {}, 0
        for word, after in zip(words, cut.tolist()):
            new[word] = raw[4 * before : 4 * after]
            before = after
        if len(self._words) + len(new) <= MOST_CACHED:
            self._words.update(new)
        return new


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def tokenizer_files(folder: str | None = None) -> tuple[str, str]:
    """The vocabulary as ranks and as a tokenizer file: in ``folder``, or where the installed package has them."""
    names = ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")
    if folder:
        return tuple(f"{folder.rstrip('/')}/{name}" for name in names)
    import public_tokenizers

    return tuple(public_tokenizers.path(name) for name in names)


def _fill(capacity: int, folder: str | None):
    kinds = _arrow()

    def work(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Made for a task and given up at its end: a worker lives on, and would hold the vocabulary and all words it has met.
        coder, worker, bins = None, TaskContext.get().partitionId(), 0
        waiting: dict[int, list] = {}
        done: list[tuple] = []
        held = 0
        end = np.array([END_ID], "<u4").tobytes()
        for batch in incoming:
            coder = coder or Encoder(*tokenizer_files(folder))
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = coder.ids(text or "") + end
                tokens, start = len(ids) // 4, 0
                for length in cuts(tokens, capacity):
                    kind = class_of(length, capacity)
                    group = waiting.setdefault(kind, [])
                    group.append((doc_id, start, length, tokens, ids[4 * start : 4 * (start + length)]))
                    start += length
                    if len(group) == kind:
                        offset = 0
                        for piece in group:
                            done.append((*piece, kind, worker, (worker << 32) + bins, offset))
                            offset += piece[2]
                            held += len(piece[4])
                        bins += 1
                        waiting[kind] = []
                if held > 16_000_000:
                    yield _batch(done, kinds)
                    done, held = [], 0
        done += [(*piece, kind, worker, None, None) for kind, group in waiting.items() for piece in group]
        yield _batch(done, kinds)
        del coder, waiting, done
        give_back_memory()

    return work


def _join_open(capacity: int):
    kinds = _arrow()

    def work(pieces: pa.Table) -> pa.Table:
        """Lays the open pieces of some workers end to end, largest class first, and cuts at the capacity."""
        rows = sorted(pieces.to_pylist(), key=lambda r: (r["kind"], r["worker"], r["doc_id"] is None, r["doc_id"], r["start"]))
        total = sum(r["length"] for r in rows)
        base = (1 << 62) + ((rows[0]["worker"] if rows else 0) << 32)
        limits = [capacity] * (total // capacity)
        limits += [1 << bit for bit in range(capacity.bit_length(), -1, -1) if (total % capacity) >> bit & 1]
        out, sequence, room = [], 0, limits[0] if limits else 0
        for r in rows:
            taken = 0
            while taken < r["length"]:
                part = min(room, r["length"] - taken)
                out.append((r["doc_id"], r["start"] + taken, part, r["doc_tokens"], r["ids"][4 * taken : 4 * (taken + part)],
                            r["kind"], r["worker"], base + sequence, limits[sequence] - room))
                taken, room = taken + part, room - part
                if not room and sequence + 1 < len(limits):
                    sequence += 1
                    room = limits[sequence]
        return pa.Table.from_batches([_batch(out, kinds)], schema=kinds)

    return work


def _arrow() -> pa.Schema:
    whole, number = pa.int64(), pa.int32()
    return pa.schema([("doc_id", whole), ("start", whole), ("length", whole), ("doc_tokens", whole), ("ids", pa.binary()),
                      ("kind", number), ("worker", whole), ("sequence_id", whole), ("offset", whole)])


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)


def pack(
    docs: DataFrame, stage: Stage, capacity: int = CAPACITY, folder: str | None = None, workers_per_group: int = 64
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), kind (its class), worker,
    sequence_id, offset. The pieces are stored once: encoding is the dear part, and a worker's bins must not change when
    a task is run again."""
    filled = texts(docs).mapInArrow(_fill(capacity, folder), PIECES)
    filled.write.option("compression", "zstd").mode("overwrite").parquet(stage.at("pieces"))
    stored = docs.sparkSession.read.schema(filled.schema).parquet(stage.at("pieces"))
    closed = stored.where(F.col("sequence_id").isNotNull())
    still_open = stored.where(F.col("sequence_id").isNull()).groupBy(F.floor(F.col("worker") / workers_per_group))
    return closed.unionByName(still_open.applyInArrow(_join_open(capacity), PIECES))


def op2_harmonic_packing(spark, sf_dir: str) -> DataFrame:
    from lonja.llm.common import table

    pieces = pack(table(spark, sf_dir, "documents"), Stage(spark, "packing"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
