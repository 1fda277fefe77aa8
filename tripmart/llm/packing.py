"""Bounded-space online packing of token sequences.

Each task encodes its documents and keeps a fixed number of open windows. A
document is placed best-fit: in the fullest window that still holds it. When
none fits and no further window may be opened, the fullest is emitted, after
its gap has been filled with the head of the document if the gap is worth a
piece of its own. Parts of whole window length are emitted at once. Windows
left open at the end of a task are packed again in groups of tasks, level by
level, until one group is left; its tail is cut into sequences whose lengths
are powers of two, which need no padding.

Of equally full windows the one opened first is taken. Very long texts are cut
into parts of window length.

A null or empty text is the end id alone. Null ids are packed like others,
repeated rows are packed as often as they occur, other columns are not looked
at, and an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import map_rows, table, written
from tripmart.llm.encoder import ENCODED_BYTES, TextEncoder, worker_encoder

CAPACITY = 4096
OPEN_WINDOWS = 64
#: A gap below this many ids is padded rather than filled with so short a piece.
LEAST_PIECE = 32
#: Tasks whose leftover windows are merged by one task of the next level.
FAN_IN = 64


@dataclass
class Piece:
    doc_id: object
    start: int  # ids of its document before it
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:n], self.doc_tokens),
                Piece(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens))


class Packer:
    """Best-fit into at most ``windows`` open windows; yields the pieces of full sequences."""

    def __init__(self, capacity: int = CAPACITY, windows: int = OPEN_WINDOWS, least: int = LEAST_PIECE):
        self.capacity, self.windows, self.least = capacity, windows, least
        self.free: list[tuple[int, int]] = []  # (free ids, window), sorted
        self.open: dict[int, list[Piece]] = {}
        self.next = 0

    def _put(self, piece: Piece, slot: int | None) -> list[Piece] | None:
        """Into the window at ``slot`` of ``free``, or a new one; the window's pieces if it is full."""
        if slot is None:
            room, window = self.capacity, self.next
            self.next += 1
            self.open[window] = []
        else:
            room, window = self.free.pop(slot)
        self.open[window].append(piece)
        if room == len(piece.ids):
            return self.open.pop(window)
        insort(self.free, (room - len(piece.ids), window))
        return None

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) > self.capacity:
            head, piece = piece.cut(self.capacity)
            yield [head]
        while len(piece.ids):
            slot = bisect_left(self.free, (len(piece.ids), -1))
            if slot < len(self.free) or len(self.free) < self.windows:
                done = self._put(piece, slot if slot < len(self.free) else None)
                if done:
                    yield done
                return
            room = self.free[0][0]
            if room >= self.least:
                head, piece = piece.cut(room)
                yield self._put(head, 0)
            else:
                yield self.open.pop(self.free.pop(0)[1])

    def leftovers(self) -> list[list[Piece]]:
        return [self.open[w] for _, w in self.free]

    def tail(self) -> Iterator[list[Piece]]:
        """The open windows run together: full sequences, then lengths that are powers of two."""
        pieces = [p for w in self.leftovers() for p in w]
        total = sum(len(p.ids) for p in pieces)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
        queue = pieces[::-1]
        for size in sizes:
            sequence = []
            while size:
                piece = queue.pop()
                if len(piece.ids) > size:
                    piece, after = piece.cut(size)
                    queue.append(after)
                sequence.append(piece)
                size -= len(piece.ids)
            yield sequence


#: Rows of a packing level: pieces of sequences (no ids), or of open windows (no sequence, with their ids).
COLUMNS = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
           "`offset` bigint, part int, `window` bigint, ids binary")
NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "window", "ids")


class Rows:
    """Collects rows of a level; sequence ids hold the level, the task and a running number."""

    def __init__(self, level: int, part: int):
        if part >= 1 << 24:
            raise ValueError("more than 2**24 tasks")
        self.base, self.part, self.count = level << 56 | part << 32, part, 0
        self.rows: list[tuple] = []

    def sequence(self, pieces: list[Piece], window: int | None = None) -> None:
        offset = 0
        for p in pieces:
            wide = p.ids.astype("<u4").tobytes()
            self.rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(wide), p.doc_tokens,
                              self.base + self.count if window is None else None, offset, self.part, window,
                              None if window is None else p.ids.tobytes()))
            offset += len(p.ids)
        self.count += window is None

    def take(self) -> dict[str, list]:
        rows, self.rows = self.rows, []
        return dict(zip(NAMES, map(list, zip(*rows)))) if rows else {n: [] for n in NAMES}


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = CAPACITY, windows: int = OPEN_WINDOWS,
         least: int = LEAST_PIECE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Needs up to ``windows * capacity`` ids of memory a task, and as many of
    shuffle for the leftovers; the file lies at the same path on every machine.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, {COLUMNS}"
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def first(batches):
        encoder = worker_encoder(tokenizer_file)
        packer, out = Packer(capacity, windows, least), Rows(0, TaskContext.get().partitionId())
        for b in batches:
            found, bounds = encoder.encode_column(b.column(1), end_id)
            for doc_id, at, to in zip(b.column(0).to_pylist(), bounds, bounds[1:]):
                ids = found[at:to].copy()  # open windows must not hold the batch
                for done in packer.add(Piece(doc_id, 0, ids, len(ids))):
                    out.sequence(done)
            yield out.take()
        for k, window in enumerate(packer.leftovers()):
            out.sequence(window, k)
        yield out.take()

    width = TextEncoder(tokenizer_file, 1).dtype.str
    level = written(map_rows(narrow, schema, first, ENCODED_BYTES), "packed")
    packed, n = level.where("ids IS NULL"), 0
    parts = (level.where("ids IS NOT NULL").agg(F.max("part")).first()[0] or 0) + 1
    while True:
        n += 1
        parts, last = -(-parts // FAN_IN), parts <= FAN_IN
        left = level.where("ids IS NOT NULL").withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).select(*NAMES)
        level = written(left.groupBy("part").applyInArrow(
            _merge(n, last, width, capacity, windows, least), schema), "packed")
        packed = packed.union(level.where("ids IS NULL"))
        if last:
            return packed.select(*NAMES[:7])


def _merge(level: int, last: bool, width: str, capacity: int, windows: int, least: int):
    """Pack the leftover windows of a group of tasks; the last group also closes its own."""
    def run(rows: pa.Table) -> pa.Table:
        out = Rows(level, rows["part"][0].as_py())
        packer = Packer(capacity, windows, least)
        rows = rows.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        for doc_id, start, ids, tokens in zip(*(rows[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))):
            for done in packer.add(Piece(doc_id, start, np.frombuffer(ids, dtype=width), tokens)):
                out.sequence(done)
        for k, window in enumerate(packer.tail() if last else packer.leftovers()):
            out.sequence(window, None if last else k)
        return pa.table(out.take(), schema=rows.schema)

    return run


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
