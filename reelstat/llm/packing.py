"""Harmonic packing of encoded documents into sequences of a fixed capacity.

Class k takes pieces of capacity/(k+1) < length <= capacity/k and puts exactly
k of them into a sequence, whatever else arrives, so each worker packs its own
rows alone and holds at most one open sequence a class. Documents are cut where
that fills classes: whole capacities first, then pieces of exactly
capacity // k, at most ``CUTS`` of them, and the rest as it is. Rests below the
last class follow each other in one open sequence. At the end of a worker the
pieces of its open sequences are laid end to end, cut at the border, so a
worker leaves one padded sequence.

Each task packs its own input split; its sequences are numbered by task, so a
task that runs again gives the same rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import int_arrays, text_blocks
from reelstat.llm.tokens import VOCABULARY, encode_added

END_ID = 1
CLASSES = 32
CUTS = 2
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class HarmonicPacker:
    """Rows (piece, sequence, offset) from documents; a piece is (doc, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, first_sequence: int = 0):
        self.capacity, self.next = capacity, first_sequence
        self.open: dict[int, list] = {}
        self.tail: list = []
        self.tail_held = 0

    def add(self, doc, ids: np.ndarray):
        size, at = len(ids), 0
        while size - at >= self.capacity:
            yield from self._close([(doc, at, ids[at:at + self.capacity], size)])
            at += self.capacity
        for _ in range(CUTS):
            k = -(-self.capacity // (size - at)) if at < size else CLASSES + 1
            if k > CLASSES or self.capacity // k == size - at:
                break
            yield from self._place(k, (doc, at, ids[at:at + self.capacity // k], size))
            at += self.capacity // k
        if at < size:
            yield from self._place(self.capacity // (size - at), (doc, at, ids[at:], size))

    def finish(self):
        for k in sorted(self.open):
            for piece in self.open.pop(k):
                yield from self._append(piece)
        if self.tail:
            yield from self._close(self.tail)
            self.tail, self.tail_held = [], 0

    def _place(self, k: int, piece):
        if k > CLASSES:
            yield from self._append(piece)
            return
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            yield from self._close(self.open.pop(k))

    def _append(self, piece):
        doc, start, ids, size = piece
        while len(ids):
            fits = ids[:self.capacity - self.tail_held]
            self.tail.append((doc, start, fits, size))
            self.tail_held += len(fits)
            start, ids = start + len(fits), ids[len(fits):]
            if self.tail_held == self.capacity:
                yield from self._close(self.tail)
                self.tail, self.tail_held = [], 0

    def _close(self, pieces):
        offset = 0
        for piece in pieces:
            yield piece, self.next, offset
            offset += len(piece[2])
        self.next += 1


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, vocabulary: str = VOCABULARY,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32 (little-endian unsigned 32-bit ids), doc_tokens,
    sequence_id, offset and, ``with_ids``, the ids.

    A document is its text's ids and then id 1; a null or empty text is id 1
    alone. Every input row is a document, also where rows or ids repeat or the
    id is null. Other columns are left out. No input gives no rows.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def table_of(rows):
        pieces = [p for p, _, _ in rows]
        columns = [pa.array([p[0] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()),
                   pa.array([len(p[2]) for p in pieces], pa.int64()),
                   pa.array([zlib.crc32(p[2].astype("<u4").tobytes()) for p in pieces], pa.int64()),
                   pa.array([p[3] for p in pieces], pa.int64()), pa.array([s for _, s, _ in rows], pa.int64()),
                   pa.array([o for _, _, o in rows], pa.int64())]
        if with_ids:
            columns.append(int_arrays(np.concatenate([p[2] for p in pieces]).astype(np.int32), np.array([len(p[2]) for p in pieces])))
        return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    def run(batches):
        packer, rows = HarmonicPacker(capacity, TaskContext.get().partitionId() << 36), []
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, _, texts in text_blocks(batch, "text"):
                for k, t in enumerate(texts):
                    rows += packer.add(ids[start + k], np.append(encode_added(t, vocabulary), np.uint32(END_ID)))
                if rows:
                    yield table_of(rows)
                    rows = []
        if rows := list(packer.finish()):
            yield table_of(rows)

    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
