"""Harmonic packing of token sequences.

A document's ids are cut into pieces: full sequences of ``capacity`` ids first; of the rest, a
piece of length r belongs to class k = capacity // r, whose sequences hold exactly k pieces. A rest
that would leave more than ``slack`` of its class's sequences empty is cut again: the longest piece
that fills the next class exactly, and what remains. Every worker fills its classes by itself,
without a shuffle; a class's sequence is given out when it has its k pieces. Pieces left over at
the end of a worker's input are laid end to end and cut at the sequences' ends, and the last
sequence is cut into lengths that are powers of two, which need no padding.

Sequence ids are ``task << 32 | number``: tasks and their rows are those of the table scan, so a
repeated task gives the same sequences.

Defined edge cases: null text counts as empty (its sequence is the end id alone); a null doc_id
stays null; repeated rows are packed one by one; texts of any length are tokenised whole; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import slices, text_or_empty
from .tokens import encoder

CAPACITY = 2048
SLACK = 1 / 64
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")
_FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Packer:
    """Packs one worker's documents; rows come out as sequences are filled."""

    def __init__(self, task: int, capacity: int = CAPACITY, slack: float = SLACK):
        self.capacity, self.slack, self.next = capacity, slack, task << 32
        self.classes: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _give_out(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def lengths(self, total: int) -> Iterator[int]:
        """The lengths that a document of ``total`` ids is cut into."""
        for _ in range(total // self.capacity):
            yield self.capacity
        rest = total % self.capacity
        while rest:
            k = self.capacity // rest
            if self.capacity - k * rest <= self.slack * self.capacity:
                yield rest
                return
            yield (cut := self.capacity // (k + 1))
            rest -= cut

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for n in self.lengths(total):
            k = self.capacity // n
            filling = self.classes.setdefault(k, [])
            filling.append((doc_id, start, ids[4 * start:4 * (start + n)], total))
            if len(filling) == k:
                self._give_out(self.classes.pop(k))
            start += n

    def end(self) -> None:
        left = [p for k in sorted(self.classes) for p in self.classes[k]]
        self.classes = {}
        room = sum(len(p[2]) // 4 for p in left)
        sizes = [self.capacity] * (room // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if room % self.capacity >> b & 1]
        pieces, at = [], 0
        for doc_id, start, ids, total in left:
            while ids:
                part = ids[:4 * (sizes[0] - at)]
                pieces.append((doc_id, start, part, total))
                at, start, ids = at + len(part) // 4, start + len(part) // 4, ids[len(part):]
                if at == sizes[0]:
                    self._give_out(pieces)
                    pieces, at = [], 0
                    sizes.pop(0)

    def taken(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        columns = [pa.array(c, pa.int64()) for c in zip(*self.rows, strict=True)]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, names=list(_FIELDS))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = encoder(tokenizer, True), Packer(TaskContext.get().partitionId(), capacity, slack)
        for batch in slices(batches, "text", 2 << 20):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode(batch.column("text").to_pylist()),
                                   strict=True):
                packer.add(doc_id, ids + end)
            if (out := packer.taken()) is not None:
                yield out
        words.forget()
        packer.end()
        if (out := packer.taken()) is not None:
            yield out

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, SCHEMA)
