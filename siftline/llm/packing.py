"""Vector bin packing of tokenised examples into sequences, by the dot-product heuristic.

A sequence has three limits: tokens, segments (pieces of examples) and loss-bearing
tokens. While a sequence is open, each waiting example is a vector of these three demands;
of those that fit whole, the one with the largest dot product of its demand with what the
sequence has left is placed (each dimension weighted by its mean demand). If none fits
whole, the one with the largest dot product is cut to what is left; its rest waits on. So
a sequence closes short of its tokens only if another limit binds or nothing waits.

Each task packs the rows it reads, with a bounded number of examples waiting; nothing is
shuffled. The sequences of a task that end short are those of its last rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.textbytes import give_back
from siftline.llm.tokens import tokenizer
from siftline.session import small_batches

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, loss_tokens bigint, ids array<int>"
)
WAITING = 512


@dataclass(frozen=True)
class Limits:
    """Of one sequence."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


class Packer:
    """Places examples as they come; ``pieces`` fills with rows of SCHEMA, in parts."""

    def __init__(self, limits: Limits, first_sequence: int, waiting: int = WAITING):
        self.limits, self.sequence, self.most = limits, first_sequence, waiting
        self.size = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.left = self.size.copy()
        self.demand = np.zeros((waiting, 3))  # of waiting examples: tokens, segments, loss tokens
        self.mean = np.zeros(3)
        self.seen = 0
        self.examples: list[tuple | None] = [None] * waiting
        self.free = list(range(waiting))
        self.at = 0
        self.pieces: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray, loss_from: int) -> None:
        """``ids`` from ``loss_from`` on bear loss."""
        if not self.free:
            self._place()
        while not self.free:
            self._place()
        slot = self.free.pop()
        self.examples[slot] = (doc_id, ids, 0, loss_from)
        self._measure(slot)
        self.seen += 1
        self.mean += (np.minimum(self.demand[slot], self.size) / self.size - self.mean) / self.seen

    def finish(self) -> None:
        while len(self.free) < self.most:
            self._place()
        self._close()

    def _measure(self, slot: int) -> None:
        _, ids, start, loss_from = self.examples[slot]
        self.demand[slot] = len(ids) - start, 1, len(ids) - max(start, loss_from)
        np.maximum(self.demand[slot], 0, out=self.demand[slot])

    def _place(self) -> None:
        """One piece into the open sequence; closes it first if nothing can enter."""
        if self.left[0] < 1 or self.left[1] < 1:
            self._close()
        live = self.demand[:, 0] > 0
        fits = live & (self.demand <= self.left).all(1)
        score = self.demand @ (self.left * self.mean / self.size ** 2)
        if fits.any():
            slot = int(np.where(fits, score, -1.0).argmax())
            return self._emit(slot, int(self.demand[slot, 0]))
        for slot in np.argsort(np.where(live, -score, np.inf), kind="stable")[:np.count_nonzero(live)]:
            _, ids, start, loss_from = self.examples[slot]
            free_of_loss = max(0, loss_from - start)
            length = int(min(self.left[0], free_of_loss + self.left[2], len(ids) - start))
            if length > 0:
                return self._emit(int(slot), length)
        self._close()  # all that waits begins with loss, and no more of it may enter

    def _emit(self, slot: int, length: int) -> None:
        doc_id, ids, start, loss_from = self.examples[slot]
        part = ids[start:start + length]
        loss = max(0, start + length - max(start, loss_from))
        self.pieces.append((
            doc_id, start, length, zlib.crc32(part.astype("<u4").tobytes()), len(ids),
            self.sequence, self.at, loss, part,
        ))
        self.left -= (length, 1, loss)
        self.at += length
        if start + length == len(ids):
            self.examples[slot], self.demand[slot] = None, 0
            self.free.append(slot)
        else:
            self.examples[slot] = (doc_id, ids, start + length, loss_from)
            self._measure(slot)

    def _close(self) -> None:
        if self.at:
            self.sequence += 1
        self.left[:], self.at = self.size, 0

    def take(self) -> pa.RecordBatch:
        rows, self.pieces = self.pieces, []
        columns = list(zip(*rows)) if rows else [()] * 9
        ids = columns[8]
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) for x in ids], out=offsets[1:])
        flat = np.concatenate(ids).astype(np.int32, copy=False) if ids else np.empty(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:8]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "ids"],
        )


def packed(docs: DataFrame, tokenizer_path: str, end_id: int, limits: Limits = Limits(),
           loss_from: str | None = None, with_ids: bool = True) -> DataFrame:
    """Every id of every document in exactly one piece: the rows of SCHEMA.

    A document is its text's ids (a null text has none) and ``end_id``. ``loss_from``
    names a column with the number of leading tokens that bear no loss, as of a prompt;
    null or no such column: all tokens bear loss. sequence_id is unique over the table,
    offset is gapless from 0 in a sequence. Repeated rows and ids are packed one by one; a
    null doc_id stays null; other columns are left behind. ``with_ids`` false leaves out
    the ids themselves.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        (F.coalesce(F.col(loss_from), F.lit(0)) if loss_from else F.lit(0)).cast("long").alias("loss_from"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path).encode
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                ids, counts = encode(some.column(1).to_pylist())
                ends = np.cumsum(counts).tolist()
                start = 0
                for doc_id, end, prompt in zip(some.column(0).to_pylist(), ends, some.column(2).to_pylist()):
                    packer.add(doc_id, np.append(ids[start:end], np.int32(end_id)), prompt)
                    start = end
                yield out(packer.take())
        packer.finish()
        yield out(packer.take())
        del packer
        give_back()

    def out(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch if with_ids else batch.select(batch.schema.names[:-1])

    schema = SCHEMA if with_ids else SCHEMA.rsplit(",", 1)[0]
    return rows.mapInArrow(pack, schema)
