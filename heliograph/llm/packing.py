"""Harmonic packing of token ids into sequences of at most CAPACITY tokens.

A document of n <= CAPACITY tokens belongs to the reciprocal class m = CAPACITY // n, that of lengths
in (CAPACITY / (m + 1), CAPACITY / m], and each bin of class m takes exactly m of its documents, whole.
Workers (partitions) fill the bins of their classes independently: no shuffle and no shared state,
in one pass. Longer documents have to be cut anyway, so they are what the space left over in
closed bins is filled with; what they don't spend there makes sequences of its own. Bins that wait
for such a document are kept, WAITING at most; beyond that the next document is cut for them,
whatever its length.

A worker's last open bins are merged largest document first and filled the same way, by cutting
the emptiest of them. The one that can't be filled falls apart into sequences whose lengths are
powers of two, which need no padding either.

A sequence's id is its worker's number and its number there. A worker that is lost and run again
reads the same rows and gives its sequences the same ids.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.llm.common import text_of
from heliograph.runtime import ship_code

CAPACITY = 2048
END_ID = 1
WORKER_BITS = 40
WAITING = 512  # closed bins with space left, 4 MB
SPARE = 64  # sequences that are kept for such space, 0.5 MB
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Worker:
    """The bins of one worker; pieces (doc_id, start, ids, doc_tokens) come out with their sequence and offset."""

    def __init__(self, number: int, capacity: int):
        self.capacity, self.next = capacity, number << WORKER_BITS
        self.open: dict[int, list] = {}  # by class: the documents of the bin being filled
        self.waiting: deque = deque()  # closed bins with space left: (pieces, tokens)
        self.spare: deque = deque()  # pieces to cut from
        self.spare_tokens = 0
        self.done: list = []

    def _place(self, pieces: list) -> None:
        at = 0
        for doc_id, start, ids, tokens in pieces:
            self.done.append((doc_id, start, len(ids) // 4, bytes(ids), tokens, self.next, at))
            at += len(ids) // 4
        self.next += 1

    def _cut(self, n: int) -> list:
        """The next n spare tokens."""
        out = []
        while n:
            doc_id, start, ids, tokens = self.spare.popleft()
            take = min(n, len(ids) // 4)
            out.append((doc_id, start, ids[: 4 * take], tokens))
            if 4 * take < len(ids):
                self.spare.appendleft((doc_id, start + take, ids[4 * take :], tokens))
            n -= take
            self.spare_tokens -= take
        return out

    def _keep(self, piece: tuple) -> None:
        self.spare.append((*piece[:2], memoryview(piece[2]), piece[3]))
        self.spare_tokens += len(piece[2]) // 4

    def _fill(self) -> None:
        while self.waiting and self.spare_tokens >= self.capacity - self.waiting[0][1]:
            pieces, used = self.waiting.popleft()
            self._place(pieces + self._cut(self.capacity - used))

    def _close(self, pieces: list) -> None:
        used = sum(len(x[2]) // 4 for x in pieces)
        if used == self.capacity:
            self._place(pieces)
        else:
            self.waiting.append((pieces, used))

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // 4
        if n > self.capacity or len(self.waiting) >= WAITING:
            self._keep((doc_id, 0, ids, n))
        else:
            m = self.capacity // n
            held = self.open.setdefault(m, [])
            held.append((doc_id, 0, ids, n))
            if len(held) == m:
                self._close(self.open.pop(m))
        self._fill()
        while self.spare_tokens >= SPARE * self.capacity:
            self._place(self._cut(self.capacity))

    def close(self) -> None:
        rest = sorted((x for held in self.open.values() for x in held), key=lambda x: -len(x[2]))
        self.open = {}
        bins: list[tuple[list, int]] = []
        for piece in rest:  # first fit, largest first; a bin for each class at most, so these are few
            n = len(piece[2]) // 4
            k = next((k for k, (_, used) in enumerate(bins) if used + n <= self.capacity), len(bins))
            held, used = bins[k] if k < len(bins) else ([], 0)
            bins[k : k + 1] = [([*held, piece], used + n)]
        for held, _ in bins:
            self._close(held)
        self.waiting = deque(sorted(self.waiting, key=lambda x: -x[1]))
        self._fill()
        while self.waiting:  # too little is spare: the emptiest bin is cut for the others
            for piece in self.waiting.pop()[0]:
                self._keep(piece)
            self._fill()
        while self.spare_tokens:
            self._place(self._cut(min(self.capacity, 1 << (self.spare_tokens.bit_length() - 1))))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone. Documents are told apart by their rows: repeated rows
    are packed as documents of their own under the same doc_id, a null doc_id stays null. Texts of
    any length are cut; an empty table gives an empty result.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from heliograph.llm.token_ids import encoded, encoder

        encode, worker = encoder(tokenizer_path).many, Worker(TaskContext.get().partitionId(), capacity)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for doc_id, ids in encoded(encode, batch.column(0), batch.column(1)):
                worker.add(doc_id, ids + end)
                if len(worker.done) >= 1024:
                    yield _batch(worker)
        worker.close()
        yield _batch(worker)

    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(run, SCHEMA)


def _batch(worker: Worker) -> pa.RecordBatch:
    columns = list(zip(*worker.done)) or [()] * 7
    worker.done = []
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def report(packed: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
