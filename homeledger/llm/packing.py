"""Best-fit packing of documents into fixed-length token sequences.

Bounded-space online best fit: pieces arrive one by one; a piece goes into the open
sequence with the least free space that still holds it. Free spaces are kept in a bitset,
so the best fit is one shift and one lowest-bit search. At most ``open_bins`` sequences are
open; when another one is needed, the fullest closes first.

Pieces are dealt to packers by hash, narrow and without their texts, and arrive in an order
that depends only on their keys, so a task that is run again after the loss of an executor
packs alike. Each run of as many arrivals as there are open bins is placed longest first;
small pieces then fill what long ones leave. Memory per packer is the open bins and one
Arrow batch, whatever the input.

Null texts are empty; an empty document is its end id alone. Documents longer than a
sequence are cut from the end: all pieces but the first are full. Repeated rows are
documents of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from homeledger.llm.bpe import codec
from homeledger.llm.common import ddl, slices

WINDOW = 2048
OPEN_BINS = 4096
END_ID = 0


class BestFit:
    """Open sequences by their free space."""

    def __init__(self, window: int, open_bins: int, first_id: int):
        self.window, self.limit, self.next_id = window, open_bins, first_id
        self.bits, self.open = 0, 0
        self.by_free: dict[int, deque[int]] = defaultdict(deque)

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        sequence = bins.popleft()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset of a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.open == self.limit and length < self.window:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, sequence = self.window, self.next_id
            self.next_id += 1
        left = free - length
        if left:
            self.by_free[left].append(sequence)
            self.bits |= 1 << left
            self.open += 1
        return sequence, self.window - free


def cut_lengths(n: int, window: int) -> list[int]:
    """Only what is longer than a window is cut; then the first piece may be shorter."""
    whole, rest = divmod(n, window)
    return [rest] * (rest > 0) + [window] * whole


def cut_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                  with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``window`` ids: key, piece, start, length, ids_crc32, and the ids if wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = codec(path), END_ID.to_bytes(4, "little")
        for batch in slices(batches):
            at, rows = [], []
            for i, ids in enumerate(own.encode_many(batch.column(1).to_pylist())):
                ids, start = ids + end, 0
                for piece, n in enumerate(cut_lengths(len(ids) // 4, window)):
                    body = ids[4 * start:4 * (start + n)]
                    at.append(i)
                    rows.append((piece, start, n, zlib.crc32(body), *([body] if with_ids else ())))
                    start += n
            columns = list(zip(*rows)) or [()] * (4 + with_ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in columns[1:4]), *(pa.array(c, pa.binary()) for c in columns[4:])],
                names=[key, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    return docs.select(key, text).mapInArrow(
        run, f"{ddl(docs, key)}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def pack_pieces(pieces: DataFrame, key: str = "doc_id", window: int = WINDOW, open_bins: int = OPEN_BINS) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = BestFit(window, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            placed = np.empty((len(lengths), 2), dtype=np.int64)
            for a in range(0, len(lengths), open_bins):
                run_of = lengths[a:a + open_bins]
                for i in np.argsort(-run_of, kind="stable").tolist():
                    placed[a + i] = packer.place(int(run_of[i]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(placed[:, 0].copy()), pa.array(placed[:, 1].copy())],
                names=[*batch.schema.names, "sequence_id", "offset"])

    order = F.xxhash64(key, "piece")
    dealt = pieces.repartition(F.col(key), F.col("piece"), F.col("ids_crc32"))
    return dealt.sortWithinPartitions(order, key, "piece", "length", "ids_crc32").mapInArrow(
        run, f"{ddl(pieces, *pieces.columns)}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                   open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """Pieces of every document with their place in a sequence of at most ``window`` ids."""
    return pack_pieces(cut_documents(docs, path, key, text, window, with_ids), key, window, open_bins)
