"""Sum-of-squares online packing of tokenized documents into fixed windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .tokens import END_ID, encoder

WINDOW = 2048
OPEN_WINDOWS = 4096

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


class Packer:
    """Windows of one task.

    ``level[h]`` counts open windows filled to h. A piece goes to the level
    (0: a new window) that leaves the smallest sum of squared counts, ties to
    the fullest. Documents are first cut into whole windows, so only their
    remainders meet this choice. When ``OPEN_WINDOWS`` are open, or at the end,
    the open ones are closed by cutting: the emptiest one's tokens fill up the
    fullest. That leaves one partly filled window a task at most.
    """

    def __init__(self, size: int = WINDOW, most_open: int = OPEN_WINDOWS):
        self.size, self.most_open = size, most_open
        self.level = np.zeros(size, np.int64)
        self.open: dict[int, list[list[tuple]]] = {}  # by level: windows, each a list of pieces (doc, start, length)
        self.n_open = 0

    def place(self, doc, start: int, length: int) -> Iterator[list[tuple]]:
        """Add tokens ``start`` to ``start + length`` of a document; yields the windows that this fills."""
        while length >= self.size:
            yield [(doc, start, self.size)]
            start, length = start + self.size, length - self.size
        if not length:
            return
        n = self.level[: self.size - length + 1]
        # Change of the sum: one window leaves level h, one comes to h + length (a full one leaves the array).
        change = 1 - 2 * n
        change[0] = 0
        change[: self.size - length] += 2 * self.level[length:] + 1
        change[1:][n[1:] == 0] = np.iinfo(np.int64).max
        h = self.size - length - int(np.argmin(change[::-1]))
        piece = (doc, start, length)
        if h:
            window = self.open[h].pop()
            self.level[h] -= 1
            self.n_open -= 1
            window.append(piece)
        else:
            window = [piece]
        if h + length == self.size:
            yield window
        else:
            self.open.setdefault(h + length, []).append(window)
            self.level[h + length] += 1
            self.n_open += 1
            if self.n_open >= self.most_open:
                yield from self.close(last=False)

    def close(self, last: bool = True) -> Iterator[list[tuple]]:
        """Close the open windows; one that stays partly filled is kept open unless this is the ``last`` call."""
        windows = [w for h in sorted(self.open, reverse=True) for w in self.open[h]]
        self.open, self.n_open = {}, 0
        self.level[:] = 0
        front, back = 0, len(windows) - 1
        while front < back:
            window, room = windows[front], self.size - sum(p[2] for p in windows[front])
            while room and front < back:
                doc, start, length = windows[back].pop()
                take = min(room, length)
                window.append((doc, start, take))
                room -= take
                if take < length:
                    windows[back].append((doc, start + take, length - take))
                elif not windows[back]:
                    back -= 1
            if not room:
                yield window
                front += 1
        for window in windows[front : back + 1]:
            used = sum(p[2] for p in window)
            if last or used == self.size:
                yield window
            else:
                self.open[used] = [window]
                self.level[used] = self.n_open = 1


def packed_sequences(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", size: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """One row a piece: its document and place there, its sequence and place there, its ids.

    A document is its ids and ``end_id``; a null or empty text is the end id
    alone. Each task packs the documents it reads, in one pass: it keeps the
    ids of open windows only, and its result is one map, without a shuffle. A
    sequence lies in one task, so a repeated task repeats whole sequences.
    Repeated documents are packed each; a null key stays null.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer = encoder(tokenizer), Packer(size)
        end, width = np.array([end_id], enc.width).tobytes(), enc.width.itemsize
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def add(window: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for (doc_id, ids, total), start, length in window:
                part = np.frombuffer(ids, enc.width, length, start * width).astype("<u4").tobytes()
                rows.append((doc_id, start, length, zlib.crc32(part), total, sequence, offset, part))
                offset += length
            sequence += 1

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            columns = zip(*rows) if rows else [[]] * 8
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            rows.clear()
            return out

        for batch in slices(batches, "text"):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.packed(batch.column("text").to_pylist())):
                ids += end
                total = len(ids) // width
                for window in packer.place((doc_id, ids, total), 0, total):
                    add(window)
                if len(rows) >= 1000:
                    yield flush()
        for window in packer.close():
            add(window)
        yield flush()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(pack, PIECES)
