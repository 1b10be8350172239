"""Sum-of-squares online packing of documents into sequences of one length.

Every input partition packs its own documents as they come, so nothing is
shuffled and nothing is held but the open windows. Whole windows are cut off
long documents; each remainder goes to the fill level that gives the smallest
sum of squared counts of partially filled windows (or opens a window), with
the counts per level in an array. Windows still open at the end are poured
together, cutting pieces where a window is full, and what is left is cut into
powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.llm.tokens import WordEncoder
from covshare.llm.workers import kept, short_batches

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, padded_length long"
)
_ROWS_OUT = 20_000
_SEQUENCE_BITS = 36  # of a sequence id; the partition's number stands above them

# A piece: (doc_id, start, ids as bytes, tokens of the document).
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """Places pieces; `closed` gets each finished sequence as a list of pieces."""

    def __init__(self, width: int, most_open: int):
        self.width = width
        self.most_open = most_open
        self.counts = np.zeros(width + 1, np.int64)  # partially filled windows at each level
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)
        self.opened = 0
        self.closed: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """The level to fill, 0 for a new window: the smallest change of the sum
        of squares, the fullest window among equals."""
        counts = self.counts
        before = counts[: self.width - size + 1]
        after = counts[size:].copy()
        change = 2 * (after - before) + 2
        change[-1] = 1 - 2 * before[-1]  # a full window is no longer partially filled
        change[0] = 2 * counts[size] + 1 if size < self.width else 0
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max  # no such window
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, step = len(ids) // 4, self.width * 4
        whole = total // self.width
        for i in range(whole):
            self.closed.append([(doc_id, i * self.width, ids[i * step : (i + 1) * step], total)])
        size = total - whole * self.width
        if not size:
            return
        piece = (doc_id, whole * self.width, ids[whole * step :], total)
        level = self.level_for(size)
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
            self.opened -= 1
        else:
            window = []
        window.append(piece)
        if level + size == self.width:
            self.closed.append(window)
        else:
            self.open[level + size].append(window)
            self.counts[level + size] += 1
            self.opened += 1
            if self.opened > self.most_open:
                self._pour(last=False)

    def finish(self) -> None:
        self._pour(last=True)

    def _pour(self, last: bool) -> None:
        """Fill windows with the pieces of all open ones, cutting where one is full."""
        pieces = [p for level in sorted(self.open, reverse=True) for w in self.open[level] for p in w]
        self.open.clear()
        self.counts[:] = 0
        self.opened = 0
        left = sum(len(p[2]) for p in pieces) // 4
        sizes = [self.width] * (left // self.width)
        rest = left % self.width
        if last:
            sizes += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        elif rest:
            sizes.append(rest)
        at = iter(pieces)
        piece = next(at, None)
        for size in sizes:
            window, room = [], size * 4
            while room:
                doc_id, start, ids, total = piece
                part = ids[:room]
                window.append((doc_id, start, part, total))
                room -= len(part)
                piece = (doc_id, start + len(part) // 4, ids[len(part) :], total) if len(part) < len(ids) else next(at, None)
            if last or size == self.width:
                self.closed.append(window)
            else:
                self.open[size].append(window)
                self.counts[size] += 1
                self.opened += 1


def _pack_partition(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, width: int, most_open: int, keep: bool
) -> Iterator[pa.RecordBatch]:
    encoder, packer = kept(WordEncoder, path) if keep else WordEncoder(path), Packer(width, most_open)
    end = np.asarray([end_id], "<u4").tobytes()
    first = TaskContext.get().partitionId() << _SEQUENCE_BITS
    done = 0
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    rows: list[tuple] = []

    def take() -> None:
        nonlocal done
        for window in packer.closed:
            offset = 0
            used = sum(len(ids) for _, _, ids, _ in window) // 4
            padded = used if used & (used - 1) == 0 else width
            for doc_id, start, ids, total in window:
                rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, first + done, offset, padded))
                offset += len(ids) // 4
            done += 1
        packer.closed.clear()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)
        rows.clear()
        return batch

    for batch in batches:
        texts = (t.as_py() for t in batch.column(1))
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
            packer.add(doc_id, ids + end)
            if len(packer.closed) >= 256:
                take()
                if len(rows) >= _ROWS_OUT:
                    yield out()
    packer.finish()
    take()
    if rows:
        yield out()


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    width: int = 2048,
    most_open: int = 2048,
    keep: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, padded_length.

    `tokenizer` is the path of a tokenizer file of the kind that drops white
    space. Each document is its ids and then `end_id`; a null or empty text is
    `end_id` alone, repeated rows are packed each on its own, a null id is
    kept. `width` must be a power of two. No more than `most_open` windows are
    open in a partition; one more and they are poured together. A partition
    whose rows come in the same order, such as one of a file scan, gives the
    same sequences when it is computed again. With `keep` a worker keeps the
    tokenizer and the words it has met for its next task, 200 MB about at most. Other columns are ignored, an
    empty table gives no rows.
    """
    if width & (width - 1):
        raise ValueError("width must be a power of two")
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _pack_partition(batches, tokenizer, end_id, width, most_open, keep), SCHEMA)
