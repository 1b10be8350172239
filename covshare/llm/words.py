"""Words of whole texts as numpy arrays, many documents at a time.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return; in UTF-8 that is the same as of characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# A byte takes 60 bytes of a worker's memory about, and a worker keeps most of what it
# had from the system for later stages.
BLOCK_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CODE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64; kept for blocks of the usual size."""
    held = _powers.get(name)
    if held is None or len(held) <= n:
        held = np.full(max(n, BLOCK_BYTES) + 1, base, np.uint64)
        held[0] = 1
        np.cumprod(held, out=held)
        if n <= 2 * BLOCK_BYTES:
            _powers[name] = held
    return held[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits (Stafford's variant 13)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: int = 1, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with `limit` bytes of text each, or one longer text."""
    data, offsets = string_bytes(batch.column(column))
    first, n = 0, batch.num_rows
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield (
            batch.slice(first, last - first),
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


@dataclass
class Words:
    """Words of a block: bounds in its bytes, and the document of each."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def hashes(self, lower: bool, prefix: int | None = None) -> np.ndarray:
        """64 bits for each word, or for its first `prefix` bytes; with `lower`,
        A-Z count as a-z."""
        return self.all_hashes(lower, (prefix,))[0]

    def all_hashes(self, lower: bool, prefixes: tuple[int | None, ...]) -> list[np.ndarray]:
        """`hashes` for several prefixes; None stands for the whole word."""
        n = len(self.data)
        code = (_CODE[_LOWER] if lower else _CODE)[self.data]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(code * _power(_BASE, "base", n)[:n], out=total[1:])
        before, shift = total[self.starts], _power(_INVERSE, "inverse", n)[self.starts]
        ends = [self.ends if p is None else np.minimum(self.starts + p, self.ends) for p in prefixes]
        return [mix((total[e] - before) * shift) for e in ends]


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = ~inside[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(offsets, starts, "right") - 1)


_PLACE = np.random.default_rng(20240602).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of each run of `width` words within a document."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += hashes[j : j + n] * _PLACE[j]
    first = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return first, mix(total[first])
