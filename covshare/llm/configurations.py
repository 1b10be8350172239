"""Packing documents into few sequences by linear grouping.

Documents become pieces of at most one sequence; a piece is known by its length
alone from then on, so only lengths and ids travel and texts are read once. The
pieces are dealt into groups of bounded size, and each group is packed as one
instance of bin packing:

1. Large lengths are sorted and cut into classes of equal cardinality, and each
   is rounded up to the largest of its class, so few sizes are left.
2. A configuration says how many pieces of each size fill one sequence. The
   fractional cover of all pieces with the fewest configurations is found by the
   simplex method, with new configurations from a knapsack over the dual prices.
3. Whole numbers of the configurations are used, and actual pieces take their
   places: the largest that a place is for, and in the last place of a sequence the
   largest that has room there, as the pieces before are shorter than rounded.
4. Large pieces that are left over and then all small ones go, in descending
   order, to the sequence with the least room that is enough, or to a new one.

A group wastes less than a sequence more than its optimum has to, apart from
the rounding, and small pieces fill what the rounding leaves open.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.llm.tokens import WordEncoder
from covshare.llm.workers import kept, short_batches
from covshare.sources.scratch import stored

WIDTH = 4096
PIECES_IN_GROUP = 20_000
CLASSES = 64  # sizes that large lengths are rounded up to
LARGE_SHARE = 8  # a piece over WIDTH / LARGE_SHARE is large: fewer of them than that fit together
_ROOMS = 512  # of a sequence, in steps that rounded sizes are counted in
_ROUNDS = 5000  # of the simplex method; it ends far earlier, and any of its states can be used
_SEQUENCE_BITS = 32  # of a sequence id; the group's number stands above them
_ROWS_OUT = 20_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, turn long"


def _cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, width: int) -> Iterator[pa.RecordBatch]:
    """The pieces of a task's documents; `turn` deals them out evenly."""
    encoder = kept(WordEncoder, path)
    end = np.asarray([end_id], "<u4").tobytes()
    turn = zlib.crc32(str(TaskContext.get().partitionId()).encode())  # tasks begin at different groups
    rows: list[tuple] = []
    names = [field.split()[0] for field in _PIECES.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 4]

    def out() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        rows.clear()
        return batch

    for batch in batches:
        texts = (t.as_py() for t in batch.column(1))
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
            ids += end
            for piece, at in enumerate(range(0, len(ids), width * 4)):
                part = ids[at : at + width * 4]
                rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), turn))
                turn += 1
        if len(rows) >= _ROWS_OUT:
            yield out()
    yield out()


def pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int, width: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, turn) for documents cut at each `width` ids."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _cut(batches, tokenizer, end_id, width), _PIECES)


def rounded_classes(lengths: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """For descending lengths: the size that each is rounded up to, as a place among
    the sizes, and the sizes, descending. Classes have equal cardinality; a few
    distinct lengths are sizes as they are."""
    n = len(lengths)
    sizes, place = np.unique(-lengths, return_inverse=True)
    if len(sizes) > classes:
        of_class = np.arange(n) * classes // n
        sizes, place = np.unique(-lengths[np.searchsorted(of_class, of_class)], return_inverse=True)
    return place, -sizes


class Knapsack:
    """Configurations of the highest price: the best of one piece more for every
    room at once, until no more fit."""

    def __init__(self, sizes: np.ndarray, width: int):
        self.sizes, self.width = sizes, width
        self.most = int(sizes.max())
        # Where the rest of each room is, after each size; what is below 0 is padding.
        self.rest = np.arange(width + 1)[None, :] - sizes[:, None] + self.most

    def best(self, prices: np.ndarray) -> np.ndarray:
        """How many pieces of each size the best configuration has."""
        padded = np.full(self.most + self.width + 1, -np.inf)
        value = padded[self.most :]
        value[:] = 0
        taken = []
        while True:
            with_it = padded[self.rest] + prices[:, None]
            choice = with_it.argmax(axis=0)
            more = with_it[choice, np.arange(self.width + 1)]
            better = more > value + 1e-12
            if not better.any():
                break
            taken.append(np.where(better, choice, -1))
            value[better] = more[better]
        counts, room = np.zeros(len(self.sizes)), self.width
        for choice in reversed(taken):
            if choice[room] >= 0:
                counts[choice[room]] += 1
                room -= int(self.sizes[choice[room]])
        return counts


def fewest_configurations(sizes: np.ndarray, demand: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(configurations as columns, how often each is used, as fractions): a basic
    solution of the smallest sum that covers `demand` pieces of each size."""
    knapsack = Knapsack(sizes, width)
    # Of each size as many as fit.
    columns = np.diag((width // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    used = inverse @ demand
    for _ in range(_ROUNDS):
        prices = inverse.sum(axis=0)
        column = knapsack.best(prices)
        if column @ prices <= 1 + 1e-9:
            break
        direction = inverse @ column
        able = np.flatnonzero(direction > 1e-9)
        if not len(able):
            break
        out = able[np.argmin(used[able] / direction[able])]
        step = used[out] / direction[out]
        used = used - step * direction
        used[out] = step
        columns[:, out] = column
        pivot = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, pivot)
        inverse[out] = pivot
    return columns, np.maximum(used, 0)


class _Stock:
    """Pieces that wait, by length; a bit of `have` tells which lengths there are."""

    def __init__(self, sizes: list[int], numbers: list[int]):
        self.held: dict[int, list[int]] = {}
        for size, number in zip(sizes, numbers, strict=True):
            self.held.setdefault(size, []).append(number)
        self.have = sum(1 << size for size in self.held)

    def take(self, most: int) -> tuple[int, int]:
        """(length, number) of the longest piece of `most` at most; length 0 for none."""
        size = (self.have & (1 << most + 1) - 1).bit_length() - 1
        if size < 1:
            return 0, -1
        number = self.held[size].pop()
        if not self.held[size]:
            self.have &= ~(1 << size)
        return size, number

    def rest(self) -> list[int]:
        """The pieces that still wait, the longest first."""
        return [n for size in sorted(self.held, reverse=True) for n in self.held[size]]


def pack_lengths(lengths: np.ndarray, width: int, classes: int = CLASSES, large_share: int = LARGE_SHARE) -> np.ndarray:
    """The sequence of each piece, as numbers from 0."""
    order = np.argsort(-lengths, kind="stable")
    n_whole = int((lengths == width).sum())
    n_large = int((lengths * large_share > width).sum())
    sequence = np.empty(len(lengths), np.int64)
    sequence[order[:n_whole]] = np.arange(n_whole)
    large = order[n_whole:n_large]
    room: list[int] = []  # of every sequence begun after the whole ones
    left: list[int] = []
    if len(large):
        place, sizes = rounded_classes(lengths[large], classes)
        demand = np.bincount(place, minlength=len(sizes)).astype(float)
        # Rounded sizes need no finer rooms than these.
        unit = max(1, width // _ROOMS) if len(sizes) == classes else 1
        columns, used = fewest_configurations(-(-sizes // unit), demand, width // unit)
        stock = _Stock(lengths[large].tolist(), large.tolist())
        plans = zip(columns.T.round().astype(int), np.floor(used + 1e-9).astype(int).tolist(), strict=True)
        # Those with the largest pieces first, as small ones fit anywhere later.
        for slots, times in sorted(((np.repeat(sizes, c).tolist(), t) for c, t in plans if t), reverse=True):
            for _ in range(times):
                free, number = width, n_whole + len(room)
                # The last place has what rounding left open besides, and so may a
                # further one.
                for most in itertools.chain(slots[:-1], itertools.repeat(width)):
                    size, piece = stock.take(min(most, free))
                    if not size and most == width:
                        break
                    if size:
                        sequence[piece] = number
                        free -= size
                if free < width:
                    room.append(free)
        left = stock.rest()
    _best_fit(lengths, [*left, *order[n_large:].tolist()], room, sequence, n_whole, width)
    return sequence


def _best_fit(lengths: np.ndarray, order: list[int], room: list[int], sequence: np.ndarray, first: int, width: int) -> None:
    """Pieces one after another to the sequence with the least room that is enough.

    Sequences stand in lists by their room; a bit of `free` tells which lists hold any.
    """
    held: list[list[int]] = [[] for _ in range(width + 1)]
    free = 0
    for number, r in enumerate(room):
        held[r].append(number)
        free |= 1 << r
    sizes = lengths.tolist()
    n = len(room)
    for piece in order:
        size = sizes[piece]
        enough = free >> size
        if enough:
            r = size + (enough & -enough).bit_length() - 1
            number = held[r].pop()
            if not held[r]:
                free &= ~(1 << r)
        else:
            r, number = width, n
            n += 1
        sequence[piece] = first + number
        r -= size
        held[r].append(number)
        free |= 1 << r


def _pack_group(table: pa.Table, width: int, classes: int, large_share: int) -> pa.Table:
    # The same rows in another order give the same sequences.
    table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32", "turn")])
    lengths = table.column("length").to_numpy()
    sequence = pack_lengths(lengths, width, classes, large_share)
    order = np.argsort(sequence, kind="stable")
    ends = np.cumsum(lengths[order])
    begin = ends - lengths[order]
    new = np.concatenate([[True], sequence[order][1:] != sequence[order][:-1]])
    offset = np.empty(len(lengths), np.int64)
    offset[order] = begin - np.maximum.accumulate(np.where(new, begin, 0))
    number = table.column("bin_group")[0].as_py() << _SEQUENCE_BITS
    return table.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column(
        "sequence_id", pa.array(sequence + number)
    ).append_column("offset", pa.array(offset))


def pack_few(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    width: int = WIDTH,
    pieces_in_group: int = PIECES_IN_GROUP,
    classes: int = CLASSES,
    large_share: int = LARGE_SHARE,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    `tokenizer` is the path of a tokenizer file of the kind that drops white space.
    A document is its ids and then `end_id`; a null or empty text is `end_id`
    alone. Documents of more than `width` ids are cut at each `width`, no others
    are. Rows that repeat are packed each on its own, a null id is kept, other
    columns are ignored, an empty table gives no rows. A group has
    `pieces_in_group` pieces about, dealt in turn and not by id, whatever repeats.
    """
    cut = stored(pieces(docs, tokenizer, id_col, text_col, end_id, width), "pieces")
    groups = max(1, -(-cut.count() // pieces_in_group))
    return (
        cut.withColumn("bin_group", F.pmod("turn", F.lit(groups)))
        .groupBy("bin_group")
        .applyInArrow(
            lambda table: _pack_group(table, width, classes, large_share),
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )
