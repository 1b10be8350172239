"""Maximal repeats across documents from enhanced suffix arrays in pieces.

Every byte string of `length` bytes holds an anchor: the 24 bytes (16 in strings
of less than 40) with the smallest hash in it, the first of them if there are several. Equal strings
have equal anchors, so occurrences of a repeat can be found by their anchors:

1. Anchors are counted by hash. Those of one document only are of no interest;
   a filter of bounded size tells which hashes are repeated.
2. The contexts of repeated anchors (as far as a string of `length` bytes with
   the anchor can reach) are grouped by hash. Each group gets an enhanced suffix
   array: contexts sorted by what follows the anchor's start, with common prefix
   lengths. A stack scan gives its common-prefix intervals; within each, the
   contexts sorted by what stands before the anchor are scanned the same way,
   which tests the diversity of left extensions. An interval of the second scan
   that spans two children of the first is a maximal repeat, and its members
   are all its occurrences.
3. An anchor with very many occurrences is not gathered in one place: the
   strings of `length` bytes around it are compared one by one instead, by a
   128-bit hash of their content, with counts combined before the shuffle.

Exact copies are set aside first, as they repeat as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covshare.llm import bitmaps
from covshare.llm.exact_dedup import copy_groups, text_key, without_rows
from covshare.llm.minhash import _spread_join
from covshare.llm.words import blocks, mix
from covshare.llm.workers import short_batches
from covshare.sources.scratch import discard, stored

LENGTH = 50
MOST_TOGETHER = 50_000  # occurrences of an anchor that one group takes
# The filter of repeated anchors has a bit for four bytes of text about, in these
# bounds: 2 ** 29 bits are 64 MB.
LEAST_FILTER_BITS, MOST_FILTER_BITS = 20, 29
_KEY_BITS = 48
_BLOCK_BYTES = 1 << 18  # a byte takes 120 bytes of a worker's memory about
_HELD = 400_000  # anchors in a task before their counts are handed on
_WHOLE = (1 << 62) - 1  # end of a span that covers a whole text
_SPAN = ("id", "text_key", "start", "end")
_C = np.random.default_rng(20240603).integers(1, 1 << 63, 32, dtype=np.uint64) | np.uint64(1)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    n = len(data) - 7
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for r in range(min(8, n)):
        count = (len(data) - r) // 8
        out[r::8] = data[r : r + 8 * count].view(">u8")[: len(out[r::8])]
    return out


def anchor_size(length: int) -> int:
    """Longer anchors are repeated by chance less often, but there are more of them."""
    return 24 if length >= 40 else 16


class Anchors:
    """Anchors of a block of documents: places, documents and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.data, self.offsets, self.length = data, offsets, length
        self.eights = _eights(data)
        n = len(data) - length + 1
        none = np.zeros(0, np.int64)
        self.place = self.doc = none
        self.hash = none.astype(np.uint64)
        self.window_place = self.window_anchor = none
        if n <= 0:
            return
        with np.errstate(over="ignore"):
            size = anchor_size(length)
            count = len(self.eights) - size + 8
            grams = self.eights[:count] * _C[0]
            for i in range(8, size, 8):
                grams = mix(grams ^ self.eights[i : i + count] * _C[i // 8])
            grams = mix(grams)
        width = length - size + 1  # anchors that a string may have
        lowest = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        step = 1
        while step * 2 <= width:
            lowest = np.minimum(lowest[:-step], lowest[step:])
            step *= 2
        if step < width:
            lowest = np.minimum(lowest[: len(lowest) - (width - step)], lowest[width - step :])
        ends = np.repeat(offsets[1:], np.diff(offsets))[:n]
        inside = np.flatnonzero(np.arange(length, length + n) <= ends)
        anchors = (lowest[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        if not len(anchors):
            return
        new = np.concatenate([[True], anchors[1:] != anchors[:-1]])
        self.place = anchors[new]
        # Hashed again: those that were the smallest of several are mostly small, and
        # would share few of the filter's slots.
        with np.errstate(over="ignore"):
            self.hash = mix(grams[self.place] * _C[31])
        self.doc = np.searchsorted(offsets, self.place, "right") - 1
        self.window_place, self.window_anchor = inside, np.cumsum(new) - 1


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, Anchors]]:
    """(ids, text keys, anchors) of blocks of (id, text, text_key)."""
    for batch in batches:
        for part, data, offsets in blocks(batch, limit=_BLOCK_BYTES):
            ids, keys = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            yield ids, keys, Anchors(data, offsets, length)


# --- 1. which anchors are repeated -------------------------------------------


def _merged(keys: np.ndarray, docs: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, docs, uses = keys[order], docs[order], uses[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return keys, docs, uses
    docs, uses = (np.minimum(np.add.reduceat(x, first), 65_535) for x in (docs, uses))
    return keys[first], docs, uses


def _count_anchors(batches: Iterator[pa.RecordBatch], length: int, share_bits: int) -> Iterator[pa.RecordBatch]:
    """(share, packed): for each share of the hashes the sorted keys with the
    number of documents and of occurrences, several million anchors at a time."""
    keys = np.zeros(0, np.uint64)
    docs, uses = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        share = (keys >> np.uint64(_KEY_BITS - share_bits)).astype(np.int64)
        bounds = np.searchsorted(share, np.arange((1 << share_bits) + 1))
        low, high = keys.astype("<u4"), (keys >> np.uint64(32)).astype("<u2")
        counts = docs.astype("<u2"), uses.astype("<u2")
        packed = [
            b"".join(x[a:b].tobytes() for x in (low, high, *counts)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(1 << share_bits)), pa.array(packed, pa.binary())], ["share", "packed"]
        )

    for _, _, anchors in _blocks(batches, length):
        found = anchors.hash >> np.uint64(64 - _KEY_BITS)
        order = np.lexsort((anchors.doc, found))
        k, d = found[order], anchors.doc[order]
        if not len(k):
            continue
        other = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
        begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        keys = np.concatenate([keys, k[begin]])
        docs = np.concatenate([docs, np.add.reduceat(other.astype(np.int64), begin)])
        uses = np.concatenate([uses, np.diff(np.append(begin, len(k)))])
        if len(keys) > _HELD:
            keys, docs, uses = _merged(keys, docs, uses)
            yield out()
            keys, docs, uses = keys[:0], docs[:0], uses[:0]
    keys, docs, uses = _merged(keys, docs, uses)
    if len(keys):
        yield out()


def _repeated_share(table: pa.Table, share_bits: int, filter_bits: int, most_together: int) -> pa.Table:
    """One share of the hashes: its part of the filter, and the slots of anchors
    with too many occurrences for one group."""
    columns: list[list[np.ndarray]] = [[], [], [], []]
    for packed in table.column("packed").to_pylist():
        n, at = len(packed) // 10, 0
        for column, kind in zip(columns, ("<u4", "<u2", "<u2", "<u2"), strict=True):
            column.append(np.frombuffer(packed, kind, n, at))
            at += n * np.dtype(kind).itemsize
    low, high, docs, uses = (np.concatenate(c) for c in columns)
    keys, docs, uses = _merged(
        high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64), docs.astype(np.int64), uses.astype(np.int64)
    )
    share = table.column("share")[0].as_py()
    slots = (keys >> np.uint64(_KEY_BITS - filter_bits)).astype(np.int64)
    bits = np.zeros(1 << (filter_bits - share_bits), np.uint8)
    bits[slots[docs > 1] - (share << (filter_bits - share_bits))] = 1
    hot = np.unique(slots[(docs > 1) & (uses > most_together)])
    return pa.table(
        {
            "share": pa.array([share], pa.int64()),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "hot": pa.array([hot.astype("<i8").tobytes()], pa.binary()),
        }
    )


class RepeatFilter:
    """Of bounded size: a bit for each slot that a repeated anchor falls into, and
    the slots of anchors that are not gathered in one group. Both only widen
    what is looked at: the exact comparison comes after."""

    def __init__(self, rows, share_bits: int, filter_bits: int):
        part = 1 << (filter_bits - 3 - share_bits)
        self.filter_bits = filter_bits
        self.bits = np.zeros(1 << (filter_bits - 3), np.uint8)
        hot = [np.zeros(0, np.int64)]
        for row in rows:
            self.bits[row.share * part : (row.share + 1) * part] = np.frombuffer(row.bits, np.uint8)
            hot.append(np.frombuffer(row.hot, "<i8"))
        self.hot = np.sort(np.concatenate(hot))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.filter_bits)).astype(np.int64)

    def repeated(self, slots: np.ndarray) -> np.ndarray:
        return (self.bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8) & 1).astype(bool)

    def too_many(self, slots: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(slots), bool)
        at = np.minimum(np.searchsorted(self.hot, slots), len(self.hot) - 1)
        return self.hot[at] == slots


# --- 2. contexts and their common-prefix intervals -----------------------------


def _contexts(batches: Iterator[pa.RecordBatch], length: int, repeats) -> Iterator[pa.RecordBatch]:
    """(anchor, context, at, id, text_key, place) of repeated anchors; the anchor
    starts at byte `at` of its context and at byte `place` of its document."""
    before, after = length - anchor_size(length), length
    for ids, keys, anchors in _blocks(batches, length):
        slots = repeats.value.slots(anchors.hash)
        use = np.flatnonzero(repeats.value.repeated(slots) & ~repeats.value.too_many(slots))
        if not len(use):
            continue
        place, doc = anchors.place[use], anchors.doc[use]
        begin = np.maximum(place - before, anchors.offsets[doc])
        end = np.minimum(place + after, anchors.offsets[doc + 1])
        raw = anchors.data.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchors.hash[use].view(np.int64)),
                pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()),
                pa.array((place - begin).astype(np.int8)),
                pa.array(ids[doc]),
                pa.array(keys[doc]),
                pa.array((place - anchors.offsets[doc]).astype(np.int32)),
            ],
            ["anchor", "context", "at", "id", "text_key", "place"],
        )


def lcp_intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common-prefix intervals of a suffix array by a stack scan.

    lcp[i] is the common prefix length of entries i - 1 and i, lcp[0] is 0. Gives
    (value, first, last) of every interval with a value of `least` or more.
    """
    values, firsts, lasts = [], [], []
    stack: list[tuple[int, int]] = []
    for i, height in enumerate([*lcp.tolist(), 0]):
        if height < least:
            height = 0
        first = i - 1
        while stack and stack[-1][0] > height:
            value, first = stack.pop()
            values.append(value)
            firsts.append(first)
            lasts.append(i - 1)
        if height and (not stack or stack[-1][0] < height):
            stack.append((height, first))
    return tuple(np.asarray(x, np.int64) for x in (values, firsts, lasts))


def _ranked(rows: np.ndarray, lengths: np.ndarray, groups: np.ndarray | None = None) -> np.ndarray:
    """Order of byte rows (a multiple of 8 wide, zeros behind `lengths`)."""
    columns = rows.view(">u8").astype(np.uint64)
    keys = [lengths, *columns.T[::-1]]
    return np.lexsort(keys if groups is None else [*keys, groups])


def _common(rows: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix lengths of rows a and b."""
    out = np.empty(len(a), np.int64)
    for at in range(0, len(a), 1 << 18):
        x, y = a[at : at + (1 << 18)], b[at : at + (1 << 18)]
        differ = rows[x] != rows[y]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[at : at + len(x)] = np.minimum(first, np.minimum(lengths[x], lengths[y]))
    return out


def _rows(data: np.ndarray, first: np.ndarray, lengths: np.ndarray, width: int, back: bool) -> np.ndarray:
    """Byte rows from (or, with `back`, backwards before) given places, zeros behind."""
    wide = -(-width // 8) * 8
    at = np.arange(wide)
    index = first[:, None] - 1 - at if back else first[:, None] + at
    use = at < lengths[:, None]
    return np.where(use, data[np.where(use, index, 0)] if len(data) else 0, 0).astype(np.uint8)


class _Tree:
    """Common-prefix intervals of the contexts of some anchors, by what follows the
    anchor's start, and the contexts' order by what stands before it."""

    def __init__(self, anchor: np.ndarray, data: np.ndarray, offsets: np.ndarray, at: np.ndarray, length: int):
        n = len(anchor)
        self.length = length
        first = offsets[:-1] + at
        after, self.before = np.minimum(offsets[1:] - first, length), np.minimum(at, length - anchor_size(length))
        right = _rows(data, first, after, length, back=False)
        self.order = _ranked(right, after, anchor)
        self.lcp = np.zeros(n, np.int64)
        self.lcp[1:] = _common(right, after, self.order[:-1], self.order[1:])
        self.lcp[1:][anchor[self.order][1:] != anchor[self.order][:-1]] = 0
        self.value, self.lower, self.upper = lcp_intervals(self.lcp, anchor_size(length))
        self.left = _rows(data, first, self.before, length - anchor_size(length), back=True)
        self.left_rank = np.empty(n, np.int64)
        self.left_rank[_ranked(self.left, self.before)] = np.arange(n)

    def runs(self) -> Iterator[slice]:
        """Intervals with `_MEMBERS` members together, or one. They are nested, so all
        of them may have as many members as contexts times bytes of an anchor's reach."""
        ends = np.cumsum(self.upper - self.lower + 1)
        first, done = 0, 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, done + _MEMBERS, "right")))
            yield slice(first, last)
            first, done = last, int(ends[last - 1])


class Repeats:
    """Maximal repeats in the contexts of some anchors.

    Members of group g are `member[start[g] : end[g]]` (numbers of contexts); the
    repeat begins `left[g]` bytes before and ends `right[g]` bytes after the
    anchor's start. Both are bounded by the contexts: a longer repeat appears
    once for each of its anchors.
    """

    def __init__(self, anchor: np.ndarray, data: np.ndarray, offsets: np.ndarray, at: np.ndarray, length: int):
        self._find(_Tree(anchor, data, offsets, at, length) if len(anchor) > 1 else None, slice(None))

    @classmethod
    def by_runs(cls, anchor: np.ndarray, data: np.ndarray, offsets: np.ndarray, at: np.ndarray, length: int) -> Iterator[Repeats]:
        """The same groups, some intervals' at a time: no group is of two intervals."""
        if len(anchor) < 2:
            return
        tree = _Tree(anchor, data, offsets, at, length)
        for run in tree.runs():
            some = cls.__new__(cls)
            some._find(tree, run)
            yield some

    def _find(self, tree: _Tree | None, run: slice) -> None:
        none = np.zeros(0, np.int64)
        self.member = self.start = self.end = self.left = self.right = none
        if tree is None or not len(tree.value[run]):
            return
        length, value, lower, upper = tree.length, tree.value[run], tree.lower[run], tree.upper[run]
        # All members of the intervals, with the child interval that each is in.
        sizes = upper - lower + 1
        interval = np.repeat(np.arange(len(value)), sizes)
        begin = np.cumsum(sizes) - sizes
        rank = np.arange(len(interval)) - begin[interval] + lower[interval]
        border = (tree.lcp[rank] == value[interval]) & (rank > lower[interval])
        child = np.cumsum(border)
        # The same members by what stands before the anchor.
        member = tree.order[rank]
        by_left = np.lexsort((tree.left_rank[member], interval))
        member, child = member[by_left], child[by_left]
        need = np.maximum(length - value, 0)[interval]
        lcs = np.zeros(len(member), np.int64)
        lcs[1:] = _common(tree.left, tree.before, member[:-1], member[1:]) + 1  # 1: nothing in common before the anchor
        lcs[1:][interval[1:] != interval[:-1]] = 0
        lcs[lcs <= need] = 0  # too short together
        depth, start, end = lcp_intervals(lcs, 1)
        if not len(depth):
            return
        span = np.stack([start, end + 1], axis=1).ravel()
        low = np.minimum.reduceat(np.append(child, child[-1]), span)[::2]
        high = np.maximum.reduceat(np.append(child, child[-1]), span)[::2]
        maximal = low < high  # members go on differently to the right
        self.member, self.start, self.end = member, start[maximal], end[maximal] + 1
        self.left, self.right = depth[maximal] - 1, value[interval[start[maximal]]]

    def expanded(self) -> tuple[np.ndarray, np.ndarray]:
        """(group, member) for all members of all groups."""
        sizes = self.end - self.start
        group = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.cumsum(sizes) - sizes
        return group, self.member[np.arange(len(group)) - begin[group] + self.start[group]]


_TOGETHER = 1 << 14  # contexts that are worked through at once, or one anchor's
_MEMBERS = 1 << 17  # members of intervals that are laid out at once, or one interval's


def _runs(table: pa.Table) -> Iterator[pa.Table]:
    """The contexts of some anchors at a time: a share may hold far more of them
    than the arrays of nested intervals leave room for."""
    order = np.argsort(table.column("anchor").to_numpy(), kind="stable")
    anchor = table.column("anchor").to_numpy()[order]
    ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
    sizes = np.diff(ends, prepend=0)
    ends = ends[sizes > 1]  # an anchor that only shares its filter slot is alone
    begin = ends - sizes[sizes > 1]
    first = 0
    while first < len(ends):
        held = np.cumsum(ends[first:] - begin[first:])
        last = first + max(1, int(np.searchsorted(held, _TOGETHER, "right")))
        use = np.concatenate([order[a:b] for a, b in zip(begin[first:last], ends[first:last], strict=True)])
        yield table.take(pa.array(use)).combine_chunks()
        first = last


def _repeats_of(table: pa.Table, length: int) -> tuple[Iterator[Repeats], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    context = table.column("context").chunk(0)
    _, offsets, data = context.cast(pa.large_binary()).buffers()
    offsets = np.frombuffer(offsets, np.int64)[: len(context) + 1]
    data = np.frombuffer(data, np.uint8)
    at = table.column("at").to_numpy().astype(np.int64)
    runs = Repeats.by_runs(table.column("anchor").to_numpy(), data, offsets, at, length)
    return runs, table.column("id").to_numpy(), table.column("place").to_numpy().astype(np.int64), data, offsets[:-1] + at


def _covered(table: pa.Table, length: int) -> pa.Table:
    """(id, text_key, start, end): for each context what its repeats cover of it,
    where a document with a smaller id has them too."""
    out = [pa.table({name: pa.array([], pa.int64()) for name in _SPAN})]
    for part in _runs(table):
        runs, ids, place, _, _ = _repeats_of(part, length)
        left, right = np.full(len(ids), -1), np.full(len(ids), -1)
        for found in runs:
            if not len(found.start):
                continue
            group, member = found.expanded()
            sizes = found.end - found.start
            smallest = np.minimum.reduceat(ids[member], np.cumsum(sizes) - sizes)
            later = ids[member] > smallest[group]
            np.maximum.at(left, member[later], found.left[group[later]])
            np.maximum.at(right, member[later], found.right[group[later]])
        use = right >= 0  # all cover the anchor, so their union is one span
        keys = part.column("text_key").to_numpy()
        spans = (ids[use], keys[use], (place - left)[use], (place + right)[use])
        out.append(pa.table(dict(zip(_SPAN, spans, strict=True))))
    return pa.concat_tables(out)


_PART = "part binary, length int, id long, text_key long, start int"


def _groups(table: pa.Table, length: int) -> pa.Table:
    """(part, length, id, text_key, start): the maximal repeats of the contexts and
    their occurrences; `part` is a hash of a repeat's bytes."""
    out: list[tuple[list, ...]] = []
    for part in _runs(table):
        runs, ids, place, data, first = _repeats_of(part, length)
        raw, keys = data.tobytes(), part.column("text_key").to_numpy()
        for found in runs:
            if not len(found.start):
                continue
            some = found.member[found.start]  # a member of each group, for its bytes
            begin, size = first[some] - found.left, found.left + found.right
            strings = [raw[a:b] for a, b in zip(begin.tolist(), (begin + size).tolist(), strict=True)]
            # An anchor chosen for a string that reaches beyond the repeat need not be one
            # wherever the repeat is; only those chosen within it have all occurrences.
            offsets = np.concatenate([[0], np.cumsum(size)])
            own = Anchors(np.frombuffer(b"".join(strings), np.uint8), offsets, length)
            within = np.zeros(len(size), bool)
            within[own.doc[own.place == offsets[own.doc] + found.left[own.doc]]] = True
            group, member = found.expanded()
            group, member = group[within[group]], member[within[group]]
            digest = np.asarray([hashlib.blake2b(s, digest_size=16).digest() for s in strings], object)
            out.append((digest[group], size[group], ids[member], keys[member], place[member] - found.left[group]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in (object, int, int, int, int)]
    types = (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    names = [field.split()[0] for field in _PART.split(", ")]
    return pa.table({n: pa.array(c.tolist() if t == pa.binary() else c.astype(np.int64), t) for n, c, t in zip(names, columns, types, strict=True)})


# --- 3. strings around anchors with very many occurrences ----------------------


def _strings(batches: Iterator[pa.RecordBatch], length: int, repeats) -> Iterator[pa.RecordBatch]:
    """(one, two, id, text_key, start): 128 bits for each string of `length` bytes
    whose anchor is not gathered in one group."""
    for ids, keys, anchors in _blocks(batches, length):
        slots = repeats.value.slots(anchors.hash)
        hot = repeats.value.repeated(slots) & repeats.value.too_many(slots)
        place = anchors.window_place[hot[anchors.window_anchor]]
        if not len(place):
            continue
        doc = np.searchsorted(anchors.offsets, place, "right") - 1
        halves = []
        with np.errstate(over="ignore"):
            for salt in (2, 17):
                total = np.zeros(len(place), np.uint64)
                for j, step in enumerate([*range(0, length - 7, 8), length - 8]):
                    total = mix(total ^ anchors.eights[place + step] * _C[(salt + j) % 32])
                halves.append(total.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, halves), pa.array(ids[doc]), pa.array(keys[doc]), pa.array((place - anchors.offsets[doc]).astype(np.int32))],
            ["one", "two", "id", "text_key", "start"],
        )


def _covered_strings(strings: DataFrame, length: int) -> DataFrame:
    """(id, text_key, start, end) of the strings that a document with a smaller id has too."""
    lowest = (
        strings.groupBy("one", "two").agg(F.min("id").alias("lowest"), F.max("id").alias("highest")).where("lowest < highest")
    )
    # Keyed by a struct of its own, so that both sides are exchanged and a string
    # that very many documents have can be split.
    key = F.struct("one", "two")
    return (
        _spread_join(strings.select(key.alias("string"), "id", "text_key", "start"), lowest.select(key.alias("string"), "lowest"), "string")
        .where("id > lowest")
        .select("id", "text_key", F.col("start").cast("long").alias("start"), (F.col("start").cast("long") + length).alias("end"))
    )


def _equal_strings(strings: DataFrame, length: int) -> DataFrame:
    """The strings that two documents have, with all occurrences."""
    shared = strings.groupBy("one", "two").agg(F.min("id").alias("lowest"), F.max("id").alias("highest")).where("lowest < highest")
    key = F.struct("one", "two")
    return _spread_join(
        strings.select(key.alias("string"), "id", "text_key", "start"), shared.select(key.alias("string")), "string"
    ).select("string.*", "id", "text_key", "start")


# --- the operator ----------------------------------------------------------------


def _power_of_two(n: float) -> int:
    return max(0, int(np.ceil(np.log2(max(n, 1)))))


class _Search:
    """The steps up to contexts, shared by the operator's outputs."""

    def __init__(self, rows: DataFrame, length: int, most_together: int):
        """rows: (id, text, text_key) without exact copies."""
        if length < 24:
            raise ValueError("repeats shorter than 24 bytes have no anchors")
        self.rows, self.length = rows, length
        spark = rows.sparkSession
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
        filter_bits = min(max(_power_of_two(size / 4), LEAST_FILTER_BITS), MOST_FILTER_BITS)
        share_bits = min(_power_of_two(max(shuffles, size / 2e7)), filter_bits - 3)
        self.groups = 1 << _power_of_two(max(4 * shuffles, size / 4e6))
        counted = rows.mapInArrow(
            lambda batches: _count_anchors(batches, length, share_bits), "share long, packed binary"
        )
        shares = counted.where(F.octet_length("packed") > 0).groupBy("share").applyInArrow(
            lambda table: _repeated_share(table, share_bits, filter_bits, most_together), "share long, bits binary, hot binary"
        )
        found = RepeatFilter(shares.toLocalIterator(), share_bits, filter_bits)  # 64 MB at most, by shares
        self.any_hot = len(found.hot) > 0
        self.filter = spark.sparkContext.broadcast(found)

    def contexts(self) -> DataFrame:
        length, repeats = self.length, self.filter
        return self.rows.mapInArrow(
            lambda batches: _contexts(batches, length, repeats), "anchor long, context binary, at tinyint, id long, text_key long, place int"
        ).withColumn("share", F.pmod(F.xxhash64("anchor"), F.lit(self.groups)))

    def spans(self) -> DataFrame:
        length = self.length
        spans = self.contexts().groupBy("share").applyInArrow(
            lambda table: _covered(table, length), "id long, text_key long, start long, end long"
        )
        if self.any_hot:
            spans = spans.union(_covered_strings(self.strings(), length))
        return spans

    def strings(self) -> DataFrame:
        length, repeats = self.length, self.filter
        return self.rows.mapInArrow(
            lambda batches: _strings(batches, length, repeats), "one long, two long, id long, text_key long, start int"
        )


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    short_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), text_key(F.col(text_col)).alias("text_key")
    )


def maximal_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", most_together: int = MOST_TOGETHER
) -> DataFrame:
    """Maximal repeats of `length` bytes or more that two documents have, with all
    occurrences: rows of (repeat, length, doc_id, start), where repeat is the SHA-256 of
    its bytes.

    Contexts show a long repeat in parts around its anchors. Parts with the same
    occurrences, but for one shift, that touch or overlap are joined, and each is
    extended to both sides as far as all its occurrences go on alike. So every set of
    occurrences that some context (26 bytes before an anchor to 50 behind it) has
    alone is found whole; a repeat of which every context is also elsewhere, each
    at another place, is not. A repeat with all occurrences in one document may be missing. A null
    text is empty, rows with a null id take no part, rows that repeat an id are told
    apart by the key of their text, and rows that repeat both count once. Texts are
    not changed, an empty table gives no rows.
    """
    rows = _plain(docs, id_col, text_col).where("id is not null").dropDuplicates(["id", "text_key"])
    rows = stored(rows, "texts")
    search = _Search(rows, length, most_together)
    parts = search.contexts().groupBy("share").applyInArrow(lambda table: _groups(table, length), _PART)
    if search.any_hot:
        parts = parts.union(
            _equal_strings(search.strings(), length).select(
                F.concat(F.hex("one"), F.hex("two")).cast("binary"), F.lit(length), "id", "text_key", "start"
            )
        )
    return _whole(stored(parts.distinct(), "parts"), rows)


def _whole(parts: DataFrame, rows: DataFrame) -> DataFrame:
    """Parts of repeats joined to whole ones.

    What tells occurrences apart is a combined hash of their places relative to the
    first one, so no part's occurrences are gathered.
    """
    first = parts.groupBy("part", "length").agg(F.min(F.struct("id", "text_key", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    placed = _spread_join(parts, first.drop("length"), "part").withColumn("shift", F.col("start") - F.col("first.start"))
    shapes = placed.groupBy("part", "length", "first", "n").agg(
        F.bit_xor(F.xxhash64("id", "text_key", "shift")).alias("shape"),
        F.bit_xor(F.xxhash64("shift", "text_key", "id", F.lit(1))).alias("shape2"),
    )
    by = Window.partitionBy("first.id", "first.text_key", "n", "shape", "shape2").orderBy("first.start", "length", "part")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    # A part that begins behind the end of all before it begins another repeat.
    begins = F.coalesce(F.col("first.start") > F.max(F.col("first.start") + F.col("length")).over(before), F.lit(True))
    runs = shapes.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(by))
    whole = (
        runs.groupBy("first.id", "first.text_key", "n", "shape", "shape2", "run")
        .agg(
            F.min(F.struct("first.start", "part")).alias("some"),
            F.max(F.col("first.start") + F.col("length")).alias("end"),
        )
        .select(
            "id", "text_key", F.col("some.start").alias("at"), F.col("some.part").alias("part"),
            (F.col("end") - F.col("some.start")).alias("whole_length"),
        )
    )
    # The leftmost part begins where the whole does, so its occurrences are those of the whole.
    joined = stored(whole, "runs")
    texts = [rows.select(F.col("id").alias(f"{x}id"), F.col("text_key").alias(f"{x}key"), F.col("text").alias(f"{x}text")) for x in ("", "other_")]
    both = (
        _spread_join(parts.select("part", F.col("id").alias("other_id"), F.col("text_key").alias("other_key"), "start"), joined, "part")
        .withColumnRenamed("text_key", "key")
        .join(texts[0], ["id", "key"])
        .join(texts[1], ["other_id", "other_key"])
        .select("part", "at", "start", F.col("whole_length").alias("length"), "text", "other_text")
    )
    extended = (
        both.mapInArrow(_extensions, "part binary, before int, behind int")
        .groupBy("part")
        .agg(F.min("before").alias("before"), F.min("behind").alias("behind"))
    )
    # Parts of one repeat that lie apart are the same when they are extended.
    found = (
        joined.join(extended, "part")
        .withColumns({"at": F.col("at") - F.col("before"), "whole_length": F.col("whole_length") + F.col("before") + F.col("behind")})
        .groupBy("id", "text_key", "at", "whole_length")
        .agg(F.min(F.struct("part", "before")).alias("some"))
    )
    named = stored(
        found.join(rows, ["id", "text_key"]).select(
            "some.part", "some.before", "whole_length",
            F.sha2(F.substring(F.col("text").cast("binary"), F.col("at") + 1, F.col("whole_length")), 256).alias("repeat"),
        ),
        "repeats",
    )
    return _spread_join(parts.drop("length"), named, "part").select(
        "repeat", F.col("whole_length").alias("length"), F.col("id").alias("doc_id"), (F.col("start") - F.col("before")).alias("start")
    )


def _alike(a: np.ndarray, b: np.ndarray) -> int:
    """How many bytes two arrays begin with alike."""
    n = min(len(a), len(b))
    at, step = 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : min(at + step, n)] != b[at : min(at + step, n)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, 2 * step
    return n


def _extensions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, before, behind): how far an occurrence goes on like the first one."""
    for batch in batches:
        before, behind = [], []
        places = zip(*(batch.column(c).to_pylist() for c in ("at", "start", "length")), strict=True)
        for (at, start, length), one, other in zip(places, batch.column("text"), batch.column("other_text"), strict=True):
            a, b = (np.frombuffer((t.as_py() or "").encode(), np.uint8) for t in (one, other))
            before.append(_alike(a[:at][::-1], b[:start][::-1]))
            behind.append(_alike(a[at + length :], b[start + length :]))
        # The first one goes on like itself, which bounds nothing: its other occurrences do.
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), pa.array(before, pa.int32()), pa.array(behind, pa.int32())], ["part", "before", "behind"]
        )


def covered_spans(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", most_together: int = MOST_TOGETHER
) -> DataFrame:
    """(id, text_key, spans): for each document the byte spans covered by a string of
    `length` bytes that a document with a smaller id has too; spans may overlap
    and reach beyond the text's end. Documents without any are left out; those that
    repeat an id are told apart by the key of their text."""
    rows = _plain(docs, id_col, text_col).where("id is not null")
    digests = stored(
        rows.select(F.struct("id", "text_key").alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")), "digests"
    )
    copies = stored(
        copy_groups(digests).where("id.id > smallest.id").select("id.*").distinct(), "copies"
    )
    search = _Search(without_rows(rows, copies, "id", F.col("text_key")), length, most_together)
    spans = search.spans().union(copies.select("id", "text_key", F.lit(0).cast("long"), F.lit(_WHOLE)))
    found = stored(
        spans.groupBy("id", "text_key").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans"
    )
    discard(digests, copies)
    return found


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`docs` as (row, spans): rows outside the filter of ids with spans pass
    without a shuffle."""
    key = text_key(docs[f"`{text_col}`"])
    packed = docs.select(F.col(id_col).cast("long").alias("id"), key.alias("text_key"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    asked = bitmaps.maybe_in(packed, F.col("id"), bitmaps.members(spans, "id"), "maybe")
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    straight = asked.where("not maybe").select("row", none.alias("spans"))
    tested = asked.where("maybe").join(spans, ["id", "text_key"], "left").select("row", "spans")
    return straight.union(tested)


def _merge(spans: list[dict] | None, n: int, length: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    if n >= length:
        for a, b in sorted((s["start"], min(s["end"], n)) for s in spans or ()):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
    return [tuple(s) for s in out]


def _cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept)


def _judged(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) as the digest columns."""
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column(1), batch.column(2), strict=True):
            data = (text.as_py() or "").encode()
            merged = _merge(spans.as_py(), len(data), length)
            removed = sum(b - a for a, b in merged)
            rows.append((len(data), removed, len(merged), hashlib.sha256(_cut(data, merged)).hexdigest()))
        n, removed, runs, sha = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def judge_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are their UTF-8 bytes. A byte is removed if a string of `length` bytes
    over it also starts in a document with a smaller id, judged on the texts as
    they came. A null text is empty; of rows that repeat an id none is smaller, each
    is judged by its own text; a row with a null id keeps everything and
    counts for nobody. Other columns are ignored, an empty table gives no rows.
    """
    joined = _with_spans(docs, covered_spans(docs, length, id_col, text_col), id_col, text_col)
    rows = joined.select(
        F.col("row").getField(id_col).cast("long").alias("doc_id"), F.col("row").getField(text_col).cast("string").alias("text"), "spans"
    )
    return rows.mapInArrow(
        lambda batches: _judged(batches, length),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without the parts of characters that they hold in part."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _cut_texts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(text, spans, row) as (row, text, changed): null stays null."""
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(0), batch.column(1), strict=True):
            if not text.is_valid or not spans.is_valid:
                texts.append(text.as_py())
                continue
            data = text.as_py().encode()
            texts.append(_cut(data, _whole_characters(data, _merge(spans.as_py(), len(data), length))).decode())
        yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(texts, pa.string())], ["row", "text"])


def drop_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars"
) -> DataFrame:
    """All documents with all their columns, their texts without repeated passages.

    A character of several bytes goes only if all its bytes do. `chars_col`, if
    the table has it, becomes the new number of characters.
    """
    joined = _with_spans(docs, covered_spans(docs, length, id_col, text_col), id_col, text_col)
    cut = joined.select(F.col("row").getField(text_col).cast("string").alias("text"), "spans", "row")
    # The text travels once: the row goes without it.
    rest = F.struct(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != text_col])
    schema = cut.select(rest.alias("row"), "text").schema
    done = cut.select("text", "spans", rest.alias("row")).mapInArrow(lambda batches: _cut_texts(batches, length), schema)
    columns = []
    for field in docs.schema:
        if field.name == text_col:
            columns.append(F.col("text").alias(text_col))
        elif field.name == chars_col:
            own = F.col("row").getField(chars_col)
            columns.append(F.when(F.col("text").isNull(), own).otherwise(F.length("text")).cast(field.dataType).alias(chars_col))
        else:
            columns.append(F.col("row").getField(field.name).alias(field.name))
    return done.select(*columns)
