"""Encoding and decoding with the pieces of a public SentencePiece model.

Words of one length advance together through a lattice held in numpy arrays: at
each position the substrings that end there are looked up by their hash among
the sorted keys of the pieces, each candidate is scored against the best path to
its start, and the maximum stores a backpointer.

The model is of the BPE kind, where a path is not scored by a sum: a sequence is
the encoding of its text exactly if each two neighbours are the encoding of
theirs. So a step is worth the piece's length if it agrees with the piece before
it and minus infinity if not. At most one candidate agrees at each position, and
the result is what the merges give.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.llm.workers import kept, short_batches

SPACE = "▁"
_START = -1  # before the first piece, and in place of a character without a piece
_LONGEST = 128  # characters of a word that goes through the lattice
_CACHE_BYTES = 200 << 20  # of one worker; a full cache is emptied, which changes no ids
_ENTRY_BYTES = 200
_HELD_BYTES = 1 << 20
_WORDS = 4096
_SEGMENT = regex.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 20  # of the tables that answer most questions before a search or a dictionary does


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys * _SPREAD >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


class PieceModel:
    """Pieces, scores and kinds of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.pieces = {i: model.id_to_piece(i) for i in range(n) if i not in special and not model.is_byte(i)}
        self.ids = {p: i for i, p in self.pieces.items()}
        self.score = {p: model.get_score(i) for i, p in self.pieces.items()}
        self.bytes_of = {i: b for b, i in self.byte.items()}
        self.longest = max(map(len, self.ids))
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("pieces across words are not supported")
        keys = {self.key(p): i for p, i in self.ids.items()}
        self.keys = np.sort(np.fromiter(keys, np.uint64, len(keys)))
        self.key_ids = np.asarray([keys[int(k)] for k in self.keys], np.int64)
        self.maybe = np.zeros(1 << _SLOT_BITS, bool)  # whether a piece may have a key of this slot
        self.maybe[_slots(self.keys)] = True
        self.agrees: dict[int, bool] = {}
        # The last pair asked for in each slot, and whether it agrees.
        self.pairs, self.answers = np.full(1 << _SLOT_BITS, -1), np.zeros(1 << _SLOT_BITS, bool)

    @staticmethod
    def key(text: str) -> int:
        total = 0
        for c in text:
            total = (total * int(_BASE) + ord(c) + 1) & (1 << 64) - 1
        return total

    def merge(self, text: str) -> list[str]:
        """The merges of BPE one after another, the best pair first, the leftmost
        among equals: for pairs of pieces, and for words too long for the lattice."""
        symbols: list[str | None] = list(text)
        after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(a: int) -> None:
            b = after[a]
            if a >= 0 and b < len(symbols) and (both := symbols[a] + symbols[b]) in self.score:
                heapq.heappush(heap, (-self.score[both], a, both))

        for i in range(len(text) - 1):
            offer(i)
        while heap:
            _, a, both = heapq.heappop(heap)
            b = after[a]
            if symbols[a] is None or b >= len(symbols) or symbols[a] + symbols[b] != both:
                continue
            symbols[a], symbols[b] = both, None
            after[a] = after[b]
            if after[b] < len(symbols):
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [s for s in symbols if s is not None]

    def ids_of(self, symbols: Iterable[str]) -> list[int]:
        out = []
        for s in symbols:
            if s in self.ids:
                out.append(self.ids[s])
            else:
                out += [self.byte[b] for b in s.encode()]
        return out

    def place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces with these keys stand, and whether there are any."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces is the encoding of its text; a left one of
        _START asks the same of the right one alone."""
        keys = (left + 1) * (1 << 32) + right
        slots = _slots(keys.view(np.uint64))
        out = self.answers[slots]
        new = np.flatnonzero(self.pairs[slots] != keys)
        if len(new):
            out[new] = self._compatible(keys[new])
            # Pairs of one slot may come together: it keeps the answer of the one it holds.
            self.pairs[slots[new]] = keys[new]
            held = new[self.pairs[slots[new]] == keys[new]]
            self.answers[slots[held]] = out[held]
        return out

    def _compatible(self, pairs: np.ndarray) -> np.ndarray:
        keys, place = np.unique(pairs, return_inverse=True)
        answers = []
        for key in keys.tolist():
            answer = self.agrees.get(key)
            if answer is None:
                a, b = (key >> 32) - 1, key & 0xFFFFFFFF
                pair = [self.pieces[b]] if a == _START else [self.pieces[a], self.pieces[b]]
                answer = self.agrees[key] = self.merge("".join(pair)) == pair
            answers.append(answer)
        return np.asarray(answers, bool)[place]


def lattice(model: PieceModel, words: list[str]) -> list[bytes]:
    """Ids of words that all have the same number of characters."""
    n, count = len(words[0]), len(words)
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(count, n).astype(np.uint64)
    total = np.zeros((n + 1, count), np.uint64)
    power = np.asarray([pow(int(_BASE), i, 1 << 64) for i in range(n + 1)], np.uint64)
    for i in range(n):
        total[i + 1] = total[i] * _BASE + chars[:, i] + np.uint64(1)
    back = np.zeros((n + 1, count), np.int64)  # length of the last piece of the best path to here
    last = np.full((n + 1, count), _START, np.int64)  # and its id
    for end in range(1, n + 1):
        best = np.full(count, -1)
        for size in range(min(end, model.longest), 0, -1):
            key = total[end] - total[end - size] * power[size]
            rows = np.flatnonzero(model.maybe[_slots(key)])
            # A path to the start of the piece exists if something ends there.
            rows = rows[(best[rows] < size) & ((back[end - size, rows] > 0) | (end == size))]
            at, hit = model.place(key[rows])
            rows, at = rows[hit], at[hit]
            if len(rows):
                ids = model.key_ids[at]
                good = model.compatible(last[end - size, rows], ids)
                rows, ids = rows[good], ids[good]
                best[rows], back[end, rows], last[end, rows] = size, size, ids
            if size == 1:
                # A character without a piece stands alone, between any two others.
                alone = np.flatnonzero(best < 0)
                alone = alone[~model.place(key[alone])[1]]
                back[end, alone], last[end, alone] = 1, _START
    on_path = np.zeros((n + 1, count), bool)
    ends, left = np.full(count, n), np.arange(count)
    while len(left):
        on_path[ends[left], left] = True
        ends[left] -= back[ends[left], left]
        left = left[ends[left] > 0]
    ids = last.T[on_path.T]
    bounds = np.cumsum(np.append(0, on_path.sum(0))).tolist()
    data = ids.astype("<u4").tobytes()
    out = [data[4 * a : 4 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for w in np.flatnonzero(((last == _START) & on_path).any(0)).tolist():
        ends_of = np.flatnonzero(on_path[:, w]).tolist()
        parts = [[i] if i != _START else model.ids_of([words[w][end - 1]]) for i, end in zip(ids[bounds[w] : bounds[w + 1]].tolist(), ends_of, strict=True)]
        out[w] = np.asarray([i for part in parts for i in part], "<u4").tobytes()
    return out


class PieceEncoder:
    """Ids as little-endian unsigned 32-bit bytes; a worker keeps those of the words it met."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self._known: dict[str, bytes] = {}
        self._bytes = 0

    def _learn(self, missing: set[str], every: set[str]) -> None:
        if self._bytes > _CACHE_BYTES:
            self._known, self._bytes = {}, 0
            self.model.agrees.clear()
            missing = every
        by_length = defaultdict(list)
        for word in missing:
            # Runs of blanks have pieces of one score, where the leftmost merge decides.
            through = len(word) <= _LONGEST and SPACE * 2 not in word
            by_length[len(word) if through else 0].append(word)
        for length, words in by_length.items():
            if length:
                found = [ids for at in range(0, len(words), _WORDS) for ids in lattice(self.model, words[at : at + _WORDS])]
            else:
                found = [np.asarray(self.model.ids_of(self.model.merge(w)), "<u4").tobytes() for w in words]
            self._known.update(zip(words, found, strict=True))
        self._bytes += sum(map(len, missing)) * 4 + _ENTRY_BYTES * len(missing)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text; None counts as empty and has none."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(_SEGMENT.findall(SPACE + text.replace(" ", SPACE)) if text else [])
            size += len(text or "")
            if size >= _HELD_BYTES or len(held) >= 512:
                yield from self._ids(held)
                held, size = [], 0
        yield from self._ids(held)

    def _ids(self, held: list[list[str]]) -> Iterator[bytes]:
        words = set().union(*held)
        missing = words.difference(self._known)
        if missing:
            self._learn(missing, words)
        known = self._known.__getitem__
        for text in held:
            yield b"".join(map(known, text))


class PieceDecoder:
    def __init__(self, model: PieceModel):
        size = max(*model.pieces, *model.bytes_of) + 1
        self._bytes = [b""] * size
        for i, piece in model.pieces.items():
            self._bytes[i] = piece.replace(SPACE, " ").encode()
        for i, byte in model.bytes_of.items():
            self._bytes[i] = bytes([byte])

    def decode(self, ids: bytes) -> str:
        """The text of some ids, without the blank that encoding puts in front."""
        data = b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.removeprefix(b" ").decode(errors="replace")


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = kept(PieceEncoder, path)
    for batch in batches:
        ids = list(encoder.encode(t.as_py() for t in batch.column(1)))
        offsets = np.cumsum([0, *(len(x) // 4 for x in ids)])
        values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))], ["doc_id", "ids"]
        )


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    decoder = PieceDecoder(PieceModel(path))
    for batch in batches:
        texts = [decoder.decode(np.asarray(x.as_py() or [], "<u4").tobytes()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = kept(PieceEncoder, path)
    decoder = PieceDecoder(encoder.model)
    for batch in batches:
        texts = batch.column(1).to_pylist()
        rows = []
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            # A blank and its sign in a text have the same piece, and are blanks when decoded.
            same = decoder.decode(ids) == (text or "").replace(SPACE, " ")
            rows.append((len(ids) // 4, zlib.crc32(ids), same))
        n, crc, same = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
            ["doc_id", "n_ids", "ids_crc32", "round_trip"],
        )


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    short_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of whole texts; `model` is the path of a model file.

    Nothing shuffles. A null or empty text has no ids, repeated rows are encoded
    alike, other columns are ignored, an empty table gives no rows.
    """
    return _plain(docs, id_col, text_col).mapInArrow(lambda batches: _encoded(batches, model), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from ids; null or empty ids give an empty text."""
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(lambda batches: _decoded(batches, model), "doc_id long, text string")


def encode_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_ids, ids_crc32 (of the ids as little-endian
    unsigned 32-bit numbers) and round_trip, whether decoding gives the text back."""
    return _plain(docs, id_col, text_col).mapInArrow(
        lambda batches: _digests(batches, model), "doc_id long, n_ids long, ids_crc32 long, round_trip boolean"
    )
