"""Prediction by partial matching over bytes, with a word model for comparison.

A text is its words (A-Z lower-cased) with one blank between two of them and an
end symbol. The model is the trie of all byte contexts of up to `ORDER` bytes
in the training texts. A symbol is predicted in the longest context; where it
was not seen there the model escapes to the next shorter one, with escape
estimate t / 2 n (n symbols seen, t of them distinct; a symbol seen c times has
(2 c - 1) / 2 n) and with the symbols of the longer context excluded.

The trie grows with the corpus and is never in one place. Its deepest level is
a table of (context and symbol, count) rows; contexts that end in the same
three bytes are worked out in one group, which 2 ** 24 rows can share at most,
and the levels of two bytes and less, 2 ** 24 entries at most, are broadcast. Texts meet the
code lengths they need in chunks: a chunk asks for its distinct words and
context-symbol pairs, and the answers are joined back to it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.llm.workers import short_batches
from covshare.sources.scratch import stored

ORDER = 5
END = 0xFF  # never a byte of UTF-8; also what stands before a text
_BLOCK = 1 << 20
_CHUNK_BYTES = 32 << 20
_LEAST_CHUNK_BYTES = 1 << 20
_BATCH_ROWS = 1 << 16
_MOST_WORDS = 300_000  # held in a task before counts are handed on
_MOST_GRAMS = 2_000_000
_LOW = 24  # bits of the context and symbol of the broadcast levels
_LOG10 = math.log(10)
_SHARE_GRAMS = 1 << 19  # worked out together, about; contexts that share three bytes are never parted
_NO_WORD, _NO_GRAM = b"", -1  # in the column that a row of the other kind leaves open


def _normal(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # at [\x20\x09-\x0D], as it is bytes


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each symbol's context and itself as one
    number, and how many symbols each text has, its end included."""
    pad = bytes([END]) * ORDER
    data = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8)
    lengths = np.asarray([len(t) + 1 for t in texts], np.int64)
    n = len(data) - ORDER
    if n <= 0:
        return np.zeros(0, np.int64), lengths
    grams = np.zeros(n, np.int64)
    for i in range(ORDER + 1):
        grams <<= 8
        grams |= data[i : i + n]
    ends = np.cumsum(lengths + ORDER)
    inside = np.ones(n, bool)
    for i in range(ORDER):  # windows that begin in one text and end in the padding of the next
        inside[(ends[:-1] - ORDER + i)] = False
    return grams[inside], lengths


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bool], list[list[bytes]], list[bytes]]]:
    """Documents in blocks of some MB: ids, training flags, words, normal texts."""
    ids, train, words, texts, size = [], [], [], [], 0
    for batch in batches:
        for i, t, text in zip(batch.column("id").to_pylist(), batch.column("train").to_pylist(), batch.column("text"), strict=True):
            w = _normal(text.as_py())
            joined = b" ".join(w)
            ids.append(i)
            train.append(t)
            words.append(w)
            texts.append(joined)
            size += len(joined) + ORDER + 1
            if size >= _BLOCK:
                yield ids, train, words, texts
                ids, train, words, texts, size = [], [], [], [], 0
    if ids:
        yield ids, train, words, texts


def _add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _rows(words: list[bytes], word_counts: list[int], grams: np.ndarray, gram_counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of (word, gram, n): a word with _NO_GRAM, or _NO_WORD with a gram. Batches
    are short, as the executor holds each beside what it makes of it."""
    for at in range(0, len(words), _BATCH_ROWS):
        some = words[at : at + _BATCH_ROWS]
        columns = [pa.array(some, pa.binary()), pa.array(np.full(len(some), _NO_GRAM)), pa.array(word_counts[at : at + _BATCH_ROWS], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["word", "gram", "n"])
    for at in range(0, len(grams), _BATCH_ROWS):
        some = grams[at : at + _BATCH_ROWS]
        columns = [pa.repeat(pa.scalar(_NO_WORD, pa.binary()), len(some)), pa.array(some), pa.array(gram_counts[at : at + _BATCH_ROWS])]
        yield pa.RecordBatch.from_arrays(columns, ["word", "gram", "n"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a task's training texts and the grams of all its texts with
    their counts in training texts, 0 for those of other texts only."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    words: Counter[bytes] = Counter()
    for _, train, found, texts in _texts(batches):
        for w, flag in zip(found, train, strict=True):
            if flag:
                words.update(w)
        for flag in (True, False):
            grams, n = _distinct(_grams([t for t, f in zip(texts, train, strict=True) if f is flag])[0])
            keys, counts = np.concatenate([keys, grams]), np.concatenate([counts, n * flag])
        if len(keys) > _MOST_GRAMS:
            keys, counts = _add_up(keys, counts)
            if len(keys) > _MOST_GRAMS // 2:
                yield from _rows([], [], keys, counts)
                keys, counts = keys[:0], counts[:0]
        if len(words) > _MOST_WORDS:
            yield from _rows(list(words), list(words.values()), keys[:0], counts[:0])
            words.clear()
    yield from _rows(list(words), list(words.values()), *_add_up(keys, counts))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    ordered = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[first], np.diff(np.append(first, len(ordered)))


class LowLevels:
    """Contexts of two bytes and less: for symbols not predicted higher up.

    Built from (two bytes and symbol, count) rows, of which there are 2 ** 24 at
    most. `escape` gives the probability of symbols in a context, with those
    seen in the context one byte longer excluded.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """keys ascending."""
        self.tables = []  # by order 2, 1, 0: keys, counts, and per context its totals and distinct symbols
        for order in (2, 1, 0):
            keys, counts = _add_up(keys & ((1 << 8 * (order + 1)) - 1), counts)
            n = np.bincount(keys >> 8, counts, 1 << 8 * order)
            t = np.bincount(keys >> 8, minlength=1 << 8 * order)
            self.tables.append((keys, counts, n, t))
        # What exclusion takes from a context of order 1 and 0 after an escape from the one above.
        self.excluded = [None, self._taken(1), self._taken(2)]

    def _taken(self, level: int) -> np.ndarray:
        above, _, n, _ = self.tables[level - 1]
        order = 2 - level
        lower = above & ((1 << 8 * (order + 1)) - 1)
        return np.bincount(above >> 8, self.count(level, lower), len(n))

    def count(self, level: int, keys: np.ndarray) -> np.ndarray:
        table, counts, _, _ = self.tables[level]
        if not len(table):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, counts[at], 0)

    def log_probability(self, key: np.ndarray, taken: np.ndarray, distinct: np.ndarray) -> np.ndarray:
        """Natural logarithms for (two bytes and symbol) keys; `taken` and
        `distinct` are the count and number of the symbols that are excluded."""
        out = np.zeros(len(key))
        open_ = np.ones(len(key), bool)
        for level, order in enumerate((2, 1, 0)):
            low = key & ((1 << 8 * (order + 1)) - 1)
            _, _, n, t = self.tables[level]
            context = low >> 8
            count = self.count(level, low)
            left, kinds = n[context] - taken, t[context] - distinct
            out, open_ = step(out, open_, count, left, kinds)
            seen = t[context] > 0
            distinct = np.where(seen, t[context], distinct)
            if level < 2:
                taken = np.where(seen, self.excluded[level + 1][context], 0)
        out[open_] -= np.log(256 - distinct[open_])
        return out


def step(out: np.ndarray, open_: np.ndarray, count: np.ndarray, left: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One context for all rows that are still open: code those whose symbol was
    seen there, let the others escape; a context without further symbols does neither."""
    out = out.copy()
    usable = open_ & (kinds > 0)
    coded = usable & (count > 0)
    out[coded] += np.log((2 * count[coded] - 1) / (2 * left[coded]))
    escaped = usable & ~coded
    out[escaped] += np.log(kinds[escaped] / (2 * left[escaped]))
    return out, open_ & ~coded


def code_lengths(grams: np.ndarray, counts: np.ndarray, low: LowLevels) -> np.ndarray:
    """Natural logarithm of each gram's probability: its last byte after those
    before it. Needs all grams of the training texts with the same three bytes
    before the last."""
    out, open_ = np.zeros(len(grams)), np.ones(len(grams), bool)
    taken = distinct = np.zeros(len(grams))
    keys, of_key = np.unique(grams, return_inverse=True)
    n_key = np.bincount(of_key, counts, len(keys))
    for order in range(ORDER, _LOW // 8 - 1, -1):
        contexts, of_context = np.unique(keys >> 8, return_inverse=True)
        n = np.bincount(of_context, n_key, len(contexts))
        t = np.bincount(of_context, n_key > 0, len(contexts))
        context = of_context[of_key]
        out, open_ = step(out, open_, n_key[of_key], n[context] - taken, t[context] - distinct)
        # The next shorter context, and what excluding this one's symbols takes from it.
        shorter, to_shorter = np.unique(keys & ((1 << 8 * order) - 1), return_inverse=True)
        n_shorter = np.bincount(to_shorter, n_key, len(shorter))
        below = n_shorter if order > _LOW // 8 else low.count(0, shorter)
        taken = np.bincount(of_context, np.where(n_key > 0, below[to_shorter], 0), len(contexts))[context]
        distinct = t[context]
        keys, of_key, n_key = shorter, to_shorter[of_key], n_shorter
    out[open_] += low.log_probability(keys[of_key][open_], taken[open_], distinct[open_])
    return out


def _asked(table: pa.Table) -> pa.Table:
    """(chunk, word, gram): the distinct words and grams of a chunk."""
    words: set[bytes] = set()
    held, size = [np.zeros(0, np.int64)], 0
    for _, _, found, texts in _texts(iter(table.to_batches())):
        words.update(*found)
        held.append(_distinct(_grams(texts)[0])[0])
        size += len(held[-1])
        if size > 2 * _MOST_GRAMS:
            held, size = [_distinct(np.concatenate(held))[0]], 0
    keys, _ = _distinct(np.concatenate(held))
    chunk = table.column("chunk")[0].as_py()
    schema = pa.schema([("chunk", pa.int64()), ("word", pa.binary()), ("gram", pa.int64())])
    rows = [
        pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, chunk)), batch.column("word"), batch.column("gram")], schema=schema)
        for batch in _rows(list(words), [0] * len(words), keys, np.zeros(len(keys), np.int64))
    ]
    return pa.Table.from_batches(rows, schema)


class Lookup:
    """Values by key for keys that are all there: a table of where the keys of a
    hash begin, which takes fewer steps than a search among all of them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(1, (2 * len(keys)).bit_length()))
        slots = self._slot(keys)
        order = np.argsort(slots, kind="stable")
        self.keys, self.values = keys[order], values[order]
        counts = np.bincount(slots, minlength=1 << 64 - int(self.shift))
        self.begin = (np.cumsum(counts) - counts).astype(np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self.begin[self._slot(keys)]
        other = np.flatnonzero(self.keys[at] != keys)
        while len(other):
            at[other] += 1
            if at.max() >= len(self.keys):
                raise KeyError("a key that is not in the table")
            other = other[self.keys[at[other]] != keys[other]]
        return self.values[at]


def _score_chunk(docs: pa.Table, answers: pa.Table, total: int, distinct: int, ends: int) -> pa.Table:
    is_word = pc.equal(answers.column("gram"), _NO_GRAM)
    gram_rows, word_rows = answers.filter(pc.invert(is_word)), answers.filter(is_word)
    lengths = Lookup(gram_rows.column("gram").to_numpy(), gram_rows.column("value").to_numpy())
    known = dict(zip(word_rows.column("word").to_pylist(), (word_rows.column("value").to_numpy() + 1).tolist(), strict=True))
    base_unit = math.log10(total + distinct + 1)
    out: dict[str, list] = {k: [] for k in ("id", "train", "n_tokens", "n_known", "base_score", "score")}
    for ids, train, words, texts in _texts(iter(docs.to_batches())):
        keys, sizes = _grams(texts)
        scores = np.add.reduceat(lengths[keys], np.cumsum(sizes) - sizes) / _LOG10
        out["id"] += ids
        out["train"] += train
        out["score"] += scores.tolist()
        for w in words:
            counts = np.fromiter(map(known.get, w, [1.0] * len(w)), float, len(w))
            out["n_tokens"].append(len(w) + 1)
            out["n_known"].append(int((counts > 1).sum()) + (ends > 0))
            out["base_score"].append(float(np.log10(counts).sum() + math.log10(ends + 1) - (len(w) + 1) * base_unit))
    return pa.table(
        {
            "doc_id": pa.array(out["id"], pa.int64()),
            "held_out": pa.array([not t for t in out["train"]], pa.bool_()),
            "n_tokens": pa.array(out["n_tokens"], pa.int64()),
            "n_known": pa.array(out["n_known"], pa.int64()),
            "train_tokens": pa.array([total] * len(out["id"]), pa.int64()),
            "base_score": pa.array(out["base_score"], pa.float64()),
            "score": pa.array(out["score"], pa.float64()),
        }
    )


SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_documents(
    docs: DataFrame, folds: int = 7, held_out_fold: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Documents whose crc32 of the id as text leaves `held_out_fold` on division
    by `folds` are held out; all others train both models. base_score adds
    log10((c + 1) / (N + V + 1)) over the words and one end; score is the log10
    probability of the words with single blanks and an end, by the byte model.
    A null text is empty: only its end is scored. A null id counts as an empty
    text for the fold. Rows that repeat train and are scored as often as they
    occur, other columns are ignored, an empty table gives no rows, and without
    training documents every symbol is equally likely. White space is scored as
    single blanks between words, whatever it was.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rest = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        (rest != held_out_fold).alias("train"),
    )
    size, ends = rows.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.when(F.col("train"), 1))
    ).first()
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, -(-size // _CHUNK_BYTES), min(shuffles, size // _LEAST_CHUNK_BYTES))

    counts = stored(
        rows.mapInArrow(_count, "word binary, gram long, n long").groupBy("word", "gram").agg(F.sum("n").alias("n")), "counts"
    )
    is_word = F.col("gram") == _NO_GRAM
    words, grams = counts.where(is_word), counts.where(~is_word).select("gram", "n")
    total, distinct, n_grams = counts.agg(
        F.coalesce(F.sum(F.when(is_word, F.col("n"))), F.lit(0)), F.count(F.when(is_word, 1)), F.count(F.when(~is_word, 1))
    ).first()
    total, distinct = total + ends, distinct + (ends > 0)

    # 2 ** 24 rows at most, whatever the corpus.
    low_rows = (
        grams.where("n > 0").groupBy(F.col("gram").bitwiseAND((1 << _LOW) - 1).alias("key")).agg(F.sum("n").alias("n")).toArrow()
    )
    low = spark.sparkContext.broadcast(LowLevels(low_rows.column("key").to_numpy(), low_rows.column("n").to_numpy()))

    def lengths(table: pa.Table) -> pa.Table:
        keys = table.column("gram").to_numpy()
        return pa.table({"gram": keys, "value": code_lengths(keys, table.column("n").to_numpy(), low.value)})

    # Contexts that end in the same three bytes stay together.
    context = F.shiftright("gram", 8).bitwiseAND((1 << 24) - 1)
    shares = max(4 * shuffles, -(-n_grams // _SHARE_GRAMS))
    coded = (
        grams.withColumn("share", F.pmod(F.xxhash64(context), F.lit(shares)))
        .groupBy("share")
        .applyInArrow(lengths, "gram long, value double")
    )
    values = words.select("word", "gram", F.col("n").cast("double").alias("value")).union(
        stored(coded, "lengths").select(F.lit(_NO_WORD).alias("word"), "gram", "value")
    )

    # By text too: an id may be missing, or that of many rows.
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))
    answers = (
        dealt.groupBy("chunk")
        .applyInArrow(_asked, "chunk long, word binary, gram long")
        .join(values, ["word", "gram"])
        .select("chunk", "word", "gram", "value")
    )
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda docs_of, answers_of: _score_chunk(docs_of, answers_of, total, distinct, ends), SCHEMA
    )
