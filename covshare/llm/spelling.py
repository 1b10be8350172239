"""Spelling variants of a corpus vocabulary by FM-index search schemes.

Two words are near if one inserted, deleted or replaced code point makes one of
the other. With L code points in the shorter word, the error leaves one half
whole: the words share their first L div 2 code points, or else their last ones.
That gives two searches. One matches the first half exactly and extends to the
right across the rest, allowing one error there; the other matches the second
half and extends to the left. Both halves end at a delimiter, so each search
runs in one direction from the start: to the left in the index of the delimited
words, to the right in that of the reversed ones. A search state is an interval
of suffix ranks, and all words of one length take each step together.

The vocabulary grows with the corpus and is never in one place. Words meet by
the half they must share: each is indexed under its own halves, and shards of
bounded size hold the index of all words whose halves fall into them. A half
that more words share than a shard may hold is split into several indexes, and
the words that ask for it are searched in each.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covshare.llm.runs import runs
from covshare.llm.workers import short_batches
from covshare.operators.joins import split_join
from covshare.sources.scratch import stored

LEAST_LENGTH = 5
LEAST_COUNT = 3
SLIP_EVERY = 97
_WORDS_IN_INDEX = 40_000
_MOST_WORDS = 400_000  # held in a task before counts are handed on

# Latin-1 bytes: letters as they are with A-Z lower-cased, all others a blank.
_LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_RUNS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256))
_CODE = np.zeros(256, np.uint8)  # 0 is the delimiter
_CODE[_LETTERS] = np.arange(1, len(_LETTERS) + 1)
_BITS = 7
_PACKED = 9  # codes of _BITS bits in a sort key


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def _count_words(batches: Iterator[pa.RecordBatch], slip_every: int, least_length: int) -> Iterator[pa.RecordBatch]:
    """(word, occurrences) of a task, after the slips."""
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        kept = [(w.decode("latin-1"), n) for w, n in counts.items() if n and len(w) >= least_length]
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            # What Latin-1 lacks becomes a question mark, which is no letter either.
            for found in runs((text.as_py() or "").encode("latin-1", "replace"), _RUNS):
                counts.update(found)
                slips = {w for w in set(found) if zlib.crc32(_utf8(w), before) % slip_every == 0} if slip_every else ()
                if slips:
                    for w, n in Counter(filter(slips.__contains__, found)).items():
                        place = zlib.crc32(_utf8(w), before) % len(w)
                        counts[w] -= n
                        counts[w[:place] + w[place + 1 :]] += n
            if len(counts) > _MOST_WORDS:
                yield out()
    yield out()


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slip_every: int = SLIP_EVERY,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): distinct lower-cased runs of letters with `least_length` code
    points and `least_count` occurrences at least.

    A run with a crc32 of `<id>:<run>` that `slip_every` divides loses the code
    point at the crc32 modulo its length (0 for `slip_every`: none does).
    A null id is empty there; a null text has no words.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (
        rows.mapInArrow(lambda batches: _count_words(batches, slip_every, least_length), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


class Index:
    """FM-index of words that are searched from their first code to the last.

    The text is every word reversed between delimiters, so that the steps of a
    backward search read a word forwards. Delimiters sort before all codes, and
    among each other by place.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        """`codes`: of all words, one after another; `lengths`: of each."""
        m = len(lengths)
        self.starts = np.cumsum(lengths + 1) - lengths  # of each word in the text
        text = np.zeros(len(codes) + m + 1, np.uint8)
        last = np.repeat(self.starts + lengths - 1, lengths)
        text[last - _within(lengths)] = codes
        self.n, self.words = len(text), m
        self.suffixes = _suffix_array(text)
        self.before = text[self.suffixes - 1]
        rows = np.argsort(self.before, kind="stable")
        # (code, rank) of every suffix's preceding code, ascending: the place of
        # (c, rank) among them is where c's suffixes lead to.
        self._steps = self.before[rows].astype(np.int64) * self.n + rows

    def step(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of what was matched and then `code`."""
        at = code.astype(np.int64) * self.n
        return np.searchsorted(self._steps, at + low), np.searchsorted(self._steps, at + high)

    def begin(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of `n` searches that have matched a delimiter."""
        return np.zeros(n, np.int64), np.full(n, self.words + 1, np.int64)

    def finish(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The word that ends here in each interval, -1 for none; words are distinct."""
        a, b = np.searchsorted(self._steps, low), np.searchsorted(self._steps, high)
        found = np.full(len(low), -1, np.int64)
        hit = np.flatnonzero(a < b)
        found[hit] = np.searchsorted(self.starts, self.suffixes[self._steps[a[hit]]])
        return found

    def children(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For distinct intervals: state * 128 + code, ascending, of the codes that follow."""
        sizes = high - low
        state = np.repeat(np.arange(len(low)), sizes)
        rows = np.repeat(low, sizes) + _within(sizes)
        return np.unique(state * 128 + self.before[rows])


def _within(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after another."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Ranks by packed codes, then doubled for those that are still tied. A suffix
    counts up to its first delimiter; equal ones are ordered by place."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(_PACKED, np.uint8)])
    key, live = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(_PACKED):
        code = np.where(live, padded[j : j + n], 0)
        key = key << _BITS | code
        live &= code != 0
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | ~live[order[1:]]
    rank = np.empty(n, np.int64)  # the first place of those that are tied
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    k = _PACKED
    tied = np.flatnonzero(_tied(new))
    while len(tied):
        which = order[tied]
        first, second = rank[which], rank[which + k]
        again = np.lexsort((second, first))
        which, first, second = which[again], first[again], second[again]
        order[tied] = which  # tied places are ascending, and so are the ranks
        new = np.ones(len(tied), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        rank[which] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[_tied(new)]
        k *= 2
    return order


def _tied(new: np.ndarray) -> np.ndarray:
    """Flags of places whose group, begun by a flag in `new`, has more than one."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return ~alone


def near_in_index(
    index: Index, codes: np.ndarray, replace: bool, delete: bool, first: int, from_right: bool
) -> tuple[np.ndarray, np.ndarray]:
    """(query, indexed word) for queries of one length, a row of `codes` each.

    One error from place `first` on, what is before it matched exactly. With
    `replace`, a code is replaced by a larger one, so that of two near words only
    one finds the other; with `delete`, one is left out: of equal neighbours the
    rightmost in the word, which comes first if the codes are read `from_right`.
    """
    n, length = codes.shape
    low, high = index.begin(n)
    query = np.arange(n)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def finish(query: np.ndarray, low: np.ndarray, high: np.ndarray, place: int) -> None:
        for j in range(place, length):
            if not len(query):
                return
            low, high = index.step(codes[query, j], low, high)
            alive = low < high
            query, low, high = query[alive], low[alive], high[alive]
        word = index.finish(low, high)
        hit = word >= 0
        found.append((query[hit], word[hit]))

    for place in range(length):
        if not len(query):
            break
        own = codes[query, place]
        if place >= first and delete:
            beside = place - 1 if from_right else place + 1
            use = own != codes[query, beside] if 0 <= beside < length else np.ones(len(query), bool)
            finish(query[use], low[use], high[use], place + 1)
        if place >= first and replace:
            states, at, state = np.unique(low, return_index=True, return_inverse=True)
            children = index.children(states, high[at])
            begin = np.searchsorted(children, state * 128 + own + 1)
            sizes = np.searchsorted(children, (state + 1) * 128) - begin
            branch = np.repeat(np.arange(len(query)), sizes)
            code = children[np.repeat(begin, sizes) + _within(sizes)] % 128
            finish(query[branch], *index.step(code, low[branch], high[branch]), place + 1)
        low, high = index.step(own, low, high)
        alive = low < high
        query, low, high = query[alive], low[alive], high[alive]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])


def _pairs(table: pa.Table) -> pa.Table:
    """Near words of a shard, each pair in both orders.

    Rows: word, n, half (length of the one it is in this shard by), suffix (the
    half is its last one), indexed. All rows are searched for.
    """
    words = table.column("word").combine_chunks()
    n = table.column("n").to_numpy()
    half = table.column("half").to_numpy()
    indexed = table.column("indexed").to_numpy()
    from_right = bool(table.column("suffix")[0].as_py())
    text = np.frombuffer("\n".join(words.to_pylist()).encode("latin-1"), np.uint8)
    ends = np.append(np.flatnonzero(text == 0x0A), len(text))
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts
    codes = _CODE[text]

    def read(rows: np.ndarray) -> np.ndarray:
        """Codes of the rows' words, one after another, in the direction of the search."""
        size = lengths[rows]
        within = _within(size)
        return codes[np.repeat(ends[rows] - 1, size) - within if from_right else np.repeat(starts[rows], size) + within]

    targets = np.flatnonzero(indexed)
    left, right = [], []
    if len(targets):
        index = Index(read(targets), lengths[targets])
        # The same length and half make the same search.
        kinds, kind = np.unique(np.stack([lengths, half]), axis=1, return_inverse=True)
        kind = kind.ravel()
        for k, (length, of_half) in enumerate(kinds.T.tolist()):
            rows = np.flatnonzero(kind == k)
            # An even length looks for shorter words by the half of those.
            own = length // 2 == of_half
            query, word = near_in_index(
                index,
                read(rows).reshape(len(rows), length),
                replace=own,
                delete=length % 2 == 1 or not own,
                # Pairs that share their first half are found by it alone.
                first=length - of_half if from_right else of_half,
                from_right=from_right,
            )
            left.append(rows[query])
            right.append(targets[word])
    a = np.concatenate(left) if left else np.zeros(0, np.int64)
    b = np.concatenate(right) if right else np.zeros(0, np.int64)
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    return pa.table(
        {"word": words.take(pa.array(one)), "near": words.take(pa.array(other)), "near_n": pa.array(n[other])}
    )


def _halves(words: DataFrame) -> DataFrame:
    """Every word under the halves that it is indexed by, and those it asks for.

    A word of even length asks for words with one code point less by their half,
    which is shorter than its own.
    """
    own = F.expr("length(word) div 2")

    def under(half: Column, indexed: bool, suffix: bool) -> Column:
        return F.struct(half.cast("int").alias("half"), F.lit(indexed).alias("indexed"), F.lit(suffix).alias("suffix"))

    entries = F.array(under(own, True, False), under(own, True, True))
    shorter = F.array(under(own - 1, False, False), under(own - 1, False, True))
    rows = words.select(
        "word", "n",
        F.explode(F.when(F.length("word") % 2 == 0, F.concat(entries, shorter)).otherwise(entries)).alias("entry"),
    ).select("word", "n", "entry.*")
    text = F.when(F.col("suffix"), F.expr("right(word, half)")).otherwise(F.expr("left(word, half)"))
    return rows.withColumn("key", F.xxhash64("suffix", "half", text))


def near_words(words: DataFrame, words_in_index: int = _WORDS_IN_INDEX) -> DataFrame:
    """(word, near, near_n): every pair of near words in both orders, once.

    `words` has distinct words of Latin-1 letters and their counts: (word, n).
    """
    rows = _halves(words)
    total = words.count()
    shards = max(1, -(-total // words_in_index))
    # Halves that more words are indexed under than one index may hold.
    large = stored(
        rows.where("indexed").groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > words_in_index)
        .select("key", F.ceil(F.col("held") / words_in_index).cast("int").alias("parts")),
        "halves",
    )
    shard = F.pmod("key", F.lit(shards)).cast("int")
    if large.isEmpty():
        placed = rows.select("word", "n", "half", "suffix", "indexed", shard.alias("shard"), F.lit(-1).alias("part"))
    else:
        own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
        known = split_join(rows, large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        placed = known.select(
            "word", "n", "half", "suffix", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("at"), "parts",
            own.alias("own"), F.col("indexed").alias("held"), F.col("key"),
        ).select(
            "word", "n", "half", "suffix", (F.col("held") & (F.col("at") == F.col("own"))).alias("indexed"),
            # A part of a large half is a shard of its own.
            F.when(F.col("parts") > 1, F.pmod("key", F.lit(1 << 30)).cast("int")).otherwise(shard).alias("shard"),
            F.when(F.col("parts") > 1, F.col("at")).otherwise(-1).alias("part"),
        )
    return placed.groupBy("suffix", "shard", "part").applyInArrow(_pairs, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last.

    A form occurs twice as often as its word at least, so a chain has no more
    steps than the largest count has bits, and each round doubles the steps taken.
    """
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        known = stored(
            split_join(known, further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if known.where("moved").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slip_every: int = SLIP_EVERY,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    words_in_index: int = _WORDS_IN_INDEX,
) -> DataFrame:
    """One row per word of the `vocabulary`: word, form, root, n, n_near, form_n.

    A word's form is the near word with the largest n, the smallest in code-point
    order of several, if it occurs twice as often as the word at least; else null,
    as is form_n. n_near counts all near words. root follows forms to the last and
    is the word itself if it has none. Null and empty texts have no words, repeated rows
    count as often as they occur, very long texts and words are used whole, other
    columns are ignored, an empty table gives no rows.
    """
    words = stored(vocabulary(docs, id_col, text_col, slip_every, least_length, least_count), "vocabulary")
    best = (
        near_words(words, words_in_index)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    )
    enough = -F.col("best.less") >= 2 * F.col("n")
    judged = stored(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
