"""Ranked lexical search: the best documents for each of a set of items.

Documents that hold the same item terms equally often and have the same length
factor score alike for every item. So documents are restricted to the
vocabulary of the items, those of one class (term frequencies and length factor
identical, not only their hash) are scored once, and a class is expanded into
its members by ascending id. No more than k members of a class can be among an
item's k best, and no more than the k best classes, ordered by score and by
their smallest id, can hold them: so a class keeps its k smallest ids, and a
group of copies that holds a third of all rows is k rows per task.

Items are searched in blocks of bounded size. A block's vocabulary, weights and
postings go to every task; each task keeps the k best classes per item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covshare.llm.runs import runs
from covshare.llm.workers import short_batches
from covshare.sources.scratch import stored

# A block of items has about as many at most, and holds a term more than that in
# all only if a single item does.
_MOST_ITEMS = 4096
_MOST_TERMS = 1 << 20
_SCORES = 4 << 20  # scores in a worker at once
_HELD = 1 << 18  # candidates before they are cut to the best k per item

# Terms are ASCII letters and digits, and all that is not ASCII; A-Z lower-cased.
_TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_N, _L = -1, -2  # in place of a term: documents with terms, and all their terms


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, item, term, repeats) of every item."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        for slot, item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            counts: Counter[bytes] = Counter()
            for found in runs((text.as_py() or "").encode(), _TERMS):
                counts.update(found)
            for column, values in zip(out, ([slot] * len(counts), [item] * len(counts), counts, counts.values()), strict=True):
                column += values
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.int64())],
            ["slot", "item_id", "term", "repeats"],
        )


def _bags(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(id, number of terms, bag) of documents with a term: the bag has (place in
    the vocabulary, occurrences) as 32-bit numbers, by ascending place."""
    for batch in batches:
        ids, sizes, bags = [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts: Counter[int | None] = Counter()
            n = 0
            for found in runs((text.as_py() or "").encode(), _TERMS):
                n += len(found)
                counts.update(map(vocabulary.get, found))
            if not n:
                continue
            counts.pop(None, None)
            ids.append(doc_id)
            sizes.append(n)
            bags.append(np.asarray(sorted(counts.items()), "<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], ["id", "n", "bag"]
        )


def _statistics(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """(term, documents with it) of a task, and its documents and their terms."""
    df, documents, length = np.zeros(n_terms, np.int64), 0, 0
    for batch in batches:
        entries = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4")
        df += np.bincount(entries[::2], minlength=n_terms)
        documents += batch.num_rows
        length += int(batch.column(0).to_numpy().sum())
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array([*held.tolist(), _N, _L], pa.int64()), pa.array([*df[held].tolist(), documents, length], pa.int64())], ["term", "n"]
    )


@dataclass
class Block:
    """Items of a block: their postings by term, with the terms' weights."""

    slots: np.ndarray
    item_ids: list[int | None]
    begin: np.ndarray  # of each term's postings
    items: np.ndarray
    repeats: np.ndarray
    weights: np.ndarray

    def scores(self, m: np.ndarray, bags: list[bytes]) -> np.ndarray:
        """Whole scores, a row per class and a column per item."""
        entries = np.frombuffer(b"".join(bags), "<i4").astype(np.int64)
        terms, tf = entries[::2], entries[1::2]
        row = np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags])
        part = self.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        order = np.argsort(terms, kind="stable")
        terms, row, part = terms[order], row[order], part[order]
        edges = np.append(np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])), len(terms))
        total = np.zeros((len(bags), len(self.slots)), np.int64)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            posted = slice(self.begin[terms[a]], self.begin[terms[a] + 1])
            # A class has a term once and a term's postings an item once.
            total[row[a:b, None], self.items[posted]] += part[a:b, None] * self.repeats[posted]
        return total


def _best(item: np.ndarray, score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best per item: highest score, then smallest first id."""
    order = np.lexsort((first, -score, item))
    begin = np.concatenate([[True], item[order][1:] != item[order][:-1]]) if len(order) else np.zeros(0, bool)
    place = np.arange(len(order))
    return order[place - np.maximum.accumulate(np.where(begin, place, 0)) < k]


def _score(batches: Iterator[pa.RecordBatch], block: Block, k: int) -> Iterator[pa.RecordBatch]:
    """The k best classes of a task for each item: slot, item_id, score, first, members."""
    n_items = len(block.slots)
    step = max(1, _SCORES // max(n_items, 1))
    least = np.ones(n_items, np.int64)  # a score below that is not among the k best
    item, score, first = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    members = pa.array([], pa.list_(pa.int64()))

    def cut() -> None:
        nonlocal item, score, first, members
        kept = _best(item, score, first, k)
        item, score, first, members = item[kept], score[kept], first[kept], members.take(pa.array(kept))
        counts = np.bincount(item, minlength=n_items)
        last = np.cumsum(counts) - 1
        full = counts == k
        least[full] = score[last[full]]

    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            found = block.scores(part.column("m").to_numpy(), part.column("bag").to_pylist())
            rows, items = np.nonzero(found >= least)
            item = np.concatenate([item, items])
            score = np.concatenate([score, found[rows, items]])
            first = np.concatenate([first, part.column("first").to_numpy()[rows]])
            members = pa.concat_arrays([members, part.column("members").cast(members.type).take(pa.array(rows))])
            if len(item) > _HELD or len(rows) > k * n_items:
                cut()
    cut()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(block.slots[item]),
            pa.array([block.item_ids[i] for i in item.tolist()], pa.int64()),
            pa.array(score),
            pa.array(first),
            members,
        ],
        ["slot", "item_id", "score", "first", "members"],
    )


def _numbered(rows: DataFrame, by: list[str], order: list[Column], k: int, name: str) -> DataFrame:
    """The first k rows of each group, numbered; a task hands on no more than k of one."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)


def _classes(bags: DataFrame, documents: int, length: int, k: int) -> DataFrame:
    """(m, bag, first, members): classes of documents with a term of the block, and
    the k smallest ids of each; null counts as larger than all."""
    m = F.expr(f"cast(25 + (cast(75 as decimal(38, 0)) * n * {documents}) div {max(length, 1)} as bigint)")
    # The hash alone decides where a class goes; bag and m keep its members apart.
    rows = bags.where("length(bag) > 0").select("id", "bag", m.alias("m")).withColumn("hash", F.xxhash64("m", "bag"))
    by = ["hash", "m", "bag"]
    least = _numbered(rows, by, [F.asc_nulls_last("id")], k, "place")
    return (
        least.groupBy(*by)
        .agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("members"))
        .select("m", "bag", F.coalesce(F.col("members")[0]["id"], F.lit((1 << 63) - 1)).alias("first"), F.col("members.id").alias("members"))
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per item and rank: item_id, rank, doc_id, score.

    The k documents with the highest scores above 0, equal ones by ascending id.
    A term has weight floor(1000 ln((2 N + 2) / (2 df + 1))), a document with n
    terms m = 25 + 75 n N div L, and the score adds weight * (10^9 tf div (1000 tf + 8 m))
    over the item's terms, repeats included; N documents have terms, L in all.
    Null and empty texts have no terms: such a document is never found and such an
    item finds nothing. Rows that repeat are documents or items of their own; a
    null id comes after all others; other columns are ignored; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    short_batches(spark)
    asked = items.select(
        F.monotonically_increasing_id().alias("slot"), F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    )
    terms = stored(asked.mapInArrow(_item_terms, "slot long, item_id long, term binary, repeats long"), "items")
    n_terms, n_items = terms.agg(F.count(F.lit(1)), F.countDistinct("slot")).first()
    blocks = max(1, -(-n_terms // _MOST_TERMS), -(-n_items // _MOST_ITEMS))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for number in range(blocks):
        here = terms.where(F.pmod(F.xxhash64("slot"), F.lit(blocks)) == number).toArrow()
        part = _search_block(rows, here, k)
        found = part if found is None else found.union(part)
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_block(rows: DataFrame, terms: pa.Table, k: int) -> DataFrame:
    spark = rows.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set(terms.column("term").to_pylist())))}
    shared = spark.sparkContext.broadcast(vocabulary)
    bags = stored(rows.mapInArrow(lambda batches: _bags(batches, shared.value), "id long, n long, bag binary"), "bags")
    n_terms = len(vocabulary)
    counts = dict(
        bags.select("n", "bag")
        .mapInArrow(lambda batches: _statistics(batches, n_terms), "term long, n long")
        .groupBy("term").agg(F.sum("n").alias("n"))
        .collect()  # a row per term of the block
    )
    documents, length = counts.get(_N, 0), counts.get(_L, 0)
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(t, 0) + 1))) for t in range(n_terms)]
    block = spark.sparkContext.broadcast(_block(terms, vocabulary, np.asarray(weights, np.int64)))
    scored = _classes(bags, documents, length, k).mapInArrow(
        lambda batches: _score(batches, block.value, k), "slot long, item_id long, score long, first long, members array<long>"
    )
    best = _numbered(scored, ["slot"], [F.desc("score"), F.asc("first")], k, "place")
    return _numbered(
        best.select("slot", "item_id", "score", F.explode("members").alias("doc_id")),
        ["slot"], [F.desc("score"), F.asc_nulls_last("doc_id")], k, "rank",
    )


def _block(terms: pa.Table, vocabulary: dict[bytes, int], weights: np.ndarray) -> Block:
    slots, of_slot = np.unique(terms.column("slot").to_numpy(), return_inverse=True)
    item_ids: list[int | None] = [None] * len(slots)
    for place, item in zip(of_slot.tolist(), terms.column("item_id").to_pylist(), strict=True):
        item_ids[place] = item
    term = np.asarray([vocabulary[t] for t in terms.column("term").to_pylist()], np.int64)
    order = np.argsort(term, kind="stable")
    begin = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(vocabulary)))]).astype(np.int64)
    return Block(slots, item_ids, begin, of_slot[order], terms.column("repeats").to_numpy()[order], weights)
