"""Quality rules: hard limits and boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.llm import boosting
from covshare.llm.words import Words, blocks, find_words, mix, windows
from covshare.llm.workers import short_batches

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The trees' inputs, and the direction in which quality may go with each (0: free).
FEATURES = {
    "n_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "dup_lines_per_line": -1,
    "repeated_part": -1,
    "distinct_part": 0,
    "upper_part": 0,
    "digit_part": 0,
    "most_common_part": 0,
    "punctuation_per_word": 0,
    "words_per_line": 0,
}
MONOTONE = {i: d for i, d in enumerate(FEATURES.values()) if d}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80
_CLASS = {
    "upper": np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1)),
    "digit": np.isin(np.arange(256), np.arange(ord("0"), ord("9") + 1)),
    "stop": np.isin(np.arange(256), list(b".,;:!?")),
}


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Per document: words in windows that its text holds twice or more."""
    first, window = windows(hashes, words.doc, REPEAT_WINDOW)
    if not len(first):
        return np.zeros(words.n_docs, np.int64)
    key = mix(window ^ mix(words.doc[first].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(first), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    change = np.zeros(len(words.doc) + 1, np.int64)
    np.add.at(change, first[again], 1)
    np.add.at(change, first[again] + REPEAT_WINDOW, -1)
    return np.bincount(words.doc[np.cumsum(change[:-1]) > 0], minlength=words.n_docs)


def _word_shares(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: distinct words, and occurrences of the most common one."""
    distinct, most = np.zeros(words.n_docs, np.int64), np.zeros(words.n_docs, np.int64)
    bounds = np.searchsorted(words.doc, np.arange(words.n_docs + 1))
    for d, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if a < b:
            ordered = np.sort(hashes[a:b])
            begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            distinct[d] = len(begin)
            most[d] = np.diff(np.append(begin, b - a)).max()
    return distinct, most


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: lines with a word, and those equal to an earlier line."""
    lines, repeated = [], []
    raw = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        worded = [line for line in raw[a:b].split(b"\n") if line.strip()]  # bytes: the six white-space characters
        lines.append(len(worded))
        repeated.append(len(worded) - len(set(worded)))
    return np.asarray(lines, np.int64), np.asarray(repeated, np.int64)


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the documents of a block: whole counts (COUNTS) and features (FEATURES)."""
    with np.errstate(over="ignore"):
        words = find_words(data, offsets)
        hashes = words.hashes(lower=False)
        repeated = _repeated_words(words, hashes)
    n_words = words.per_doc()
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends[words.ends < len(data)]] -= 1
    inside = np.cumsum(inside[:-1]) > 0 if len(data) else np.zeros(0, bool)
    chars = _per_doc(inside & _STARTS_CHAR[data], offsets)
    symbols = _per_doc(_SYMBOL[data], offsets)
    lines, dup_lines = _lines(data, offsets)
    distinct, most = _word_shares(words, hashes)
    counts = np.stack([n_words, chars, symbols, dup_lines, repeated], axis=1)
    per_word, per_line = np.maximum(n_words, 1), np.maximum(lines, 1)
    upper, digit, stop = (_per_doc(flags[data], offsets) for flags in _CLASS.values())
    features = np.stack(
        [
            n_words,
            chars / per_word,
            symbols / per_word,
            dup_lines / per_line,
            repeated / per_word,
            distinct / per_word,
            upper / np.maximum(chars, 1),
            digit / np.maximum(chars, 1),
            most / per_word,
            stop / per_word,
            n_words / per_line,
        ],
        axis=1,
    )
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED_PERCENT * counts[:, 0])


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) as (features, label)."""
    for batch in batches:
        for part, data, offsets in blocks(batch, column=0):
            _, features = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(features), pa.list_(pa.float64())), part.column(1)], ["features", "label"]
            )


def _judged(batches: Iterator[pa.RecordBatch], model: boosting.Trees, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in blocks(batch):
            counts, features = statistics(data, offsets)
            failed = base_failed(counts)
            quality = model.probability(features)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    *[pa.array(counts[:, i], pa.int64()) for i in range(len(COUNTS))],
                    pa.array(failed),
                    pa.array(~failed & (quality >= threshold)),
                    pa.array(quality),
                ],
                ["doc_id", *COUNTS, "base_failed", "kept", "quality"],
            )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of at most `most_rows` labelled documents, chosen by a hash
    of the id. Labels are thinned before the join, so that only ids of the sample
    are joined to texts; a row without label or text is left out, and of several texts
    with one id the smallest is used."""
    ids = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    sample = texts.join(F.broadcast(ids), "id")  # most_rows bounds what is broadcast
    return sample.groupBy("id", "label").agg(F.min("text").alias("text")).select("text", "label")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 8000, id_col: str = "doc_id", text_col: str = "text") -> boosting.Trees:
    """Trees for P(label = 1), fitted on at most `most_rows` labelled documents.

    The sample's statistics are a few numbers a row; texts stay on the executors.
    """
    short_batches(docs.sparkSession)
    rows = (
        labelled_sample(docs, labels, label, most_rows, id_col, text_col)
        .mapInArrow(_features_of, "features array<double>, label int")
        .collect()
    )
    rows.sort()  # the fit does not depend on the order in which tasks end
    x = np.asarray([r.features for r in rows], float).reshape(-1, len(FEATURES))
    return boosting.fit(x, np.asarray([r.label for r in rows], float), MONOTONE)


def judge_quality(
    docs: DataFrame, model: boosting.Trees, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, the five counts, base_failed, kept, quality.

    A document fails the base rules with less than 20 words, or if more than
    30 % of its words stand in 8-word windows found twice or more in it; others
    are kept if the model's probability reaches `threshold`. Nothing shuffles. A
    null text has no words and fails; repeated rows are judged alike; a null id
    stays null; other columns are ignored, an empty table gives no rows.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(
        lambda batches: _judged(batches, model, threshold),
        f"doc_id long, {counts}, base_failed boolean, kept boolean, quality double",
    )
