"""Toxicity by a chain of linear classifiers over words and beginnings of words.

The categories stand in an order. Each one's model sees the text's features and
the probabilities of the categories before it. For training these come from
models that were fitted without the row's fold; otherwise later models would
trust them more than they deserve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covshare.llm.exact_dedup import text_key, without_rows
from covshare.llm.words import Words, blocks, find_words
from covshare.llm.workers import short_batches
from covshare.sources.scratch import stored

BUCKETS = 1 << 20
#: Whole words and their first bytes, which inflected forms share.
PREFIXES = (None, 4, 5, 6)
_SALT = np.asarray([0x1F83D9AB, 0x5BE0CD19, 0x428A2F98, 0x71374491], np.uint64)
MOST_FEATURES = 4096
LEAST_SCORE = 4.5  # of a feature's difference between the classes, in standard deviations


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word's features, not distinct."""
    with np.errstate(over="ignore"):
        hashes = words.all_hashes(True, PREFIXES)
        buckets = [((h ^ s) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64) for h, s in zip(hashes, _SALT, strict=True)]
    return np.tile(words.doc, len(PREFIXES)), np.concatenate(buckets)


def _distinct(doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(doc * BUCKETS + bucket)
    return key // BUCKETS, key % BUCKETS


@dataclass(frozen=True)
class Linear:
    bias: float
    buckets: np.ndarray  # sorted
    weights: np.ndarray
    earlier: np.ndarray  # weights of the earlier categories' probabilities

    def probability(self, doc: np.ndarray, bucket: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """For distinct (document, bucket) pairs and a row of earlier
        probabilities per document."""
        at = np.searchsorted(self.buckets, bucket)
        at[at == len(self.buckets)] = 0
        hit = self.buckets[at] == bucket if len(self.buckets) else np.zeros(len(bucket), bool)
        score = np.bincount(doc[hit], self.weights[at[hit]], len(earlier)) if hit.any() else np.zeros(len(earlier))
        return 1 / (1 + np.exp(-np.clip(score + self.bias + earlier @ self.earlier, -40, 40)))


def _scores(present: np.ndarray, with_y: np.ndarray, n: int, positive: float) -> np.ndarray:
    """How many standard deviations a feature's share differs between the classes;
    0 for features of less than three documents."""
    if positive in (0, n):
        return np.zeros(len(present))
    share = present / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / positive + 1 / (n - positive)))
    score = np.abs(with_y / positive - (present - with_y) / (n - positive)) / spread
    score[present < 3] = 0
    return score


def fit_linear(doc: np.ndarray, bucket: np.ndarray, y: np.ndarray, earlier: np.ndarray, steps: int = 400, ridge: float = 5e-5) -> Linear:
    """Logistic regression on the features that tell the classes apart best, by
    accelerated gradient steps. With one class only it is a constant."""
    n = len(y)
    positive = float(y.sum())
    if n == 0 or positive in (0, n):
        rate = (positive + 0.5) / (n + 1)
        empty = np.zeros(0)
        return Linear(float(np.log(rate / (1 - rate))), empty.astype(np.int64), empty, np.zeros(earlier.shape[1]))
    present = np.bincount(bucket, minlength=BUCKETS)
    with_y = np.bincount(bucket, y[doc], BUCKETS)
    score = _scores(present, with_y, n, positive)
    chosen = np.argsort(-score, kind="stable")[:MOST_FEATURES]
    chosen = np.sort(chosen[score[chosen] >= LEAST_SCORE])
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    used = place[bucket] >= 0
    row, col = doc[used], place[bucket[used]]
    width = len(chosen) + earlier.shape[1] + 1

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, w[col], n) + earlier @ w[len(chosen) : -1] + w[-1]

    def backward(v: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(col, v[row], len(chosen)), earlier.T @ v, [v.sum()]])

    # The largest curvature bounds the step: a few power iterations.
    v = np.ones(width)
    for _ in range(8):
        v = backward(forward(v / np.linalg.norm(v)))
    step = 1 / (0.25 * np.linalg.norm(v) / n * 1.1 + ridge)
    w = np.zeros(width)
    w[-1] = np.log(positive / (n - positive))
    ahead, t = w, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(forward(ahead), -40, 40)))
        slope = backward(p - y) / n
        slope[:-1] += ridge * ahead[:-1]
        new = ahead - step * slope
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return Linear(float(w[-1]), chosen, w[: len(chosen)], w[len(chosen) : -1])


def _subset(doc: np.ndarray, bucket: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    number = np.cumsum(keep) - 1
    used = keep[doc]
    return number[doc[used]], bucket[used]


def fit_chain(doc: np.ndarray, bucket: np.ndarray, labels: np.ndarray, folds: int = 3) -> list[Linear]:
    """One model per column of labels; rows are dealt to folds by their number."""
    n = len(labels)
    fold = np.arange(n) % folds
    models, earlier = [], np.zeros((n, 0))
    for y in labels.T.astype(float):
        models.append(fit_linear(doc, bucket, y, earlier))
        held_out = np.zeros(n)
        for k in range(folds):
            inside = fold != k
            model = fit_linear(*_subset(doc, bucket, inside), y[inside], earlier[inside])
            held_out[~inside] = model.probability(*_subset(doc, bucket, ~inside), earlier[~inside])
        earlier = np.column_stack([earlier, held_out])
    return models


def chain_probabilities(models: list[Linear], doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    earlier = np.zeros((n, 0))
    for model in models:
        earlier = np.column_stack([earlier, model.probability(doc, bucket, earlier)])
    return earlier


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, labels) as (id, distinct buckets, labels)."""
    for batch in batches:
        for part, data, offsets in blocks(batch):
            words = find_words(data, offsets)
            doc, bucket = _distinct(*_features(words))
            bounds = np.searchsorted(doc, np.arange(words.n_docs + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(bucket.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists, part.column(2)], ["id", "buckets", "labels"])


def _useful_only(batches: Iterator[pa.RecordBatch], keep: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, buckets, labels) as (id, kept buckets as 32-bit bytes, labels)."""
    for batch in batches:
        packed = []
        for buckets in batch.column(1):
            own = buckets.values.to_numpy()
            packed.append(own[keep[own]].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["id", "buckets", "labels"]
        )


def _judged(batches: Iterator[pa.RecordBatch], models: list[Linear], names: list[str], threshold: float) -> Iterator[pa.RecordBatch]:
    used = np.zeros(BUCKETS, bool)
    for model in models:
        used[model.buckets] = True
    for batch in batches:
        for part, data, offsets in blocks(batch):
            words = find_words(data, offsets)
            doc, bucket = _features(words)
            known = used[bucket]
            p = chain_probabilities(models, *_distinct(doc[known], bucket[known]), words.n_docs)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(p[:, i]) for i in range(len(names))], pa.array(p[:, -1] < threshold), part.column(2)],
                ["doc_id", *names, "kept", "text_key"],
            )


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], most_rows: int = 8000,
    id_col: str = "doc_id", text_col: str = "text",
) -> list[Linear]:
    """The chain for `categories`: name to SQL condition over the labels' columns,
    in chain order; a condition that is null counts as false.

    At most `most_rows` labelled documents are used, chosen by a hash of the id.
    Of a document with several label rows one is used for each category: true
    if any is; of several texts with one id one is used. Texts and features stay on
    the executors; those features come to the driver that tell the classes apart.
    """
    short_batches(docs.sparkSession)
    names = list(categories)
    ids = (
        labels.select(F.col(id_col).alias("id"), *[F.expr(f"coalesce({c}, false)").cast("int").alias(f"c{i}") for i, c in enumerate(categories.values())])
        .where("id is not null")
        .groupBy("id")
        .agg(*[F.max(f"c{i}").alias(f"c{i}") for i in range(len(names))])
        .orderBy(F.xxhash64("id"), "id")
        .limit(most_rows)
        .select("id", F.array(*[f"c{i}" for i in range(len(names))]).alias("labels"))
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    sample = texts.join(F.broadcast(ids), "id").select("id", "text", "labels")  # most_rows bounds what is broadcast
    features = stored(
        sample.mapInArrow(_sample_features, "id long, buckets array<int>, labels array<int>")
        .groupBy("id", "labels")
        .agg(F.min("buckets").alias("buckets"))
        .select("id", "buckets", "labels"),
        "features",
    )
    # Features that can't be chosen go before anything is collected: of the others
    # there are BUCKETS at most, whatever the texts' length.
    sums = [F.sum(F.col("labels")[i]).alias(f"c{i}") for i in range(len(names))]
    n, *positives = features.agg(F.count(F.lit(1)), *sums).first()
    counts = (
        features.select(F.explode("buckets").alias("bucket"), "labels")
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("present"), *sums)
        .where("present > 2")  # what _scores asks for
        .toArrow()
    )
    bucket, present = counts.column("bucket").to_numpy(), counts.column("present").to_numpy()
    keep = np.zeros(BUCKETS, bool)
    for i, positive in enumerate(positives):
        if len(bucket):
            keep[bucket] |= _scores(present, counts.column(f"c{i}").to_numpy(), n, float(positive)) >= LEAST_SCORE / 2
    rows = features.mapInArrow(
        lambda batches: _useful_only(batches, keep), "id long, buckets binary, labels array<int>"
    ).collect()
    rows.sort(key=lambda r: r.id)  # whatever the order in which tasks end
    targets = np.asarray([r.labels for r in rows], float).reshape(-1, len(names))
    sets = [np.frombuffer(r.buckets, "<u4").astype(np.int64) for r in rows]
    del rows
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bucket = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    return fit_chain(doc, bucket, targets)


def judge_toxicity(
    docs: DataFrame, models: list[Linear], names: list[str], threshold: float = 0.3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, a probability per category, kept (the last
    category's probability is below `threshold`).

    Whole texts are read, nothing shuffles. A null or empty text has no features
    and gets the base rates; repeated rows are judged alike, a null id stays
    null, other columns are ignored, an empty table gives no rows.
    """
    return _judged_rows(docs, models, names, threshold, id_col, text_col).drop("text_key")


def _judged_rows(
    docs: DataFrame, models: list[Linear], names: list[str], threshold: float, id_col: str, text_col: str
) -> DataFrame:
    """The rows of `judge_toxicity` with the key of each row's text."""
    short_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), text_key(F.col(text_col)).alias("text_key")
    )
    schema = ", ".join(["doc_id long", *[f"{n} double" for n in names], "kept boolean", "text_key long"])
    return rows.mapInArrow(lambda batches: _judged(batches, models, names, threshold), schema)


#: Categories over the columns `quality` and `toxic`; the last one decides.
CATEGORIES = {
    "toxic_junk": "toxic = 1 and quality = 0",
    "toxic_prose": "toxic = 1 and quality = 1",
    "toxic": "toxic = 1",
}


def toxic_documents(docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None) -> DataFrame:
    """`judge_toxicity` of all documents by a chain fitted on the labelled ones."""
    categories = categories or CATEGORIES
    return judge_toxicity(docs, fit_toxicity(docs, labels, categories), list(categories))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None, threshold: float = 0.3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents that are not rejected, with all their columns.

    The chain is fitted on the labelled ones among them. A null or empty text and a row
    with a null id stay; rows that repeat an id are judged by their texts, one by one.
    """
    categories = categories or CATEGORIES
    models = fit_toxicity(docs, labels, categories, id_col=id_col, text_col=text_col)
    judged = _judged_rows(docs.where(F.length(text_col) > 0), models, list(categories), threshold, id_col, text_col)
    rejected = judged.where("not kept and doc_id is not null").select("doc_id", "text_key")
    return without_rows(docs, rejected, id_col, text_key(docs[f"`{text_col}`"]))
