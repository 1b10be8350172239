"""Ranked search against a plain version."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from conftest_llm import EDGE, edge, nothing, table  # noqa: F401

from covshare.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id LONG, text STRING, doc_id STRING, rank STRING, slot STRING, term STRING"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, k=10):
    """[(item_id, rank, doc_id, score)]; documents are rows."""
    counts = [Counter(terms(t)) for _, t in rows]
    n_docs = sum(1 for c in counts if c)
    length = sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, _), c in zip(rows, counts):
            n = sum(c.values())
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // length)))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, r + 1, d, -s) for r, (s, _, d) in enumerate(found[:k])]
    return sorted(out, key=str)


def answers(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def items_table(spark, items):
    return spark.createDataFrame([(i, t, *["z"] * 4) for i, t in items], ITEMS)


def world(seed, n_docs=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" if i % 5 else f"Ñé{i}" for i in range(60)]
    weights = [1 / (1 + i) for i in range(60)]

    def text(n):
        return rng.choice([" ", ", ", "_-"]).join(rng.choices(vocabulary, weights, k=n))

    rows = [(i, text(rng.randrange(0, 60))) for i in range(n_docs)]
    # Groups of copies, some of one bag in another order.
    rows += [(1000 - i, rows[7][1]) for i in range(40)]
    rows += [(2000 + i, " ".join(reversed(rows[9][1].split()))) for i in range(30)]
    items = [(i, text(rng.randrange(1, 30))) for i in range(25)]
    return rows, items


def test_search(spark):
    for seed in (1, 2):
        rows, items = world(seed)
        found = lexical.search(table(spark, rows).repartition(4), items_table(spark, items))
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert answers(found) == brute(rows, items)


def test_blocks(spark, monkeypatch):
    """Items in several blocks, scores of some rows at once, candidates cut often."""
    rows, items = world(3)
    for name, value in (("_MOST_ITEMS", 7), ("_SCORES", 40), ("_HELD", 5)):
        monkeypatch.setattr(lexical, name, value)
    assert answers(lexical.search(table(spark, rows).repartition(3), items_table(spark, items), k=4)) == brute(rows, items, 4)


def test_ties_and_odd_rows(spark, edge, nothing):
    items = [(1, "WORD1x1 word2x2 word1x1"), (1, "lang"), (None, "cd AB ab"), (3, None), (4, ""), (5, "straße über")]
    asked = items_table(spark, items)
    assert answers(lexical.search(edge, asked)) == brute(EDGE, items)
    copies = [(i, "same text here") for i in (9, 3, 3, None, 5, 8, 1, 7, 6, 2, 4, 11, 10)]
    items = [(1, "here"), (2, "text text"), (3, "absent")]
    assert answers(lexical.search(table(spark, copies + [(20, "other words")]), items_table(spark, items))) == brute(
        copies + [(20, "other words")], items
    )
    assert lexical.search(nothing, asked).collect() == []
    assert lexical.search(edge, items_table(spark, [])).collect() == []


def test_equal_hashes_stay_apart():
    """Classes are told apart by what they hold: ties go to the smallest first id."""
    item, score = np.asarray([0, 0, 0, 1, 1]), np.asarray([5, 7, 7, 1, 1])
    first = np.asarray([1, 9, 3, 4, 2])
    assert lexical._best(item, score, first, 2).tolist() == [2, 1, 4, 3]
    grouped = defaultdict(list)
    for i in lexical._best(item, score, first, 1).tolist():
        grouped[int(item[i])].append(i)
    assert grouped == {0: [2], 1: [4]}
