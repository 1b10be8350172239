"""Packing by linear grouping against plain versions and bounds."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import EDGE, edge, nothing, table  # noqa: F401
from tokenizers import Tokenizer

from covshare.llm import configurations

WORDS = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def plain_best_fit(lengths, width):
    """Sequences that descending best fit needs."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(width - n)
    return len(rooms)


def fewest(lengths, width):
    """The optimum, by trying all ways."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms)}.values():
            if rooms[j] >= lengths[i]:
                place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, width - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


def used_sequences(lengths, width, **kwargs):
    sequence = configurations.pack_lengths(np.asarray(lengths), width, **kwargs)
    filled = np.bincount(sequence, lengths)
    assert filled.max(initial=0) <= width and (filled > 0).all()
    return len(filled)


def test_knapsack():
    rng = random.Random(1)
    for _ in range(30):
        sizes = np.asarray(sorted(rng.sample(range(3, 30), 4), reverse=True))
        prices = np.asarray([rng.random() for _ in sizes])
        found = configurations.Knapsack(sizes, 40).best(prices)
        assert found @ sizes <= 40
        every = itertools.product(*(range(40 // s + 1) for s in sizes))
        assert found @ prices == pytest.approx(max(np.dot(c, prices) for c in every if np.dot(c, sizes) <= 40))


def test_fewest_configurations():
    """Covers the demand by configurations that fit, with the sum of the dual prices."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = -np.sort(-rng.choice(np.arange(13, 100), 6, replace=False))
        demand = rng.integers(1, 50, 6).astype(float)
        columns, used = configurations.fewest_configurations(sizes, demand, 100)
        assert (columns >= 0).all() and (sizes @ columns <= 100 + 1e-6).all() and (used >= 0).all()
        assert np.allclose(columns @ used, demand)
        prices = np.linalg.solve(columns.T, np.ones(6))
        best = configurations.Knapsack(sizes, 100).best(prices)
        assert best @ prices <= 1 + 1e-6  # no configuration would lower the sum


def test_rounded_classes():
    lengths = -np.sort(-np.random.default_rng(3).integers(500, 4000, 1000))
    place, sizes = configurations.rounded_classes(lengths, 10)
    assert len(sizes) == 10 and (sizes[place] >= lengths).all() and (np.diff(sizes) < 0).all()
    assert set(np.bincount(place)) == {100} and set(sizes) <= set(lengths)
    assert configurations.rounded_classes(np.asarray([9, 9, 4]), 10)[1].tolist() == [9, 4]


def test_small_optima():
    rng = random.Random(4)
    extra = 0
    for _ in range(60):
        lengths = [rng.randrange(1, 41) for _ in range(9)]
        extra += used_sequences(lengths, 40) - fewest(lengths, 40)
    assert extra <= 2


@pytest.mark.parametrize(
    "kind, slack", [("mixed", 1.001), ("large", 1.0), ("thirds", 0.95), ("halves", 1.0), ("sizes", 0.98), ("small", 1.0)]
)
def test_as_few_as_best_fit(kind, slack):
    rng = np.random.default_rng(5)
    lengths = {
        "mixed": np.clip(rng.lognormal(6.4, 1.1, 6000).astype(int) + 1, 1, 4096),
        "large": rng.integers(600, 4097, 6000),
        "thirds": rng.integers(1200, 1700, 6000),
        "halves": rng.integers(1900, 2300, 3000),
        "sizes": np.repeat([1400, 1340, 1350, 2700, 2000, 2096], 1000),
        "small": rng.integers(1, 500, 6000),
    }[kind]
    assert used_sequences(lengths, 4096) <= plain_best_fit(lengths.tolist(), 4096) * slack + 1


def check(rows, documents, width):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in documents}
    found, by_sequence = Counter(), defaultdict(list)
    for r in rows:
        part = np.asarray(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.start == r.piece * width and len(part) == r.length == min(width, len(ids[r.doc_id]) - r.start)
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
        found[r.doc_id, r.piece] += 1
        by_sequence[r.sequence_id].append((r.offset, r.length))
    copies = Counter(i for i, _ in documents)
    assert found == {(i, p): copies[i] for i in copies for p in range(-(-len(ids[i]) // width))}
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= width
    return len(by_sequence)


def test_pack_few(spark, edge, nothing):
    frame = configurations.pack_few(edge, WORDS, width=64)
    assert frame.columns == COLUMNS
    rows = frame.collect()
    n = check(rows, EDGE, 64)
    assert n <= -(-sum(r.length for r in rows) // 64) + 1
    assert configurations.pack_few(nothing, WORDS).collect() == []


def test_groups(spark):
    """Several groups of even size, whatever ids and rows repeat; the same on each run."""
    rng = random.Random(6)
    documents = [(i, " ".join(["word"] * rng.randrange(1, 80))) for i in range(300)]
    documents += [(None, "same words")] * 200 + [(7, documents[7][1])] * 150
    frame = table(spark, documents).repartition(3).cache()
    rows = configurations.pack_few(frame, WORDS, width=100, pieces_in_group=100).collect()
    check(rows, documents, 100)
    sizes = Counter(r.sequence_id >> 32 for r in rows)
    assert len(sizes) == 7 and max(sizes.values()) <= 100 + 3
    again = configurations.pack_few(frame, WORDS, width=100, pieces_in_group=100).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)
