"""Spelling variants against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import EDGE, edge, nothing, table  # noqa: F401

from covshare.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, slip_every=97, least_length=5, least_count=3):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % slip_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_count and len(w) >= least_length}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, **bounds):
    counts = brute_words(rows, **bounds)
    out = {}
    for w, n in counts.items():
        around = [x for x in counts if near(w, x)]
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (form, n, len(around), counts[form] if form else None)
    result = {}
    for w, (form, n, n_near, form_n) in out.items():
        last = w
        while out[last][0]:
            last = out[last][0]
        result[w] = (form, last, n, n_near, form_n)
    return result


def answers(frame):
    rows = frame.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def variants(seed, n, alphabet="abcdeñé", longest=12):
    """Words with many near ones: chains of single errors from a few stems."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(4, longest))) for _ in range(n // 8)]
    while len(words) < n:
        w = rng.choice(words)
        at, c = rng.randrange(len(w) + 1), rng.choice(alphabet)
        words.append(rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :]]) or w)
    return words, rng


def documents(seed, n_words, n_docs=40):
    words, rng = variants(seed, n_words)
    weights = [1 / (1 + i % 37) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=200)).title()) for i in range(n_docs)]


def test_index_ranks():
    """Suffixes in order, delimiters by place; every word and no other is found."""
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 40, 200)
    codes = rng.integers(1, 4, int(lengths.sum())).astype(np.uint8)
    words = sorted({tuple(w) for w in np.split(codes, np.cumsum(lengths)[:-1])})
    lengths = np.asarray([len(w) for w in words])
    index = spelling.Index(np.concatenate([np.asarray(w, np.uint8) for w in words]), lengths)
    text = [0]
    for w in words:
        text += [*w[::-1], 0]
    order = sorted(range(len(text)), key=lambda i: text[i : text.index(0, i) + 1] + [i])
    assert index.suffixes.tolist() == order
    for k, w in enumerate([*words, (9, 9), words[0] + (1,)]):
        low, high = index.begin(1)
        for c in w:
            low, high = index.step(np.asarray([c]), low, high)
        assert index.finish(low, high).tolist() == [words.index(w) if w in words else -1]


@pytest.mark.parametrize("in_index", [40, 10**6])
def test_near_words(spark, in_index):
    """Every pair once in both orders, whether halves fill one index or several."""
    words = sorted({w for w in variants(11, 400, "abñ", 14)[0] if len(w) >= 4})
    frame = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long").repartition(3)
    rows = spelling.near_words(frame, in_index).collect()
    found = [(r.word, r.near) for r in rows]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if near(a, b)}
    assert all(words[r.near_n - 1] == r.near for r in rows)


def test_variants(spark):
    rows = documents(3, 300)
    expected = brute(rows)
    found = answers(spelling.spelling_variants(table(spark, rows).repartition(5), words_in_index=50))
    assert found == expected
    assert any(root != form for form, root, *_ in found.values() if form)


def test_slips_and_letters(spark):
    text = "Überaus ÜBERAUS ×××××× Straße naïve÷naïve x1abcdez2 日本abcdeŁfghij kelvinK ſabcde ÿÿÿÿÿÿ"
    rows = [(i, text) for i in range(300)]
    assert answers(spelling.spelling_variants(table(spark, rows))) == brute(rows)


def test_edge_rows(spark, edge, nothing):
    assert answers(spelling.spelling_variants(edge, least_count=1)) == brute(EDGE, least_count=1)
    assert spelling.spelling_variants(nothing).collect() == []
    assert spelling.spelling_variants(nothing).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_very_long(spark):
    """Texts that are split at blanks and words of many code points."""
    long = "ab" * 20_000
    rows = [(1, f"{long} {long[:-1]} {long}b " * 40), (2, "wörter " * 900_000)]
    assert answers(spelling.spelling_variants(table(spark, rows))) == brute(rows)
