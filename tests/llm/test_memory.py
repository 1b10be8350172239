"""What a worker takes of its executor's memory, as numpy reports it."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from covshare.llm import minhash, repeats, toxicity, words


def _peak(work) -> float:
    """MB that `work` holds at most."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _batch(n: int, size: int) -> pa.RecordBatch:
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 50_000, size)) for _ in range(n)]
    numbers = pa.array(np.arange(n))
    return pa.RecordBatch.from_arrays([numbers, pa.array(texts), numbers], ["id", "text", "text_key"])


def _contexts(n: int, anchors: int) -> pa.Table:
    """Contexts of edited copies of one passage: they differ from it behind a place and
    before one, so intervals are nested as deep as can be."""
    rng = np.random.default_rng(5)
    rows = np.tile(rng.integers(97, 123, 76).astype(np.uint8), (n, 1))
    place, odd = np.arange(76), rng.integers(65, 91, (n, 76)).astype(np.uint8)
    before, behind = (rng.integers(0, 40, n)[:, None] for _ in range(2))
    rows = np.where((place < 26 - before) | (place >= 50 + behind), odd, rows).astype(np.uint8)
    return pa.table(
        {
            "anchor": pa.array(np.arange(n) % anchors),
            "context": pa.array([r.tobytes() for r in rows], pa.binary()),
            "at": pa.array(np.full(n, 26, np.int8)),
            "id": pa.array(rng.permutation(n)),
            "text_key": pa.array(np.arange(n)),
            "place": pa.array(np.full(n, 26, np.int32)),
        }
    )


@pytest.mark.parametrize(
    "work",
    [
        lambda batch: list(toxicity._sample_features(iter([batch]))),
        lambda batch: list(minhash._signatures(iter([batch]), 5)),
    ],
)
def test_blocks_of_texts(work):
    batch = _batch(1000, 600)  # 4 MB of text
    words._powers.clear()
    assert _peak(lambda: work(batch)) < 100
    assert sum(p.nbytes for p in words._powers.values()) < 10e6  # kept until the worker ends


def test_anchors_of_large_batches():
    batch = _batch(500, 600)
    assert _peak(lambda: list(repeats._count_anchors(iter([batch]), 50, 6))) < 40


def test_nested_intervals_of_one_anchor():
    table = _contexts(30_000, 1)
    assert _peak(lambda: repeats._covered(table, 50)) < 100


@pytest.mark.parametrize("members", [1, 60, 1000])
def test_groups_by_runs_of_intervals(members, monkeypatch):
    def by_row(table: pa.Table) -> list[dict]:
        return sorted(table.to_pylist(), key=lambda row: str(sorted(row.items())))

    table = _contexts(400, 3)
    whole = repeats._covered(table, 50), repeats._groups(table, 50)
    monkeypatch.setattr(repeats, "_MEMBERS", members)
    parts = repeats._covered(table, 50), repeats._groups(table, 50)
    assert whole[0].num_rows > 100
    for a, b in zip(whole, parts, strict=True):
        assert by_row(a) == by_row(b)


def test_no_contexts():
    table = _contexts(1, 1)
    assert repeats._covered(table, 50).num_rows == repeats._covered(table.slice(1), 50).num_rows == 0
