"""Runs of wanted bytes in whole texts, some MB at a time."""

from __future__ import annotations

from collections.abc import Iterator

_PIECE_BYTES = 4 << 20


def runs(data: bytes, table: bytes) -> Iterator[list[bytes]]:
    """`data` translated by `table`, which makes a blank of every byte that no run
    holds and of all ASCII white space, as lists of the runs between blanks."""
    data = data.translate(table)
    at = 0
    while at < len(data):
        end = at + _PIECE_BYTES
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            if cut <= at:  # a run longer than a piece
                cut = data.find(b" ", end)
            end = cut if cut > at else len(data)
        yield data[at:end].split()
        at = end
