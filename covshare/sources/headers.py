"""Headers of CSV files as they come: unnamed and repeated columns, and files of
one folder that have their columns in other orders.

Only the header line of each file is looked at here, through the file system
Spark reads with; the data are scanned by Spark alone.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import SparkSession

_AT_ONCE = 32  # files whose headers are read side by side
_GLOB = str.maketrans({c: f"\\{c}" for c in "*?[]{}\\"})


@dataclass(frozen=True)
class Group:
    """Files with one header, and the names that its columns go by."""

    header: tuple[str, ...]
    files: list[str]

    def names(self, declared: Iterable[str] = ()) -> list[str]:
        """A distinct name for every column, whatever the header says.

        Columns have the header's names; those without any are `Unnamed: ` and their
        place from 0, and repetitions, also in other letter case, end in `.1`, `.2`
        and so on. A declared name belongs to the first column that has exactly it.
        """
        out: list[str] = [""] * len(self.header)
        taken: set[str] = set()
        for name in declared:
            if name in self.header:
                out[self.header.index(name)] = name
                taken.add(name.lower())
        for place, name in enumerate(self.header):
            if out[place]:
                continue
            base = name if name.strip() else f"Unnamed: {place}"
            own, repetition = base, 0
            while own.lower() in taken:
                repetition += 1
                own = f"{base}.{repetition}"
            out[place] = own
            taken.add(own.lower())
        return out


def _header_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """The first line of a file that is not blank."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        data = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, encoding))
        line = reader.readLine()
        while line is not None and not line.strip("﻿ \t\r"):
            line = reader.readLine()
        return line
    finally:
        stream.close()


def header_groups(spark: SparkSession, path: str, delimiter: str, encoding: str) -> list[Group]:
    """The files below a path, a folder or a glob, by header; empty ones left out.

    With one header for all, the group's only file is the path itself.
    """
    files = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(max_workers=_AT_ONCE) as pool:
        lines = list(pool.map(lambda file: _header_line(spark, file, encoding), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            header = next(csv.reader([line.removeprefix("﻿")], delimiter=delimiter))
            groups.setdefault(tuple(header), []).append(file.translate(_GLOB))
    if not groups:
        raise ValueError(f"{path} has no header line")
    if len(groups) == 1:
        return [Group(header, [path]) for header in groups]
    return [Group(header, found) for header, found in groups.items()]
