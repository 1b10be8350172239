import hashlib
import re
import textwrap
from collections import Counter

import duckdb
from brute import ascii_lower
from conftest_llm import EDGE, edge, nothing, table  # noqa: F401

from covshare.llm import bitmaps, exact_dedup, licences
from covshare.llm.oracle import llm_oracles
from pyspark.sql import functions as F


def expected(rows):
    sha = [hashlib.sha256(ascii_lower(t or "").encode()).hexdigest() for _, t in rows]
    size = Counter(sha)
    best = {s: max((i for (i, _), x in zip(rows, sha) if x == s and i is not None), default=None) for s in size}
    return Counter((i, best[s], size[s], i == best[s], s) for (i, _), s in zip(rows, sha))


def test_edge_rows(edge):
    assert Counter(map(tuple, exact_dedup.exact_duplicates(edge).collect())) == expected(EDGE)


def test_many_copies(spark):
    rows = [(i, f"Text {i % 7 if i % 3 else 0}") for i in range(600)]
    assert Counter(map(tuple, exact_dedup.exact_duplicates(table(spark, rows)).collect())) == expected(rows)


def test_drop_by_text(spark):
    rows = [(1, "a"), (5, "A"), (5, "unique five"), (7, "a"), (8, "c"), (None, "c")]
    kept = exact_dedup.drop_exact_duplicates(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(5, "unique five"), (7, "a"), (8, "c"), (None, "c")])


def test_drop_keeps_columns(edge):
    kept = exact_dedup.drop_exact_duplicates(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0, r.size) for r in kept.collect()) == sorted(
        (i or 0, "z") for i in [2, 3, 5, 5, 6, 7, 8, 9, 10, 11, 12] + [None]
    )


def test_filter_loses_nothing(spark):
    keys = spark.range(0, 4000, 3).withColumnRenamed("id", "k")
    asked = bitmaps.maybe_in(spark.range(4000), F.col("id"), bitmaps.members(keys, "k", 1 << 16), "hit", 1 << 16)
    hits = {r.id for r in asked.where("hit").collect()}
    assert hits >= set(range(0, 4000, 3)) and len(hits) < 2000


def test_native_plan(spark, edge):
    for frame in (exact_dedup.exact_duplicates(edge), licences.scan_licences(edge)):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)


def test_empty(nothing):
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    assert exact_dedup.drop_exact_duplicates(nothing).count() == 0
    assert licences.scan_licences(nothing).count() == 0


def test_licences(spark, edge):
    texts = {
        1: "Intro.\nLicensed under the Apache License, Version 2.0.",
        2: 'Licensed under the Apache License, Version 2.0 (the "License"); you may\nno',
        3: "Released under the MIT License. All rights reserved.",
        4: "this work is licensed under the gnu general public license, VERSION 3",
        5: "All rights reserved.",
        6: "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
        7: "We like the MIT License.",
    }
    rows = {r.doc_id: r for r in licences.scan_licences(table(spark, texts.items())).collect()}
    assert [rows[i].licence for i in range(1, 8)] == ["Apache-2.0", None, "MIT", "GPL-3.0", "unknown", "MIT", None]
    assert rows[6].licences == "CC-BY-NC-4.0,MIT" and rows[6].sentence_ids == "ccbync_short|mit_short|"
    assert {r.licence for r in licences.scan_licences(edge).collect()} == {None}


NOTICES = {
    "MIT": 'Copyright (c) 2020 A. Author\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n'
    'of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, '
    "including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
    "copies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following "
    "conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial "
    "portions of the Software.\n",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided "
    "that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice.\n\n"
    "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote "
    "products derived from\n   this software without specific prior written permission.\n",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General "
    "Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any "
    "later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even "
    "the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more "
    "details.\n",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General "
    "Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any "
    "later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even "
    "the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more "
    "details.\n",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was "
    "not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in '
    "compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0\nInternational License.\n",
}


def test_official_notices(spark):
    """As they are wrapped, unwrapped, wrapped elsewhere, and in comments."""
    ways = [
        lambda t: t,
        lambda t: t.replace("\n", "\r\n"),
        lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
        lambda t: "\n\n".join(textwrap.fill(p, 37) for p in t.split("\n\n")),
        *[lambda t, m=m: "".join(f"{m}{line}\n" for line in t.split("\n")) for m in ("# ", " * ", "// ", "dnl ", "C     ", "REM ")],
    ]
    rows = [(name, way(text)) for name, text in NOTICES.items() for way in ways]
    got = licences.scan_licences(table(spark, enumerate(t for _, t in rows))).collect()
    assert {(rows[r.doc_id], r.licence) for r in got} == {(row, row[0]) for row in rows}


def test_sentences_end_at_blank_lines(spark):
    texts = ["Licensed under the\n\nMIT License.", "#Licensed under the\n#\n# MIT License.", "Not licensed under the\nMIT License."]
    texts += ["\n" * 50_000 + ". " * 50_000 + "\nLicensed\nunder the MIT License", "It is licensed. Licensed under\nthe MIT license! x"]
    got = {r.doc_id: r.licence for r in licences.scan_licences(table(spark, enumerate(texts))).collect()}
    assert [got[i] for i in range(5)] == [None, None, None, "MIT", "MIT"]


MORE_NOTICES = {
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
    "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)\n",
    "Zlib": "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held "
    "liable for any damages\narising from the use of this software.\n",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General "
    "Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later "
    "version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied "
    "warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU\nLesser General Public License for more details.\n",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General "
    "Public License as published\nby the Free Software Foundation, either version 3 of the License, or\n(at your option) any later "
    "version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied "
    "warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU Affero General Public License for more details.\n",
    "EPL-2.0": "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\n"
    "which is available at https://www.eclipse.org/legal/epl-2.0/\n",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring rights to "
    "this software to the public domain\nworldwide. This software is distributed without any warranty.\n",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified\ncopies of this license document, and changing it is "
    "allowed as long\nas the name is changed.\n",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License.\n",
    "OFL-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.\nThis license is copied below\n",
}


def test_licences_agree_with_the_sql(spark, tmp_path):
    """Wrapped, joined and cut notices, sentences inside others, one behind another."""
    ways = [
        lambda t: t,
        lambda t: t.replace("\n", "\r\n"),
        lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
        lambda t: "\n\n".join(textwrap.fill(p, 29, break_long_words=False, break_on_hyphens=False) for p in t.split("\n\n")),
        lambda t: "".join(f"C {line}\n" for line in t.split("\n")),
        lambda t: t + t.upper() + "Released under\nthe MIT License! " + t,
        lambda t: t[: len(t) // 2] + "\n\n" + t[len(t) // 2 :],
        lambda t: "x " + t,
    ]
    notices = NOTICES | MORE_NOTICES
    rows = list(enumerate(way(text) for text in notices.values() for way in ways))
    rows += [(10_000 + i, t) for i, t in enumerate([None, "", "\n\x01\x02\n ", "c\nc\n\nAll rights\nreserved.", "all rights reserved all rights reserved"])]
    path = f"{tmp_path}/documents.parquet"
    table(spark, rows).repartition(2).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    found = licences.scan_licences(spark.read.parquet(path))
    expected = con.execute(llm_oracles()["op10_licences"]).fetchall()
    names = [d[0] for d in con.description]
    got = sorted(tuple(r[n] for n in names) for r in found.collect())
    assert got == sorted(expected)
    by_id = {r[names.index("doc_id")]: r[names.index("licence")] for r in got}
    for k, name in enumerate(notices):
        assert [by_id[k * len(ways) + w] for w in range(5)] == [name] * 5
    assert all(by_id[k * len(ways) + 7] != name or name in ("LGPL-2.1",) for k, name in enumerate(notices) if "\n\n" not in notices[name])
