"""Licence recognition by sentences, in SQL functions only.

Texts are normalised to words and cut into pieces at the places where a sentence
may end. Neighbouring pieces of a paragraph are joined and looked up in a map from
normalised licence sentences to their identifiers, so that line breaks and full
stops within a sentence do not hide it; a second map tells by the first two words
how many words a known sentence may have, so that few joins are made. The sequence
of identifiers in a document is matched against ordered rules. The maps are dealt
into buckets by a hash of the key, and a look-up takes as long whatever the number
of sentences. Nothing shuffles: every document is judged on its own, and the maps
are constants in the plan.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covshare.llm.exact_dedup import ascii_lower

# Sentences of public licences, normalised (lower case, runs of
# characters other than letters and digits are one blank).
SENTENCES = {
    "licensed under the apache license version 2 0": "apache_short",
    "licensed under the apache license version 2 0 the license": "apache_header",
    "you may not use this file except in compliance with the license": "apache_compliance",
    "you may obtain a copy of the license at": "apache_copy",
    "released under the mit license": "mit_short",
    "licensed under the mit license": "mit_short",
    "this project is licensed under the mit license": "mit_short",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to "
    "do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software": "mit_notice",
    "this work is licensed under the gnu general public license version 3": "gpl3_short",
    "licensed under the gnu general public license version 3": "gpl3_short",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license as published by the free software foundation either version 3 of "
    "the license or at your option any later version": "gpl3_grant",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license as published by the free software foundation either version 2 of "
    "the license or at your option any later version": "gpl2_grant",
    "this program is distributed in the hope that it will be useful but without any warranty without "
    "even the implied warranty of merchantability or fitness for a particular purpose": "gnu_warranty",
    "licensed under cc by 4 0": "ccby_short",
    "licensed under cc by sa 4 0": "ccbysa_short",
    "licensed under cc by nc 4 0": "ccbync_short",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby_short",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international "
    "license": "ccbync_short",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd_grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission": "bsd_endorse",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2_short",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
    "permission to use copy modify and or distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies": "isc_grant",
    "permission to use copy modify and or distribute this software for any purpose with or without "
    "fee is hereby granted": "zero_bsd_grant",
    "distributed under the boost software license version 1 0": "boost_short",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of "
    "the software and accompanying documentation covered by this license the software to use "
    "reproduce display distribute execute and transmit the software and to prepare derivative works "
    "of the software and to permit third parties to whom the software is furnished to do so all "
    "subject to the following": "boost_grant",
    "this software is provided as is without any express or implied warranty": "zlib_as_is",
    "in no event will the authors be held liable for any damages arising from the use of this "
    "software": "zlib_liable",
    "this library is free software you can redistribute it and or modify it under the terms of the "
    "gnu lesser general public license as published by the free software foundation either version 2 "
    "1 of the license or at your option any later version": "lgpl21_grant",
    "this library is free software you can redistribute it and or modify it under the terms of the "
    "gnu lesser general public license as published by the free software foundation either version 3 "
    "of the license or at your option any later version": "lgpl3_grant",
    "this library is distributed in the hope that it will be useful but without any warranty without "
    "even the implied warranty of merchantability or fitness for a particular purpose": "gnu_warranty",
    "licensed under the gnu lesser general public license version 3": "lgpl3_short",
    "licensed under the gnu affero general public license version 3": "agpl3_short",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu affero general public license as published by the free software foundation either version 3 "
    "of the license or at your option any later version": "agpl3_grant",
    "this program and the accompanying materials are made available under the terms of the eclipse "
    "public license 2 0 which is available at": "epl2_terms",
    "this program and the accompanying materials are made available under the terms of the eclipse "
    "public license v1 0 which accompanies this distribution and is available at": "epl1_terms",
    "to the extent possible under law the author s have dedicated all copyright and related and "
    "neighboring rights to this software to the public domain worldwide": "cc0_dedication",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license "
    "document and changing it is allowed as long as the name is changed": "wtfpl_copies",
    "this work is licensed under a creative commons attribution sharealike 4 0 international "
    "license": "ccbysa_short",
    "this work is licensed under a creative commons attribution noderivatives 4 0 international "
    "license": "ccbynd_short",
    "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 "
    "international license": "ccbyncsa_short",
    "this font software is licensed under the sil open font license version 1 1": "ofl_short",
    "all advertising materials mentioning features or use of this software must display the "
    "following acknowledgement": "bsd_advertising",
}

# Known sentences that official notices join without a place where
# a sentence may end, or with a link behind. Their identifiers, joined by "|".
JOINED = {
    "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license": "apache_header|apache_compliance",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache_copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache_copy",
    "this program and the accompanying materials are made available under the terms of the eclipse "
    "public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2_terms",
    "this program and the accompanying materials are made available under the terms of the eclipse "
    "public license v1 0 which accompanies this distribution and is available at http www eclipse "
    "org legal epl v10 html": "epl1_terms",
}

# Fixed values: (licence, sequence of identifiers that must follow each other
# within the document's identifiers), most specific first. "|" ends each one.
RULES = (
    ("Apache-2.0", "apache_header|apache_compliance|apache_copy|"),
    ("Apache-2.0", "apache_header|apache_compliance|"),
    ("Apache-2.0", "apache_short|"),
    ("MIT", "mit_grant|mit_notice|"),
    ("MIT", "mit_short|"),
    ("GPL-3.0", "gpl3_grant|gnu_warranty|"),
    ("GPL-2.0", "gpl2_grant|gnu_warranty|"),
    ("GPL-3.0", "gpl3_short|"),
    ("AGPL-3.0", "agpl3_grant|gnu_warranty|"),
    ("AGPL-3.0", "agpl3_short|"),
    ("LGPL-2.1", "lgpl21_grant|gnu_warranty|"),
    ("LGPL-3.0", "lgpl3_grant|gnu_warranty|"),
    ("LGPL-3.0", "lgpl3_short|"),
    ("BSD-4-Clause", "bsd_grant|bsd_advertising|"),
    ("BSD-3-Clause", "bsd_grant|bsd_endorse|"),
    ("BSD-2-Clause", "bsd_grant|"),
    ("CC-BY-NC-SA-4.0", "ccbyncsa_short|"),
    ("CC-BY-NC-4.0", "ccbync_short|"),
    ("CC-BY-ND-4.0", "ccbynd_short|"),
    ("CC-BY-SA-4.0", "ccbysa_short|"),
    ("CC-BY-4.0", "ccby_short|"),
    ("MPL-2.0", "mpl2_short|"),
    ("Unlicense", "unlicense|"),
    ("ISC", "isc_grant|"),
    ("0BSD", "zero_bsd_grant|"),
    ("BSL-1.0", "boost_grant|"),
    ("BSL-1.0", "boost_short|"),
    ("Zlib", "zlib_as_is|zlib_liable|"),
    ("EPL-2.0", "epl2_terms|"),
    ("EPL-1.0", "epl1_terms|"),
    ("CC0-1.0", "cc0_dedication|"),
    ("WTFPL", "wtfpl_copies|"),
    ("OFL-1.1", "ofl_short|"),
)


#: Marks in normalised texts: a sentence may end (first with a blank behind a full
#: stop, then also with a line break), and a blank line.
STOP, END, GAP = "\x01", "\n", "\x02"

# What is replaced, in this order, after A-Z are lower-cased. Lines may start with
# comment marks that are letters.
STEPS = (
    ("(?m)^[ \t]*(?:dnl|rem|c)(?:[ \t\r]+|$)", ""),
    ("[.!?:][ \t]+", STOP),
    (f"[^a-z0-9{END}{STOP}]+", " "),
    (f"[ {STOP}]{{2,}}", STOP),
    (f"[ {STOP}]?{END}[ {STOP}]?{END}[ {END}{STOP}]*", GAP),
    (f"[ {STOP}]?{END}[ {STOP}]?", END),
)


def _words_and_ends(text: Column) -> Column:
    """The text's words in lower case with one character between two of them: GAP
    for blank lines, END for a line break or `.`, `!`, `?` or `:` before a blank,
    else a blank. A line of nothing but comment marks is blank."""
    out = F.translate(ascii_lower(F.coalesce(text, F.lit(""))), STOP, GAP)  # a text's own are no ends
    for pattern, by in STEPS:
        # Lines end at END alone.
        out = F.regexp_replace(out, pattern.replace("(?m)", "(?dm)"), by)
    return F.trim(F.translate(out, STOP, END))


def known_sentences() -> dict[str, str]:
    """Normalised sentences and their identifiers."""
    return SENTENCES | JOINED


class _Buckets:
    """A map as a constant, dealt into small ones by a hash of the key."""

    def __init__(self, entries: Mapping[str, Column], kind: str):
        """`kind` is the type of the values."""
        self.n = 2 * len(entries)
        dealt = defaultdict(list)
        for key, value in entries.items():
            dealt[zlib.crc32(key.encode()) % self.n].append((F.lit(key), value))
        none = F.expr(f"cast(map() as map<string, {kind}>)")
        self.maps = F.array(*[
            F.create_map(*chain.from_iterable(dealt[i])) if i in dealt else none for i in range(self.n)
        ])

    def __getitem__(self, key: Column) -> Column:
        """The value of a key, null without one."""
        return F.element_at(F.get(self.maps, F.pmod(F.crc32(key.cast("binary")), F.lit(self.n)).cast("int")), key)


def _first_words(text: Column, n: Column) -> Column:
    return F.call_function("substring_index", text, F.lit(" "), n)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the licence sentences of a text, in order, each ended by `|`.

    A known sentence starts and ends where a sentence may end, and may hold such
    places, but no blank line. Of several that start at one place the longest
    counts, and the next one starts behind it.
    """
    sentences = known_sentences()
    known = _Buckets({s: F.lit(i) for s, i in sentences.items()}, "string")
    sizes = defaultdict(set)
    for sentence in sentences:
        words = sentence.split(" ")
        sizes[" ".join(words[:2])].add(len(words))
    starts = _Buckets({two: F.array(*map(F.lit, sorted(found, reverse=True))) for two, found in sizes.items()}, "array<int>")
    most = max(chain.from_iterable(sizes.values()))

    def found_in(pieces: Column) -> Column:
        """Identifiers of one paragraph's sentences."""
        begun = F.filter(
            F.transform(
                pieces,
                lambda _, i: F.struct(
                    i.alias("at"),
                    starts[_first_words(F.array_join(F.slice(pieces, i + 1, 2), " "), F.lit(2))].alias("sizes"),
                ),
            ),
            lambda start: start["sizes"].isNotNull(),
        )

        def longest(start: Column) -> Column:
            """(at, behind, ids) of the longest sentence that starts with a piece."""
            rest = F.slice(pieces, start["at"] + 1, most)  # a piece has a word at least
            plain, ends = F.array_join(rest, " "), F.array_join(rest, END)

            def tried(n_words: Column) -> Column:
                sentence = _first_words(plain, n_words)
                behind = F.substr(ends, F.length(sentence) + 1, F.lit(1))
                ids = F.when(behind.isin("", END), known[sentence])
                n = F.size(F.split(F.substr(ends, F.lit(1), F.length(sentence)), END))
                return F.struct(start["at"].alias("at"), (start["at"] + n).alias("behind"), ids.alias("ids"))

            return F.get(F.filter(F.transform(start["sizes"], tried), lambda t: t["ids"].isNotNull()), F.lit(0))

        none = F.struct(F.lit(0).alias("behind"), F.lit("").alias("ids"))
        return F.aggregate(
            F.transform(begun, longest),
            none,
            lambda so_far, one: F.when(
                one["at"] >= so_far["behind"],
                F.struct(one["behind"].alias("behind"), F.concat(so_far["ids"], one["ids"], F.lit("|")).alias("ids")),
            ).otherwise(so_far),
            lambda last: last["ids"],
        )

    paragraphs = F.transform(F.split(_words_and_ends(text), GAP), lambda paragraph: F.split(paragraph, END))
    return F.array_join(F.transform(paragraphs, found_in), "")


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, sentence_ids, licences, licence.

    `sentence_ids` is the sequence joined by `|`, `licences` all licences whose
    rule matches, sorted and joined by commas, and `licence` the one of the
    first rule that matches (`unknown` if there are licence sentences but no
    rule matches, null without any). Null and empty texts have no sentences;
    repeated rows are judged alike; other columns are ignored.
    """
    joined = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(F.col(text_col)).alias("sentence_ids"))
    # An identifier starts the sequence or follows a bar.
    fits = [(name, F.concat(F.lit("|"), "sentence_ids").contains(f"|{rule}")) for name, rule in RULES]
    first = F.when(F.col("sentence_ids") == "", None)
    for name, fit in fits:
        first = first.when(fit, name)
    every = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(fit, name) for name, fit in fits]))))
    return joined.select(
        "doc_id", "sentence_ids", F.concat_ws(",", every).alias("licences"),
        first.otherwise("unknown").alias("licence"),
    )
