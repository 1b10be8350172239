"""Token ids of whole texts by a public tokenizer, word by word.

The tokenizers used here (lower case, BPE with word ends) drop white space and
never join across it, so the ids of a text are those of its words one after
another. Words repeat, so a worker keeps the ids of those it has met.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import regex

_CACHE_BYTES = 200 << 20  # of one worker; a full cache is emptied, which changes no ids
_ENTRY_BYTES = 190  # of the dictionary and both objects, besides their content
_GROUP = 64
_HELD_BYTES = 1 << 20  # of texts whose new words are looked up together

# Letters whose lower case, composition and class never changed; words with
# others, or with the name of a special token, go through the whole tokenizer.
_ODD = regex.compile(r"[^\x20-\x7eÀ-ɏ]|<\|")
# Stands for a blank among ids; no run of ids holds these four bytes.
_BETWEEN = b"\xff\xff\xff\xff"


class WordEncoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._whole = Tokenizer.from_str(json.dumps(spec))
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self._split = regex.compile(f"{splits[0]}| ")
        # The same merges for parts that are normalised and split already.
        spec["normalizer"] = None
        spec["pre_tokenizer"]["pretokenizers"] = [
            {"type": "WhitespaceSplit"},
            *[p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] != "Split"],
        ]
        self._merges = Tokenizer.from_str(json.dumps(spec))
        suffix = spec["model"]["end_of_word_suffix"]
        vocabulary = spec["model"]["vocab"]
        self._is_end = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a part
        self._is_end[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        self._known: dict[bytes, bytes] = {}
        self._parts: dict[str, bytes] = {" ": _BETWEEN}
        self._bytes = 0

    def _learn(self, missing: set[bytes], all_words: set[bytes]) -> None:
        if self._bytes > _CACHE_BYTES:
            self._known, self._parts, self._bytes = {}, {" ": _BETWEEN}, 0
            missing = all_words
        joined = b" ".join(missing).decode()
        other = [w for w in joined.split(" ") if _ODD.search(w)] if _ODD.search(joined) else []
        found = self._whole.encode_batch_fast(other, add_special_tokens=False)
        self._known.update((w.encode(), np.asarray(e.ids, "<u4").tobytes()) for w, e in zip(other, found, strict=True))
        plain = list(missing.difference(map(str.encode, other))) if other else list(missing)
        # Parts of all words in one go, with the blanks between the words.
        parts = self._split.findall(b" ".join(plain).decode().lower())
        self._learn_parts(list(set(parts).difference(self._parts)))
        ids = b"".join(map(self._parts.__getitem__, parts))
        self._known.update(zip(plain, ids.split(_BETWEEN), strict=True) if plain else ())
        self._bytes += sum(map(len, missing)) * 4 + _ENTRY_BYTES * len(missing)

    def _learn_parts(self, parts: list[str]) -> None:
        groups = [parts[at : at + _GROUP] for at in range(0, len(parts), _GROUP)]
        found = self._merges.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoded in zip(groups, found, strict=True):
            ids = np.asarray(encoded.ids, "<u4")
            ends = [0, *((np.flatnonzero(self._is_end[ids]) + 1) * 4).tolist()]
            data = ids.tobytes()
            self._parts.update((p, data[a:b]) for p, a, b in zip(group, ends[:-1], ends[1:], strict=True))
        self._bytes += sum(map(len, parts)) * 4 + _ENTRY_BYTES * len(parts)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text; None counts as empty."""
        held: list[list[bytes]] = []
        size = 0
        for text in texts:
            data = (text or "").encode()
            # The vocabulary is lower case; a special token's name is matched as written.
            held.append((data if b"<|" in data else data.lower()).split())  # at [\x20\x09-\x0D], as it is bytes
            size += len(data)
            if size >= _HELD_BYTES or len(held) >= 512:
                yield from self._ids(held)
                held, size = [], 0
        yield from self._ids(held)

    def _ids(self, held: list[list[bytes]]) -> Iterator[bytes]:
        words = set().union(*held)
        missing = words.difference(self._known)
        if missing:
            self._learn(missing, words)
        known = self._known.__getitem__
        for text in held:
            yield b"".join(map(known, text))
