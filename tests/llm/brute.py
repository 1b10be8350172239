"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def words(text, lower=True):
    return WORD.findall(ascii_lower(text or "") if lower else text or "")


def shingles(text, width):
    w = words(text)
    if 0 < len(w) < width:
        return {tuple(w)}
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def near_duplicates(rows, width, percent=80):
    """{id: (n_shingles, component)}; every pair that shares a shingle is tested."""
    sets = {i: shingles(t, width) for i, t in rows}
    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    tested = set()
    for members in lists.values():
        for k, a in enumerate(members):
            for b in members[k + 1 :]:
                if (a, b) in tested:
                    continue
                tested.add((a, b))
                both = len(sets[a] & sets[b])
                if both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def removed_flags(rows, length):
    """{id: flags per byte}: bytes covered by a string that a smaller id has too."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in {b[j : j + length] for j in range(len(b) - length + 1)}:
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        flags = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if first[b[j : j + length]] < i:
                flags[j : j + length] = b"\1" * length
        out[i] = flags
    return out
