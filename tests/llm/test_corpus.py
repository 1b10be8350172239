"""Operators that compare documents with each other, and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from conftest_llm import EDGE, edge, nothing, table  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from covshare.llm import minhash, ppm, repeats


def near_copies(seed, copies, words, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    texts = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(text))
    return texts


def check_near(spark, rows, **options):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(table(spark, rows), **options).collect()}
    expected = brute.near_duplicates(rows, options.get("shingle_words", 5))
    assert got == {i: (n, c, c == i) for i, (n, c) in expected.items()}


def test_near_copies_of_one_text(spark):
    # Some copies are linked to the middle of the group, some to few others or none.
    texts = near_copies(1, 160, 120, 7)
    rows = list(enumerate(texts + texts[:20], 100))
    random.Random(1).shuffle(rows)
    check_near(spark, rows, shingle_words=4)


def test_near_edge_rows(spark, edge, nothing):
    rows = minhash.near_duplicates(edge).collect()
    named = sorted({(i, t) for i, t in EDGE if i is not None}, key=lambda r: r[0])
    expected = brute.near_duplicates(named, 5)
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in EDGE)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
        else:
            assert r.component_id is None and r.kept
    assert minhash.near_duplicates(nothing).count() == 0


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {i: i for p in pairs for i in p}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.a: r.b for r in minhash.components(spark.createDataFrame(pairs, "a LONG, b LONG")).collect()}
    assert got == {i: find(i) for i in parent if find(i) != i}


PASSAGE = "This passage stands in many documents, word for word, and is long enough to be found. "


def repeated_rows():
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    rows = [(i, letters(rng.randrange(200)) + (PASSAGE * (i % 3)) + letters(rng.randrange(200))) for i in range(60)]
    rows += [(100 + i, rows[i][1][rng.randrange(30) : -10]) for i in range(20)]
    rows += [(200 + i, "ab" * (20 + 5 * i)) for i in range(6)] + [(300, rows[3][1]), (301, "")]
    return rows


@pytest.mark.parametrize("most_together", [2, 1000])
def test_repeats(spark, most_together, monkeypatch):
    rows = repeated_rows()
    flags = brute.removed_flags(rows, 50)
    spans = {
        r.id: [x.asDict() for x in r.spans] for r in repeats.covered_spans(table(spark, rows), most_together=most_together).collect()
    }
    for i, text in rows:
        data = (text or "").encode()
        got = bytearray(len(data))
        for a, b in repeats._merge(spans.get(i), len(data), 50):
            got[a:b] = b"\1" * (b - a)
        assert got == flags[i], i


def test_repeats_digests(edge, nothing):
    rows = repeats.judge_repeats(edge).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in EDGE)
    flags = brute.removed_flags([(i, t) for i, t in EDGE if i is not None], 50)
    texts = dict(EDGE)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        removed = flags.get(r.doc_id, bytearray(len(data)))
        runs = sum(1 for j, x in enumerate(removed) if x and not (j and removed[j - 1]))
        kept = bytes(x for x, f in zip(data, removed) if not f)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(data), sum(removed), runs, hashlib.sha256(kept).hexdigest()
        )
    assert repeats.judge_repeats(nothing).count() == 0


def test_cut_texts_keep_whole_characters(edge):
    cut = repeats.drop_repeats(edge)
    assert cut.columns == edge.columns
    rows = cut.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in EDGE)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text is None and by_id[6].text == dict(EDGE)[6]
    assert by_id[7].text == " more" and by_id[7].n_chars == 5
    # 12 shares 59 two-byte letters and half of the next with 11.
    assert by_id[12].text == "e"


def test_interval_tree_finds_all_maximal_repeats():
    rng = random.Random(8)
    letters = lambda kinds: "".join(rng.choice(kinds) for _ in range(rng.randrange(9)))
    anchor, length = "0123456789abcdef", 24
    around = [(letters("xy"), letters("uv")) for _ in range(60)]
    texts = [(left + anchor + right).encode() for left, right in around]
    offsets = np.cumsum([0, *map(len, texts)])
    at = np.asarray([len(left) for left, _ in around])
    found = repeats.Repeats(np.zeros(60, np.int64), np.frombuffer(b"".join(texts), np.uint8), offsets, at, length)
    groups = defaultdict(set)
    for g, m in zip(*found.expanded()):
        groups[g].add(int(m))
    got = {(int(found.left[g]), int(found.right[g]) - 16, frozenset(m)) for g, m in groups.items()}
    expected = set()
    for before in range(9):
        for after in range(8 - before, 9):
            classes = defaultdict(list)
            for i, (left, right) in enumerate(around):
                if len(left) >= before and len(right) >= after:
                    classes[left[len(left) - before :], right[:after]].append(i)
            for members in classes.values():
                ends = [(around[i][0][: len(around[i][0]) - before][-1:] or i, around[i][1][after : after + 1] or i) for i in members]
                if len(members) > 1 and all(len(set(e)) > 1 for e in zip(*ends)):
                    expected.add((before, after, frozenset(members)))
    assert expected and got == expected


def brute_maximal(rows, length):
    """{(repeat bytes): occurrences} of maximal repeats that two documents have."""
    data = {i: t.encode() for i, t in rows if t}
    left = {(i, p) for i, d in data.items() for p in range(len(d) - length + 1)}
    out = {}
    n = length
    while left:
        by_string = defaultdict(list)
        for i, p in left:
            by_string[data[i][p : p + n]].append((i, p))
        left = set()
        for string, places in by_string.items():
            if len({i for i, _ in places}) < 2:
                continue
            before = {data[i][p - 1] if p else (i, p) for i, p in places}
            behind = {data[i][p + n] if p + n < len(data[i]) else (i, p) for i, p in places}
            if len(before) > 1 and len(behind) > 1:
                out[string] = set(places)
            left.update((i, p) for i, p in places if p + n < len(data[i]))
        n += 1
    return out


@pytest.mark.parametrize("most_together", [2, 1000])
def test_maximal_repeats(spark, most_together):
    """Whole repeats of several hundred bytes with all occurrences, nested ones too."""
    rng = random.Random(13)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    long, inner = letters(260), letters(90)
    rows = [(i, letters(60) + long[: 260 - 20 * (i % 3)] + letters(40)) for i in range(8)]
    rows += [(20 + i, letters(30) + long[70:200] + letters(30) + inner) for i in range(5)]
    rows += [(40 + i, inner + letters(i) + inner + letters(20)) for i in range(3)] + [(50, rows[0][1]), (51, None), (52, "ab" * 90), (53, "ab" * 60)]
    texts = {i: (t or "").encode() for i, t in rows}
    found = defaultdict(set)
    for r in repeats.maximal_repeats(table(spark, rows).repartition(3), most_together=most_together).collect():
        string = texts[r.doc_id][r.start : r.start + r.length]
        assert hashlib.sha256(string).hexdigest() == r.repeat
        assert (r.doc_id, r.start) not in found[string]
        found[string].add((r.doc_id, r.start))
    expected = brute_maximal(rows, 50)
    many = {s: p for s, p in found.items() if len({i for i, _ in p}) > 1}
    # All are maximal repeats with all their occurrences.
    assert all(expected[s] == p for s, p in many.items())

    def places(string):
        return sum(t.startswith(string, p) for t in texts.values() for p in range(len(t)))

    # Those are missing of which every string is in further places too.
    for string, occurrences in expected.items():
        if string not in many:
            width = 50 if most_together == 2 else min(77, len(string))
            assert all(places(string[k : k + width]) > len(occurrences) for k in range(len(string) - width + 1))
    assert max(map(len, many)) > 250 and inner.encode() in many


def test_ppm(spark, edge, nothing):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["The", "cat", "sat", "étage", "x" * rng.randrange(1, 9)]) for _ in range(rng.randrange(30)))) for i in range(80)]
    order, end = ppm.ORDER, bytes([ppm.END])
    normal = lambda t: end * order + " ".join(brute.words(t)).encode() + end
    contexts, words, ends = [defaultdict(Counter) for _ in range(order + 1)], Counter(), 0
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            words.update(brute.words(t))
            ends += 1
            b = normal(t)
            for p in range(order, len(b)):
                for o in range(order + 1):
                    contexts[o][b[p - o : p]][b[p]] += 1
    total, distinct = sum(words.values()) + ends, len(words) + 1

    def probability(history, symbol):
        out, p = set(), 1.0
        for o in range(order, -1, -1):
            seen = {k: n for k, n in contexts[o].get(history[order - o :], {}).items() if k not in out}
            if seen:
                if symbol in seen:
                    return p * (2 * seen[symbol] - 1) / (2 * sum(seen.values()))
                p *= len(seen) / (2 * sum(seen.values()))
                out |= set(seen)
        return p / (256 - len(out))

    for history in (end * order, b" cat ", b"zzzzz"):
        assert abs(sum(probability(history, s) for s in range(256)) - 1) < 1e-9
    got = {r.doc_id: r for r in ppm.score_documents(table(spark, rows)).collect()}
    for i, t in rows:
        b, w, r = normal(t), brute.words(t), got[i]
        score = sum(math.log10(probability(b[p - order : p], b[p])) for p in range(order, len(b)))
        base = sum(math.log10((c + 1) / (total + distinct + 1)) for c in [*(words[x] for x in w), ends])
        assert r.score == pytest.approx(score, rel=1e-9) and r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            zlib.crc32(str(i).encode()) % 7 == 2, len(w) + 1, sum(x in words for x in w) + 1, total
        )
    assert ppm.score_documents(edge).count() == len(EDGE) and ppm.score_documents(nothing).count() == 0


def test_code_lengths_lookup():
    keys = np.random.default_rng(1).integers(0, 1 << 48, 5000)
    keys = np.unique(keys)
    lookup = ppm.Lookup(keys, keys * 2)
    asked = np.random.default_rng(2).choice(keys, 20_000)
    assert (lookup[asked] == asked * 2).all()


def test_pipeline(spark, tmp_path):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("therionsatl") for _ in range(rng.randrange(2, 9)))
    insults = ["grobian", "lumpen", "zounder"]
    rows, labels = [], []
    for i in range(240):
        text = [word() for _ in range(rng.randrange(60, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(5):
                text[rng.randrange(len(text))] = rng.choice(insults)
        rows.append((i, " ".join(text)))
        if i < 180:
            labels.append((i, 1, int(toxic)))
    rows += [(300 + i, rows[6 * i + 1][1].upper()) for i in range(5)]  # equal
    rows += [(400 + i, rows[6 * i + 2][1] + " and one end more") for i in range(5)]  # near
    rows += [(500 + i, rows[6 * i + 3][1] + " " + PASSAGE + " ".join(word() for _ in range(80))) for i in range(3)]
    rows += [(600, None), (601, ""), (602, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    docs.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")

    left = [r for r in rows if r[0] >= 240 or r[0] % 6]
    groups = defaultdict(list)
    for i, t in left:
        groups[brute.ascii_lower(t or "")].append(i)
    stay = {max(ids) for ids in groups.values()}
    left = [r for r in left if r[0] in stay]
    near = brute.near_duplicates(left, 5)
    left = [r for r in left if near[r[0]][1] == r[0]]
    flags = brute.removed_flags(left, 50)

    steps = [spark.read.parquet(f"{tmp_path}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, steps[-1], str(tmp_path))
        assert out.dtypes == steps[0].dtypes
        out.write.parquet(f"{tmp_path}/stage{k}")
        steps.append(spark.read.parquet(f"{tmp_path}/stage{k}"))
    final = {r.doc_id: r.text for r in steps[-1].collect()}
    assert final == {i: None if t is None else bytes(x for x, f in zip(t.encode(), flags[i]) if not f).decode() for i, t in left}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(final)
    tokens = Counter()
    for r in pieces:
        tokens[r.doc_id] += r.length
    assert all(tokens[r.doc_id] == r.doc_tokens for r in pieces)


def overlapping_groups(seed, width=150):
    """Near copies of several texts that are near copies of each other in turn."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"

    def edited(text, edits):
        text = list(text)
        for _ in range(edits):
            text[rng.randrange(len(text))] = word()
        return text

    base = [word() for _ in range(width)]
    texts = []
    for family in range(5):
        # Some families are linked to the one before, some too far from it.
        base = edited(base, (3, 14)[family % 2])
        centre = base
        texts += [edited(centre, rng.choice((0, 1, 2, 4, 6, 9, 12, 20))) for _ in range(60)]
        texts += [centre[: width - 4 * k] for k in range(1, 12)]
    rows = list(enumerate((" ".join(t) for t in texts), 10))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shingle_words, direct, later, rounds", [(4, 128, 1 << 14, 4), (5, 8, 8, 4), (5, 8, 1 << 14, 4), (5, 8, 8, 1)])
def test_overlapping_groups(spark, monkeypatch, shingle_words, direct, later, rounds):
    """Also where several rounds of leaders are needed, and where the last one cuts them short."""
    monkeypatch.setattr(minhash, "_DIRECT", direct)
    monkeypatch.setattr(minhash, "_DIRECT_LATER", later)
    monkeypatch.setattr(minhash, "_ROUNDS", rounds)
    # A bound below the share of collisions that any linked pair has.
    check_near(spark, overlapping_groups(shingle_words), shingle_words=shingle_words, matches=30)


def test_pairs_that_lists_of_differences_test(spark):
    """Every linked pair is tested, once, and few of those that share too little."""
    rng = random.Random(9)
    leader = list(range(100))
    sets = {0: leader}
    for i in range(1, 120):  # 20 shingles gone and 20 new ones, from few or many that a group may lose or get
        group, pool = i % 4, 26 if i % 3 else 34
        gone = rng.sample(range(20 * group, 20 * group + pool), 20)
        sets[i] = sorted(set(leader) - set(gone) | {1000 * group + j for j in rng.sample(range(100, 100 + pool), 20)})
    frame = spark.createDataFrame(list(sets.items()), "id LONG, shingles ARRAY<LONG>")
    pairs = spark.createDataFrame([(0, i) for i in sets if i], "leader LONG, id LONG")
    compared = minhash._compared(pairs, frame, 80).withColumn("component", F.col("id"))
    lists = minhash._difference_lists(compared.where("wide"))
    tests = [(r.a, r.b) for r in minhash._tests(lists, 80).collect()]
    near_leader = {r.id for r in compared.where("linked").collect()}
    linked = {
        (a, b) for a in sets for b in sets
        if a > b > 0 and not {a, b} <= near_leader
        and 100 * len(set(sets[a]) & set(sets[b])) >= 80 * len(set(sets[a]) | set(sets[b]))
    }
    assert linked <= set(tests) and len(tests) == len(set(tests))
    asked = lists.where("indexed").select("key", F.col("id").alias("other"))
    every = lists.join(asked, "key").where("id <> other").select(F.least("id", "other"), F.greatest("id", "other")).distinct().count()
    assert 0 < len(linked) and len(tests) < 0.9 * every


def test_rows_without_partner_leave_their_lists(spark):
    """No test is lost with the rows that leave, whatever the components."""
    rng = random.Random(12)
    rows = []
    for key in range(40):
        for i in range(rng.randrange(2, 9)):
            rest = rng.randrange(1, 12)
            rows.append((key, 100 * key + i, 100 * key + i, True, False, 20, rest, rng.randrange(0, 6000)))
    columns = "key LONG, id LONG, component LONG, indexed BOOLEAN, linked BOOLEAN, weight LONG, rest LONG, lack LONG"
    lists = spark.createDataFrame(rows, columns)
    left = minhash._with_partner(lists, 80)
    tests = {(r.a, r.b) for r in minhash._tests(lists, 80).collect()}
    assert tests and tests == {(r.a, r.b) for r in minhash._tests(left, 80).collect()}
    kept = {r.id for r in left.collect()}
    assert {i for pair in tests for i in pair} <= kept and len(kept) < 0.9 * len(rows)
    alone = [(1, 1, 1, True, False, 20, 5, 1700), (1, 2, 2, True, False, 20, 9, 100), (1, 3, 3, True, False, 20, 9, 3500)]
    assert {r.id for r in minhash._with_partner(spark.createDataFrame(alone, columns), 80).collect()} == {1, 2}
    # Where nothing is known to lack, as in the lists of the first round, all rows stay.
    first = lists.withColumns({"rest": F.lit(0).cast("long"), "lack": F.lit(0).cast("long")})
    assert minhash._with_partner(first, 80).count() == len(rows)


def test_differences_of_a_group_are_listed_once(spark, monkeypatch):
    """Near copies of one text whose lists of differences are long, but hardly hold a
    pair to test: they are not compared with further leaders."""
    made, lists_of = [], minhash._difference_lists

    def counted(compared):
        made.append(compared.agg(F.count("*"), F.sum(F.size("differences"))).first())
        return lists_of(compared)

    monkeypatch.setattr(minhash, "_difference_lists", counted)
    monkeypatch.setattr(minhash, "_DIRECT_LATER", 1 << 8)
    texts = near_copies(3, 300, 100, 9)
    check_near(spark, list(enumerate(texts)))
    first, later = made[0], made[1:]
    assert first[0] > 200 and sum(rows for _, rows in later) < 0.1 * first[1]


TWICE = [(1, PASSAGE * 2 + "alone"), (5, PASSAGE * 2 + "alone"), (5, "quite another text " * 5), (7, "x" + PASSAGE + "y"), (7, "quite another text " * 5)]


def test_an_id_with_two_texts(spark):
    got = Counter(
        (r.doc_id, r.n_bytes, r.n_removed) for r in repeats.judge_repeats(table(spark, TWICE)).collect()
    )
    n, m = len(TWICE[0][1]), len(TWICE[2][1])
    assert got == Counter([(1, n, 0), (5, n, n), (5, m, 0), (7, len(PASSAGE) + 2, len(PASSAGE)), (7, m, m)])
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    rows = [(1, texts[0]), (5, texts[0] + " more"), (5, texts[1]), (7, texts[1] + " more"), (9, texts[2]), (9, texts[2])]
    near = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(table(spark, rows)).collect())
    assert near == Counter([(1, 1, True), (5, 1, False), (5, 5, True), (7, 5, False), (9, 9, True), (9, 9, True)])
    left = Counter((r.doc_id, r.text) for r in minhash.drop_near_duplicates(table(spark, rows)).collect())
    assert left == Counter([rows[0], rows[2], rows[4], rows[5]])


def test_pipeline_on_odd_tables(spark, edge, nothing, tmp_path):
    """An empty table, null ids and texts, ids with two texts, columns with clashing names."""
    labels = spark.createDataFrame([(4, 1, 0), (6, 1, 0), (8, 1, 0), (7, 1, 0), (9, 0, 1)], "doc_id LONG, quality INT, toxic INT")
    more = edge.union(table(spark, [(5, "quite another text"), (None, None), (20, _letters(3)), (20, _letters(4))]))
    for name, docs in (("none", nothing), ("odd", more)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(out) == (name == "odd")
    ids = {r.doc_id for r in out}
    assert {2, 3, 5, 20, None} <= ids and 4 not in ids  # 4 equals 5 but for case
    whole = spark.read.parquet(f"{tmp_path}/odd/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, whole, f"{tmp_path}/odd")
        assert kept.dtypes == whole.dtypes
        texts = Counter((r.doc_id, r.text) for r in kept.collect())
        assert texts[5, "quite another text"] == 1 and texts[20, _letters(3)] == texts[20, _letters(4)] == 1


def _letters(seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30))
