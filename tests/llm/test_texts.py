"""Operators that judge or encode every text on its own."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import words
from conftest_llm import EDGE, edge, nothing, table  # noqa: F401
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from covshare.llm import boosting, packing, pieces, quality, toxicity, urls, workers
from covshare.llm.tokens import WordEncoder
from covshare.llm.words import find_words, string_bytes
from pyspark.sql import functions as F

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "Å   x\x1cy <|endoftext|>z <|ENDOFTEXT|> İstanbul ΣΑΣ don't 12a3 q\u0301 ", " x  y", "   ", "x▁▁y", "日本語 テキスト😀\n\nné",
    "ab " * 50 + "  " * 20, "\x00 z", "a" * 300,
]


def test_words():
    rng = random.Random(3)
    texts = [None, *("".join(rng.choice(" \t\n\x0bAbÄ日.") for _ in range(rng.randrange(40))) for _ in range(200))]
    found = find_words(*string_bytes(pa.array(texts)))
    raw = found.data.tobytes()
    got = [[] for _ in texts]
    for d, a, b in zip(found.doc, found.starts, found.ends):
        got[d].append(raw[a:b].decode())
    assert got == [words(t, lower=False) for t in texts]
    with np.errstate(over="ignore"):
        hashes = dict(zip(found.hashes(lower=True).tolist(), (words(w)[0] for t in got for w in t)))
    assert len(set(hashes.values())) == len(hashes) == len({w for t in texts for w in words(t)})


def test_word_ids():
    texts = [t for _, t in EDGE] + ODD
    tokenizer = Tokenizer.from_file(WORDS)
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in WordEncoder(WORDS).encode(texts)] == expected


def test_packing(spark, edge):
    rows = packing.pack(edge, WORDS, width=64).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in EDGE}
    by_doc, by_sequence = {}, {}
    for r in rows:
        part = np.asarray(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    copies = Counter(i for i, _ in EDGE)
    for i, spans in by_doc.items():
        places = Counter(p for a, n in spans for p in range(a, a + n))
        assert places == {p: copies[i] for p in range(len(ids[i]))}
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 64 and (at == 64 or at & (at - 1) == 0)


def test_sum_of_squares_level():
    packer = packing.Packer(16, 100)
    rng, total = random.Random(5), 0
    for i in range(300):
        size = rng.randrange(1, 16)
        counts = packer.counts.copy()

        def after(level):
            c = counts.copy()
            if level:
                c[level] -= 1
            if level + size < 16:
                c[level + size] += 1
            return int((c**2).sum())

        best = min(after(h) for h in range(17 - size) if not h or counts[h])
        assert after(packer.level_for(size)) == best
        packer.add(i, b"\0\0\0\0" * size)
        total += size
    packer.finish()
    assert sum(len(p[2]) // 4 for w in packer.closed for p in w) == total


def test_pieces(spark, edge):
    texts = [t for _, t in EDGE if t] + ODD
    library = SentencePieceProcessor(model_file=PIECES)
    encoder = pieces.PieceEncoder(PIECES)
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == library.encode(texts)
    encoded = pieces.encode(edge, PIECES)
    back = Counter((r.doc_id, r.text) for r in pieces.decode(encoded, PIECES).collect())
    assert back == Counter((i, t or "") for i, t in EDGE)
    assert all(r.round_trip for r in pieces.encode_digests(edge, PIECES).collect())


def test_quality_counts(edge, nothing):
    model = boosting.fit(np.zeros((0, len(quality.FEATURES))), np.zeros(0), quality.MONOTONE)
    rows = quality.judge_quality(edge, model, threshold=0.0).collect()
    texts = dict(EDGE)
    for r in rows:
        w = words(texts[r.doc_id], lower=False)
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        often = Counter(windows)
        repeated = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
        lines = [x for x in (texts[r.doc_id] or "").split("\n") if words(x)]
        symbols = sum((texts[r.doc_id] or "").count(c) for c in "#*$%&|<>")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated)
        )
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))
        assert r.kept == (not r.base_failed)
    assert len(rows) == len(EDGE) and quality.judge_quality(nothing, model).count() == 0


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=2000)) > 0).astype(float)
    trees = boosting.fit(x, y, {0: 1, 1: -1})
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.9
    for j, sign in ((0, 1), (1, -1)):
        z = np.repeat(x[:50], 40, axis=0)
        z[:, j] = np.tile(np.linspace(-4, 4, 40), 50)
        steps = np.diff(trees.log_odds(z).reshape(50, 40), axis=1) * sign
        assert (steps >= -1e-9).all()


def test_splits_and_scores_against_a_plain_version():
    """The first split has the largest gain of all, and flattened trees score as nested ones."""
    rng = np.random.default_rng(4)
    for trial in range(8):
        x = rng.integers(0, 6, size=(60, 3)).astype(float)
        y = (x[:, trial % 3] + rng.normal(size=60) > 3).astype(float)
        trees = boosting.fit(x, y, trees=3, depth=2, ridge=1.0, least_weight=2.0)
        p = 1 / (1 + np.exp(-trees.base))
        g, h = y - p, np.full(60, p * (1 - p))
        gains = {}
        for j in range(3):
            for cut in np.unique(x[:, j])[:-1]:
                left = x[:, j] <= cut
                if min(h[left].sum(), h[~left].sum()) >= 2.0:
                    gains[j, cut] = sum(g[s].sum() ** 2 / (h[s].sum() + 1) / 2 for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + 1) / 2
        best = max(gains.values(), default=0)
        if best > 1e-6:
            assert gains[trees.feature[0, 0], trees.threshold[0, 0]] == pytest.approx(best)

        def nested(t, node, row):
            j = trees.feature[t, node]
            if j < 0:
                return trees.value[t, node]
            return nested(t, 2 * node + 1 + (row[j] > trees.threshold[t, node]), row)

        z = rng.normal(3, 3, size=(40, 3))
        z[0] = np.nan
        expected = [trees.base + sum(nested(t, 0, row) for t in range(3)) for row in z]
        assert trees.log_odds(z) == pytest.approx(expected)


def test_quality_sample_has_one_row_per_id(spark):
    """Copies of a sampled document weigh no more than it does."""
    rows = [(i, f"a b c {'x' * (i % 7)}") for i in range(50)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id LONG, quality INT")
    sample = quality.labelled_sample(table(spark, rows + rows[:1] * 300 + [(1, "z")]), labels, "quality", 40)
    assert sample.count() == 40
    assert {r.text for r in sample.collect()} <= {t for _, t in rows}


def test_labelled_urls_as_an_argument(spark):
    """Held-out precision and recall on hosts none of whose words were fitted."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("therionsatl") for _ in range(rng.randrange(5, 9)))

    def url(blocked):
        if blocked:
            return f"http://{word()}-{word()}-{rng.randrange(10**6)}.{word()}.biz/{rng.randrange(10**9)}?a=1&b={rng.randrange(10**9)}&c=3"
        return f"https://{word()}.{rng.choice(('org', 'biz'))}/{word()}/{word()}"

    labelled = spark.createDataFrame([(url(i % 3 == 0), int(i % 3 == 0)) for i in range(900)], "url STRING, blocked INT")
    held = [(i, url(i % 3 == 0)) for i in range(600)]
    pages = spark.createDataFrame(held, "page_id LONG, url STRING")
    verdicts = {r.page_id: r.verdict for r in urls.judge_urls(pages, rules=(), labelled=labelled).collect()}
    blocked = {i for i, v in verdicts.items() if v == "block"}
    right = {i for i in blocked if i % 3 == 0}
    assert len(right) / len(blocked) > 0.95 and len(right) / 200 > 0.95


def test_urls(spark, nothing):
    cases = {
        "http://www.Example.com/en/1?x=/": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "https://a.example.com/en": ("a.example.com", "/en", "com/", "allow"),
        "http://telecom/": ("telecom", "/", None, None),
        "http://com#/": ("com", "", None, None),
        "http://b.NET/es/x#y?z": ("b.net", "/es/x", "net/es/", "block"),
        "http://Ünet.net?/fr/": ("Ünet.net", "", None, None),
        "//no.net/fr/": ("", "", None, None),
        None: ("", "", None, None),
        "": ("", "", None, None),
        "x://y://z/q": ("y:", "//z/q", None, None),
    }
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(cases)], "page_id LONG, url STRING, host STRING, rule INT")
    rows = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert rows[i].verdict == verdict if verdict else rows[i].verdict in ("allow", "block")
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_url_model_on_unseen_hosts():
    rng = random.Random(2)
    name = lambda: "".join(rng.choice("therionsatl") for _ in range(rng.randrange(5, 9)))
    bad = ["casino-" + name() for _ in range(100)] + [name() + "-ads" for _ in range(100)]
    good = [name() for _ in range(600)]
    rows = [(f"http://{h}.org/en/{rng.randrange(9999)}", f"{h}.org", "/en/1", int("-" in h)) for h in bad + good]
    rng.shuffle(rows)
    model = urls.UrlModel(rows[:500])
    assert ((model.blocked([r[:3] for r in rows[500:]]) >= 0.5) == [r[3] for r in rows[500:]]).mean() > 0.95


def url_rows(spark, named):
    return urls.with_parts(spark.createDataFrame([(u, b) for u, b in named], "url STRING, blocked INT"))


def test_url_sample_holds_distinct_urls(spark):
    """An URL with most of the rows and the smallest hash does not fill the sample."""
    named = [(f"http://{'ads-' if i % 2 else 'garden'}{i}.net/a", i % 2) for i in range(300)]
    first = url_rows(spark, named).orderBy(F.xxhash64("url")).first()
    rows = url_rows(spark, named + [(first.url, first.blocked)] * 400)
    once, often = (urls.fit_urls(r, 200).blocked([("http://ads-7.net/a", "ads-7.net", "/a"), ("http://garden8.net/a", "garden8.net", "/a")]) for r in (url_rows(spark, named), rows))
    for p in (once, often):
        assert p[0] > 0.5 > p[1]


def test_suffixes_count_all_rows(spark):
    """A suffix that the sample lacks is judged by all its labelled pages."""
    # Suffixes of the same letters and the same number of rows differ by their labels only.
    names = ["abcd", "abdc", "acbd", "acdb", "adbc", "adcb", "bacd", "badc"]
    hashed = lambda s: sorted(((r.h, r.url) for r in url_rows(spark, [(f"http://h{i:04d}.{s}/", 0) for i in range(2000)]).select("url", F.xxhash64("url").alias("h")).collect()))
    named = [(u, int(s == "badc")) for s in names for _, u in hashed(s)[:25]]
    named += [(u, 0) for _, u in hashed("dcba")[-60:]]
    rows = url_rows(spark, named)
    assert not any(".dcba" in r.url for r in rows.orderBy(F.xxhash64("url")).limit(150).collect())
    pages = rows.select(F.monotonically_increasing_id().alias("page_id"), "url")
    got = urls.judge_urls(pages, rules=(), model=urls.fit_urls(rows, 150)).where("host like '%.dcba'").collect()
    assert len(got) == 60 and all(r.verdict == "allow" for r in got)


def test_toxicity_held_out(spark, edge, nothing):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    models = toxicity.fit_toxicity(docs, labels.where("doc_id % 4 <> 0"), toxicity.CATEGORIES, most_rows=3000)
    names = list(toxicity.CATEGORIES)
    judged = toxicity.judge_toxicity(docs, models, names).join(
        labels.where("doc_id % 4 = 0").select("doc_id", labels.toxic.alias("label")), "doc_id"
    ).groupBy("label", "kept").count().collect()
    n = {(r.label, r.kept): r["count"] for r in judged}
    assert n[1, False] / (n[1, False] + n.get((1, True), 0)) > 0.85
    assert n.get((0, False), 0) / n[0, True] < 0.01
    rows = toxicity.judge_toxicity(edge, models, names).collect()
    assert len(rows) == len(EDGE) and all(r.kept for r in rows)
    assert toxicity.toxic_documents(nothing, labels.limit(0)).count() == 0


def test_toxicity_sample_with_repeated_ids(spark):
    """Copies of one sampled document do not push the others out of the sample."""
    rows = [(i, f"a b {'vile' if i % 2 else 'kind'} c") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id LONG, toxic INT")
    once, often = (
        toxicity.fit_toxicity(table(spark, r), labels, {"toxic": "toxic = 1"}, most_rows=200)
        for r in (rows, rows + rows[:1] * 600)
    )
    assert len(once[0].buckets) > 0
    assert once[0].bias == often[0].bias and list(once[0].weights) == list(often[0].weights)


@pytest.mark.parametrize("operator", [lambda d: packing.pack(d, WORDS), lambda d: pieces.encode_digests(d, PIECES)])
def test_empty(nothing, operator):
    assert operator(nothing).count() == 0


def test_pairs_of_pieces_that_share_a_slot(monkeypatch):
    """With few slots most pairs meet others there; the ids are those of the library."""
    monkeypatch.setattr(pieces, "_SLOT_BITS", 3)
    rng = random.Random(4)
    texts = ["".join(rng.choice("aeinrst mlo\u00e9\u4e2d\U0001f600") for _ in range(400)) for _ in range(20)]
    encoder = pieces.PieceEncoder(PIECES)
    expected = SentencePieceProcessor(model_file=PIECES).encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == expected


def test_what_a_worker_keeps(tmp_path):
    """One object for all tasks that ask for a file one after another, a new one for a new file."""
    made = []

    def make(path):
        made.append(path)
        return object()

    first, second = tmp_path / "a", tmp_path / "b"
    first.write_text("1")
    second.write_text("2")
    one = workers.kept(make, str(first))
    assert workers.kept(make, str(first)) is one
    assert workers.kept(make, str(second)) is not one
    second.write_text("22")
    workers.kept(make, str(second))
    assert made == [str(first), str(second), str(second)]
