"""MinHash near-duplicates by an inverted join on signature coordinates.

Every document has a signature of `COORDINATES` minima. Documents are posted
under their coordinate-value pairs, and two documents are candidates when they
collide in `matches` pairs or more. Two documents with that many collisions
also collide in the first COORDINATES - matches + 1 of their pairs, in any one
order of all pairs; with the rarest first, few lists of the index are long and
most documents have no candidates at all (prefix filter). Candidates are then
confirmed on their full sets of shingles.

Long lists are never expanded into all their pairs. Links are only needed up
to connectivity, so a list tests its members against one leader, and members
that are then in one component need no test. What is left has a member that is
not linked to the leader, and such a pair can only be linked if both differ from
the leader in the same shingles, in more of them than a bound that follows from
the sizes. So the differences are indexed, again with the rarest first, and
that gives new and much shorter lists, until all are settled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covshare.llm import bitmaps
from covshare.llm.exact_dedup import text_key, without_rows
from covshare.llm.words import blocks, find_words, mix, windows
from covshare.llm.workers import short_batches
from covshare.sources.scratch import discard, stored

COORDINATES = 64
# A pair of similarity 0.8 has 64 x 0.8 = 51 collisions on average with a standard
# deviation of 3.2; it has less than 36 once in about 300,000 pairs.
MATCHES = 36

_A, _B = (np.random.default_rng(seed).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1) for seed in (71, 72))
_SHORT = np.uint64(0x5851F42D4C957F2D)


def _block_shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of each shingle; a document with fewer words has one."""
    words = find_words(data, offsets)
    hashes = words.hashes(lower=True)
    first, shingles = windows(hashes, words.doc, width)
    doc = words.doc[first]
    counts = words.per_doc()
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        begin = np.cumsum(counts) - counts
        whole = []
        for d in short:
            h = hashes[begin[d] : begin[d] + counts[d]]
            key = _SHORT * np.uint64(counts[d])
            for j, x in enumerate(h):
                key = mix(np.asarray([key ^ x + np.uint64(j)]))[0]
            whole.append(key)
        order = np.argsort(np.concatenate([doc, short]), kind="stable")
        doc = np.concatenate([doc, short])[order]
        shingles = np.concatenate([shingles, np.asarray(whole, np.uint64)])[order]
    return doc, shingles


def _sets(doc: np.ndarray, shingles: np.ndarray, n_docs: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each document."""
    bounds = np.searchsorted(doc, np.arange(n_docs + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        ordered = np.sort(shingles[a:b])
        if len(ordered) > 1:
            ordered = ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])]
        yield ordered


def _signatures(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for part, data, offsets in blocks(batch):
            with np.errstate(over="ignore"):
                doc, shingles = _block_shingles(data, offsets, width)
                n_docs = len(offsets) - 1
                sizes, digests = [], []
                for distinct in _sets(doc, shingles, n_docs):
                    sizes.append(len(distinct))
                    digests.append(hashlib.blake2b(distinct.tobytes(), digest_size=16).digest())
                signature = np.zeros((n_docs, COORDINATES), np.int32)
                if len(doc):
                    present, at = np.unique(doc, return_index=True)
                    for j in range(COORDINATES):
                        lowest = np.minimum.reduceat(shingles * _A[j] + _B[j], at)
                        signature[present, j] = (lowest >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, signature.size + 1, COORDINATES), pa.int32()), pa.array(signature.ravel())
                    ),
                ],
                ["id", "text_key", "n", "digest", "sig"],
            )


def _shingle_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in blocks(batch):
            with np.errstate(over="ignore"):
                doc, shingles = _block_shingles(data, offsets, width)
                sets = [s.view(np.int64) for s in _sets(doc, shingles, len(offsets) - 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])


def _spread_join(rows: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on `key`, of which `rows` may hold one value in a third of its rows.

    The key is joined together with a hash of it, so that both sides have an
    exchange of their own below the join and adaptive execution can split it.
    """
    spread = F.xxhash64(key, F.lit(key))
    return rows.withColumn("spread", spread).join(small.withColumn("spread", spread), ["spread", key], how).drop("spread")


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) from every node but the smallest of its component to that one.

    Alternating stars: every node's larger neighbours, then its smaller ones, are
    linked to its smallest neighbour until each component is a star. A node with
    many links is a minimum combined before the shuffle and a join that can split.
    """
    def star(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) as (v, smallest of u and its v's)."""
        lowest = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return _spread_join(pairs, lowest, "u")

    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    held = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        large = star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u > v").distinct()
        small = star(down)
        linked = (
            small.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(small.select("u", "m"))
            .where("a > b")
            .distinct()
        )
        edges = stored(linked, "components")
        discard(held)
        held = edges
        # A star has no node that is linked to two, or both from and to others.
        ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select("b", F.lit(0), F.lit(1))
        )
        if ends.groupBy("a").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or up * down > 0").isEmpty():
            return edges


def _prefix_postings(reps: DataFrame, matches: int) -> DataFrame:
    """(key, id, weight): documents under the rarest of their coordinate-value pairs.

    The weight is the smaller, the more other documents a document shares pairs
    with: the middle of a group of near copies has the smallest.

    A pair of one document only can't collide. With `c` other pairs, a document
    can reach `matches` collisions only if c >= matches, and its prefix holds the
    c - matches + 1 rarest of them.
    """
    keys = reps.select("id", F.posexplode("sig").alias("place", "value")).select(
        "id", (F.col("place").cast("long") * F.lit(1 << 32) + F.col("value").cast("long")).alias("key")
    )
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("lists")).where("lists > 1")
    held = (
        _spread_join(keys, shared, "key")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("lists", "key"))).alias("keys"))  # COORDINATES at most
        .where(F.size("keys") >= matches)
    )
    prefix = F.expr(f"slice(keys, 1, size(keys) - {matches - 1})")
    weight = -F.aggregate("keys", F.lit(0).cast("long"), lambda total, x: total + x["lists"])
    return held.select("id", weight.alias("weight"), F.explode(prefix).alias("entry")).select(
        F.col("entry.key").alias("key"), "id", "weight"
    )


def _with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the column's value for each."""
    left = table.select(F.col("id").alias("a"), F.col(column).alias("of_a"))
    right = table.select(F.col("id").alias("b"), F.col(column).alias("of_b"))
    return _spread_join(_spread_join(pairs, right, "b"), left, "a")


def _colliding(pairs: DataFrame, reps: DataFrame, matches: int) -> DataFrame:
    equal = F.aggregate(
        F.zip_with("of_a", "of_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x
    )
    return _with_both(pairs, reps, "sig").where(equal >= matches).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked by their full sets."""
    both = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    either = F.size("of_a") + F.size("of_b") - both
    return _with_both(pairs, sets, "shingles").where(both * 100 >= either * percent).select("a", "b")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For (leader, id): what the id's set C is missing or has besides (`gone`, `new`),
    `linked` (to the leader), `near` and `wide` (zones around it), and three numbers.

    With C the leader's set, Dx = C - X and Ix = X - C, the intersection of A and B
    is |C| - |Da| - |Db| plus the number of differences that a and b share. So they
    must share at least as many as make up `percent`. With b not linked to C, that is
    more than `kept` = (100 |Da| + percent |Ia|) / (100 + percent) by what b lacks to be
    linked to C; if a is not linked to C either, that holds for b as well. As they can't
    share more than |Da| + |Ia|, it is also at least `asked`, which follows from b alone:
    (percent (|B| + |C|) - (100 + percent) |B and C|) / 100. For a pair that is known it is
    (lack of a + lack of b) / 2 (100 + percent), with `lack` of x being
    2 (100 |Dx| + percent |Ix|) - (100 - percent) |C|.

    One minus the similarity is a metric: what is linked to an id in the near zone
    is in the wide one.
    """
    zone = max(0, 3 * percent - 200)
    wide = max(0, zone + percent - 100)
    both = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    total = (F.size("of_a") + F.size("of_b")).cast("long")
    found = (
        _with_both(pairs.select(F.col("leader").alias("b"), F.col("id").alias("a")), sets, "shingles")
        .withColumns({"both": both, "total": total, "gone": F.array_except("of_b", "of_a"), "new": F.array_except("of_a", "of_b")})
        .withColumn("either", F.col("total") - F.col("both"))
    )
    in_wide = F.col("both") * 100 >= F.col("either") * wide
    return found.select(
        F.col("b").alias("leader"), F.col("a").alias("id"),
        (F.col("both") * 100 >= F.col("either") * percent).alias("linked"),
        (F.col("both") * 100 >= F.col("either") * zone).alias("near"),
        in_wide.alias("wide"),
        F.when(in_wide, F.concat("gone", "new")).alias("differences"),
        F.ceil((F.col("total") * percent - F.col("both") * (100 + percent)) / F.lit(100)).alias("asked"),
        F.floor((F.size("gone") * 100 + F.size("new") * percent) / F.lit(100 + percent)).alias("kept"),
        (F.size("gone") * 200 + F.size("new") * 2 * percent - F.size("of_b") * (100 - percent)).cast("long").alias("lack"),
    )


def _difference_lists(compared: DataFrame) -> DataFrame:
    """Lists (key, id, component, indexed, linked, weight, rest, lack) such that two ids in
    the wide zone of a leader of which one, b, is not linked to it are in a common list if
    they are linked: both indexed there, or a indexed there and linked to the leader.

    The rarest differences of b up to `asked` (see `_compared`) are asked for, and
    those of every id up to `kept` are indexed. `rest` counts this difference and those
    after it in the order of all: where two ids meet first, they share as many at most.
    """
    known = compared.withColumn("weight", F.size("differences").cast("long"))
    rows = known.select(
        "leader", "id", "component", "asked", "kept", "weight", "lack", F.explode("differences").alias("shingle")
    ).withColumn("key", F.xxhash64("leader", "shingle"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("lists")).where("lists > 1")
    ordered = (
        _spread_join(rows.drop("shingle"), shared, "key")
        .groupBy("leader", "id", "component", "asked", "kept", "weight", "lack")
        .agg(F.sort_array(F.collect_list(F.struct("lists", "key"))).alias("keys"))  # a set's differences at most
        # Places in the order of all differences; those of one document only come first.
        .withColumn("alone", F.col("weight") - F.size("keys"))
        .withColumn("indexed_to", F.col("weight") - F.col("kept"))
        .withColumn("asked_to", F.when(F.col("asked") > 0, F.col("weight") - F.col("asked") + 1).otherwise(0))
        .withColumn("use", F.greatest(F.lit(0), F.greatest("indexed_to", "asked_to") - F.col("alone")).cast("int"))
        .select(
            "id", "component", "asked", "weight", "lack", "alone", "indexed_to",
            F.posexplode(F.expr("slice(keys, 1, use)")).alias("place", "entry"),
        )
    )
    return ordered.select(
        F.col("entry.key").alias("key"), "id", "component", (F.col("alone") + F.col("place") < F.col("indexed_to")).alias("indexed"),
        (F.col("asked") <= 0).alias("linked"), "weight", (F.col("weight") - F.col("alone") - F.col("place")).alias("rest"), "lack",
    )


def _with_partner(lists: DataFrame, percent: int) -> DataFrame:
    """The rows of lists without those that `_tests` leaves out with every row of their list.

    It asks for 2 (100 + percent) rest >= lack + lack of the other, with the rest of either.
    So the smallest lack in the list must not be over what a row's rest leaves for the
    other, nor a row's lack over the most that any rest in the list leaves. In a group of
    near copies most rows of the long lists fail that, and need no further leader.
    """
    leaves = F.col("rest") * (2 * (100 + percent)) - F.col("lack")
    bounds = lists.groupBy("key").agg(F.min("lack").alias("least_lack"), F.max(leaves).alias("most_left"))
    return (
        _spread_join(lists, bounds, "key")
        .where((F.col("least_lack") <= leaves) & (F.col("lack") <= F.col("most_left")))
        .select(*lists.columns)
    )


def _tests(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of lists that have to be tested, each once.

    Of two rows that are indexed one asks for the other. A pair is left out where it
    can't share enough from there on, were that the first list it meets in (see
    `_difference_lists`); what is linked can, in the first one.
    """
    some = lists.where("indexed").select(
        "key", F.col("id").alias("other"), F.col("component").alias("of_other"), F.col("linked").alias("other_linked"),
        F.col("rest").alias("other_rest"), F.col("lack").alias("other_lack"),
    )
    return (
        lists.select("key", "id", "component", "indexed", "rest", "lack")
        .join(some, "key")
        .where("component <> of_other and ((indexed and id > other) or (not indexed and other_linked))")
        .where(F.least("rest", "other_rest") * (2 * (100 + percent)) >= F.col("lack") + F.col("other_lack"))
        .select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b"))
        .distinct()
    )


# Tests in a list that are made without a leader. Lists of differences are short, and
# a leader for each would compare the same documents again and again.
_DIRECT, _DIRECT_LATER = 128, 1 << 14
_ROUNDS = 4  # with leaders; what they leave is tested directly


def _links(reps: DataFrame, sets_of, matches: int, percent: int) -> DataFrame | None:
    """Edges (a, b) to the smallest member of each component, None without links.

    In each round a list with many tests compares its members with a leader. Those
    near it leave the list: the differences from the leader are indexed, and any
    link of theirs is in the lists of that index. Those further off stay for the
    next round's leader. So lists only lose members, and new ones hold ids that
    share what sets them apart from a leader, and enough of it to be tested.
    """
    # In these lists a pair may collide often enough from any place on: nothing is lacking.
    first = {"component": F.col("id"), "indexed": F.lit(True), "linked": F.lit(False), "rest": F.lit(0).cast("long"), "lack": F.lit(0).cast("long")}
    columns = ["key", "id", "component", "indexed", "linked", "weight", "rest", "lack"]
    lists = stored(_prefix_postings(reps, matches).withColumns(first).select(*columns), "lists")
    if lists.isEmpty():
        return None
    sets = sets_of(lists.select("id").distinct())
    found, known = [], None
    few = _DIRECT
    for left in reversed(range(_ROUNDS + 1)):
        open_lists = stored(_open_lists(lists), "open")
        discard(lists)
        tests = _tests(open_lists.where(F.col("tests") <= few) if left else open_lists, percent)
        found.append(stored(_linked(_colliding(tests, reps, matches), sets, percent), "edges"))
        with_leader = open_lists.where((F.col("tests") > few) & (F.col("id") != F.col("leader")))
        if not left or with_leader.isEmpty():
            discard(open_lists)
            break
        compared = stored(_compared(with_leader.select("leader", "id").distinct(), sets, percent), "compared")
        found.append(stored(compared.where("linked").select(F.col("id").alias("a"), F.col("leader").alias("b")), "edges"))
        # Until the end it is enough to know that those linked to one leader belong together.
        own = found[-1].groupBy("a").agg(F.min("b").alias("b"))
        known, before = stored(own if known is None else own.union(known).groupBy("a").agg(F.min("b").alias("b")), "known"), known
        near = compared.where("near").select("leader", "id")
        further = with_leader.join(near, ["leader", "id"], "left_anti")
        further = _component(further.drop("component"), known, "id", "component").select(*columns)
        new = stored(_difference_lists(_unsettled(compared, known)).select(*columns), "differences")
        lists = stored(further.union(_with_partner(new, percent)), "lists")
        discard(compared, open_lists, before, new)
        few = _DIRECT_LATER
    discard(sets, known)
    every = reduce(DataFrame.union, found)
    edges = None if every.isEmpty() else components(every)
    discard(*found)
    return edges


def _component(rows: DataFrame, known: DataFrame, column: str, name: str) -> DataFrame:
    """Rows with what an id belongs to as far as is known, (a, b): itself if nothing is."""
    centres = known.select(F.col("a").alias(column), F.col("b").alias(name))
    return _spread_join(rows, centres, column, "left").withColumn(name, F.coalesce(name, column))


def _unsettled(compared: DataFrame, known: DataFrame) -> DataFrame:
    """What is in the wide zone of a leader in which there is an id of another
    component, with each id's component."""
    of_id = _component(compared.where("wide"), known, "id", "component")
    spans = of_id.groupBy("leader").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    some = _component(spans, known, "leader", "own").where("low <> own or high <> own").select("leader")
    return _spread_join(of_id, some, "leader")


def _open_lists(lists: DataFrame) -> DataFrame:
    """Rows of the lists that hold several components, with the number of tests that
    the list needs at most, and its leader.

    The indexed row with the smallest weight leads a list, or rather the one that
    leads the best of the lists that this one is in: so the lists of one group
    of near copies share a leader, which need not be in each of them."""
    entry = F.when(F.col("indexed"), F.struct("weight", "id"))
    spans = (
        lists.groupBy("key")
        .agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"),
            F.sum(F.col("indexed").cast("long")).alias("m"),
            F.sum((F.col("indexed") & F.col("linked")).cast("long")).alias("l"),
            F.min(entry).alias("entry"),
        )
        .where("low < high and (m > 1 or l > 0)")
        .select("key", F.expr("m * m + l * n").alias("tests"), "entry")
    )
    rows = _spread_join(lists, spans, "key").withColumn("first", F.col("entry.id"))
    best = rows.groupBy("id").agg(F.min("entry").alias("best")).select(F.col("id").alias("first"), F.col("best.id").alias("leader"))
    return _spread_join(rows.drop("entry"), best, "first").select(*lists.columns, "tests", "leader")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    matches: int = MATCHES,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A document's set holds the distinct shingles of `shingle_words` words after
    lower-casing A-Z; with fewer words the whole sequence is one shingle, and a
    null or empty text has none and no links. Documents with
    100 * intersection >= percent * union are linked; component_id is the
    smallest id reachable over links, and kept tells whether that is the
    document's own. Equal sets are one node from the start, so copies are never
    paired. Rows that repeat an id are one document each, judged by its own text;
    equal texts get the same answer. A row with a null id has no links and is kept.
    Other columns are ignored, an empty table gives no rows. `matches` collisions are
    asked for before the exact test: lower it for a `percent` below 80.
    """
    return _judged(docs, id_col, text_col, shingle_words, percent, matches).drop("text_key")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """The documents whose component has no smaller id, with all their columns.

    Documents without words, and those with a null id, all stay. Rows that repeat
    an id are judged by their texts, one by one.
    """
    judged = _judged(docs, id_col, text_col, shingle_words, percent, MATCHES)
    return without_rows(docs, judged.where("not kept").select("doc_id", "text_key"), id_col, text_key(docs[f"`{text_col}`"]))


def _judged(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, percent: int, matches: int) -> DataFrame:
    """The rows of `near_duplicates`, with the key of each row's text.

    Every distinct set is a node with a number of its own, whatever ids it has.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        text_key(F.col(text_col)).alias("text_key"),
    )
    signed = stored(
        rows.mapInArrow(
            lambda batches: _signatures(batches, shingle_words), "id long, text_key long, n long, digest binary, sig array<int>"
        ),
        "signatures",
    )
    linkable = signed.where("n > 0 and id is not null")
    # The row that stands for a set; of an id with several texts, one is named by its key.
    groups = stored(
        linkable.groupBy("digest").agg(F.min(F.struct("id", "text_key")).alias("rep"))
        .select("digest", "rep.*", F.monotonically_increasing_id().alias("node")),
        "groups",
    )
    reps = stored(
        _spread_join(linkable, groups.select("digest", F.col("id").alias("of"), F.col("text_key").alias("key"), "node"), "digest")
        .where("id = of and text_key = key")
        .dropDuplicates(["node"])
        .select(F.col("node").alias("id"), "sig"),
        "reps",
    )

    def sets_of(nodes: DataFrame) -> DataFrame:
        """Shingle sets of some nodes; only rows near their ids shuffle."""
        wanted = stored(groups.join(nodes.withColumnRenamed("id", "node"), "node", "left_semi").select("node", "id", "text_key"), "wanted")
        near = bitmaps.maybe_in(rows.where("id is not null"), F.col("id"), bitmaps.members(wanted, "id"), "maybe").where("maybe")
        found = stored(
            near.select("id", "text", "text_key")
            .join(wanted, ["id", "text_key"])
            .dropDuplicates(["node"])
            .select("node", "text")
            .mapInArrow(lambda batches: _shingle_sets(batches, shingle_words), "id long, shingles array<long>"),
            "sets",
        )
        discard(wanted)
        return found

    labels = _links(reps, sets_of, matches, percent)
    discard(reps)
    if labels is None:
        labelled = groups.select("digest", F.col("id").alias("component"))
    else:
        # The smallest id of each component, for those of more than one node.
        known = groups.select("digest", "id", F.col("node").alias("a")).join(labels, "a", "left")
        centres = labels.select(F.col("b").alias("a")).distinct().withColumn("centre", F.lit(True))
        of = stored(
            known.join(centres, "a", "left").select(
                "digest", "id", F.when(F.col("b").isNotNull(), F.col("b")).when(F.col("centre"), F.col("a")).alias("component")
            ),
            "nodes",
        )
        least = of.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
        labelled = _spread_join(of, least, "component", "left").select("digest", F.coalesce("least", "id").alias("component"))
    labelled = stored(labelled, "labelled")
    discard(groups, labels, None if labels is None else of)
    answers = _spread_join(linkable.select("id", "text_key", "n", "digest"), labelled, "digest").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "text_key"
    )
    others = signed.where("n = 0 or id is null").select("id", "n", "id", "text_key")
    return answers.union(others).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key"
    )
