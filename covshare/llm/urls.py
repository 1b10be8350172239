"""URL filters: ordered rules, and boosted trees on lexical features."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covshare.llm import boosting
from covshare.llm.exact_dedup import ascii_lower
from covshare.operators.joins import split_join
from covshare.sources.scratch import stored

# Fixed values: (host, path, verdict) of the default rules.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

# Host words of categories that public block lists name. URLs with
# one of them between dots or hyphens are the blocked examples of the default fit.
BLOCKED_WORDS = (
    "adult", "ads", "bets", "betting", "casino", "pills", "poker", "porn", "spam", "track", "viagra", "warez", "xxx",
)

FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "host_entropy",
    "hyphens", "host_digits", "parameters", "query_length", "fragment", "secure", "suffix_blocked", "suffix_seen",
    "longest_label", "path_digit_ratio",
)
#: More blocked URLs under a suffix never speak for an URL.
MONOTONE = {FEATURES.index("suffix_blocked"): 1}


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Columns host and path: after the first `://` up to `/`, `?`, `#` or the end
    with A-Z lower-cased, and from there up to `?`, `#` or the end."""
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    has = F.coalesce(F.col(url).contains("://"), F.lit(False))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.when(has, ascii_lower(host)).otherwise("")).withColumn(
        "path", F.when(has, path).otherwise("")
    )


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, prefix, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = (F.concat(F.lit("."), host).endswith(f".{name}")) & path.startswith(prefix)
        rule = F.when(fits, f"{name}{prefix}").otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def suffix(host: str) -> str:
    """The last label of a host."""
    return host.rpartition(".")[2]


def lexical(url: str, host: str, path: str, blocked: float, seen: float) -> list[float]:
    """The features of an URL; the last two arguments are its suffix's statistics."""
    query = url.partition("?")[2].partition("#")[0]
    labels = host.split(".")
    digits = sum(c.isdigit() for c in url)
    return [
        len(url), len(host), len(path), path.count("/"), len(labels), digits / max(len(url), 1), _entropy(url),
        _entropy(host), host.count("-"), sum(c.isdigit() for c in host), query.count("=") , len(query),
        float("#" in url), float(url.startswith("https:")), blocked, seen, max(map(len, labels)),
        sum(c.isdigit() for c in path) / max(len(path), 1),
    ]


class Suffixes:
    """For suffixes: the smoothed part of their labelled rows that is blocked, and
    log of how many rows there are. Others have the part of all, and 0."""

    def __init__(self, counts: Iterable[tuple[str, int, int]], rows: int, blocked: int):
        """counts: (suffix, rows, blocked rows); then the same of all labelled rows."""
        self.overall = (blocked + 1) / (rows + 2)
        self.counts = {name: (n, bad) for name, n, bad in counts}

    def smoothed(self, n: int | None, bad: int | None) -> tuple[float, float]:
        """The statistics of a suffix by its counts; None for one without labelled rows."""
        return ((bad + 10 * self.overall) / (n + 10), math.log1p(n)) if n else (self.overall, 0.0)

    def of(self, host: str) -> tuple[float, float]:
        return self.smoothed(*self.counts.get(suffix(host), (None, None)))


class UrlModel:
    """Trees with the suffix statistics that their inputs need.

    Statistics of a whole corpus stay in `table` (suffix, n, bad); the model then
    has those of its sample only, and `judge_urls` joins the pages to the table."""

    def __init__(self, rows: list[tuple[str, str, str, int]], suffixes: Suffixes | None = None, table: DataFrame | None = None):
        """rows: (url, host, path, blocked) of the labelled sample, of which the
        statistics are if they are not given."""
        if suffixes is None:
            total, bad = Counter(), defaultdict(int)
            for _, host, _, blocked in rows:
                total[suffix(host)] += 1
                bad[suffix(host)] += blocked
            suffixes = Suffixes([(s, n, bad[s]) for s, n in total.items()], len(rows), sum(bad.values()))
        self.suffixes, self.table = suffixes, table
        self.trees = boosting.fit(
            self.features([r[:3] for r in rows]), np.asarray([r[3] for r in rows], float), MONOTONE
        )

    def features(self, rows) -> np.ndarray:
        return _matrix([lexical(*r, *self.suffixes.of(r[1])) for r in rows])

    def blocked(self, rows) -> np.ndarray:
        return self.trees.probability(self.features(rows))


def _matrix(features: list[list[float]]) -> np.ndarray:
    return np.asarray(features, float).reshape(-1, len(FEATURES))


def labelled_urls(rows: DataFrame) -> DataFrame:
    """Rows of (url, host, path) with blocked = 1 where the host has a blocked word;
    URLs without a host are not labelled."""
    pattern = rf"(^|[.-])({'|'.join(BLOCKED_WORDS)})([.-]|$)"
    return rows.where("host <> ''").withColumn("blocked", F.col("host").rlike(pattern).cast("int"))


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(suffix, n, bad): rows and blocked rows of every suffix."""
    return labelled.groupBy(_suffix_column().alias("suffix")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("bad")
    )


def _suffix_column() -> Column:
    return F.substring_index("host", ".", -1)


def fit_urls(labelled: DataFrame, most_rows: int = 20_000) -> UrlModel:
    """Fit on at most `most_rows` distinct rows of (url, host, path, blocked 0 or
    1), chosen by a hash of the URL. The suffix statistics count all rows."""
    usable = labelled.where("url is not null and blocked in (0, 1)").select(
        "url", "host", "path", F.col("blocked").cast("int")
    )
    table = stored(suffix_counts(usable), "suffixes")
    rows = (
        usable.distinct()
        .orderBy(F.xxhash64("url"), "url", "blocked", "host", "path")
        .limit(most_rows)
        .collect()
    )
    total = table.agg(F.sum("n"), F.sum("bad")).first()
    names = table.sparkSession.createDataFrame([(s,) for s in {suffix(r.host) for r in rows}], "suffix string")
    known = table.join(F.broadcast(names), "suffix").select("suffix", "n", "bad").collect()  # most_rows bounds both
    return UrlModel([tuple(r) for r in rows], Suffixes(map(tuple, known), total[0] or 0, total[1] or 0), table)


def _scored(batches: Iterator[pa.RecordBatch], trees: boosting.Trees, suffixes: Suffixes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        url, host, path, n, bad = (batch.column(c).to_pylist() for c in ("url", "host", "path", "n", "bad"))
        p = trees.probability(_matrix([
            lexical(u or "", h, q, *suffixes.smoothed(k, b)) for u, h, q, k, b in zip(url, host, path, n, bad, strict=True)
        ]))
        yield batch.drop_columns(["url", "n", "bad"]).append_column("blocked_probability", pa.array(p))


def judge_urls(
    pages: DataFrame, rules=RULES, model: UrlModel | None = None, threshold: float = 0.5,
    id_col: str = "page_id", url_col: str = "url", labelled: DataFrame | None = None,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, blocked_probability.

    The longest rule that fits decides; where none does, the model blocks at
    `threshold`. Without a model one is fitted on `labelled`, rows of (url, blocked 0
    or 1), or without those on the pages' own URLs, labelled by `labelled_urls`. Pages are joined to their suffix's counts, which adaptive
    execution broadcasts if they are small and else deals out, a common suffix to
    several tasks. A null URL, or one without `://`, has an empty host and path and
    is judged by the model like any other; repeated rows are judged alike, other
    columns are ignored, an empty table gives no rows.
    """
    rows = with_parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumn("rule", rule).withColumn("says", verdict)
    if model is None:
        model = fit_urls(labelled_urls(rows) if labelled is None else with_parts(labelled))
    trees, suffixes, table = model.trees, model.suffixes, model.table
    if table is None:
        counts = [(s, *c) for s, c in suffixes.counts.items()]
        table = pages.sparkSession.createDataFrame(counts, "suffix string, n long, bad long")
    counted = split_join(ruled.withColumn("suffix", _suffix_column()), table, "suffix", "left").drop("suffix")
    scored = counted.mapInArrow(
        lambda batches: _scored(batches, trees, suffixes),
        counted.drop("url", "n", "bad").schema.add("blocked_probability", "double"),
    )
    own = F.when(F.col("blocked_probability") >= threshold, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("says", own).alias("verdict"), "blocked_probability"
    )
