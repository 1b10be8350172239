"""The query catalogue as plain SQL, written filing by filing.

Deliberately another way to the same results than the operators take: filings
are joined to populations row by row and made distinct afterwards.
"""

from __future__ import annotations

from covshare.layout import (
    BUCKETS,
    CLASSES,
    COUNTY,
    DIRECTIONS,
    LEVELS,
    NATION,
    SPEED_TIERS,
    STATE,
    TIERS,
    TOP_BUCKET,
    UPLOAD,
    bucket_column,
    cumulative_column,
    lower_bound_column,
    median_column,
    provider_count_column,
    tier_column,
)
from covshare.sources.fixtures import oracle_ctes


def _pad(value: str, width: int) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return (
        f"CASE WHEN length({text}) >= {width} THEN {text} "
        f"ELSE lpad({text}, {width}, '0') END"
    )


def _pct(part: str, whole: str) -> str:
    return f"100 * (CAST({part} AS DOUBLE) / {whole})"


def _big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


_BLOCK = _pad("block_code", 15)

_COMMON = f"""
filing AS (
SELECT block_code AS block_id, {_BLOCK} AS block_code,
       CAST(substr({_BLOCK}, 1, 5) AS INT) AS county_fips,
       CAST(substr({_BLOCK}, 1, 2) AS INT) AS state_fips,
       hoco_num, substr(dba_name, 1, 23) AS dba_name, consumer, business,
       CAST(coalesce(max_down, 0) AS DOUBLE) AS max_down,
       CAST(coalesce(max_up, 0) AS DOUBLE) AS max_up
FROM deployment_raw),
people AS (SELECT {_BLOCK} AS block_code, gl_pop FROM block_pop_raw),
county AS (
SELECT CAST(county_fips AS INT) AS county_fips,
       CAST(substr({_pad('county_fips', 5)}, 1, 2) AS INT) AS state_fips, county_pop
FROM county_pop_raw),
state_total AS (
SELECT state_fips, {_big('sum(county_pop)')} AS state_pop FROM county GROUP BY state_fips),
den AS (
SELECT county_fips, county.state_fips, county_pop, state_pop,
       (SELECT {_big('sum(state_pop)')} FROM state_total) AS national_pop
FROM county JOIN state_total ON county.state_fips = state_total.state_fips),
located AS (
SELECT f.block_code, f.block_id, f.county_fips, d.state_fips, f.hoco_num,
       f.consumer, f.business, f.max_down, f.max_up, coalesce(p.gl_pop, 0) AS gl_pop,
       d.county_pop, d.state_pop, d.national_pop
FROM filing f LEFT JOIN people p ON f.block_code = p.block_code
JOIN den d ON f.county_fips = d.county_fips),
avail AS (
SELECT *, {_pct('gl_pop', 'county_pop')} AS pct_of_county,
       {_pct('gl_pop', 'state_pop')} AS pct_of_state,
       {_pct('gl_pop', 'national_pop')} AS pct_of_nation
FROM located WHERE gl_pop <> 0)"""

_ACCESS = "max_up >= 3 AND max_down >= 25"
_LACK = "max_up <= 3 AND max_down <= 25"
_BLOCK_COLUMNS = (
    "block_code, county_fips, state_fips, gl_pop, county_pop, state_pop, national_pop"
)
_SHARES = "pct_of_county, pct_of_state, pct_of_nation"
_CLASS_TEST = {"c": "consumer = 1", "b": "business = 1", "a": "business = 1 OR consumer = 1"}
_LABEL = {COUNTY: "county", STATE: "state", NATION: "national"}
_FILING_ROW = "block_code, county_fips, gl_pop, max_down, max_up"


def _query(select: str, *ctes: str) -> str:
    return f"WITH {oracle_ctes()},{_COMMON}" + "".join(f",\n{c}" for c in ctes) + f"\n{select}"


def _blocks(name: str, where: str) -> str:
    """Distinct blocks with a filing that meets a condition."""
    return f"{name} AS (SELECT DISTINCT {_BLOCK_COLUMNS} FROM avail WHERE {where})"


def _by_level(rows: str, measures: dict[str, str], geography: str = "") -> str:
    """Sums at the three levels in long form: level, geo_id, then the measures."""
    parts = []
    for level in LEVELS:
        geo = level.key or "CAST(0 AS INT)"
        group = f"GROUP BY {level.key}" if level.key else ""
        columns = ", ".join(
            f"{_pct(f'coalesce({_big(total)}, 0)', f'max({level.population})')} AS {name}"
            for name, total in measures.items()
        )
        parts.append(f"SELECT '{level.name}' AS level, {geo} AS geo_id, {columns} FROM {rows} {group}")
    return "\nUNION ALL ".join(parts)


# -- blocks by top speed -----------------------------------------------------


def _top(direction) -> str:
    speed, top = direction.speed, direction.top_speed
    return f"""{top}s AS (
SELECT DISTINCT {_BLOCK_COLUMNS}, {_SHARES}, {speed} AS {top}
FROM (SELECT *, max({speed}) OVER (PARTITION BY block_code) AS best
      FROM avail WHERE consumer = 1)
WHERE {speed} = best)"""


def _in_tier(speed: str, tier: int) -> str:
    if tier == 0:
        return f"{speed} = 0"
    low = SPEED_TIERS[tier][1]
    floor = f"{speed} > 0" if tier == 1 else f"{speed} >= {low}"
    if tier == len(SPEED_TIERS) - 1:
        return floor
    return f"{floor} AND {speed} < {SPEED_TIERS[tier + 1][1]}"


def _tier_case(speed: str) -> str:
    whens = " ".join(f"WHEN {_in_tier(speed, i)} THEN {i}" for i in TIERS)
    return f"CAST(CASE {whens} END AS INT)"


def _tier_columns(direction, level, speed: str | None = None) -> str:
    speed = speed or direction.top_speed
    return ", ".join(
        _pct(
            f"coalesce({_big(f'sum(CASE WHEN {_in_tier(speed, i)} THEN gl_pop END)')}, 0)",
            f"max({level.population})",
        )
        + f" AS {tier_column(direction, i, level)}"
        for i in TIERS
    )


def _tier_share(direction, level, speed: str | None = None) -> str:
    key = f"{level.key}, " if level.key else ""
    group = f" GROUP BY {level.key}" if level.key else ""
    return f"SELECT {key}{_tier_columns(direction, level, speed)} FROM {direction.top_speed}s{group}"


# -- providers ---------------------------------------------------------------

_FREQ = [
    f"""freq_{k.code} AS (
SELECT block_code, {_big('count(DISTINCT hoco_num)')} AS {k.column}
FROM filing WHERE {_CLASS_TEST[k.code]} GROUP BY block_code)"""
    for k in CLASSES
] + [
    """freq AS (
SELECT coalesce(ab.block_code, c.block_code) AS block_code, prov_cons, prov_bus, prov_all
FROM (SELECT coalesce(a.block_code, b.block_code) AS block_code, prov_all, prov_bus
      FROM freq_a a FULL OUTER JOIN freq_b b ON a.block_code = b.block_code) ab
FULL OUTER JOIN freq_c c ON ab.block_code = c.block_code)"""
]

_COUNTED = f"""counted AS (
SELECT DISTINCT f.block_code, coalesce(prov_cons, 0) AS prov_cons,
       coalesce(prov_bus, 0) AS prov_bus, coalesce(prov_all, 0) AS prov_all,
       county_fips, state_fips, gl_pop, county_pop, state_pop, national_pop, {_SHARES}
FROM freq f JOIN avail v ON f.block_code = v.block_code WHERE v.consumer = 1)"""


def _in_bucket(klass, bucket: int) -> str:
    sign = ">=" if bucket == TOP_BUCKET else "="
    return f"{klass.column} {sign} {bucket}"


def _people_in(klass, test: str) -> str:
    return f"coalesce({_big(f'sum(CASE WHEN {test} THEN gl_pop END)')}, 0)"


def _bucket_columns(level) -> str:
    return ", ".join(
        _pct(_people_in(k, _in_bucket(k, b)), f"max({level.population})")
        + f" AS {bucket_column(level, k, b)}"
        for k in CLASSES
        for b in BUCKETS
    )


def _upto(klass, bucket: int) -> str:
    return "TRUE" if bucket == TOP_BUCKET else f"{klass.column} <= {bucket}"


def _cumulative_columns(level) -> str:
    return ", ".join(
        _pct(_people_in(k, _upto(k, b)), f"max({level.population})")
        + f" AS {cumulative_column(level, k, b)}"
        for k in CLASSES
        for b in BUCKETS
    )


def _level_rows(level, columns: str, source: str = "counted") -> str:
    key = f"{level.key}, " if level.key else ""
    group = f" GROUP BY {level.key}" if level.key else ""
    return f"SELECT {key}{columns} FROM {source}{group}"


def _bucket_share(level) -> str:
    extra, cte = "", []
    if level is COUNTY:
        extra = "max(state_fips) AS state_fips, max(county_pop) AS county_pop, "
        return _level_rows(level, extra + _bucket_columns(level))
    if level is STATE:
        return f"""SELECT s.*, c.state_pop_covered FROM ({_level_rows(level, _bucket_columns(level))}) s
JOIN ({_COVERED}) c ON s.state_fips = c.state_fips"""
    return _level_rows(level, _bucket_columns(level))


_COVERED = f"""SELECT state_fips, {_big('sum(county_pop)')} AS state_pop_covered
FROM (SELECT DISTINCT state_fips, county_fips, county_pop FROM counted) GROUP BY state_fips"""


def _cumulative_long(level) -> str:
    key = f"{level.key}, " if level.key else ""
    parts = [
        f"SELECT {key}'{k.code}' AS class, CAST({b} AS INT) AS bucket, "
        f"{cumulative_column(level, k, b)} AS share FROM cumulated"
        for k in CLASSES
        for b in BUCKETS
    ]
    cte = f"cumulated AS ({_level_rows(level, _cumulative_columns(level))})"
    return _query("\nUNION ALL ".join(parts), *_FREQ, _COUNTED, cte)


def _step(level, klass, k: int, mode: str, at: int = 50) -> tuple[str, str]:
    """Condition and value of one step of the interpolated median, or another quantile."""
    low = cumulative_column(level, klass, k)
    high = cumulative_column(level, klass, k + 1)
    reached = f"{high} <= {at}" if mode == "as_written" else f"{high} >= {at}"
    value = (
        f"{k} + CASE WHEN {high} - {low} = 0 THEN CAST('inf' AS DOUBLE) "
        f"ELSE ({at} - {low}) / ({high} - {low}) END"
    )
    return f"{low} < {at} AND {reached}", value


def _median_case(level, klass, mode: str, at: int = 50) -> tuple[str, str]:
    steps = [(k, *_step(level, klass, k, mode, at)) for k in range(TOP_BUCKET)]
    steps.reverse()
    value = " ".join(f"WHEN {test} THEN {value}" for _, test, value in steps)
    bracket = " ".join(f"WHEN {test} THEN {k}" for k, test, _ in steps)
    return f"CASE {value} END", f"CAST(CASE {bracket} END AS INT)"


def _median_long(mode: str) -> str:
    ctes, parts = [], []
    for level in LEVELS:
        ctes.append(f"cum_{level.name} AS ({_level_rows(level, _cumulative_columns(level))})")
        for klass in CLASSES:
            value, bracket = _median_case(level, klass, mode)
            parts.append(
                f"SELECT '{level.name}' AS level, {level.key or 'CAST(0 AS INT)'} AS geo_id, "
                f"'{klass.code}' AS class, {value} AS value, {bracket} AS bracket "
                f"FROM cum_{level.name}"
            )
    return _query("\nUNION ALL ".join(parts), *_FREQ, _COUNTED, *ctes)


def _quantiles_long(mode: str) -> str:
    ctes, parts = [], []
    for level in LEVELS:
        ctes.append(f"cum_{level.name} AS ({_level_rows(level, _cumulative_columns(level))})")
        for klass in CLASSES:
            for at in (25, 50, 75):
                value, bracket = _median_case(level, klass, mode, at)
                parts.append(
                    f"SELECT '{level.name}' AS level, {level.key or 'CAST(0 AS INT)'} AS geo_id, "
                    f"'{klass.code}' AS class, CAST({at} AS DOUBLE) AS quantile, {value} AS value, "
                    f"{bracket} AS bracket FROM cum_{level.name}"
                )
    return _query("\nUNION ALL ".join(parts), *_FREQ, _COUNTED, *ctes)


def _sketched() -> str:
    """The exact counts, which the sketches come close to."""
    parts = []
    for level in LEVELS:
        key = level.key or "CAST(0 AS INT)"
        group = f"GROUP BY {level.key}" if level.key else ""
        for k in CLASSES:
            own = _big(f"count(DISTINCT CASE WHEN {_CLASS_TEST[k.code]} THEN hoco_num END)")
            parts.append(
                f"SELECT '{level.name}' AS level, {key} AS geo_id, '{k.code}' AS class, {own} AS n, "
                f"TRUE AS close FROM filing {group} "
                f"HAVING bool_or({_CLASS_TEST['c']}) AND bool_or({_CLASS_TEST['b']})"
            )
    return _query("\nUNION ALL ".join(parts))


# The tiers of the queries with other edges: position, name, condition on the speed.
_OTHER_TIERS = {
    "dl": (
        (0, "none", "{0} = 0"), (1, "some", "{0} > 0 AND {0} < 10"), (2, "ten", "{0} >= 10 AND {0} < 24.5"),
        (3, "exactly 24.5", "{0} = 24.5"), (4, "more", "{0} > 24.5 AND {0} < 100"), (5, "hundred", "{0} >= 100"),
    ),
    "ul": (
        (0, "one", "{0} >= 1 AND {0} < 3"), (1, "three", "{0} >= 3 AND {0} < 20"), (2, "twenty", "{0} >= 20"),
    ),
}


def _other_tiers(direction) -> str:
    parts = []
    for tier, name, test in _OTHER_TIERS[direction.code]:
        people = f"sum(CASE WHEN {test.format(direction.top_speed)} THEN gl_pop END)"
        rows = _by_level(f"{direction.top_speed}s", {"share": people})
        parts.append(
            f"SELECT level, geo_id, CAST({tier} AS INT) AS tier, '{name}' AS name, share FROM ({rows})"
        )
    return _query("\nUNION ALL ".join(parts), _top(direction))


def _bucket_long() -> str:
    parts = []
    for level in LEVELS:
        group = f"GROUP BY {level.key}" if level.key else ""
        for k in CLASSES:
            columns = ", ".join(
                _pct(_people_in(k, _in_bucket(k, b)), f"max({level.population})")
                + f" AS share_{b}"
                for b in BUCKETS
            )
            parts.append(
                f"SELECT '{level.name}' AS level, {level.key or 'CAST(0 AS INT)'} AS geo_id, "
                f"'{k.code}' AS class, {columns} FROM counted {group}"
            )
    return _query("\nUNION ALL ".join(parts), *_FREQ, _COUNTED)


def _provider_count(level) -> str:
    key = level.key
    parts = []
    for k in CLASSES:
        own = f"{key}, " if key else "'national' AS merge_level, "
        group = f" GROUP BY {key}" if key else ""
        parts.append(
            f"(SELECT {own}{_big('count(DISTINCT hoco_num)')} AS "
            f"{provider_count_column(level, k)} FROM filing WHERE {_CLASS_TEST[k.code]}{group}) {k.code}"
        )
    on = key or "merge_level"
    names = ", ".join(provider_count_column(level, k) for k in CLASSES)
    first = f"c.{key}, " if key else ""
    return (
        f"SELECT {first}{names} FROM {parts[0]} JOIN {parts[1]} ON c.{on} = b.{on} "
        f"JOIN {parts[2]} ON c.{on} = a.{on}"
    )


# -- the county report -------------------------------------------------------

_COUNTY_DATA = f"""county_data AS (
SELECT DISTINCT CAST(h.county_fips AS INT) AS county_fips, n.state_fp AS state_fips,
       n.county_name, h.population, h.housing_units
FROM (SELECT *, {_pad(f"concat(CAST(state_fp AS VARCHAR), {_pad('county_fp', 3)})", 5)} AS k
      FROM county_names_raw) n
JOIN county_housing_raw h ON n.k = {_pad('h.county_fips', 5)})"""


def _share_tables(mode: str) -> list[str]:
    """Access, download and upload shares per level, slips included as written."""
    if mode == "as_written":
        access = [_blocks("access_blocks", _ACCESS), _blocks("covered_blocks", "TRUE")]
        present = f"SELECT DISTINCT {_BLOCK_COLUMNS} FROM avail WHERE ({_ACCESS}) OR ({_LACK})"
        source = {
            ("acc", COUNTY): "access_blocks", ("acc", STATE): "access_blocks", ("acc", NATION): "access_blocks",
            ("ds", COUNTY): "covered_blocks", ("ds", STATE): "covered_blocks", ("ds", NATION): "access_blocks",
            ("us", COUNTY): "covered_blocks", ("us", STATE): "covered_blocks", ("us", NATION): "access_blocks",
        }
    else:
        access = [
            _blocks("access_blocks", _ACCESS),
            _blocks("down_blocks", "max_down >= 25"),
            _blocks("up_blocks", "max_up >= 3"),
        ]
        present = f"SELECT DISTINCT {_BLOCK_COLUMNS} FROM avail"
        names = {"acc": "access_blocks", "ds": "down_blocks", "us": "up_blocks"}
        source = {(s, level): names[s] for s in names for level in LEVELS}
    tables = [*access, f"present AS ({present})"]
    for level in LEVELS:
        key = level.key or "1"
        columns = ", ".join(
            _pct(
                f"coalesce({_big(f'(SELECT sum(gl_pop) FROM {source[s, level]} b WHERE b.{level.key} = p.{level.key})' if level.key else f'(SELECT sum(gl_pop) FROM {source[s, level]})')}, 0)",
                level.population,
            )
            + f" AS pctpopwBB{s}_{level.access_suffix}"
            for s in ("acc", "ds", "us")
        )
        names = f"{level.key}, " if level.key else ""
        tables.append(
            f"shares_{level.name} AS (SELECT {names}{columns} FROM "
            f"(SELECT DISTINCT {names}{level.population} FROM present) p)"
        )
    return tables


_ACCESS_NAMES = [
    f"pctpopwBB{s}_{level.access_suffix}" for level in LEVELS for s in ("acc", "ds", "us")
]
_WITHOUT = [
    f"100 - pctpopwBBacc_{level.access_suffix} AS pctpopwoBBacc_{level.access_suffix}"
    for level in LEVELS
]
_WITHOUT_NAMES = [f"pctpopwoBBacc_{level.access_suffix}" for level in LEVELS]


def _access_step(mode: str) -> list[str]:
    return [
        _COUNTY_DATA,
        *_share_tables(mode),
        f"""step_access AS (
SELECT d.*, {', '.join(_ACCESS_NAMES)}, {', '.join(_WITHOUT)}
FROM county_data d JOIN shares_county c ON d.county_fips = c.county_fips
JOIN shares_state s ON d.state_fips = s.state_fips CROSS JOIN shares_nation)""",
    ]


_TIER_NAMES = [
    tier_column(d, i, level) for d in DIRECTIONS for level in LEVELS for i in TIERS
]


def _common(direction, level, mode: str) -> list[str]:
    columns = [tier_column(direction, i, level) for i in TIERS]
    stem = f"mc{direction.letter.lower()}s"
    largest = f"greatest({', '.join(columns)})"
    labelled = list(columns)
    if mode == "as_written" and level is NATION:
        labelled[1] = tier_column(direction, 1, STATE)
    top = f"greatest({', '.join(labelled)})"
    label = " ".join(f"WHEN {c} = {top} THEN '{c}'" for c in labelled)
    return [
        f"{largest} AS {stem}_prop_{level.tier_suffix}",
        f"CASE {label} END AS {stem}_tier_{level.tier_suffix}",
    ]


_COMMON_NAMES = [
    f"mc{d.letter.lower()}s_{what}_{level.tier_suffix}"
    for d in DIRECTIONS
    for level in LEVELS
    for what in ("prop", "tier")
]
_TOTAL_NAMES = [f"total{d.letter}SPCT" for d in DIRECTIONS]
_FAST = [
    (d, level, f"{stem}_{level.tier_suffix}")
    for d, stem in zip(DIRECTIONS, ("dsgteq25", "usgteq3"))
    for level in LEVELS
]
_FAST_NAMES = [name for _, _, name in _FAST]


def _tiers_step(mode: str) -> list[str]:
    ctes = [_top(d) for d in DIRECTIONS]
    joins = []
    for d in DIRECTIONS:
        for level in LEVELS:
            totals = []
            if level is COUNTY:
                totals.append(f"{_pct('CAST(sum(gl_pop) AS BIGINT)', 'max(county_pop)')} AS total{d.letter}SPCT")
            name = next(n for d2, l2, n in _FAST if d2 is d and l2 is level)
            floor = 3 if d is UPLOAD else 25
            fast = f"coalesce(CAST(sum(CASE WHEN {d.top_speed} >= {floor} THEN gl_pop END) AS BIGINT), 0)"
            totals.append(f"{_pct(fast, f'max({level.population})')} AS {name}")
            table = f"tier_{d.code}_{level.name}"
            ctes.append(
                f"{table} AS (" + _level_rows(
                    level, f"{_tier_columns(d, level)}, {', '.join(totals)}", f"{d.top_speed}s"
                ) + ")"
            )
            joins.append(
                f"JOIN {table} ON a.{level.key} = {table}.{level.key}"
                if level.key
                else f"CROSS JOIN {table}"
            )
    ctes.append(
        f"step_tiers_plain AS (SELECT a.*, 'national' AS merge_level, "
        f"{', '.join(_TIER_NAMES + _TOTAL_NAMES + _FAST_NAMES)} FROM step_access a {' '.join(joins)})"
    )
    common = [c for d in DIRECTIONS for level in LEVELS for c in _common(d, level, mode)]
    ctes.append(f"step_tiers AS (SELECT *, {', '.join(common)} FROM step_tiers_plain)")
    return ctes


_COUNT_NAMES = [provider_count_column(level, k) for level in LEVELS for k in CLASSES]


def _counts_step() -> list[str]:
    ctes = [f"counts_{level.name} AS ({_provider_count(level)})" for level in LEVELS]
    ctes.append(
        f"""step_counts AS (
SELECT t.*, {', '.join(_COUNT_NAMES)} FROM step_tiers t
JOIN counts_county c ON t.county_fips = c.county_fips
JOIN counts_state s ON t.state_fips = s.state_fips CROSS JOIN counts_nation)"""
    )
    return ctes


_BUCKET_NAMES = [
    bucket_column(level, k, b) for level in LEVELS for k in CLASSES for b in BUCKETS
]
_CUMULATIVE_NAMES = [
    cumulative_column(level, k, b) for level in LEVELS for k in CLASSES for b in BUCKETS
]


def _provider_step(mode: str) -> list[str]:
    ctes = [*_FREQ, _COUNTED]
    for level in LEVELS:
        extra = "max(county_pop) AS county_pop, " if level is COUNTY else ""
        ctes.append(
            f"by_{level.name} AS ("
            + _level_rows(level, f"{extra}{_bucket_columns(level)}, {_cumulative_columns(level)}")
            + ")"
        )
    ctes.append(f"covered AS ({_COVERED})")
    ctes.append(
        f"""step_shares AS (
SELECT t.*, c.county_pop, v.state_pop_covered, {', '.join(_BUCKET_NAMES + _CUMULATIVE_NAMES)}
FROM step_counts t JOIN by_county c ON t.county_fips = c.county_fips
JOIN by_state s ON t.state_fips = s.state_fips
JOIN covered v ON t.state_fips = v.state_fips CROSS JOIN by_nation)"""
    )
    medians, labels = [], []
    for level in LEVELS:
        for k in CLASSES:
            value, bracket = _median_case(level, k, mode)
            medians.append(f"{value} AS {median_column(level, k)}")
            stem = cumulative_column(level, k, 0)[:-1]
            if mode == "as_written":
                labels.append(f"'{stem}' || CAST({bracket} AS VARCHAR)")
            else:
                medians.append(f"{bracket} AS {lower_bound_column(level, k)}")
    if labels:
        medians.append(f"coalesce({', '.join(reversed(labels))}) AS lb")
    ctes.append(f"step_medians AS (SELECT *, {', '.join(medians)} FROM step_shares)")
    return ctes


def _report_ctes(mode: str) -> list[str]:
    return [*_access_step(mode), *_tiers_step(mode), *_counts_step(), *_provider_step(mode)]


_IDENTITY = ["county_fips", "state_fips", "county_name", "population", "housing_units"]
_UP_TO_TIERS = [
    *_IDENTITY, "merge_level", *_ACCESS_NAMES, *_WITHOUT_NAMES,
    *_TIER_NAMES, *_COMMON_NAMES, *_TOTAL_NAMES,
]
_UP_TO_SHARES = [
    *_UP_TO_TIERS, *_COUNT_NAMES, "county_pop", "state_pop_covered", *_BUCKET_NAMES,
]


def _final(mode: str) -> str:
    medians = [median_column(level, k) for level in LEVELS for k in CLASSES]
    medians += (
        ["lb"]
        if mode == "as_written"
        else [lower_bound_column(level, k) for level in LEVELS for k in CLASSES]
    )
    kept = [c for c in (*_UP_TO_SHARES, *_CUMULATIVE_NAMES, *_FAST_NAMES, *medians)
            if c not in ("county_fips", "state_fips", "merge_level")]
    return _query(
        f"""SELECT x.county_fips, x.state_fips,
       coalesce(x.merge_level, n.merge_level) AS merge_level,
       {', '.join(kept)}, rural_blocks_c, rural_blocks_s, rural_blocks_n
FROM (SELECT y.*, CAST(coalesce(y.sf, s.state_fips) AS INT) AS state_fips, rural_blocks_s
      FROM (SELECT m.* EXCLUDE (county_fips, state_fips), m.state_fips AS sf,
                   CAST(coalesce(m.county_fips, r.county_fips) AS INT) AS county_fips, rural_blocks_c
            FROM step_medians m FULL OUTER JOIN rural_county_raw r
              ON m.county_fips IS NOT DISTINCT FROM r.county_fips) y
      FULL OUTER JOIN rural_state_raw s ON y.sf IS NOT DISTINCT FROM s.state_fips) x
FULL OUTER JOIN rural_national_raw n ON x.merge_level IS NOT DISTINCT FROM n.merge_level""",
        *_report_ctes(mode),
    )


def _select_report(columns: list[str], step: str, ctes: list[str]) -> str:
    return _query(f"SELECT {', '.join(columns)} FROM {step}", *ctes)


def _enrich(county: str, state: str, nation: str, payload: str) -> str:
    return _query(
        f"""SELECT a.county_fips, a.state_fips, 'national' AS merge_level,
       pctpopwBBacc_county, pctpopwoBBacc_county, {payload}
FROM step_access a LEFT JOIN {county} c ON a.county_fips = c.county_fips
LEFT JOIN {state} s ON a.state_fips = s.state_fips
LEFT JOIN {nation} n ON n.merge_level = 'national'""",
        *_access_step("as_written"),
    )


def _extended(mode: str) -> str:
    return f"""WITH report AS ({_final(mode)}),
{oracle_ctes()},
{_COMMON},
more AS (
SELECT r.*, adopting_c, adopting_s, adopting_n, progress_c, progress_s, progress_n,
       CAST((SELECT max(CASE WHEN pctpopwoBBacc_county < 0 THEN 1 ELSE 0 END) FROM report) AS INT) AS less_than_zero,
       pctpopwoBBacc_county + pctpopwBBacc_county AS totalpct
FROM report r
LEFT JOIN adoption_county_raw ac ON ac.county_fips = r.county_fips
LEFT JOIN adoption_state_raw ast ON ast.state_fips = r.state_fips
LEFT JOIN adoption_national_raw an ON an.merge_level = r.merge_level
LEFT JOIN progress_county_raw pc ON pc.county_fips = r.county_fips
LEFT JOIN progress_state_raw ps ON ps.state_fips = r.state_fips
LEFT JOIN progress_national_raw pn ON pn.merge_level = r.merge_level)
SELECT m.* EXCLUDE (county_fips, state_fips, merge_level), c.county_fips, s.state_code AS state_fips, n.merge_level,
       poverty_allages_c, medianHHinc_c, s.poverty AS poverty_allages_s, s.median_income AS medianHHinc_s,
       n.poverty AS poverty_allages_n, n.median_income AS medianHHinc_n
FROM ({_INCOME_COUNTY}) c LEFT JOIN more m ON m.county_fips = c.county_fips
RIGHT JOIN income_state_raw s ON s.state_code = m.state_fips
JOIN income_national_raw n ON n.merge_level = m.merge_level"""


_INCOME_COUNTY = """SELECT CAST(state_code * 1000 + county_code AS INT) AS county_fips,
       poverty AS poverty_allages_c, median_income AS medianHHinc_c FROM income_county_raw"""


def oracle_queries() -> dict[str, str]:
    as_written, intended = "as_written", "intended"
    whole = "CAST(floor(max_down) AS DOUBLE) AS max_down, CAST(floor(max_up) AS DOUBLE) AS max_up"
    sql = {
        # sources and sinks
        "src_block_pop": _query(
            f"SELECT {_BLOCK} AS block_code, gl_pop, gl_housing_units, gl_households FROM block_pop_raw"
        ),
        "src_deployment": _query(
            "SELECT block_code, county_fips, state_fips, hoco_num, dba_name, consumer, business, max_down, max_up FROM filing"
        ),
        "src_deployment_whole_speeds": _query(
            f"SELECT block_id AS block_code, hoco_num, {whole} FROM filing"
        ),
        "src_reordered": _query(
            f"SELECT {_BLOCK} AS block_code, gl_pop, gl_housing_units, gl_households FROM block_pop_raw"
        ),
        "src_unnamed_column": _query(
            f"SELECT {_BLOCK} AS block_code, gl_pop, gl_housing_units, gl_households, "
            "CASE WHEN block_code % 2 = 0 THEN CAST(block_code % 1000 AS VARCHAR) END AS own_index FROM block_pop_raw"
        ),
        "src_extra_columns": _query(
            "SELECT state_fp, county_fp, county_name, 'H1' AS class_code, "
            "concat('S', CAST(state_fp AS VARCHAR)) AS state_name FROM county_names_raw"
        ),
        "jn_rural_shared_names": _query(
            "SELECT county_fips, state_fips, merge_level, county_pop, rural_blocks_c AS blocks_x, "
            "rural_blocks_s AS blocks_y, rural_blocks_n AS blocks FROM "
            "(SELECT CAST(county_fips AS INTEGER) AS county_fips, county_pop, "
            "CAST(floor(county_fips / 1000) AS INTEGER) AS state_fips, 'national' AS merge_level FROM county_pop_raw) r "
            "FULL JOIN (SELECT CAST(county_fips AS INTEGER) AS county_fips, rural_blocks_c FROM rural_county_raw) c "
            "USING (county_fips) "
            "FULL JOIN (SELECT CAST(state_fips AS INTEGER) AS state_fips, rural_blocks_s FROM rural_state_raw) s "
            "USING (state_fips) FULL JOIN rural_national_raw n USING (merge_level)"
        ),
        "src_county_housing": _query("SELECT county_fips, population, housing_units FROM county_housing_raw"),
        "src_county_population": _query("SELECT county_fips, county_pop FROM county_pop_raw"),
        "src_county_names": _query("SELECT state_fp, county_fp, county_name FROM county_names_raw"),
        "src_pruned": _query(
            "SELECT consumer, business, block_id AS block_code, hoco_num, county_fips, state_fips FROM filing"
        ),
        "snk_csv_roundtrip": _query("SELECT county_fips, county_pop FROM county"),
        "snk_report": _select_report(
            [*_IDENTITY, *_ACCESS_NAMES, *_WITHOUT_NAMES], "step_access", _access_step(as_written)
        ),
        # projections and scalar functions
        "prj_select": _query(f"SELECT {_FILING_ROW} FROM avail"),
        "fn_zero_pad": _query(
            f"""SELECT block_code, {_BLOCK} AS block_text,
       {_pad('CAST(floor(block_code / 10000000000) AS BIGINT)', 5)} AS county_text,
       {_pad('CAST(floor(block_code / 10000000000) AS BIGINT) % 1000', 3)} AS county_part_text,
       {_pad('CAST(floor(block_code / 10000000000000) AS BIGINT)', 2)} AS state_text,
       {_pad('block_code', 5)} AS too_long_text FROM block_pop_raw"""
        ),
        "fn_geo_keys": _query(
            f"""SELECT {_BLOCK} AS block_code,
       CAST(floor(block_code / 10000000000) AS INT) AS county_fips,
       CAST(floor(block_code / 10000000000000) AS INT) AS state_fips,
       CAST(substr({_BLOCK}, 1, 5) AS INT) AS county_from_text,
       CAST(substr({_BLOCK}, 1, 2) AS INT) AS state_from_text FROM block_pop_raw"""
        ),
        "fn_left": _query(
            "SELECT block_code, hoco_num, dba_name AS full_name, substr(dba_name, 1, 23) AS dba_name FROM deployment_raw"
        ),
        "fn_compose_key": _query(
            f"""SELECT state_fp, county_fp,
       {_pad(f"concat(CAST(state_fp AS VARCHAR), {_pad('county_fp', 3)})", 5)} AS county_fips
FROM county_names_raw"""
        ),
        "fn_null_fill": _query(
            """SELECT coalesce(f.block_id, p.block_code) AS block_code, hoco_num,
       coalesce(gl_pop, 0) AS gl_pop, coalesce(max_down, 0) AS max_down, coalesce(max_up, 0) AS max_up
FROM filing f FULL OUTER JOIN block_pop_raw p ON f.block_id = p.block_code"""
        ),
        # filters
        "flt_populated": _query(f"SELECT {_FILING_ROW} FROM located WHERE gl_pop <> 0"),
        "flt_access": _query(f"SELECT {_FILING_ROW} FROM avail WHERE {_ACCESS}"),
        "flt_no_access": _query(f"SELECT {_FILING_ROW} FROM avail WHERE {_LACK}"),
        "flt_speed": _query(f"SELECT {_FILING_ROW} FROM avail WHERE max_down >= 25"),
        "flt_speed_up": _query(f"SELECT {_FILING_ROW} FROM avail WHERE max_up >= 3"),
        "flt_class": _query(
            f"SELECT {_FILING_ROW}, consumer, business FROM avail WHERE business = 1 OR consumer = 1"
        ),
        # block tables
        "blk_pct": _query(f"SELECT DISTINCT block_code, {_SHARES} FROM avail"),
        "blk_population": _query(
            """SELECT DISTINCT block_code, CAST(substr(block_code, 1, 5) AS INT) AS county_fips,
       CAST(substr(block_code, 1, 2) AS INT) AS state_fips, gl_pop FROM people"""
        ),
        # joins
        "jn_outer_indicator": _query(
            f"""SELECT CASE WHEN p.block_code IS NULL THEN 'left_only'
            WHEN f.block_id IS NULL THEN 'right_only' ELSE 'both' END AS provenance,
       {_big('count(*)')} AS n
FROM filing f FULL OUTER JOIN block_pop_raw p ON f.block_id = p.block_code GROUP BY 1"""
        ),
        "jn_county_data": _query(
            f"""SELECT {_pad('county_fips', 5)} AS county_fips, {_pad('state_fips', 2)} AS state_fips,
       county_name, population, housing_units FROM county_data""",
            _COUNTY_DATA,
        ),
        "jn_county_state_pop": _query("SELECT county_fips, state_fips, county_pop, state_pop FROM den"),
        "jn_block_denominators": _query(
            "SELECT block_code, hoco_num, county_fips, state_fips, gl_pop, county_pop, state_pop FROM located"
        ),
        "jn_national": _query("SELECT county_fips, 'national' AS merge_level, national_pop FROM den"),
        # population totals
        "agg_state_pop": _query("SELECT state_fips, state_pop FROM state_total"),
        "agg_national_pop": _query(f"SELECT {_big('sum(state_pop)')} AS national_pop FROM state_total"),
        # shares
        "shr_grouping_sets": _query(
            _by_level(
                "flagged",
                {
                    "access": "sum(CASE WHEN access THEN gl_pop END)",
                    "down": "sum(CASE WHEN down THEN gl_pop END)",
                    "up": "sum(CASE WHEN up THEN gl_pop END)",
                },
            ),
            f"""flagged AS (SELECT {_BLOCK_COLUMNS}, bool_or({_ACCESS}) AS access,
       bool_or(max_down >= 25) AS down, bool_or(max_up >= 3) AS up
FROM avail GROUP BY {_BLOCK_COLUMNS})""",
        ),
        # set operations
        "set_union_access": _query(
            f"""SELECT DISTINCT state_fips, county_fips, block_code, {_SHARES},
       CAST(NULL AS DOUBLE) AS max_down, CAST(NULL AS DOUBLE) AS max_up FROM avail WHERE {_ACCESS}
UNION ALL SELECT state_fips, county_fips, block_code, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE),
       CAST(0 AS DOUBLE), max_down, max_up FROM avail WHERE {_LACK}"""
        ),
        "set_distinct_blocks": _query(
            f"SELECT DISTINCT state_fips, county_fips, block_code, {_SHARES} FROM avail WHERE {_ACCESS}"
        ),
        "set_county_keys": _query(
            "SELECT DISTINCT state_fips, county_pop, county_fips FROM avail WHERE consumer = 1"
        ),
        # providers
        "prov_count_block": _query("SELECT block_code, prov_cons, prov_bus, prov_all FROM freq", *_FREQ),
        "prov_blocks": _query(
            "SELECT block_code, prov_cons, prov_bus, prov_all, "
            + ", ".join(f"CAST(least({k.column}, 8) AS INT) AS bucket_{k.code}" for k in CLASSES)
            + f", {_SHARES} FROM counted",
            *_FREQ,
            _COUNTED,
        ),
        "prov_share_all_classes": _bucket_long(),
        "prov_median_as_written": _median_long(as_written),
        "prov_median_intended": _median_long(intended),
        "prov_quantiles_as_written": _quantiles_long(as_written),
        "prov_quantiles_intended": _quantiles_long(intended),
        "opt_provider_sketches": _sketched(),
        "rpt_extended": _extended(as_written),
        "rpt_extended_intended": _extended(intended),
        "fn_fill_table": _query(
            """SELECT county_fips, CASE WHEN county_fips % 4 <> 1 THEN county_name ELSE '0' END AS county_name,
       CASE WHEN county_fips % 3 <> 0 THEN population ELSE 0 END AS population,
       CASE WHEN county_fips % 5 <> 2 THEN CAST(housing_units AS DOUBLE) / 2 ELSE 0 END AS half_units
FROM county_data""",
            _COUNTY_DATA,
        ),
        "snk_published": _query("SELECT county_fips, state_fips, county_pop FROM county"),
        # the county report
        "rpt_access": _select_report([*_IDENTITY, *_ACCESS_NAMES], "step_access", _access_step(as_written)),
        "rpt_access_intended": _select_report(
            [*_IDENTITY, *_ACCESS_NAMES, *_WITHOUT_NAMES], "step_access", _access_step(intended)
        ),
        "rpt_without_access": _select_report(
            ["county_fips", *[n for n in _ACCESS_NAMES if "BBacc" in n], *_WITHOUT_NAMES],
            "step_access",
            _access_step(as_written),
        ),
        "rpt_tiers": _select_report(
            ["county_fips", "state_fips", "county_name", *_TIER_NAMES],
            "step_tiers",
            [*_access_step(as_written), *_tiers_step(as_written)],
        ),
        "tier_most_common": _select_report(
            ["county_fips", *_COMMON_NAMES],
            "step_tiers",
            [*_access_step(as_written), *_tiers_step(as_written)],
        ),
        "tier_most_common_intended": _select_report(
            ["county_fips", *_COMMON_NAMES],
            "step_tiers",
            [*_access_step(intended), *_tiers_step(intended)],
        ),
        "tier_totals": _select_report(
            ["county_fips", *_TOTAL_NAMES],
            "step_tiers",
            [*_access_step(as_written), *_tiers_step(as_written)],
        ),
        "tier_at_least": _select_report(
            ["county_fips", *_FAST_NAMES],
            "step_tiers",
            [*_access_step(as_written), *_tiers_step(as_written)],
        ),
        "rpt_provider_counts": _select_report(
            [*_UP_TO_TIERS, *_COUNT_NAMES],
            "step_counts",
            [*_access_step(as_written), *_tiers_step(as_written), *_counts_step()],
        ),
        "rpt_provider_shares": _select_report(_UP_TO_SHARES, "step_shares", _report_ctes(as_written)),
        "prov_median_lower_bound": _select_report(
            ["county_fips", "lb"], "step_medians", _report_ctes(as_written)
        ),
        "rpt_final": _final(as_written),
        "rpt_final_intended": _final(intended),
        # optional enrichment
        "opt_left_enrich": _enrich(
            "adoption_county_raw", "adoption_state_raw", "adoption_national_raw",
            "adopting_c, adopting_s, adopting_n",
        ),
        "opt_progress_enrich": _enrich(
            "progress_county_raw", "progress_state_raw", "progress_national_raw",
            "progress_c, progress_s, progress_n",
        ),
        "opt_any_negative": _query(
            """SELECT county_fips, CAST((SELECT max(CASE WHEN pctpopwoBBacc_county < 0 THEN 1 ELSE 0 END)
       FROM step_access) AS INT) AS less_than_zero FROM step_access""",
            *_access_step(as_written),
        ),
        "opt_total_pct": _query(
            "SELECT county_fips, pctpopwoBBacc_county + pctpopwBBacc_county AS totalpct FROM step_access",
            *_access_step(as_written),
        ),
        "opt_income_source": _query(_INCOME_COUNTY),
        "opt_income_join": _query(
            f"""SELECT n.merge_level, s.state_code AS state_fips, c.county_fips, pctpopwBBacc_county,
       pctpopwoBBacc_county, poverty_allages_c, medianHHinc_c,
       s.poverty AS poverty_allages_s, s.median_income AS medianHHinc_s,
       n.poverty AS poverty_allages_n, n.median_income AS medianHHinc_n
FROM ({_INCOME_COUNTY}) c JOIN step_access a ON c.county_fips = a.county_fips
JOIN income_state_raw s ON s.state_code = a.state_fips CROSS JOIN income_national_raw n""",
            *_access_step(as_written),
        ),
        "opt_county_pop_from_blocks": _query(
            f"""SELECT d.county_fips, county_name, population, s.gl_pop FROM county_data d JOIN (
SELECT county_fips, {_big('sum(coalesce(gl_pop, 0))')} AS gl_pop
FROM filing f LEFT JOIN people p ON f.block_code = p.block_code GROUP BY county_fips) s
ON d.county_fips = s.county_fips""",
            _COUNTY_DATA,
        ),
        "opt_county_pop_from_blocks_intended": _query(
            f"""SELECT d.county_fips, county_name, population, s.gl_pop FROM county_data d JOIN (
SELECT county_fips, {_big('sum(coalesce(gl_pop, 0))')} AS gl_pop
FROM (SELECT DISTINCT block_code, county_fips FROM filing) f
LEFT JOIN people p ON f.block_code = p.block_code GROUP BY county_fips) s
ON d.county_fips = s.county_fips""",
            _COUNTY_DATA,
        ),
    }

    # access shares: the zero branch decides which places exist
    surveyed = f"({_ACCESS}) OR ({_LACK})"
    for name, level, where in (
        ("shr_access_county", COUNTY, surveyed),
        ("shr_access_state", STATE, surveyed),
        ("shr_access_national", NATION, surveyed),
        ("shr_access_county_intended", COUNTY, "TRUE"),
    ):
        share = _pct(
            _big("coalesce(sum(CASE WHEN access THEN gl_pop END), 0)"),
            f"max({level.population})",
        )
        sql[name] = _query(
            _level_rows(level, f"{share} AS pct_with_access", "flagged"),
            f"""flagged AS (SELECT {_BLOCK_COLUMNS}, bool_or({_ACCESS}) AS access
FROM avail WHERE {where} GROUP BY {_BLOCK_COLUMNS})""",
        )

    for name, test in (("down", "max_down >= 25"), ("up", "max_up >= 3")):
        flagged = f"""flagged AS (SELECT {_BLOCK_COLUMNS}, bool_or({test}) AS fast,
       bool_or({_ACCESS}) AS access FROM avail GROUP BY {_BLOCK_COLUMNS})"""
        sql[f"shr_{name}_intended"] = _query(
            _by_level("flagged", {"pct": "sum(CASE WHEN fast THEN gl_pop END)"}), flagged
        )
        sql[f"shr_{name}_as_written"] = _query(
            "SELECT level, geo_id, CASE WHEN level = 'nation' THEN access ELSE covered END AS pct FROM ("
            + _by_level(
                "flagged",
                {"covered": "sum(gl_pop)", "access": "sum(CASE WHEN access THEN gl_pop END)"},
            )
            + ")",
            flagged,
        )

    for d in DIRECTIONS:
        top = d.top_speed
        sql[f"blk_top_{d.code}"] = _query(
            f"SELECT block_code, county_fips, state_fips, gl_pop, {top} FROM {top}s", _top(d)
        )
        sql[f"tier_blocks_{d.code}"] = _query(
            f"SELECT block_code, {_tier_case(top)} AS tier, {_SHARES} FROM {top}s", _top(d)
        )
        sql[f"tier_share_{d.code}_other_edges"] = _other_tiers(d)
        sql[f"blk_top_filings_{d.code}"] = _query(
            f"""SELECT block_code, county_fips, hoco_num, gl_pop, max_down, max_up
FROM (SELECT *, max({d.speed}) OVER (PARTITION BY block_code) AS best FROM avail WHERE consumer = 1)
WHERE {d.speed} = best"""
        )
        sql[f"tier_share_{d.code}_whole_speeds"] = _query(
            _tier_share(d, COUNTY, f"floor({top})"), _top(d)
        )
        for level in LEVELS:
            sql[f"tier_share_{d.code}_{_LABEL[level]}"] = _query(_tier_share(d, level), _top(d))

    for level in LEVELS:
        label = _LABEL[level]
        sql[f"prov_count_{label}"] = _query(_provider_count(level))
        sql[f"prov_share_{label}"] = _query(_bucket_share(level), *_FREQ, _COUNTED)
        sql[f"prov_cumulative_{label}"] = _cumulative_long(level)
    return sql
