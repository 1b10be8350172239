"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

import string

from covshare.llm.licences import GAP, RULES, STEPS, STOP, known_sentences

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

_EXACT_DEDUP = f"""
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY sha) AS keep_id,
       CAST(count(*) OVER (PARTITION BY sha) AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY sha) AS kept,
       sha AS text_sha256
FROM (SELECT doc_id, sha256({_LOWER}) AS sha FROM documents)
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licences() -> str:
    known = ", ".join(f"({_text(s)}, {_text(i)})" for s, i in known_sentences().items())
    first = " ".join(f"WHEN contains('|' || sentence_ids, '|{r}') THEN '{n}'" for n, r in RULES)
    every = ", ".join(f"CASE WHEN contains('|' || sentence_ids, '|{r}') THEN '{n}' END" for n, r in RULES)
    normal = f"translate({_LOWER}, {_text(STOP)}, {_text(GAP)})"
    for pattern, by in STEPS:
        normal = f"regexp_replace({normal}, {_text(pattern)}, {_text(by)}, 'g')"
    return f"""
WITH RECURSIVE known(sentence, ids) AS (VALUES {known}),
paragraphs AS (
  SELECT doc_id, unnest(p) AS paragraph, unnest(range(len(p))) AS par
  FROM (SELECT doc_id, string_split(trim(translate({normal}, {_text(STOP)}, chr(10))), {_text(GAP)}) AS p
        FROM documents)),
pieces AS (
  SELECT doc_id, par, pieces, unnest(range(len(pieces))) AS place
  FROM (SELECT doc_id, par, string_split(paragraph, chr(10)) AS pieces FROM paragraphs)),
starts AS (
  SELECT doc_id, par, place, array_to_string(pieces[place + 1 : place + 200], ' ') AS plain,
         array_to_string(pieces[place + 1 : place + 200], chr(10)) AS ends
  FROM pieces),
tried AS (
  SELECT doc_id, par, place, ids, length(sentence) AS n,
         place + len(string_split(substr(ends, 1, length(sentence)), chr(10))) AS behind
  FROM starts JOIN known
    ON starts_with(plain, sentence) AND substr(ends, length(sentence) + 1, 1) IN ('', chr(10))),
longest AS (
  SELECT * FROM tried QUALIFY row_number() OVER (PARTITION BY doc_id, par, place ORDER BY n DESC) = 1),
linked AS (
  SELECT a.doc_id, a.par, a.place, any_value(a.ids) AS ids, min(b.place) AS next
  FROM longest a LEFT JOIN longest b ON b.doc_id = a.doc_id AND b.par = a.par AND b.place >= a.behind
  GROUP BY a.doc_id, a.par, a.place),
taken AS (
  SELECT l.* FROM linked l JOIN (SELECT doc_id, par, min(place) AS place FROM linked GROUP BY doc_id, par) f
    ON f.doc_id = l.doc_id AND f.par = l.par AND f.place = l.place
  UNION ALL
  SELECT l.* FROM taken t JOIN linked l ON l.doc_id = t.doc_id AND l.par = t.par AND l.place = t.next),
found AS (
  SELECT d.doc_id, coalesce(string_agg(ids || '|', '' ORDER BY par, place), '') AS sentence_ids
  FROM documents d LEFT JOIN taken USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, sentence_ids,
       array_to_string(list_sort(list_distinct([{every}])), ',') AS licences,
       CASE WHEN sentence_ids = '' THEN NULL {first} ELSE 'unknown' END AS licence
FROM found
"""


_TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(_LOWER)

_LEXICAL = f"""
WITH tokens AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
factors AS (SELECT doc_id, 25 + (75 * n * n_docs) // n_terms AS m FROM lengths, totals),
asked AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
held AS (
  SELECT doc_id, term, count(*) AS tf FROM tokens SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN factors USING (doc_id)
  GROUP BY item_id, doc_id HAVING score > 0)
SELECT item_id,
       CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scores QUALIFY rank <= 10
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op5_exact_dedup": _EXACT_DEDUP,
        "op10_licences": _licences(),
        "op11_lexical": _LEXICAL,
    }
