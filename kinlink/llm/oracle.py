"""DuckDB SQL for the queries that SQL can express, over whole tables.

Written from the contracts, in plain joins: no hashes in place of words, no filters before the exact test.
"""

from __future__ import annotations

from . import licenses, secrets

UPPER, LOWER = licenses.UPPER, licenses.LOWER
ALNUM, BLANK = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x20\x09-\x0D]+"


def lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def row_words(pattern: str, text: str) -> str:
    """rid, doc_id, w (list of words) of every row of documents."""
    return f"SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({text}, '{pattern}') AS w FROM documents"


def contamination(window: int = 10) -> str:
    return f"""
WITH d AS ({row_words(ALNUM, lowered('text'))}),
i AS (SELECT item_id, regexp_extract_all({lowered('text')}, '{ALNUM}') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT item_id, w, least({window}, len(w)) AS k, unnest(range(1, greatest(len(w) - {window - 1}, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT rid, k, p, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
occ AS (SELECT rid, p, k, item_id FROM dw JOIN iw USING (k, s)),
hit AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + k)) AS q FROM occ) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)"""


def either_case(pattern: str) -> str:
    """An expression without classes that hold letters of one case only, its ASCII letters in either case."""
    out, inside = "", False
    for at, c in enumerate(pattern):
        inside = c == "[" or inside and c != "]"
        plain = c.isalpha() and not inside and pattern[at - 1 : at] != "\\" and pattern[at - 3 : at - 1] != "\\x"
        out += f"[{c.lower()}{c.upper()}]" if plain else c
    return out


def secret_spans() -> str:
    parts = []
    for rank, rule in enumerate((*secrets.BASE, *secrets.MORE)):
        e = rule.pattern.replace(r"\s", r"\x09-\x0D\x20")
        e = quoted(either_case(e) if rule.ignore_case else e)
        # the pieces between the matches and the matches themselves give the places
        parts.append(f"""
  SELECT rid, {rank} AS rank, '{rule.kind}' AS kind, finish - size AS start, finish, least_part FROM (
    SELECT rid, size, least_part, sum(gap + size) OVER (PARTITION BY rid ORDER BY nth) AS finish FROM (
      SELECT rid, nth, length(gaps[nth]) AS gap, length(found[nth]) AS size, length(parts[nth]) AS least_part FROM (
        SELECT rid, gaps, found, parts, unnest(range(1, len(found) + 1)) AS nth FROM (
          SELECT rid, string_split_regex(text, {e}) AS gaps, regexp_extract_all(text, {e}) AS found, regexp_extract_all(text, {e}, {rule.group}) AS parts FROM d))))
  WHERE least_part >= {rule.least}""")
    base = len(secrets.BASE)
    said = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(finish AS BIGINT)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({' UNION ALL '.join(parts)}),
each AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg({said}, ',' ORDER BY start, rank) FILTER (rank < {base}) AS base, string_agg({said}, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN each USING (rid)"""


def repeats(least: int = 50) -> str:
    return f"""
WITH d AS ({row_words(BLANK, "coalesce(text, '')")}),
windows AS (
  SELECT rid, doc_id, p, array_to_string(w[p:p + {least - 1}], ' ') AS s
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - {least - 2})) AS p FROM d WHERE len(w) >= {least})),
later AS (SELECT rid, p FROM (SELECT rid, p, doc_id, min(doc_id) OVER (PARTITION BY s) AS first_id FROM windows) WHERE first_id < doc_id OR doc_id IS NULL AND first_id IS NOT NULL),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + {least})) AS p FROM later),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT rid, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS text
  FROM words LEFT JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""


def near_copies(size: int = 3, percent: int = 90) -> str:
    return f"""
WITH RECURSIVE d AS ({row_words(BLANK, lowered('text'))}),
s AS (
  SELECT DISTINCT rid, array_to_string(w[p:p + {size - 1}], ' ') AS shingle
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
links AS (
  SELECT a, b FROM (SELECT x.rid AS a, y.rid AS b, count(*) AS shared FROM s x JOIN s y USING (shingle) WHERE x.rid <> y.rid GROUP BY ALL)
  JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * shared >= {percent} * (na.n + nb.n - shared)),
reach AS (SELECT rid, rid AS other FROM d UNION SELECT reach.rid, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT reach.rid, min(d.doc_id) AS component_id FROM reach JOIN d ON d.rid = other GROUP BY reach.rid)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id FROM d LEFT JOIN n USING (rid) JOIN least USING (rid)"""


def license_labels() -> str:
    shapes = {label: licenses._plain(t) for t, label in licenses.TEMPLATES.items()}
    wanted = ", ".join(f"({quoted(label)}, {quoted(word)})" for label, words in shapes.items() for word in words)
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)}, {quoted(p.split()[0])}, {len(p.split())})" for p, label in licenses.PHRASES.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {lowered('text')} AS text FROM documents),
own AS (SELECT rid, doc_id, regexp_extract_all(text, '{ALNUM}') AS w FROM d),
phrases(phrase, label, word, k) AS (VALUES {phrases}),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM own),
places AS (SELECT rid, label, p - 1 AS start FROM words JOIN phrases USING (word) JOIN own USING (rid) WHERE array_to_string(w[p:p + k - 1], ' ') = phrase),
wanted(label, word) AS (VALUES {wanted}),
sizes AS (SELECT label, count(*) AS size FROM wanted GROUP BY label),
lines AS (SELECT rid, unnest(parts) AS line, generate_subscripts(parts, 1) AS nth FROM (SELECT rid, string_split(text, chr(10)) AS parts FROM d)),
tokens AS (SELECT DISTINCT rid, nth, unnest(regexp_extract_all(line, '{ALNUM}')) AS word FROM lines),
shared AS (SELECT rid, nth, label, count(*) AS n FROM tokens JOIN wanted USING (word) GROUP BY ALL),
found AS (SELECT rid, label, n / size AS containment FROM shared JOIN sizes USING (label) WHERE n >= greatest(1, ceil({licenses.THRESHOLD} * size))),
base AS (SELECT rid, count(*) AS n, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY rid),
every AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM places UNION SELECT rid, label FROM found) GROUP BY rid),
best AS (SELECT rid, max(containment) AS score FROM found GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels, CAST(CASE WHEN base.n > 0 THEN 1 ELSE coalesce(best.score, 0) END AS DOUBLE) AS score
FROM own LEFT JOIN base USING (rid) LEFT JOIN every USING (rid) LEFT JOIN best USING (rid)"""


def oracles() -> dict[str, str]:
    return {
        "op2_positional_index": contamination(),
        "op4_trigram_secrets": secret_spans(),
        "op6_suffix_automaton_dedup": repeats(),
        "op9_token_combination_join": near_copies(),
        "op10_license_containment": license_labels(),
    }
