"""The SQL that DuckDB runs for the same results, written as a chain of common table expressions."""

from __future__ import annotations

from kinlink import config as C
from kinlink.plans import entities as E

A_STOP = "[" + ", ".join(f"'{w}'" for w in C.STOPWORDS) + "]"
_EVERY = "|".join(sorted(C.LEGAL_SUFFIXES, key=lambda s: -len(s)))


def _map(table: dict[str, str], key: str) -> str:
    return f"(CASE {key} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + " END)"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


def clean(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '[&+]', ' and ', 'g'), '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _tight(c: str) -> str:
    return f"lower(regexp_replace(trim({c}), '\\s*-\\s*', '-', 'g'))"


def normalized(name: str, source: str) -> str:
    """CTEs name_0 .. name: the normalized records of a record view."""
    addr, country = "trim(business_address)", "country_normalized"
    known = " ".join(f"WHEN lower(trim(country)) IN ({', '.join(repr(x) for x in said)}) THEN '{k}'" for k, said in C.COUNTRIES.items())
    front, back = rf"^({_EVERY})\b\s*", rf"\s*\b({_EVERY})$"
    get = lambda p: f"regexp_extract({addr}, {_quoted(p)}, 1)"
    prefixed = f"list_filter(regexp_split_to_array({get(C.HOUSE_PREFIXED)}, '\\s+'), lambda w: w <> '')"
    return f"""{name}_0 AS (SELECT *, substr(entity_id, 1, 2) AS source, {clean('business_name')} AS name_normalized, {clean(addr)} AS cleaned,
  CASE {known} WHEN length(trim(country)) > 3 THEN concat(upper(substr(trim(country), 1, 1)), lower(substr(trim(country), 2))) ELSE upper(trim(country)) END AS country_normalized FROM ({source}) r),
{name}_1 AS (SELECT *, regexp_extract(name_normalized, '{front}', 1) AS lead, trim(regexp_replace(name_normalized, '{front}', '')) AS rest FROM {name}_0),
{name}_2 AS (SELECT *, regexp_extract(rest, '{back}', 1) AS tail, trim(regexp_replace(rest, '{back}', '')) AS core0 FROM {name}_1),
{name}_3 AS (SELECT *, CASE WHEN core0 = '' THEN name_normalized ELSE core0 END AS name_core, coalesce({_map(C.LEGAL_SUFFIXES, "(CASE WHEN lead <> '' THEN lead ELSE tail END)")}, '') AS name_legal_suffix,
  CASE WHEN {addr} = '' THEN 1 ELSE 0 END AS address_is_empty,
  CASE WHEN {addr} = '' THEN '' ELSE array_to_string(list_transform(string_split(cleaned, ' '), lambda w: coalesce({_map(C.ADDRESS_WORDS, 'w')}, w)), ' ') END AS address_normalized,
  CASE upper({country}) WHEN 'INDIA' THEN {get(C.POSTAL_INDIA)} WHEN 'US' THEN {get(C.POSTAL_US)} WHEN 'FRANCE' THEN {get(C.POSTAL_FRANCE)} ELSE CASE WHEN {get(C.POSTAL_INDIA)} <> '' THEN {get(C.POSTAL_INDIA)} ELSE {get(C.POSTAL_US)} END END AS address_postal_code,
  {prefixed} AS pre, {_tight(get(C.HOUSE_LEADING))} AS lead_house, {_tight(get(C.HOUSE_BEFORE_STREET))} AS mid_house FROM {name}_2),
{name} AS (SELECT entity_id, business_name, business_address, country, source, country_normalized, name_normalized, name_core, name_legal_suffix, address_is_empty, address_normalized, address_postal_code,
  CASE WHEN len(pre) > 0 AND length(pre[1]) <= 10 THEN lower(array_to_string(pre[1:2], ' ')) WHEN lead_house <> '' AND length(lead_house) <= 15 THEN lead_house ELSE mid_house END AS address_house_number,
  {words('name_normalized')} AS name_tokens, {words('address_normalized')} AS address_tokens, regexp_extract_all(address_normalized, '\\b\\d+\\b') AS address_numeric_tokens FROM {name}_3)"""


def signature(c: str) -> str:
    told = f"list_filter({c}, lambda w: NOT list_contains({A_STOP}, w) AND length(w) > 1)"
    return f"array_to_string(list_sort(CASE WHEN len({told}) > 0 THEN {told} ELSE {c} END), ' ')"


RECORDS = normalized("s1", E.S1.format(part="part")) + ",\n" + normalized("pool", f"{E.S2.format(part='part')} UNION ALL {E.S3.format(part='part')}") + f",\ntruth AS ({E.TRUTH.format(part='part')})"


def grams(c: str, n: int) -> str:
    return f"CASE WHEN length({c}) >= {n} THEN list_transform(range(1, length({c}) - {n - 2}), lambda i: substr({c}, i, {n})) ELSE [] END"


def gram_set(c: str, n: int) -> str:
    return f"CASE WHEN {c} = '' THEN [] WHEN length({c}) < {n} THEN [{c}] ELSE list_distinct({grams(c, n)}) END"


def jaccard(a: str, b: str) -> str:
    both = f"len(list_distinct(list_concat({a}, {b})))"
    return f"(CASE WHEN {both} = 0 THEN 0.0 ELSE len(list_distinct(list_intersect({a}, {b}))) * 1.0 / {both} END)"


def tfidf(rule: str, k: int, floor: float) -> str:
    """CTEs t_<rule>: s1_id, cand_id, source, sim of the k nearest candidates of each source."""
    short = rule.split("_")[0]
    if rule == "char_tfidf":
        terms, cap = grams("name_core", 3), ""
    else:
        w = "regexp_extract_all(trim(concat_ws(' ', name_core, address_normalized)), '\\b\\w\\w+\\b')"
        terms = f"list_concat({w}, CASE WHEN len({w}) > 1 THEN list_transform(range(1, len({w})), lambda i: concat({w}[i], ' ', {w}[i + 1])) ELSE [] END)"
        cap = " AND df <= 0.5 * n"
    return f"""{short}_c AS (SELECT country_normalized, source, entity_id AS id, unnest({terms}) AS term FROM pool),
{short}_s AS (SELECT country_normalized, entity_id AS id, unnest({terms}) AS term FROM s1),
{short}_n AS (SELECT country_normalized, source, count(*) AS n FROM pool GROUP BY ALL),
{short}_i AS (SELECT country_normalized, source, term, ln((1 + n) / (1 + df)) + 1 AS idf FROM (SELECT country_normalized, source, term, count(DISTINCT id) AS df FROM {short}_c GROUP BY ALL) JOIN {short}_n USING (country_normalized, source) WHERE df >= 2{cap}),
{short}_cv AS (SELECT country_normalized, source, id, term, (1 + ln(count(*))) * any_value(idf) AS v FROM {short}_c JOIN {short}_i USING (country_normalized, source, term) GROUP BY ALL),
{short}_sv AS (SELECT country_normalized, source, id, term, (1 + ln(count(*))) * any_value(idf) AS v FROM {short}_s JOIN {short}_i USING (country_normalized, term) GROUP BY ALL),
{short}_cw AS (SELECT *, v / sqrt(sum(v * v) OVER (PARTITION BY source, id)) AS w FROM {short}_cv),
{short}_sw AS (SELECT *, v / sqrt(sum(v * v) OVER (PARTITION BY source, id)) AS w FROM {short}_sv),
{short}_p AS (SELECT a.id AS s1_id, b.id AS cand_id, source, round(sum(a.w * b.w), 9) AS sim FROM {short}_sw a JOIN {short}_cw b USING (country_normalized, source, term) GROUP BY ALL),
t_{rule} AS (SELECT s1_id, cand_id, source, sim FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY sim DESC, cand_id) AS place FROM {short}_p) WHERE place <= {k} AND sim >= {floor})"""


def fired(cfg: C.BlockingConfig, only: str | None = None) -> str:
    """CTEs up to fired: s1_id, cand_id, rule, detail, source, rule_ord, tok_pos."""
    told = lambda c: f"list_filter({words(c)}, lambda w: NOT list_contains({A_STOP}, w))"
    sig = signature(words("name_core"))
    on, parts, extra = ([only] if only else [r for r in C.RULES[:6]] + (["char_tfidf"] if cfg.char_tfidf else []) + (["combined_tfidf"] if cfg.combined_tfidf else [])), [], []
    for rule in on:
        n = C.RULES.index(rule) + 1
        if n <= 3:
            key = {1: "name_core", 2: "name_normalized", 3: sig}[n]
            keep = "key <> ''" if n == 1 else "key <> '' AND key <> name_core"
            parts.append(f"SELECT a.entity_id AS s1_id, b.cand_id, '{rule}' AS rule, '' AS detail, b.source, {n} AS rule_ord, 0 AS tok_pos FROM (SELECT *, {key} AS key FROM s1) a JOIN (SELECT *, entity_id AS cand_id FROM (SELECT *, {key} AS key FROM pool) WHERE {keep}) b ON a.country_normalized = b.country_normalized AND a.key = b.key WHERE a.key <> ''")
        elif n == 4:
            extra.append(f"""tok AS (SELECT country_normalized, source, entity_id AS cand_id, unnest(list_distinct({words('name_normalized')})) AS key FROM pool),
tok_kept AS (SELECT * FROM tok WHERE NOT list_contains({A_STOP}, key) AND length(key) >= {cfg.token_min_length}),
tok_cap AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY country_normalized, source, key) AS df, row_number() OVER (PARTITION BY country_normalized, source, key ORDER BY cand_id) AS place FROM tok_kept) WHERE df BETWEEN {cfg.token_min_df} AND {cfg.token_max_df} AND place <= {cfg.token_cap})""")
            parts.append(f"SELECT a.s1_id, b.cand_id, 'rare_token' AS rule, a.key AS detail, b.source, 4 AS rule_ord, a.pos AS tok_pos FROM (SELECT country_normalized, entity_id AS s1_id, unnest(name_tokens) AS key, unnest(range(0, len(name_tokens))) AS pos FROM s1) a JOIN tok_cap b ON a.country_normalized = b.country_normalized AND a.key = b.key")
        elif n <= 6:
            column, high, cap = ("address_postal_code", cfg.postal_max_df, cfg.postal_cap) if n == 5 else ("address_house_number", cfg.house_max_df, cfg.house_cap)
            gate = "AND (list_has_any(a.told, b.told) OR (length(a.name_core) >= 2 AND substr(a.name_core, 1, 2) = substr(b.name_core, 1, 2)))" if cfg.weak_name_gate else ""
            parts.append(f"SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, '{rule}' AS rule, '' AS detail, b.source, {n} AS rule_ord, 0 AS tok_pos FROM (SELECT *, {told('name_normalized')} AS told FROM s1 WHERE {column} <> '') a JOIN (SELECT * FROM (SELECT *, {told('name_core')} AS told, count(*) OVER (PARTITION BY country_normalized, source, {column}) AS df, row_number() OVER (PARTITION BY country_normalized, source, {column} ORDER BY entity_id) AS place FROM pool WHERE {column} <> '') WHERE df <= {high} AND place <= {cap}) b ON a.country_normalized = b.country_normalized AND a.{column} = b.{column} WHERE true {gate}")
        else:
            k, floor = (cfg.char_k, cfg.char_floor) if n == 7 else (cfg.combined_k, cfg.combined_floor)
            extra.append(tfidf(rule, k, floor))
            parts.append(f"SELECT s1_id, cand_id, '{rule}' AS rule, printf('%.2f', sim) AS detail, source, {n} AS rule_ord, 0 AS tok_pos FROM t_{rule}")
    return ",\n".join([RECORDS, *extra, f"fired AS ({' UNION ALL '.join(parts)})"])


def candidates(cfg: C.BlockingConfig) -> str:
    """CTEs up to pairs (s1_id, cand_id, source, n_rules, cand_pos) and kept (the firings of these)."""
    cap = cfg.total_cap or 1 << 60
    return fired(cfg) + f""",
grouped AS (SELECT s1_id, cand_id, source, count(*) AS n_rules, min(rule_ord * 100000 + tok_pos) AS first FROM fired GROUP BY ALL),
sized AS (SELECT *, count(*) OVER (PARTITION BY s1_id) AS total FROM grouped),
pairs AS (SELECT s1_id, cand_id, source, n_rules, cand_pos FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY CASE WHEN total > {cap} THEN -n_rules ELSE 0 END, source, first, cand_id) AS cand_pos FROM sized) WHERE cand_pos <= {cap}),
kept AS (SELECT f.* FROM fired f SEMI JOIN pairs p ON f.s1_id = p.s1_id AND f.cand_id = p.cand_id)"""


def per_entity(cfg: C.BlockingConfig) -> str:
    return candidates(cfg) + """,
entities AS (SELECT s.entity_id AS s1_id, s.country_normalized AS country, coalesce(t.n, 0) AS true_matches_count, coalesce(c.n, 0) AS candidates_count, coalesce(c.kept, 0) AS retained_true_matches, coalesce(c.s2, 0) AS s2_candidates, coalesce(c.s3, 0) AS s3_candidates
 FROM s1 s LEFT JOIN (SELECT s1_id, count(*) AS n FROM truth GROUP BY 1) t ON s.entity_id = t.s1_id
 LEFT JOIN (SELECT p.s1_id, count(*) AS n, count(t.cand_id) AS kept, count(*) FILTER (source = 'S2') AS s2, count(*) FILTER (source = 'S3') AS s3 FROM pairs p LEFT JOIN truth t ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id GROUP BY 1) c ON s.entity_id = c.s1_id)"""


METRICS = """count(*) AS n_entities, CAST(sum(true_matches_count) AS BIGINT) AS true_pairs, CAST(sum(retained_true_matches) AS BIGINT) AS retained_pairs, CAST(sum(candidates_count) AS BIGINT) AS n_candidates,
 round(CASE WHEN sum(true_matches_count) > 0 THEN sum(retained_true_matches) / sum(true_matches_count) ELSE 1.0 END, 6) AS pair_recall,
 round(CASE WHEN count(*) FILTER (true_matches_count > 0) > 0 THEN count(*) FILTER (true_matches_count > 0 AND retained_true_matches = true_matches_count) / count(*) FILTER (true_matches_count > 0) ELSE 1.0 END, 6) AS entity_recall,
 round(avg(candidates_count), 6) AS mean_candidates, round(CAST(quantile_cont(candidates_count, 0.5) AS DOUBLE), 6) AS median_candidates, round(CAST(quantile_cont(candidates_count, 0.9) AS DOUBLE), 6) AS p90_candidates, round(CAST(quantile_cont(candidates_count, 0.95) AS DOUBLE), 6) AS p95_candidates, CAST(max(candidates_count) AS BIGINT) AS max_candidates"""


def query(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
