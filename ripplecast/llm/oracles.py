"""DuckDB SQL of the operators whose whole result SQL can express.

Each statement restates its query's contract plainly (every window, every pair that
shares a shingle, every match), without the operator's method. Only the secret
patterns are shared, being fixed values.
"""

from __future__ import annotations

from ripplecast.llm.secrets import BASE, MORE, Rule

WORDS = r"'[^\x20\x09-\x0D]+'"

#: Operator 5: every window of 20 words, as text.
SUBSTRING_DEDUP = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS p,
         unnest([array_to_string(w[i:i + 19], ' ') FOR i IN range(1, len(w) - 18)]) AS content
  FROM d WHERE len(w) >= 20
), later AS (
  SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, p) > 1
), covered AS (
  SELECT DISTINCT doc_id, p + i AS p FROM later, range(20) AS r(i)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

#: Operator 8: every pair of documents with a common shingle; components by closure.
JACCARD_JOIN = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id,
         unnest([array_to_string(w[p:p + 4], ' ') FOR p IN range(1, greatest(len(w) - 4, 1) + 1)]) AS shingle
  FROM d WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least_id AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""

#: Operator 9: every string of 100 bytes, by its MD5; bytes travel as pairs of hex digits.
SUFFIX_ARRAY_DEDUP = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), cut AS (
  SELECT doc_id, unnest(regexp_extract_all(h, '.{1,200}')) AS part,
         unnest(range(CAST((length(h) + 199) // 200 AS BIGINT))) AS c FROM d
), pairs AS (
  SELECT doc_id, c, part || coalesce(lead(part) OVER (PARTITION BY doc_id ORDER BY c), '') AS two FROM cut
), strings AS (
  SELECT doc_id, 100 * c + j AS s, md5_number(substr(two, 2 * j + 1, 200)) AS content
  FROM pairs, range(100) AS r(j) WHERE length(two) - 2 * j >= 200
), later AS (
  SELECT doc_id, s FROM strings QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, s) > 1
), marked AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS opens FROM later
), numbered AS (
  SELECT doc_id, s, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM marked
), runs AS (
  SELECT doc_id, k, min(s) AS a, max(s) + 100 AS b FROM numbered GROUP BY doc_id, k
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL
  SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS h
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
), totals AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM runs GROUP BY doc_id
)
SELECT doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       coalesce(n, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)
"""


def _re2(regex: str) -> str:
    """The pattern with its one case-free group spelled out: the other dialect folds beyond A-Z."""
    if "(?i:" not in regex:
        return regex
    head, rest = regex.split("(?i:", 1)
    words, tail = rest.split(")", 1)
    return f"{head}(?:{''.join(f'[{c.upper()}{c}]' if c.isalpha() else c for c in words)}){tail}"


def _matches(k: int, rule: Rule) -> str:
    regex = "'" + _re2(rule.regex).replace("'", "''") + "'"
    return f"""
  SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, {rule.least} AS least,
         regexp_extract_all(text, {regex}) AS found, regexp_extract_all(text, {regex}, {rule.group}) AS tested,
         string_split(regexp_replace(text, {regex}, chr(57344), 'g'), chr(57344)) AS gap
  FROM d"""


#: Operator 10: every rule over every text; places from the lengths of matches and of the texts between.
SECRET_SCAN = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(_matches(k, r) for k, r in enumerate(BASE + MORE))}),
places AS (
  SELECT doc_id, k, kind, least, unnest(found) AS match, unnest(tested) AS tested,
         unnest([list_sum([length(x) FOR x IN gap[:i]]) + coalesce(list_sum([length(x) FOR x IN found[:i - 1]]), 0)
                 FOR i IN range(1, len(found) + 1)]) AS s
  FROM m WHERE len(found) > 0
), spans AS (
  SELECT doc_id, k, kind, CAST(s AS BIGINT) AS s, CAST(s + length(match) AS BIGINT) AS e FROM places WHERE length(tested) >= least
), written AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
         string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, k) FILTER (k < {len(BASE)}) AS base,
         string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN written USING (doc_id)
"""

#: Operator 12: every line with its key; the least document of each key.
LINE_DEDUP = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d
), keyed AS (
  SELECT doc_id, p, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), least_id AS (
  SELECT key, min(doc_id) AS least FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text, count(*) AS n
  FROM keyed LEFT JOIN least_id USING (key) WHERE coalesce(doc_id <= least, true) GROUP BY doc_id
)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, len(l) - coalesce(n, 0) AS n_dropped,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
