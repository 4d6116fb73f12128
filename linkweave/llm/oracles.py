"""DuckDB SQL for the queries of this package that SQL expresses.

Only fixed values (license templates, stop words) come from the operators; all rules are written here again, in another form:
repeated windows, shingles and links are rows, grouped and joined."""

from __future__ import annotations

from linkweave.llm.licenses import TEMPLATES
from linkweave.llm.quality import STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP2 = rf"""
WITH templates(name, body) AS (VALUES {", ".join(f"({_text(k)}, {_text(v)})" for k, v in TEMPLATES.items())}),
texts AS (SELECT row_number() OVER () AS r, doc_id, [x FOR x IN string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+') IF x <> ''] AS w FROM documents),
told AS (SELECT name, [x FOR x IN string_split_regex(lower(body), '[^a-z0-9]+') IF x <> ''] AS w FROM templates),
wanted AS (
  SELECT DISTINCT name, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT name, w, unnest(range(1, len(w) - 3)) AS i FROM told)
),
sizes AS (SELECT name, count(*) AS n, cast(pow(2, ceil(log2(count(*)))) AS BIGINT) AS step FROM wanted GROUP BY name),
found AS (
  SELECT r, i - 1 AS pos, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM texts)
),
hits AS (SELECT f.r, f.pos, f.s, name, n, step FROM found f JOIN wanted USING (s) JOIN sizes USING (name)),
windows AS (
  SELECT r, name, n, s, pos // step AS x FROM hits
  UNION ALL SELECT r, name, n, s, pos // step - 1 FROM hits WHERE pos >= step
),
held AS (SELECT r, x, name FROM windows GROUP BY r, x, name, n HAVING count(DISTINCT s) * 100 >= n * 80),
names AS (SELECT r, count(DISTINCT name) AS k, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM held GROUP BY r)
SELECT doc_id, coalesce(k, 0) AS n_licenses, coalesce(licenses, '') AS licenses FROM texts LEFT JOIN names USING (r)
"""

OP5 = rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 3), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM texts WHERE len(w) > 0)
),
sets AS (SELECT r, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS p FROM shingles GROUP BY r),
points AS (SELECT p, min(r) AS r, min(n) AS n, min(doc_id) AS id FROM sets JOIN texts USING (r) GROUP BY p),
held AS (SELECT p, n, s FROM points JOIN shingles USING (r)),
meets AS (SELECT a.p AS a, b.p AS b, a.n AS n, b.n AS m, count(*) AS k FROM held a JOIN held b ON a.s = b.s AND a.p <> b.p GROUP BY ALL),
links AS (SELECT a, b FROM meets WHERE 100 * k >= 85 * (n + m - k)),
reach(p, q) AS (SELECT p, p FROM points UNION SELECT reach.p, links.b FROM reach JOIN links ON reach.q = links.a),
least AS (SELECT reach.p AS p, min(points.id) AS id FROM reach JOIN points ON reach.q = points.p GROUP BY reach.p)
SELECT doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(least.id, doc_id) AS component_id
FROM texts LEFT JOIN sets USING (r) LEFT JOIN least ON least.p = sets.p
"""

OP6 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
),
windows AS (SELECT r, i, list_slice(w, i, i + 2) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM texts)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS k FROM windows) WHERE k > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY r),
counts AS (
  SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    cast(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len([x FOR x IN w IF lower(x) IN ({", ".join(map(_text, sorted(set(STOP_WORDS))))})]) AS n_stop_words
  FROM texts LEFT JOIN covered USING (r)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_symbols > n_words
       OR 100 * n_stop_words < n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM judged
"""

SQL: dict[str, str] = {"op2_licenses": OP2, "op5_jaccard": OP5, "op6_quality": OP6}
