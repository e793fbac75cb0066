"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from tidewake.llm import secrets

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all({_LOWERED}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP2 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, w[i : i + 9] AS g FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)),
widths AS (SELECT DISTINCT len(g) AS n FROM windows),
places AS (SELECT r, n, w[i : i + n - 1] AS g, i FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, widths)),
hits AS (SELECT DISTINCT r, i, n, item FROM places JOIN windows USING (g)),
hit_words AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits)),
runs AS (SELECT r, min(p) AS first, max(p) AS last FROM (SELECT r, p, p - row_number() OVER (PARTITION BY r ORDER BY p) AS run FROM hit_words) GROUP BY r, run),
spans AS (SELECT r, sum(last - first + 1) AS n_hit, flatten(list([first - 1, last] ORDER BY first)) AS spans FROM runs GROUP BY r),
names AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(spans, []) AS spans
FROM docs LEFT JOIN spans USING (r) LEFT JOIN names USING (r)
"""

OP4 = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
shingles AS (SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT x, y FROM common JOIN sizes s ON s.r = x JOIN sizes t ON t.r = y WHERE 10 * c >= 8 * (s.n + t.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(r, other) AS (SELECT r, r FROM docs UNION SELECT reach.r, y FROM reach JOIN both_ways ON x = other)
SELECT d.doc_id, min(o.doc_id) AS class_id, (SELECT count(*) FROM both_ways WHERE x = d.r) AS n_links
FROM docs d JOIN reach ON reach.r = d.r JOIN docs o ON o.r = other GROUP BY d.r, d.doc_id
"""

OP7 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS (SELECT r, doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs)),
earliest AS (SELECT h, min(doc_id) AS low FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM windows JOIN earliest USING (h) WHERE low < doc_id)),
placed AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS line FROM placed ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, (SELECT count(*) FROM gone WHERE gone.r = docs.r) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

_KINDS = ", ".join(f"({i}, '{name}', {_quoted(pattern)})" for i, (name, pattern) in enumerate(zip(secrets.KINDS, (secrets.ASSIGN, secrets.ACCESS, secrets.HEX, secrets.MIXED))))
OP9 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
kinds(kind, name, pattern) AS (VALUES {_KINDS}),
listed AS (
  SELECT r, doc_id, source, 0 AS kind, regexp_extract_all(t, {_quoted(secrets.ASSIGN)}) AS ms, string_split_regex(t, {_quoted(secrets.ASSIGN)}) AS gaps FROM docs
  UNION ALL SELECT r, doc_id, source, 1, regexp_extract_all(t, '{secrets.ACCESS}'), string_split_regex(t, '{secrets.ACCESS}') FROM docs
  UNION ALL SELECT r, doc_id, source, 2, regexp_extract_all(t, '{secrets.HEX}'), string_split_regex(t, '{secrets.HEX}') FROM docs
  UNION ALL SELECT r, doc_id, source, 3, regexp_extract_all(t, '{secrets.MIXED}'), string_split_regex(t, '{secrets.MIXED}') FROM docs),
matches AS (SELECT r, doc_id, source, kind, place, ms[place] AS m, gaps[place] AS gap FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS place FROM listed)),
placed AS (SELECT *, length(gap) + coalesce(sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a,
  CASE kind WHEN 0 THEN regexp_extract(m, {_quoted(secrets.ASSIGN)}, 2) ELSE m END AS value FROM matches),
fits AS (SELECT *, a + length(m) AS b FROM placed WHERE CASE kind WHEN 0 THEN length(value) >= {secrets.MIN_ASSIGNED}
  WHEN 3 THEN regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') ELSE true END),
owned AS (SELECT value, count(DISTINCT coalesce(source, chr(1))) AS owners, count(DISTINCT coalesce(source, chr(1)) || chr(2) || coalesce(CAST(doc_id AS VARCHAR), '')) AS repositories
  FROM fits GROUP BY value),
judged AS (SELECT f.*, owners <= 2 AND repositories <= 5 AS live,
  max(CASE WHEN kind < 3 THEN b END) OVER before AS ended, min(CASE WHEN kind < 3 THEN a END) OVER behind AS follows
  FROM fits f JOIN owned USING (value)
  WINDOW before AS (PARTITION BY r ORDER BY a, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  behind AS (PARTITION BY r ORDER BY a, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
shown AS (SELECT *, name || ':' || a || ':' || b AS label, kind < 3 OR (live AND coalesce(ended <= a, true) AND coalesce(follows >= b, true)) AS seen FROM judged JOIN kinds USING (kind))
SELECT any_value(d.doc_id) AS doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
  sha256(coalesce(string_agg(label, ',' ORDER BY a, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
  coalesce(string_agg(label, ',' ORDER BY a, kind) FILTER (WHERE seen), '') AS spans,
  count(*) FILTER (WHERE seen AND live) AS n_live, count(*) FILTER (WHERE seen AND NOT live) AS n_example
FROM docs d LEFT JOIN shown s ON s.r = d.r GROUP BY d.r
"""

ORACLES: dict[str, str] = {
    "op2_decontaminate": OP2,
    "op4_ngram_join": OP4,
    "op7_passage_dedup": OP7,
    "op9_secrets": OP9,
}
