"""DuckDB SQL of the corpus queries whose whole results SQL can express."""

from __future__ import annotations

#: Words with A-Z folded, and the 5-word shingles of a list of words.
_FOLDED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
_SHINGLES = "list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))"

OP4 = f"""
WITH items AS (SELECT item_id, ws, len(ws) AS n FROM (SELECT item_id, {_FOLDED} AS ws FROM benchmark)),
docs AS (SELECT doc_id, ws, len(ws) AS n FROM (SELECT doc_id, {_FOLDED} AS ws FROM documents)),
item_shingles AS (SELECT item_id, n - 4 AS m, h, count(*) AS c FROM (SELECT item_id, n, unnest({_SHINGLES}) AS h FROM items WHERE n >= 5) GROUP BY ALL),
doc_shingles AS (SELECT doc_id, n - 4 AS size, generate_subscripts(hs, 1) - 1 AS p, unnest(hs) AS h FROM (SELECT doc_id, n, {_SHINGLES} AS hs FROM docs WHERE n >= 5)),
hits AS (SELECT doc_id, size, item_id, m, p, h, c FROM doc_shingles JOIN item_shingles USING (h)),
starts AS (SELECT DISTINCT doc_id, item_id, m, s FROM (SELECT doc_id, size, item_id, m, unnest(range(greatest(0, p - m + 1), least(p, size - m) + 1)) AS s FROM hits)),
common AS (SELECT doc_id, item_id, m, s, sum(k) AS k FROM (
  SELECT x.doc_id, x.item_id, x.m, s, h, least(any_value(c), count(*)) AS k
  FROM starts x JOIN hits y ON x.doc_id = y.doc_id AND x.item_id = y.item_id AND y.p BETWEEN s AND s + x.m - 1 GROUP BY ALL) GROUP BY ALL),
short AS (SELECT d.doc_id, i.item_id, unnest(range(0, d.n - i.n + 1)) AS s, d.ws AS dw, i.ws AS iw, i.n AS n FROM docs d JOIN items i ON i.n BETWEEN 1 AND 4 AND d.n >= i.n),
found AS (
  SELECT doc_id, item_id, s, k / (2 * m - k) AS similarity FROM common WHERE 100 * k >= 75 * (2 * m - k)
  UNION ALL SELECT doc_id, item_id, s, 1.0 FROM short WHERE dw[s + 1:s + n] = iw)
SELECT doc_id, item_id, max(similarity)::DOUBLE AS similarity, arg_min(s, (-similarity, s)) AS start_word, count(*) AS n_windows
FROM found GROUP BY doc_id, item_id
"""

OP7 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, (2 * i + 1)::BIGINT, 100) AS k FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
least AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k HAVING count(*) > 1),
gone AS (SELECT doc_id, i FROM windows JOIN least USING (k) WHERE doc_id > low),
islands AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM gone)),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 50 AS e FROM islands GROUP BY doc_id, island),
pieces AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM spans
  UNION ALL SELECT d.doc_id, len(h) // 2, len(h) // 2, coalesce((SELECT max(e) FROM spans WHERE spans.doc_id = d.doc_id), 0) FROM d),
kept AS (SELECT p.doc_id, sum(e - s)::BIGINT AS n_removed, count(*) - 1 AS n_spans, string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (s - before))::BIGINT), '' ORDER BY s, e) AS rest
  FROM pieces p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, n_removed, n_spans, sha256(unhex(rest)) AS kept_sha256 FROM kept JOIN d USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE
d AS (SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct({_SHINGLES}) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS hs FROM (SELECT doc_id, {_FOLDED} AS ws FROM documents)),
x AS (SELECT doc_id, len(hs) AS n, unnest(hs) AS h FROM d),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, low) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.low FROM reach r JOIN edges e ON r.doc_id = e.a WHERE r.low < e.b),
component AS (SELECT doc_id, min(low) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, len(hs) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN component USING (doc_id)
"""
