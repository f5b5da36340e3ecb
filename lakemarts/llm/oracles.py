"""The same questions in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER + "'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, array_to_string(ws[i + 1 : i + least(len(ws), 10)], ' ') AS words, least(len(ws), 10) AS n
  FROM (SELECT item, ws, unnest(range(greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(ws[i + 1 : i + n], ' ') AS words
  FROM (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS i FROM d JOIN sizes ON len(ws) >= n)
),
hits AS (SELECT doc_id, i, n, item FROM doc_windows JOIN item_windows USING (words, n)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP2 = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM split),
shown AS (
  SELECT *, row_number() OVER d - 1 AS n, count(*) OVER (PARTITION BY doc_id) AS total
  FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY p)
),
runs AS (
  SELECT doc_id, n, 3 AS size, 'run' || chr(10) || line || chr(10) || lead(line, 1) OVER d || chr(10) || lead(line, 2) OVER d AS content
  FROM shown WINDOW d AS (PARTITION BY doc_id ORDER BY n)
  QUALIFY lead(line, 2) OVER d IS NOT NULL
  UNION ALL
  SELECT doc_id, 0, total, 'all' || chr(10) || string_agg(line, chr(10) ORDER BY n) FROM shown WHERE total < 3 GROUP BY doc_id, total
),
placed AS (
  SELECT *, first_value(doc_id) OVER c AS doc0, first_value(n) OVER c AS n0, row_number() OVER c AS k
  FROM runs WINDOW c AS (PARTITION BY content ORDER BY doc_id, n)
),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = doc0 THEN greatest(n, n0 + size) ELSE n END, n + size)) AS n
  FROM placed WHERE k > 1
),
kept AS (
  SELECT l.doc_id, l.p, l.line FROM lines l
  LEFT JOIN shown s ON s.doc_id = l.doc_id AND s.p = l.p
  LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.n = s.n
  WHERE g.n IS NULL
),
texts AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text FROM kept GROUP BY doc_id)
SELECT d.doc_id, CAST(length(coalesce(t.text, '')) AS BIGINT) AS n_chars_left, sha256(coalesce(t.text, '')) AS text_sha256
FROM documents d LEFT JOIN texts t USING (doc_id)
"""

OP4 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
valid AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.r AS x, b.r AS y, b.vec_id AS other FROM valid a
  JOIN valid b ON b.label = a.label AND b.r <> a.r AND len(b.e) = len(a.e) AND list_cosine_similarity(a.e, b.e) >= 0.93
),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
least AS (SELECT r.x, min(v.vec_id) AS vec_id FROM reached r JOIN v ON v.r = r.y GROUP BY r.x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, coalesce(n, 0) AS n_links, CAST(least(v.vec_id, coalesce(m.vec_id, v.vec_id)) AS BIGINT) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(m.vec_id, v.vec_id)) AS kept
FROM v LEFT JOIN counts ON counts.x = v.r LEFT JOIN least m ON m.x = v.r
"""

OP5 = f"""
WITH RECURSIVE classes AS (
  SELECT coalesce(text, '') AS text, min(doc_id) AS class_id FROM documents GROUP BY coalesce(text, '')
),
w AS (SELECT class_id, {_WORDS} AS ws FROM classes),
grams AS (
  SELECT class_id, array_to_string(ws[i + 1 : i + least(len(ws), 5)], ' ') AS gram, count(*) AS n
  FROM (SELECT class_id, ws, unnest(range(greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)
  GROUP BY class_id, gram
),
sizes AS (SELECT class_id, sum(n) AS n FROM grams GROUP BY class_id),
shared AS (
  SELECT a.class_id AS x, b.class_id AS y, sum(least(a.n, b.n)) AS n
  FROM grams a JOIN grams b ON b.gram = a.gram AND b.class_id <> a.class_id GROUP BY a.class_id, b.class_id
),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.class_id = x JOIN sizes b ON b.class_id = y
  WHERE 5 * shared.n >= 4 * (a.n + b.n - shared.n)
),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT d.doc_id, c.class_id, least(c.class_id, coalesce(m.y, c.class_id)) AS component_id,
  d.doc_id = least(c.class_id, coalesce(m.y, c.class_id)) AS kept
FROM documents d JOIN classes c ON c.text = coalesce(d.text, '') LEFT JOIN least m ON m.x = c.class_id
"""

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER + "'), "
    r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS ws FROM documents
),
found AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term
),
groups AS (SELECT DISTINCT lang, source FROM d),
sizes AS (
  SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.c, 0) AS c,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(o.c, 0) + 1) // (g.n + l.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.c + 1) // (l.n + l.v) AS q
  FROM sizes g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN counts o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
  GROUP BY a.lang, a.source, b.source
),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200
"""

OP12 = r"""
WITH RECURSIVE fields AS (
  SELECT *, coalesce(CAST(strlen(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR), '-')
    || coalesce(CAST(strlen(source) AS VARCHAR) || ':' || source, '-')
    || coalesce(CAST(strlen(lang) AS VARCHAR) || ':' || lang, '-')
    || coalesce(CAST(strlen(CAST(n_chars AS VARCHAR)) AS VARCHAR) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, i: xor(x // 2, (x % 2) * CAST(3988292384 AS BIGINT)))) % 2 = 1 AS even_crc
  FROM documents
),
changed AS (SELECT *, CASE WHEN even_crc THEN replace(text, chr(10), '') ELSE text END AS other FROM fields),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(CAST(strlen(other) AS VARCHAR) || ':' || other, '-')) AS changed_leaf
  FROM changed
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM leaves
),
nodes AS (
  SELECT 0 AS level, source, i, n, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, source, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY level, source, n, i // 3
),
subroots AS (SELECT source, digest AS subroot FROM nodes WHERE n = 1),
ranked AS (SELECT source, subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s, count(*) OVER () AS m FROM subroots),
tops AS (
  SELECT 0 AS level, s, m, subroot AS digest FROM ranked
  UNION ALL
  SELECT level + 1, s // 3, (m + 2) // 3, sha256(string_agg(digest, '' ORDER BY s)) FROM tops WHERE m > 1 GROUP BY level, m, s // 3
),
root AS (SELECT digest AS root FROM tops WHERE m = 1),
around AS (
  SELECT p.source, p.i AS leaf_i, k.level, k.i // 3 AS run, p.i // CAST(3 ** k.level AS BIGINT) AS own, k.i, k.digest
  FROM placed p JOIN nodes k ON k.source IS NOT DISTINCT FROM p.source AND k.n > 1
    AND k.i // 3 = p.i // CAST(3 ** (k.level + 1) AS BIGINT) AND k.i <> p.i // CAST(3 ** k.level AS BIGINT)
  UNION ALL
  SELECT p.source, p.i, 100 + k.level, k.s // 3, r.s // CAST(3 ** k.level AS BIGINT), k.s, k.digest
  FROM placed p JOIN ranked r ON r.source IS NOT DISTINCT FROM p.source
    JOIN tops k ON k.m > 1 AND k.s // 3 = r.s // CAST(3 ** (k.level + 1) AS BIGINT) AND k.s <> r.s // CAST(3 ** k.level AS BIGINT)
),
steps AS (
  SELECT p.source, p.i, k.level FROM placed p
    JOIN (SELECT DISTINCT source, level FROM nodes WHERE n > 1) k ON k.source IS NOT DISTINCT FROM p.source
  UNION ALL
  SELECT p.source, p.i, 100 + k.level FROM placed p, (SELECT DISTINCT level FROM tops WHERE m > 1) k
),
sides AS (
  SELECT t.source, t.i, t.level, coalesce(string_agg(a.digest, '' ORDER BY a.i) FILTER (a.i < a.own), '') AS l,
    coalesce(string_agg(a.digest, '' ORDER BY a.i) FILTER (a.i > a.own), '') AS r
  FROM steps t LEFT JOIN around a ON a.source IS NOT DISTINCT FROM t.source AND a.leaf_i = t.i AND a.level = t.level
  GROUP BY t.source, t.i, t.level
),
listed AS (SELECT source, i, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs FROM sides GROUP BY source, i),
climbed AS (
  SELECT p.source, p.i, 0 AS k, p.changed_leaf AS digest, coalesce(ls, []) AS ls, coalesce(rs, []) AS rs
  FROM placed p LEFT JOIN listed t ON t.source IS NOT DISTINCT FROM p.source AND t.i = p.i
  UNION ALL
  SELECT source, i, k + 1, sha256(ls[k + 1] || digest || rs[k + 1]), ls, rs FROM climbed WHERE k < len(ls)
)
SELECT p.doc_id, p.leaf, b.subroot, root.root,
  sha256(list_reduce(list_prepend('', list_transform(range(len(c.ls)), lambda j: c.ls[j + 1] || c.rs[j + 1])), lambda x, y: x || y)) AS proof_sha256,
  c.digest AS folded_root, c.digest = root.root AS verified
FROM placed p JOIN subroots b ON b.source IS NOT DISTINCT FROM p.source
JOIN climbed c ON c.source IS NOT DISTINCT FROM p.source AND c.i = p.i AND c.k = len(c.ls), root
"""

LLM_ORACLES = {
    "op1_decontamination": OP1,
    "op2_line_dedup": OP2,
    "op4_embedding_dedup": OP4,
    "op5_near_dedup": OP5,
    "op11_source_divergence": OP11,
    "op12_merkle_manifest": OP12,
}
