"""The registered queries in SQL for DuckDB, where SQL can say the same in reasonable time."""

from __future__ import annotations

from voltmark.llm import license_rules

OP9_LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT doc_id, pos, line, top IS NOT NULL AND doc_id < top AS gone
  FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP4_DECONTAMINATE = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
starts AS (
  SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS i FROM doc_words, sizes WHERE len(w) >= size),
hits AS (
  SELECT doc_id, i, windows.size, item_id
  FROM starts JOIN windows ON windows.size = starts.size AND windows.phrase = array_to_string(w[i : i + starts.size - 1], ' ')),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP1_EMBEDDING_DEDUP = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS size
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND a.size > 0 AND b.size > 0
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95),
reach AS (
  SELECT a AS node, a AS least FROM links
  UNION
  SELECT links.b, reach.least FROM reach JOIN links ON links.a = reach.node WHERE reach.least < links.b),
groups AS (SELECT node, min(least) AS component FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id,
       coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN groups ON node = vec_id LEFT JOIN counts ON a = vec_id
"""

OP8_SUBSTRING_DEDUP = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 12, 0) + 1)) AS i FROM words WHERE len(w) >= 13)),
firsts AS (SELECT phrase, min(doc_id) AS first FROM windows GROUP BY phrase HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM windows JOIN firsts USING (phrase) WHERE first < doc_id),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM each_word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

OP11_SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
words AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS whole FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, sum(whole) AS total, count(*) AS v FROM kept GROUP BY lang),
groups AS (
  SELECT d.lang, d.source, coalesce(t.total, 0)::HUGEINT AS total, coalesce(l.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM docs) d
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source) t USING (lang, source)
  LEFT JOIN langs l USING (lang)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p,
         1 + (1000000000::HUGEINT * (k.whole + 1)) // (l.total + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(s.value), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  GROUP BY a.lang, a.source, b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL SELECT lang, source, 'term', item, value FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def _licenses() -> str:
    """Every rule tried at every place of its keyword, and detections compared pair by pair."""
    rows = ",\n".join(
        f"({i}, {r.priority}, {float(r.weight)!r}::DOUBLE, '{r.label}', '{r.keyword}', '{r.ahead}', '{r.on}')"
        for i, r in enumerate(license_rules.all_rules())
    )
    ahead, on = license_rules.WORDS_AHEAD, license_rules.WORDS_ON
    return f"""
WITH rules(rule, priority, weight, label, keyword, front, pattern) AS (VALUES {rows}),
texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
places AS (
  SELECT r, i - 1 AS place, w[i] AS word, array_to_string(w[greatest(1, i - {ahead}) : i - 1], ' ') AS ahead,
         array_to_string(w[i : i + {on - 1}], ' ') || ' ' AS words
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM texts)
  WHERE w[i] IN (SELECT keyword FROM rules)),
tried AS (
  SELECT r, place, rule, priority, weight, label, front,
         regexp_extract(words, '^(' || pattern || ') ', 1) AS matched,
         CASE WHEN front <> '' THEN regexp_extract(ahead, '(?:^| )(' || front || ')$', 1) ELSE '' END AS led
  FROM places JOIN rules ON keyword = word),
hits AS (
  SELECT r, rule, priority, weight, label,
         place - CASE WHEN front = '' THEN 0 ELSE len(string_split(led, ' ')) END AS a, place + len(string_split(matched, ' ')) AS b
  FROM tried WHERE matched <> '' AND (front = '' OR led <> '')),
base AS (
  SELECT r, count(*) AS n, min(a) AS first, max(a) AS last, list_sort(list(DISTINCT label)) AS labels
  FROM hits WHERE priority = 0 GROUP BY r),
best AS (
  SELECT * FROM hits d WHERE priority = 0 OR NOT EXISTS (
    SELECT 1 FROM hits e
    WHERE e.r = d.r AND e.a <= d.a AND e.b >= d.b
      AND (e.priority > d.priority OR e.priority = d.priority AND (e.b - e.a > d.b - d.a OR e.b - e.a = d.b - d.a AND e.rule < d.rule)))),
found AS (SELECT r, list_sort(list(DISTINCT label)) AS labels, max(weight) AS score FROM best GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first::BIGINT AS first_word, last::BIGINT AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels, coalesce(array_to_string(found.labels, ','), '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""


OP12_LICENSES = _licenses()

ORACLES = {
    "op11_source_divergence": OP11_SOURCE_DIVERGENCE,
    "op12_licenses": OP12_LICENSES,
    "op8_substring_dedup": OP8_SUBSTRING_DEDUP,
    "op1_embedding_dedup": OP1_EMBEDDING_DEDUP,
    "op4_decontaminate": OP4_DECONTAMINATE,
    "op9_line_dedup": OP9_LINE_DEDUP,
}
