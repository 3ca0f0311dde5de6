"""Equivalent SQL (DuckDB) of the operators that SQL can express; for checking only."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Smallest id that links (a < b) reach, for the ids of `nodes`.
_COMPONENTS = """
both_ways AS (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (
  SELECT id, id FROM nodes WHERE id IN (SELECT x FROM both_ways)
  UNION SELECT r.id, l.y FROM reach r JOIN both_ways l ON l.x = r.other
),
component AS (SELECT id, MIN(other) AS component_id FROM reach GROUP BY id)
"""

WINDOW_DEDUP = f"""
WITH split AS (SELECT doc_id, {_WORDS.format(text="COALESCE(text, '')")} AS w FROM documents),
word AS (
  SELECT doc_id, pos, w[pos] AS word,
         CASE WHEN pos + 49 <= len(w) THEN array_to_string(w[pos:pos + 49], ' ') END AS text_of_window
  FROM (SELECT doc_id, w, UNNEST(range(1, len(w) + 1)) AS pos FROM split)
),
first AS (SELECT text_of_window, MIN(doc_id) AS least FROM word WHERE text_of_window IS NOT NULL GROUP BY 1),
marked AS (
  SELECT word.*, bool_or(COALESCE(least < doc_id, FALSE)) OVER (
           PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM word LEFT JOIN first USING (text_of_window)
),
kept AS (
  SELECT doc_id, COUNT(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS text
  FROM marked GROUP BY doc_id
)
SELECT split.doc_id, len(w) AS n_words, COALESCE(n_removed, 0) AS n_removed,
       sha256(COALESCE(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
nodes AS (SELECT vec_id AS id FROM v),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id < q.vec_id AND len(p.e) = len(q.e)
  WHERE list_cosine_similarity(p.e, q.e) >= 0.95
),
{_COMPONENTS},
times AS (SELECT x AS id, COUNT(*) AS n FROM both_ways GROUP BY x)
SELECT vec_id, COALESCE(n, 0) AS n_links, COALESCE(component_id, vec_id) AS component_id,
       COALESCE(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN times ON times.id = vec_id LEFT JOIN component ON component.id = vec_id
"""

NEAR_DEDUP = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, {_WORDS.format(text=f"translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents
),
shingles AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM split
),
one AS (SELECT doc_id, len(s) AS n, UNNEST(s) AS shingle FROM shingles),
nodes AS (SELECT doc_id AS id FROM shingles),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM one p JOIN one q ON p.shingle = q.shingle AND p.doc_id < q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * COUNT(*) >= 75 * (p.n + q.n - COUNT(*))
),
{_COMPONENTS}
SELECT doc_id, len(s) AS n_shingles, COALESCE(component_id, doc_id) AS component_id,
       COALESCE(component_id, doc_id) = doc_id AS kept
FROM shingles LEFT JOIN component ON component.id = doc_id
"""

DIVERGENCE = r"""
WITH own AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM own
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON k.lang = w.lang AND k.term = w.term
  GROUP BY w.lang, w.source, w.term
), langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce((SELECT sum(c.n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM own) g
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS held,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * l.v) AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.n + 2)) // (l.n + 2 * l.v) AS BIGINT) AS q
  FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
), listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE held > 0 AND p > q
)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM listed QUALIFY part = 'pair' OR rank <= 10
"""

PREFIX_TRIE = r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(text, '') AS text, key,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS k
  FROM (SELECT *, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
        FROM conversations WHERE conv_id IS NOT NULL)
), ids AS (  -- CRC-32 of the decimal number, bit by bit
  SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)),
      lambda y, i: xor(y // 2, (y % 2) * 3988292384))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT c, key, text, row_number() OVER (PARTITION BY c ORDER BY own, k) AS d FROM (
    SELECT i.c, t.key, t.text, t.k, 0 AS own FROM ids i JOIN turns t ON t.c = i.c - i.c % 20 AND t.k <= i.h
    UNION ALL SELECT i.c, t.key, t.text, t.k, 1 FROM ids i JOIN turns t ON t.c = i.c AND t.k > i.h)
), starts AS (
  SELECT c, 0 AS d, '' AS p, 0 AS words FROM ids
  UNION ALL
  SELECT c, d, string_agg(key, '') OVER (PARTITION BY c ORDER BY d),
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM rebuilt
), nodes AS (
  SELECT p, d, any_value(words) AS words, min(c) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE NOT EXISTS (
           SELECT 1 FROM rebuilt r WHERE r.c = starts.c AND r.d > starts.d)), '') AS ends
  FROM starts GROUP BY p, d
), kids AS (SELECT left(p, 64 * (d - 1)) AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
own AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.p = nodes.p
), sums AS (
  SELECT left(p, 64 * a) AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM own) GROUP BY 1
)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
       s.saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN sums s ON s.p = o.p LEFT JOIN own up ON o.d > 0 AND up.p = left(o.p, 64 * (o.d - 1))
"""
