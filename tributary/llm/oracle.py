"""DuckDB SQL of the queries that SQL can express, by their contracts and not by the operators' methods."""

from __future__ import annotations

# Words between ASCII white space, as they are written.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Windows of 20 words that also start earlier cover the words that go.
SUBSTRING = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
place AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM w WHERE len(words) >= 20),
window_ AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 19], ' ') AS said FROM place),
repeated AS (SELECT doc_id, pos FROM window_ QUALIFY row_number() OVER (PARTITION BY said ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM repeated),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
told AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT lost) AS kept, count(*) FILTER (WHERE lost) AS n
         FROM (SELECT word.*, gone.pos IS NOT NULL AS lost FROM word LEFT JOIN gone USING (doc_id, pos)) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(told.n, 0) AS n_removed, sha256(coalesce(told.kept, '')) AS kept_sha256
FROM w LEFT JOIN told USING (doc_id)"""

#: Links by the shingles that two sets share; components by the smallest id that can be reached.
NEAR = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
own AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 2], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 1))) AS pos FROM w WHERE len(words) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM own GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM own a JOIN own b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * both_.n >= 85 * (x.n + y.n - both_.n)),
way AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.id, way.b FROM reach JOIN way ON way.a = reach.other)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN size USING (doc_id) JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) r ON r.id = d.doc_id"""

#: The template writes ``<s>[role]``, a line break, the text, ``</s>`` and a line break, and five characters longer.
CHAT = r"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
long_ AS (SELECT *, length(regexp_replace(regexp_replace(regexp_replace(role || text, '&', '&amp;', 'g'), '[<>]', '&lt;', 'g'), '[][]', '&lsqb;', 'g')) AS chars FROM told)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars + 4 + 2 + 5)::BIGINT AS formatted_chars
FROM long_ GROUP BY conv_id"""

#: All inner products of anchors and rows, then the rule.
NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.other_id AS negative_id,
       p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)
QUALIFY row_number() OVER w <= 3"""
