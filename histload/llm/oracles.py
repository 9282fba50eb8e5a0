"""SQL with the same rows as the queries, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_line_dedup"] = r"""
WITH lines AS (
  SELECT *, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents
), keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM lines
), boilerplate AS (
  SELECT key, min(doc_id) AS first, min(md5(text)) FILTER (doc_id IS NULL) AS first_nameless FROM keyed WHERE key <> ''
  GROUP BY key HAVING count(DISTINCT coalesce(source, chr(1))) >= 10
), marked AS (
  SELECT k.*, b.key IS NOT NULL AND coalesce(k.doc_id > b.first,
    k.doc_id IS NULL AND (b.first IS NOT NULL OR md5(k.text) > b.first_nameless)) AS gone FROM keyed k LEFT JOIN boilerplate b USING (key)
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text, lang, source, n_chars,
  count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM marked GROUP BY doc_id, lang, source, n_chars
"""

ORACLES["op2_top_k"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES["op4_tool_calls"] = """
WITH calls AS (
  SELECT conv_id, turn, conv_id || ':' || turn AS call_id, text, CASE role WHEN 'user' THEN 'answer' ELSE 'configure' END AS name
  FROM conversations WHERE role IN ('user', 'system')
), results AS (
  SELECT conv_id, turn AS result_turn, conv_id || ':' || (turn - 1) AS call_id, text AS content
  FROM conversations WHERE role = 'assistant'
), both_sides AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.turn, c.name, c.text,
    r.result_turn, r.content
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
)
SELECT b.conv_id, b.call_id, b.turn, b.name,
  CASE WHEN b.turn IS NULL THEN 'orphan' WHEN b.result_turn IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
  b.result_turn, b.turn AS at, CASE WHEN b.turn IS NOT NULL THEN 0::BIGINT END AS step,
  (b.name = 'answer' AND b.turn >= 2 AND NOT EXISTS (
    SELECT 1 FROM calls e WHERE e.conv_id = b.conv_id AND e.turn = b.turn - 2))::BIGINT AS n_unresolved,
  false AS cyclic, '' AS errors, (b.turn IS NOT NULL)::BIGINT AS n_calls, (b.result_turn IS NOT NULL)::BIGINT AS n_results,
  '{' || concat_ws(',',
    CASE b.name WHEN 'answer' THEN '"arguments":' || to_json({'prompt': b.text, 'turn': b.turn})
                WHEN 'configure' THEN '"arguments":' || to_json({'instructions': b.text}) END,
    '"id":' || to_json(b.call_id), '"name":' || to_json(b.name), '"result":' || to_json(b.content),
    '"result_turn":' || b.result_turn, '"turn":' || b.turn) || '}' AS json
FROM both_sides b
"""

ORACLES["op11_merkle"] = """
WITH RECURSIVE crc AS (  -- CRC-32 of the decimal doc_id, byte by byte, bit by bit
  SELECT doc_id, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda c, d: list_reduce(list_prepend(xor(c, d), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), fields AS (
  SELECT d.*, coalesce(crc % 3 = 0, false) AS tampers, concat_ws('',
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head
  FROM documents d LEFT JOIN crc c ON c.doc_id = d.doc_id
), hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tampers THEN sha256(head || coalesce(strlen(text) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM fields
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed
), nodes AS (  -- the trees of the languages, level by level
  SELECT lang, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM nodes WHERE n > 1 GROUP BY lang, level, i // 8, n
), subroots AS (
  SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, j AS i, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, i // 8, n
), runs AS (  -- nodes of a run, in order
  SELECT lang, false AS upper, level, i // 8 AS run, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT NULL, true, level, i // 8, list(h ORDER BY i) FROM top WHERE n > 1 GROUP BY ALL
), folds AS (  -- from each leaf up to its subroot, then from there to the root
  SELECT row_number() OVER () AS row, doc_id, lang, leaf, coalesce(tampered, leaf) AS h, '' AS beside, false AS upper, 0 AS level, i, true AS more FROM leaves
  UNION ALL
  SELECT row, doc_id, f.lang, leaf,
    CASE WHEN r.hs IS NULL THEN f.h ELSE sha256(array_to_string(r.hs[: f.i % 8], '') || f.h || array_to_string(r.hs[f.i % 8 + 2 :], '')) END,
    CASE WHEN r.hs IS NULL THEN beside ELSE beside || array_to_string(r.hs[: f.i % 8], '') || array_to_string(r.hs[f.i % 8 + 2 :], '') END,
    f.upper OR r.hs IS NULL, CASE WHEN r.hs IS NULL THEN 0 ELSE f.level + 1 END,
    CASE WHEN r.hs IS NULL THEN s.j ELSE f.i // 8 END, NOT (f.upper AND r.hs IS NULL)
  FROM folds f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang
    LEFT JOIN runs r ON r.upper = f.upper AND (r.lang IS NOT DISTINCT FROM f.lang OR f.upper) AND r.level = f.level AND r.run = f.i // 8
  WHERE f.more
)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(beside) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM folds f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang JOIN top t ON t.n = 1 WHERE NOT f.more
"""
