"""DuckDB SQL of those queries of this subpackage that SQL can express."""

from __future__ import annotations

OP4 = r"""
WITH RECURSIVE grades AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), docs AS (
  SELECT d.doc_id, d.source,
    coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    CASE WHEN g.quality > 0 THEN 2.0 WHEN g.quality IS NOT NULL THEN 0.5 ELSE 1.0 END AS weight
  FROM documents d LEFT JOIN grades g ON g.doc_id = d.doc_id
), items AS (
  SELECT source, doc_id, size, count(*) AS n, (size * count(*))::BIGINT AS total,
    -ln((('0x' || md5('0:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size)[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / any_value(weight) AS key
  FROM docs GROUP BY source, doc_id, size
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM docs GROUP BY source
), fill AS (
  -- Round by round: sources whose share reaches their stop leave, the others share what is left.
  SELECT 0 AS round, source, source_size, weight, NULL::DOUBLE AS stopped,
    (SELECT sum(source_size) FROM sources)::BIGINT AS rest, (SELECT sum(weight) FROM sources)::BIGINT AS sharing
  FROM sources
  UNION ALL
  SELECT round + 1, source, source_size, weight, now_stopped,
    (rest - sum(CASE WHEN stopped IS NULL AND now_stopped IS NOT NULL THEN 3 * source_size ELSE 0 END) OVER ())::BIGINT,
    (sharing - sum(CASE WHEN stopped IS NULL AND now_stopped IS NOT NULL THEN weight ELSE 0 END) OVER ())::BIGINT
  FROM (SELECT *, CASE WHEN stopped IS NOT NULL THEN stopped
      WHEN rest::DOUBLE * weight >= (3 * source_size)::DOUBLE * sharing THEN (3 * source_size)::DOUBLE END AS now_stopped FROM fill)
  WHERE round < (SELECT count(*) FROM sources)
), targets AS (
  SELECT source, source_size, coalesce(stopped, rest::DOUBLE * weight / sharing) AS target
  FROM fill WHERE round = (SELECT count(*) FROM sources)
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets
), filling AS (
  -- Eight rounds: of the items not taken, those of at most half the rest, by key, as long as their sum fits.
  SELECT 0 AS round, i.*, b.source_size, b.target, b.epochs, b.target - (b.epochs * b.source_size)::DOUBLE AS rest, false AS taken
  FROM items i JOIN budgets b ON b.source IS NOT DISTINCT FROM i.source
  UNION ALL
  SELECT round + 1, source, doc_id, size, n, total, key, source_size, target, epochs,
    rest - sum(CASE WHEN now THEN total ELSE 0 END) OVER (PARTITION BY source)::DOUBLE, taken OR now
  FROM (SELECT *, small AND sum(CASE WHEN small THEN total ELSE 0 END) OVER (
      PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)::DOUBLE <= rest AS now
    FROM (SELECT *, NOT taken AND total > 0 AND total <= rest / 2 AS small FROM filling WHERE round < 8))
), filled AS (
  SELECT *, row_number() OVER (PARTITION BY source, taken OR total = 0 ORDER BY abs(total - rest), key, doc_id NULLS FIRST, size) AS place
  FROM filling WHERE round = 8
), counted AS (
  SELECT *, epochs + CASE WHEN taken OR (total > 0 AND place = 1 AND abs(total - rest) < rest) THEN 1 ELSE 0 END AS copies FROM filled
)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies::BIGINT AS copies
FROM counted, unnest(range(n)) AS r(k)
"""

OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')] ELSE
    [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END) AS s
  FROM words WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS id, a AS low FROM both_ways
  UNION
  SELECT e.a, r.low FROM reach r JOIN both_ways e ON e.b = r.id WHERE r.low < e.a
), labels AS (SELECT id, min(low) AS low FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, d.doc_id) AS component_id,
  d.doc_id = coalesce(low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN labels l ON l.id = d.doc_id
"""

OP9 = """
WITH parts AS (
  SELECT rowid AS row, vec_id, len(embedding) AS width, generate_subscripts(embedding, 1) AS place,
    unnest(embedding)::DOUBLE AS x
  FROM (SELECT row_number() OVER () AS rowid, vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL)
), usable AS (
  SELECT row FROM parts GROUP BY row HAVING bool_and(x IS NOT NULL AND isfinite(x))
), whole AS (
  SELECT p.row, vec_id, width, place, floor(256 * x)::BIGINT AS q FROM parts p JOIN usable u ON u.row = p.row
), scored AS (
  SELECT a.vec_id AS query_id, b.row, b.vec_id, sum(a.q * b.q)::BIGINT AS score
  FROM whole a JOIN whole b ON a.place = b.place AND a.width = b.width AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0 GROUP BY a.vec_id, b.row, b.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# CRC-32 of a text of ASCII characters: a character is taken in, then eight bits are shifted out.
CRC32 = """xor(list_reduce(flatten([[256 + ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split({text}, '')]),
    lambda crc, step: CASE WHEN step > 0 THEN xor(crc, step - 256)
      ELSE xor(crc >> 1, CASE WHEN crc & 1 = 1 THEN 3988292384 ELSE 0 END) END, 4294967295::BIGINT), 4294967295)"""

OP11 = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations
), hashed AS (
  SELECT *, CRC % 20 AS fault FROM turns
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE fault <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending FROM damaged
), faulty AS (
  SELECT *, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), insertions (state, reached, cost, letters, lines) AS (
  -- Two insertions in a row reach every state that more of them reach.
  VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
    (1, 1, 0, '', []), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
    (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']), (2, 2, 6, 'II', ['assistant:', 'user:']),
    (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:']), (3, 3, 6, 'II', ['user:', 'assistant:'])
), edits (letter, initial, state, reached, cost, says) AS (
  VALUES ('D', '', 0, 0, 4, ''), ('D', '', 1, 1, 4, ''), ('D', '', 2, 2, 4, ''), ('D', '', 3, 3, 4, ''),
    ('K', 's', 0, 1, 0, ''), ('K', 'u', 0, 2, 0, ''), ('K', 'u', 1, 2, 0, ''), ('K', 'u', 3, 2, 0, ''), ('K', 'a', 2, 3, 0, ''),
    ('R', '', 0, 2, 3, 'user'), ('R', '', 1, 2, 3, 'user'), ('R', '', 3, 2, 3, 'user'), ('R', '', 2, 3, 3, 'assistant')
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counts
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS place FROM (
      SELECT w.conv_id, r.i, e.reached AS state, w.audit || n.letters || e.letter AS audit,
        w.cost + n.cost + e.cost + CASE WHEN e.letter <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END AS cost,
        w.lines || n.lines || CASE e.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [r.role || ':' || r.text] ELSE [e.says || ':' || r.text] END AS lines
      FROM ways w JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
      JOIN insertions n ON n.state = w.state JOIN edits e ON e.state = n.reached
      WHERE e.letter = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R' OR e.initial = r.initial))))
  WHERE place = 1
), finished AS (
  SELECT w.conv_id, w.cost + n.cost AS cost, w.audit || n.letters AS audit, w.lines || n.lines AS lines
  FROM ways w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
  JOIN insertions n ON n.state = w.state AND n.reached IN (0, 3)
), best AS (
  SELECT * FROM finished QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
""".replace("CRC", CRC32.format(text="place"))

OP13 = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, CRC % 9 AS h FROM (SELECT DISTINCT c, c::VARCHAR AS digits FROM turns)
), rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS pos, role, text FROM (
    SELECT v.c, 0 AS own, t.pos, role, text FROM convs v JOIN turns t ON t.c = v.c - v.c % 5 AND t.pos <= v.h
    UNION ALL
    SELECT v.c, 1, t.pos, role, text FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h)
), steps AS (
  SELECT c, pos, role, text, sha256(string_agg(sha256(role || chr(10) || text), '' ORDER BY pos) OVER prefix) AS node,
    sha256(string_agg(sha256(role || chr(10) || text), '' ORDER BY pos) OVER before) AS parent
  FROM rebuilt
  WINDOW prefix AS (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    before AS (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), at_nodes AS (
  SELECT c, 0 AS depth, 'root' AS node, NULL AS parent, 0 AS bytes FROM convs
  UNION ALL SELECT c, pos, node, coalesce(parent, 'root'), strlen(text) FROM steps
), ends AS (
  SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT c, arg_max(node, depth) AS node FROM at_nodes GROUP BY c) GROUP BY node
), nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes
  FROM at_nodes GROUP BY node
), families AS (
  SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.parent = n.node) AS n_children FROM nodes n
), below AS (
  -- A node is below another if the other lies on the way of its smallest member.
  SELECT w.node, count(*) FILTER (d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.bytes) AS saved_tokens
  FROM families d JOIN at_nodes w ON w.c = d.conv_id AND w.depth <= d.depth GROUP BY w.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
  coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM families n LEFT JOIN nodes p ON p.node = n.parent JOIN below b ON b.node = n.node LEFT JOIN ends e ON e.node = n.node
""".replace("CRC", CRC32.format(text="digits"))


def oracle_sql() -> dict[str, str]:
    return {"op4_source_mixing": OP4, "op5_minhash_near_dedup": OP5, "op9_exact_top_k": OP9, "op11_conversation_repair": OP11, "op13_prefix_trie": OP13}
