"""SQL for the operators that SQL can express."""

from __future__ import annotations

# crc32 by its table of 256 remainders; texts as their UTF-8 bytes.
CRC32 = """
  remainders AS (
    SELECT list(c ORDER BY i) AS t FROM (
      SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END) AS c
      FROM (SELECT unnest(range(256)) AS i))
  )
"""


def _crc32(text: str) -> str:
    code = f"list_transform(string_split({text}, ''), lambda s: CAST(unicode(s) AS BIGINT))"
    utf8 = f"""flatten(list_transform({code}, lambda p: CASE
      WHEN p < 128 THEN [p]
      WHEN p < 2048 THEN [192 + p // 64, 128 + p % 64]
      WHEN p < 65536 THEN [224 + p // 4096, 128 + p // 64 % 64, 128 + p % 64]
      ELSE [240 + p // 262144, 128 + p // 4096 % 64, 128 + p // 64 % 64, 128 + p % 64] END))"""
    return f"""xor(CAST(4294967295 AS BIGINT), list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), {utf8}),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])))"""


# Near words share a pattern: the same letters with one place open, or one letter left out.
SPELLING = f"""
WITH RECURSIVE {CRC32},
runs AS (
  SELECT concat(CAST(doc_id AS VARCHAR), ':') AS k, run, count(*) AS n
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
),
hashed AS (SELECT run, n, {_crc32("concat(k, run)")} AS h FROM runs, remainders),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0
      THEN concat(substring(run, 1, h % length(run)), substring(run, h % length(run) + 2)) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
holes AS (
  SELECT word, n, i, substring(word, 1, i) AS head, substring(word, i + 2) AS tail
  FROM (SELECT *, unnest(range(length(word))) AS i FROM words)
),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM holes a JOIN holes b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.head || a.tail = b.word
  UNION
  SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.head || a.tail = b.word
),
nearest AS (
  SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS best FROM pairs GROUP BY word
),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.less >= 5 * w.n THEN best.other END AS form,
    CASE WHEN -best.less >= 5 * w.n THEN -best.less END AS form_n
  FROM words w LEFT JOIN nearest m ON w.word = m.word
),
chains AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chains c JOIN formed f ON c.next = f.word
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chains c ON f.word = c.word AND c.next IS NULL
"""


GRID_JOIN = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id, b.vec_id AS other FROM vectors a JOIN vectors b ON a.label = b.label
    AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.other FROM reached r JOIN links l ON r.other = l.vec_id
),
lowest AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counted AS (SELECT vec_id, count(*) AS n FROM links GROUP BY vec_id)
SELECT l.vec_id, coalesce(n, 0) AS n_links, component_id, l.vec_id = component_id AS kept
FROM lowest l LEFT JOIN counted c ON l.vec_id = c.vec_id
"""


# Step i takes every conversation over its row i, from each state of the role pattern
# (0 nothing yet, 1 system, 2 user, 3 assistant) and with up to two turns inserted first.
TURNS = f"""
WITH RECURSIVE {CRC32},
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS h
  FROM conversations, remainders
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, LATERAL (SELECT unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END))) WHERE h <> 0
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged
),
faulty AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair,
    CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ordered
),
inserts AS (SELECT * FROM (VALUES
  (0, 0, 0, '', []), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
  (1, 1, 0, '', []), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
  (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']), (2, 2, 6, 'II', ['assistant:', 'user:']),
  (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:']), (3, 3, 6, 'II', ['user:', 'assistant:'])
) AS t(before, state, cost, letters, lines)),
edits AS (SELECT * FROM (VALUES
  ('K', 's', 0, 1), ('K', 'u', 0, 2), ('K', 'u', 1, 2), ('K', 'u', 3, 2), ('K', 'a', 2, 3),
  ('R', '', 0, 2), ('R', '', 1, 2), ('R', '', 3, 2), ('R', '', 2, 3),
  ('D', '', 0, 0), ('D', '', 1, 1), ('D', '', 2, 2), ('D', '', 3, 3)
) AS t(letter, initial, before, state)),
ways AS (
  SELECT i.before AS start, e.letter, e.initial, e.state, i.cost, i.letters || e.letter AS letters, i.lines
  FROM inserts i JOIN edits e ON i.state = e.before
),
best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state,
    {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS way
  FROM ordered
  UNION ALL
  SELECT b.conv_id, f.i, w.state, min({{
    'cost': b.way.cost + w.cost + CASE w.letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
      + CASE WHEN w.letter <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END,
    'audit': b.way.audit || w.letters,
    'lines': b.way.lines || CAST(w.lines AS VARCHAR[]) || CASE w.letter WHEN 'D' THEN CAST([] AS VARCHAR[])
      WHEN 'K' THEN [f.role || ':' || f.text]
      ELSE [CASE w.state WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] END}})
  FROM best b JOIN faulty f ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = b.i + 1
    JOIN ways w ON w.start = b.state AND (w.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
      AND (w.letter <> 'K' OR w.initial = f.initial)
  GROUP BY ALL
),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
),
ended AS (
  SELECT b.conv_id, min({{'cost': b.way.cost + s.cost, 'audit': b.way.audit || s.letters,
    'lines': b.way.lines || CAST(s.lines AS VARCHAR[])}}) AS way
  FROM best b JOIN counted c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n
    JOIN inserts s ON s.before = b.state AND s.state IN (0, 3)
  GROUP BY b.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.way.cost, 0) AS cost,
  coalesce(e.way.audit, '') AS audit, sha256(coalesce(array_to_string(e.way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLES: dict[str, str] = {
    "op11_reduced_neighbourhood": SPELLING,
    "op12_grid_order_join": GRID_JOIN,
    "op13_weighted_repair": TURNS,
}
