"""DuckDB SQL for the training-data queries that SQL can express."""

#: Unsigned crc32 of a short ASCII text: bit by bit over its characters.
_CRC32 = """xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(1, length({s}) + 1), lambda i: ascii(substr({s}, i, 1))::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
    ), 4294967295)"""

#: All pairs of documents that share a shingle, and the closure of their links: for small tables.
_JACCARD = r"""
  WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
  ),
  sets AS (
    SELECT doc_id, CASE
      WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM words
  ),
  post AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
  shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS together
    FROM post a JOIN post b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
  ),
  linked AS (SELECT x, y FROM shared WHERE 100 * together >= 80 * (nx + ny - together)),
  sides AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
  reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, s.y FROM reach r JOIN sides s ON s.x = r.other
  )
  SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
  FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

#: Nodes as lists of turns, and their totals over all their prefixes.
_TRIE = f"""
  WITH own AS (
    SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns,
      {_CRC32.format(s="CAST(conv_id AS VARCHAR)")} % 9 AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
  ),
  built AS (
    SELECT o.c, list_concat(coalesce(list_slice(f.turns, 1, o.h), []), coalesce(list_slice(o.turns, o.h + 1, len(o.turns)), [])) AS path
    FROM own o LEFT JOIN own f ON f.c = o.c - o.c % 5
  ),
  members AS (SELECT c, path, unnest(range(0, len(path) + 1)) AS depth FROM built),
  nodes AS (
    SELECT list_slice(path, 1, depth) AS prefix, depth, min(c) AS conv_id, count(*) AS n_convs,
      sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(path) = depth), '')) AS ends_sha256
    FROM members GROUP BY ALL
  ),
  kin AS (
    SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1
      AND list_slice(k.prefix, 1, n.depth) = n.prefix) AS n_children,
      (n.n_convs - 1) * CASE WHEN n.depth = 0 THEN 0 ELSE octet_length(encode(n.prefix[n.depth].text)) END AS saved
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
  ),
  below AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM kin),
  totals AS (
    SELECT list_slice(prefix, 1, up) AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM below GROUP BY ALL
  )
  SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, CAST(n_convs AS BIGINT) AS n_convs,
    CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
  FROM kin JOIN totals USING (prefix)
"""

ORACLES = {
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t
    """,
    "op4_jaccard_join": _JACCARD,
    "op13_turn_trie": _TRIE,
}
