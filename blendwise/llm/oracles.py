"""DuckDB SQL of the operators that SQL can express over whole tables."""

from __future__ import annotations

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), w AS (
  SELECT payload_digest, max(page_id) AS winner FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN w.winner <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN w.winner <> d.page_id THEN w.winner END AS refers_to
FROM d LEFT JOIN w USING (payload_digest)
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# CRC-32 of the id's digits: each byte is an xor, followed by eight shifts (-1).
_CRC = """xor(4294967295, list_reduce([4294967295] || flatten(list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
    lambda i: [CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END))"""

MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT coalesce('=' || source, '') AS tree, doc_id, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS tampered
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS size, row_number() OVER () AS n
  FROM hashed
), grown AS (
  SELECT 0 AS level, tree, pos, size, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, tree, pos // 3, (size + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM grown WHERE size > 1 GROUP BY ALL
), subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS size FROM grown WHERE size = 1
), top AS (
  SELECT 0 AS level, pos, size, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (size + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE size > 1 GROUP BY ALL
), low AS (
  SELECT l.n, g.level, coalesce(string_agg(g.h, '' ORDER BY g.pos) FILTER (g.pos < l.pos // CAST(pow(3, g.level) AS BIGINT)), '') AS lft,
         coalesce(string_agg(g.h, '' ORDER BY g.pos) FILTER (g.pos > l.pos // CAST(pow(3, g.level) AS BIGINT)), '') AS rgt
  FROM leaves l JOIN grown g ON g.tree = l.tree AND g.size > 1 AND g.pos // 3 = l.pos // CAST(pow(3, g.level + 1) AS BIGINT)
  GROUP BY l.n, g.level
), high AS (
  SELECT s.tree, t.level, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < s.pos // CAST(pow(3, t.level) AS BIGINT)), '') AS lft,
         coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > s.pos // CAST(pow(3, t.level) AS BIGINT)), '') AS rgt
  FROM subroots s JOIN top t ON t.size > 1 AND t.pos // 3 = s.pos // CAST(pow(3, t.level + 1) AS BIGINT)
  GROUP BY s.tree, t.level
), low_steps AS (
  SELECT n, list(lft || '|' || rgt ORDER BY level) AS steps FROM low GROUP BY n
), high_steps AS (
  SELECT tree, list(lft || '|' || rgt ORDER BY level) AS steps FROM high GROUP BY tree
), proofs AS (
  SELECT l.*, s.h AS subroot, (SELECT h FROM top WHERE size = 1) AS root,
         coalesce(a.steps, CAST([] AS VARCHAR[])) || coalesce(b.steps, CAST([] AS VARCHAR[])) AS steps
  FROM leaves l JOIN subroots s USING (tree) LEFT JOIN low_steps a USING (n) LEFT JOIN high_steps b USING (tree)
), folded AS (
  SELECT *, list_reduce([coalesce(tampered, leaf)] || steps,
                        lambda node, step: sha256(split_part(step, '|', 1) || node || split_part(step, '|', 2))) AS folded_root
  FROM proofs
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM folded
"""

_DISTANCE = "list_dot_product(a.v, a.v) - 2 * list_dot_product(a.v, c.v) + list_dot_product(c.v, c.v)"


def _round(i: int) -> str:
    """Nearest entries under the codebooks c{i}, and the codebooks after it."""
    return f"""near{i} AS MATERIALIZED (
  SELECT a.n, a.p, any_value(a.v) AS v, arg_min(c.e, ({_DISTANCE}) * 16 + c.e) AS e, min({_DISTANCE}) AS d
  FROM parts a JOIN c{i} c USING (p) GROUP BY a.n, a.p
), c{i + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT p, e, list(x ORDER BY k) AS v FROM (
      SELECT p, e, k, floor(sum(v[k]) / count(*)) AS x FROM near{i}, range(1, 9) AS r(k) GROUP BY p, e, k) GROUP BY p, e
  ) m USING (p, e)
)"""


LLOYD = f"""
WITH usable AS (
  SELECT vec_id, label, embedding, list_transform(embedding, lambda x: floor(4096 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), rows AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n FROM usable
), parts AS MATERIALIZED (
  SELECT n, p, list_slice(v, 8 * p + 1, 8 * p + 8) AS v FROM rows, range(8) AS r(p)
), c0 AS MATERIALIZED (
  SELECT p, n - 1 AS e, v FROM parts WHERE n <= 16
), {", ".join(_round(i) for i in range(7))}, coded AS (
  SELECT n, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near6 GROUP BY n
), books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, k)) AS digest
  FROM (SELECT p, e, k, v[k] AS x FROM c6, range(1, 9) AS r(k))
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM rows JOIN coded USING (n), books
"""

TOPK = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v, row_number() OVER () AS n FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), ranked AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score,
         CAST(row_number() OVER (PARTITION BY q.n ORDER BY list_dot_product(q.v, x.v) DESC, x.vec_id NULLS LAST) AS INTEGER) AS rank
  FROM rows q JOIN rows x ON x.n <> q.n WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLE_SQL = {"op3_warc_salvage": WARC, "op11_dual_tree_lloyd": LLOYD, "op12_merkle_manifest": MERKLE, "op13_pivot_topk": TOPK}
