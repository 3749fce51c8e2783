"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK_WORDS = r"'[^\x20\x09-\x0D]+'"

OP9 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, {_BLANK_WORDS}), []) AS words FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)])
  END AS s FROM w
), flat AS (
  SELECT doc_id, unnest(s) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), component AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN component ON doc_id = a
"""

OP6 = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL
), last AS (
  SELECT conv_id, max(i) AS l, arg_max(text, i) AS reply FROM t WHERE role = 'assistant' GROUP BY conv_id
), pair AS (
  SELECT a.conv_id, a.l, b.reply AS other, b.reply IS NOT NULL AS given,
    CASE WHEN b.reply = a.reply THEN a.l + 1 ELSE a.l END AS n
  FROM last a LEFT JOIN last b ON b.conv_id = xor(a.conv_id, 1)
), shown AS (
  SELECT t.conv_id, i, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS s
  FROM t JOIN last ON last.conv_id = t.conv_id AND i <= l
)
SELECT pair.conv_id, CAST(n AS BIGINT) AS n_common,
  coalesce(string_agg(s, '' ORDER BY i) FILTER (i < n), '') AS prompt,
  coalesce(string_agg(s, '' ORDER BY i) FILTER (i >= n), '') AS chosen,
  CASE WHEN given AND n = l
    THEN '<|im_start|>assistant' || chr(10) || other || '<|im_end|>' || chr(10) ELSE '' END AS rejected,
  CASE WHEN n = l THEN '22-' || (max(length(s)) FILTER (i = l) - 1) ELSE '' END AS chosen_spans,
  CASE WHEN given AND n = l THEN '22-' || (22 + length(other) + 10) ELSE '' END AS rejected_spans
FROM pair JOIN shown ON shown.conv_id = pair.conv_id
GROUP BY pair.conv_id, n, l, given, other
"""

# floor(1024 * x) of each component of the vectors that an operator on embeddings takes.
_WHOLE = """
SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding,
  lambda x: x IS NULL OR NOT isfinite(x)), true)
"""


def _clusters(k: int, rounds: int, length: int, seed: int) -> str:
    """Rounds of assignment and new centroids, written out one after the other."""

    def assigned(centroids: str) -> str:
        return f"""
  SELECT r, vec_id, any_value(v.v) AS v, arg_min(c, (d, c)) AS c, CAST(min(d) AS BIGINT) AS d FROM (
    SELECT v.r, v.vec_id, v.v, z.c,
      list_inner_product(v.v, v.v) - 2 * list_inner_product(v.v, z.v) + list_inner_product(z.v, z.v) AS d
    FROM v CROSS JOIN {centroids} z) v GROUP BY r, vec_id"""

    steps = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM ({_WHOLE}) WHERE len(v) = {length})",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('{seed}:' || vec_id) AS h, v FROM v WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))""",
    ]
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({assigned(f'c{i}')})")
        steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(q ORDER BY j) AS v FROM (
      SELECT c, j, CAST((s - ((s % n) + n) % n) // n AS DOUBLE) AS q FROM (
        SELECT c, j, sum(CAST(x AS BIGINT)) AS s, count(*) AS n FROM (
          SELECT c, unnest(v) AS x, unnest(range(len(v))) AS j FROM a{i}) GROUP BY c, j))
    GROUP BY c) m ON m.c = c{i}.c)""")
    steps.append(f"a AS MATERIALIZED ({assigned(f'c{rounds}')})")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(z.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a JOIN c{rounds} z ON z.c = a.c
"""


OP11 = _clusters(k=8, rounds=10, length=64, seed=3)

# crc32 by its table of 256 numbers; keys are plain ASCII. The search takes the turns of all
# conversations in step, with the best (cost, edits) of each of the four states.
OP12 = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n)
), hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[1 + xor(c, b) % 256]))) % 20 AS fate
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE fate <> 0
), ordered AS (
  SELECT conv_id, turn, role, text, row_number() OVER w AS i,
    left(role, 1) AS first, lag(left(role, 1)) OVER w || left(role, 1) AS pair,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS ending
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), t AS MATERIALIZED (
  SELECT *, ending = '' OR again AS gone,
    CAST(ending <> '' AND NOT again AND NOT regexp_matches(ending, '[.!?]') AS INTEGER) AS cut
  FROM ordered
), best(conv_id, i, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), {'c': 0, 'e': ''}, CAST(NULL AS STRUCT(c INTEGER, e VARCHAR)),
    CAST(NULL AS STRUCT(c INTEGER, e VARCHAR)), CAST(NULL AS STRUCT(c INTEGER, e VARCHAR)) FROM t
  UNION ALL
  SELECT conv_id, i,
    CASE WHEN s0 IS NULL THEN NULL ELSE {'c': s0.c + 3, 'e': s0.e || 'D'} END,
    list_sort(list_filter([
      CASE WHEN s1 IS NULL THEN NULL ELSE {'c': s1.c + 3, 'e': s1.e || 'D'} END,
      CASE WHEN s0 IS NULL OR gone OR first <> 's' THEN NULL ELSE {'c': s0.c + cut, 'e': s0.e || 'K'} END
    ], lambda x: x IS NOT NULL))[1],
    list_sort(list_filter(list_concat(
      [CASE WHEN s2 IS NULL THEN NULL ELSE {'c': s2.c + 3, 'e': s2.e || 'D'} END],
      CASE WHEN gone OR s2 IS NULL THEN []
        ELSE [{'c': s2.c + 2 + cut + u.c, 'e': s2.e || 'I' || u.e}] END,
      CASE WHEN gone THEN [] ELSE list_transform(list_filter([s0, s1, s3], lambda x: x IS NOT NULL),
        lambda x: {'c': x.c + cut + u.c, 'e': x.e || u.e}) END
    ), lambda x: x IS NOT NULL))[1],
    list_sort(list_filter(list_concat(
      [CASE WHEN s3 IS NULL THEN NULL ELSE {'c': s3.c + 3, 'e': s3.e || 'D'} END],
      CASE WHEN gone OR s2 IS NULL THEN []
        ELSE [{'c': s2.c + cut + a.c, 'e': s2.e || a.e}] END,
      CASE WHEN gone THEN [] ELSE list_transform(list_filter([s0, s1, s3], lambda x: x IS NOT NULL),
        lambda x: {'c': x.c + 2 + cut + a.c, 'e': x.e || 'I' || a.e}) END
    ), lambda x: x IS NOT NULL))[1]
  FROM (
    SELECT t.conv_id, t.i, gone, cut, first, s0, s1, s2, s3,
      CASE WHEN first = 'u' THEN {'c': 0, 'e': 'K'} ELSE {'c': 2, 'e': 'R'} END AS u,
      CASE WHEN first = 'a' THEN {'c': 0, 'e': 'K'} ELSE {'c': 2, 'e': 'R'} END AS a
    FROM best JOIN t ON t.conv_id IS NOT DISTINCT FROM best.conv_id AND t.i = best.i + 1
  )
), ended AS (
  SELECT conv_id, list_sort(list_filter([s0,
      CASE WHEN s1 IS NULL THEN NULL ELSE {'c': s1.c + 4, 'e': s1.e || 'II'} END,
      CASE WHEN s2 IS NULL THEN NULL ELSE {'c': s2.c + 2, 'e': s2.e || 'I'} END, s3
    ], lambda x: x IS NOT NULL))[1] AS f
  FROM (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
), edit AS (
  SELECT conv_id, unnest(string_split(f.e, '')) AS e, unnest(range(length(f.e))) AS k FROM ended WHERE f.e <> ''
), placed AS (
  SELECT conv_id, e, k, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS o
  FROM edit WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING)
), repaired AS (
  SELECT p.conv_id, k, o, e, t.role, CASE WHEN e = 'I' THEN '' ELSE t.text END AS text,
    max(CAST(o = 1 AND e = 'K' AND first = 's' AS INTEGER)) OVER (PARTITION BY p.conv_id) AS shift
  FROM placed p JOIN t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = greatest(p.i, 1) WHERE e <> 'D'
), line AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - shift) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || text, chr(10) ORDER BY o) AS whole
  FROM repaired GROUP BY conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (ending = '') AS blank, count(*) FILTER (ending <> '' AND again) AS duplicate,
    count(*) FILTER (cut = 1) AS truncated,
    count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM t GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(f.c, 0) AS BIGINT) AS cost, coalesce(f.e, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN line l ON l.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP13 = f"""
WITH v AS (SELECT row_number() OVER () AS r, * FROM ({_WHOLE})),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON len(c.v) = len(q.v) AND c.vec_id IS DISTINCT FROM q.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 10
"""

SQL: dict[str, str] = {
    "op6_chat": OP6,
    "op9_near_dup": OP9,
    "op11_clusters": OP11,
    "op12_repair": OP12,
    "op13_top_k": OP13,
}
