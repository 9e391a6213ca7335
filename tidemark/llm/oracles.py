"""SQL for DuckDB over the same tables."""

OP2 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
  END AS shingles
  FROM split
), items AS (
  SELECT doc_id, unnest(shingles) AS item FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common
  JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.shingles) + len(y.shingles) - n)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS least FROM documents
  UNION
  SELECT ways.b, reach.least FROM reach JOIN ways ON ways.a = reach.node WHERE reach.least < ways.b
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, min(least) AS component_id, doc_id = min(least) AS kept
FROM sets JOIN reach ON node = doc_id GROUP BY doc_id, shingles
"""

OP3 = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT doc_id, h, length(h) // 2 AS n FROM bytes
), strings AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS x
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM sized WHERE n >= 100)
), repeats AS (
  SELECT doc_id, p FROM strings QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, p) > 1
), steps AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS opens
  FROM repeats
), numbered AS (
  SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM steps
), runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, g
), gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
                 || substr(any_value(h), 2 * max(b) + 1) AS h,
         sum(b - a) AS removed, count(*) AS spans
  FROM gaps JOIN sized USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.h, sized.h))) AS kept_sha256
FROM sized LEFT JOIN kept USING (doc_id)
"""

OP5 = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), best AS (
  SELECT body, first(doc_id ORDER BY points DESC, doc_id) AS keep_id, count(*) AS group_size
  FROM bare GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM bare JOIN best USING (body)
"""

OP7 = """
WITH bare AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), first AS (
  SELECT body, min(page_id) AS first_id FROM bare GROUP BY body
)
SELECT page_id,
       strlen(body) AS payload_bytes,
       list_aggregate(
         list_transform(
           range(32),
           lambda i: substr(
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER,
             1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM bare JOIN first USING (body)
"""


#: Every prefix as a list of turns; the checksum bit by bit (a byte, then eight steps marked -1).
OP12 = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'r': r, 't': t} ORDER BY place) AS ts FROM turns GROUP BY conv_id
), opened AS (
  SELECT conv_id, ts, conv_id - conv_id % 20 AS base,
         xor(list_reduce(
           list_concat([4294967295::BIGINT],
             flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[]))),
           lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END
         ), 4294967295::BIGINT) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.ts[1:o.h], []), o.ts[o.h + 1:]) AS ts
  FROM opened o LEFT JOIN own b ON b.conv_id = o.base
), depths AS (
  SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS depth FROM rebuilt
), prefixes AS (
  SELECT conv_id, depth, ts[1:depth] AS node, len(ts) = depth AS ended,
         CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(ts[depth].t, '[^\x20\x09-\x0D]+')) END AS words
  FROM depths
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), linked AS (
  SELECT c.node, p.node AS parent, p.conv_id AS parent_conv_id
  FROM nodes c JOIN nodes p ON p.depth = c.depth - 1 AND p.node = c.node[1:c.depth - 1]
), counted AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children
  FROM nodes n LEFT JOIN (SELECT parent AS node, count(*) AS n FROM linked GROUP BY parent) c ON c.node = n.node
), below AS (
  SELECT a.node, sum(b.saved)::BIGINT AS saved_tokens, count(*) FILTER (b.n_children = 0) AS n_leaves
  FROM counted a JOIN counted b ON b.depth >= a.depth AND b.node[1:a.depth] = a.node GROUP BY a.node
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted JOIN below USING (node) LEFT JOIN linked USING (node)
"""

OP13 = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def all_sql():
    return {
        "op2_near_dedup": OP2,
        "op3_suffix_dedup": OP3,
        "op5_exact_dedup": OP5,
        "op7_warc": OP7,
        "op12_prefix_trie": OP12,
        "op13_voronoi_topk": OP13,
    }
