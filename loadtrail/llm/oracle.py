"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT_DEDUP = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)
"""

#: All pairs that share a shingle, and the components by following links: fit for small tables only.
NGRAM_JOIN = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
    FROM worded
), keyed AS (
    SELECT doc_id, len(s) AS n, list_sort(s) AS s, min(doc_id) OVER same AS class_id, count(*) OVER same AS class_rows
    FROM sets WINDOW same AS (PARTITION BY list_sort(s))
),
shingles AS (SELECT doc_id, n, unnest(s) AS x FROM keyed WHERE doc_id = class_id),
linked AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id AND a.n * 10 >= b.n * 9 AND b.n * 10 >= a.n * 9
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (
    SELECT DISTINCT class_id AS d, class_id AS r FROM keyed
    UNION
    SELECT reached.d, links.b FROM reached JOIN links ON reached.r = links.a
), roots AS (SELECT d, min(r) AS root FROM reached GROUP BY d),
others AS (
    SELECT links.a, CAST(sum(keyed.class_rows) AS BIGINT) AS n FROM links JOIN keyed ON keyed.doc_id = links.b GROUP BY links.a
)
SELECT keyed.doc_id, CAST(keyed.n AS BIGINT) AS n_shingles, CASE WHEN keyed.n = 0 THEN keyed.doc_id ELSE root END AS component_id,
       CASE WHEN keyed.n = 0 THEN 0 ELSE class_rows - 1 + coalesce(others.n, 0) END AS n_links
FROM keyed JOIN roots ON roots.d = keyed.class_id LEFT JOIN others ON others.a = keyed.class_id
"""

#: The checksum by its table, and every prefix of every conversation: fit for small tables only.
PREFIX_TRIE = """
WITH codes AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
            CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END) AS c
        FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))
), own AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
    SELECT conv_id, turns, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda x, y: xor(t[CAST(xor(x, y) & 255 AS INT) + 1], x >> 8))) % 6 AS h
    FROM own, codes
), rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
    FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100
), prefixes AS (
    SELECT conv_id, len(turns) AS n, d, turns[1:d] AS path FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * coalesce(length(path[d].t), 0) AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
    FROM prefixes GROUP BY d, path
), children AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
shaped AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON children.path = nodes.path),
sums AS (
    SELECT k, path[1:k] AS path, sum(CAST(n_children = 0 AS INT)) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(d + 1)) AS k FROM shaped) GROUP BY ALL
)
SELECT s.conv_id, CAST(s.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, s.n_convs, CAST(s.n_children AS BIGINT) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, s.ends_sha256
FROM shaped s JOIN sums ON sums.k = s.d AND sums.path = s.path
LEFT JOIN nodes p ON p.d = s.d - 1 AND p.path = s.path[1:s.d - 1]
"""

#: All windows of all documents against all windows of all items.
DECONTAMINATION = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), i AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), passages AS (
    SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS t FROM (
        SELECT item, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)
), cut AS (
    SELECT r, m, s, array_to_string(w[s:s + m - 1], ' ') AS t FROM (
        SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM passages) WHERE len(w) >= m)
), met AS (SELECT DISTINCT r, c.m, s, t FROM cut c SEMI JOIN passages p ON c.m = p.m AND c.t = p.t),
hit AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(s, s + m)) AS k FROM met) GROUP BY r),
listed AS (
    SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM met JOIN passages p ON met.m = p.m AND met.t = p.t) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.r = d.r LEFT JOIN listed ON listed.r = d.r
"""


#: All anchors against all rows.
HARD_NEGATIVES = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
        CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.r <> b.r
), positives AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.score DESC, n.vec_id, n.other) AS INT) AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.r = p.r AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": NGRAM_JOIN,
        "op2_exact_dedup": EXACT_DEDUP,
        "op11_prefix_trie": PREFIX_TRIE,
        "op12_decontamination": DECONTAMINATION,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
