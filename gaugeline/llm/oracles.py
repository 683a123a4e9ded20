"""DuckDB SQL for the queries that SQL can express, written from the definitions of their results."""

_COMPONENTS = """
    reach(node, other) AS (
        SELECT a, a FROM nodes
        UNION
        SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other
    )"""

OP1 = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), sound AS (
    SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e)
      AND len(list_filter(e, lambda x: isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM sound p JOIN sound q
      ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
    WHERE list_dot_product(p.e, q.e) / (sqrt(list_dot_product(p.e, p.e)) * sqrt(list_dot_product(q.e, q.e))) >= 0.98
), nodes AS (SELECT DISTINCT a FROM links),{_COMPONENTS},
component AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
       vec_id = coalesce(component, vec_id) AS kept
FROM v LEFT JOIN counted ON a = vec_id LEFT JOIN component ON node = vec_id
"""

OP2 = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), texts AS (
    SELECT text, min(doc_id) AS text_id, count(*) AS n_copies, any_value(words) AS words FROM w WHERE len(words) > 0 GROUP BY text
), shingles AS (
    SELECT DISTINCT text_id, s FROM (
        SELECT text_id, unnest([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, greatest(len(words) - 4, 1) + 1)]) AS s FROM texts)
), sizes AS (SELECT text_id, count(*) AS n FROM shingles GROUP BY text_id),
shared AS (
    SELECT p.text_id AS a, q.text_id AS b, count(*) AS n FROM shingles p JOIN shingles q ON p.s = q.s AND p.text_id <> q.text_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.text_id = a JOIN sizes y ON y.text_id = b
    WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)
), nodes AS (SELECT DISTINCT a FROM links),{_COMPONENTS},
component AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT doc_id, coalesce(text_id, doc_id) AS text_id, coalesce(component, text_id, doc_id) AS class_id,
       coalesce(n_copies, 1) AS n_copies, doc_id = coalesce(component, text_id, doc_id) AS kept
FROM w LEFT JOIN texts USING (text) LEFT JOIN component ON node = text_id
"""

OP5 = """
WITH turns AS (
    SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS i
    FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
), answer AS (
    SELECT conv_id, i, text FROM turns WHERE role = 'assistant' QUALIFY i = max(i) OVER (PARTITION BY conv_id)
), rejected AS (
    SELECT t.conv_id, t.role, CASE WHEN own.i IS NULL THEN t.text ELSE other.text END AS text,
           row_number() OVER (PARTITION BY t.conv_id ORDER BY t.i) AS i
    FROM turns t LEFT JOIN answer own ON own.conv_id = t.conv_id AND own.i = t.i
    LEFT JOIN answer other ON other.conv_id = xor(t.conv_id, 1)
    WHERE own.i IS NULL OR other.conv_id IS NOT NULL
), differ AS (
    SELECT conv_id, min(i) AS i FROM (
        SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.i, r.i) AS i
        FROM turns c FULL JOIN rejected r ON c.conv_id = r.conv_id AND c.i = r.i
        WHERE c.i IS NULL OR r.i IS NULL OR c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text) GROUP BY conv_id
), sides AS (
    SELECT 'c' AS side, conv_id, role, text, i FROM turns UNION ALL SELECT 'r', conv_id, role, text, i FROM rejected
), rendered AS (
    SELECT s.*, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) AS head, head || coalesce(text, '') || '<|end|>' || chr(10) AS shown,
           d.i IS NOT NULL AND s.i >= d.i AS after
    FROM sides s LEFT JOIN differ d ON d.conv_id = s.conv_id
), placed AS (
    SELECT *, coalesce(sum(length(shown)) OVER (PARTITION BY conv_id, side, after ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM rendered
)
SELECT conv_id AS pair_id, CAST(count(*) FILTER (side = 'c' AND NOT after) AS INTEGER) AS n_prompt_turns,
       coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'c' AND NOT after), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'c' AND after), '') AS chosen,
       coalesce(string_agg(shown, '' ORDER BY i) FILTER (side = 'r' AND after), '') AS rejected,
       '[' || coalesce(string_agg('{"begin":' || CAST(before + length(head) AS BIGINT) || ',"end":' || CAST(before + length(shown) AS BIGINT) || '}', ',' ORDER BY i)
           FILTER (side = 'c' AND after AND role = 'assistant'), '') || ']' AS chosen_spans,
       '[' || coalesce(string_agg('{"begin":' || CAST(before + length(head) AS BIGINT) || ',"end":' || CAST(before + length(shown) AS BIGINT) || '}', ',' ORDER BY i)
           FILTER (side = 'r' AND after AND role = 'assistant'), '') || ']' AS rejected_spans
FROM placed GROUP BY conv_id
"""

OP6 = """
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), sources AS (
    SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM docs GROUP BY source
), weighed AS (
    SELECT *, CASE (i - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap,
           sum(source_size) OVER () * 150 / 100.0::DOUBLE AS total FROM sources
), levels AS (
    SELECT *, (total - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed WINDOW f AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)
), goals AS (
    SELECT *, CASE WHEN common IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, weight * common) END AS target
    FROM (SELECT *, (SELECT arg_min(level, source_size::DOUBLE / weight) FROM levels WHERE cap > weight * level) AS common FROM levels)
), placed AS (
    SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, floor(target + 0.5) AS goal,
           coalesce(sum(size) OVER (PARTITION BY i ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM docs JOIN goals ON docs.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(start + size, goal) - start) + greatest(0, least(source_size + start + size, goal) - source_size - start) AS BIGINT) AS taken
FROM placed
"""

OP12 = """
WITH own AS (
    SELECT conv_id, list({'k': k, 'b': octet_length(encode(text))} ORDER BY turn NULLS FIRST, k) AS turns
    FROM (SELECT *, sha256(octet_length(encode(role)) || ':' || role || text) AS k
          FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))
    GROUP BY conv_id
), hashed AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda s, b: xor(xor(s, b) >> 1, 3988292384 * (xor(s, b) & 1)))) % 9 AS h
    FROM own
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(f.turns[1:c.h], []), c.turns[c.h + 1:]) AS path
    FROM hashed c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 5
), beginnings AS (
    SELECT conv_id, d, d = len(path) AS ends, array_to_string(list_transform(path[1:d], lambda t: t.k), '') AS node, path[d].b AS bytes
    FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n, substr(node, 1, 64 * (d - 1)) AS above, coalesce((n - 1) * any_value(bytes), 0) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM beginnings GROUP BY node, d
), counted AS (
    SELECT p.*, coalesce(c.n_children, 0) AS n_children
    FROM nodes p LEFT JOIN (SELECT above, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY above) c ON c.above = p.node
), subtrees AS (
    SELECT substr(node, 1, 64 * up) AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(d + 1)) AS up FROM counted) GROUP BY ALL
)
SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM counted x JOIN subtrees s ON s.node = x.node LEFT JOIN nodes p ON p.node = x.above AND p.d = x.d - 1
"""

ORACLES = {"op1_spherical_caps": OP1, "op2_dart_minhash": OP2, "op5_preference": OP5, "op6_source_schedule": OP6, "op12_prefix_trie": OP12}
