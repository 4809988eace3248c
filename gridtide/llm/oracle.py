"""SQL twins, for DuckDB, of the queries that SQL can express."""

OP9 = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, i, w[i:i + 2] AS gram
  FROM split, unnest(range(1, len(w) - 1)) AS r(i)
), repeated AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (VALUES (0), (1), (2)) AS t(k)
  WHERE n > 1 GROUP BY doc_id
), measured AS (
  SELECT doc_id, text, w, lines, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
         OR n_symbols * 10 > n_words
         OR word_chars < 2 * n_words OR word_chars > 12 * n_words
         OR len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) * 5 > n_words
         OR len(list_filter(w, lambda x: length(x) > 40)) * 20 > n_words
         OR (n_dup_lines > 3 AND n_dup_lines * 2 > len(lines))
         OR len(list_distinct(w)) * 10 < sqrt(n_words) * 20
         OR len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) * 10 > len(lines) * 9) AS kept
FROM based
"""

OP3 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, w[i:i + 3] AS s FROM split, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS r(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), near AS (
  SELECT a, b FROM links JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reach AS (
  SELECT a AS node, a AS seen FROM near
  UNION
  SELECT reach.node, near.b FROM reach JOIN near ON near.a = reach.seen
), least AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON least.node = d.doc_id
"""

OP5 = r"""
WITH hashes AS (
  SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS hashed,
         CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes
  FROM documents
), levels AS (
  SELECT doc_id, n_bytes, CAST(d AS INTEGER) AS depth, hashed >> CAST(60 - d AS INTEGER) AS prefix,
         sum(n_bytes) OVER (PARTITION BY d, hashed >> CAST(60 - d AS INTEGER)) AS total
  FROM hashes, range(0, 61) AS r(d)
), placed AS (
  SELECT * FROM levels WHERE total <= 4000000 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
)
SELECT doc_id, n_bytes, depth, prefix, dense_rank() OVER (ORDER BY prefix << (60 - depth)) - 1 AS shard_id, CAST(0 AS BIGINT) AS page
FROM placed
"""

OP8 = r"""
WITH turns AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS t FROM conversations GROUP BY conv_id
), ranked AS (
  SELECT *, row_number() OVER same AS k, first(conv_id) OVER same AS best_id, first(t) OVER same AS best
  FROM turns WINDOW same AS (PARTITION BY t[1] ORDER BY len(t) DESC, conv_id)
), answers AS (
  SELECT conv_id, t, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')[-1] AS last FROM turns
), donors AS (
  SELECT *, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS donor FROM answers WHERE last IS NOT NULL AND conv_id IS NOT NULL
), pairs AS (
  SELECT best_id AS chosen_id, best AS c, conv_id AS rejected_id, t AS r FROM ranked WHERE k > 1
  UNION ALL
  SELECT a.conv_id, a.t, b.conv_id, list_concat(a.t[1:a.last - 1], [b.t[b.last]])
  FROM donors a JOIN donors b ON b.conv_id = a.donor AND b.conv_id <> a.conv_id
), shared AS (
  SELECT *, coalesce(nullif(list_position(list_transform(range(1, least(len(c), len(r)) + 1),
                lambda i: c[i] IS DISTINCT FROM r[i]), true), 0) - 1, least(len(c), len(r))) AS n FROM pairs
), texts AS (
  SELECT chosen_id, rejected_id, n, c, r,
         list_transform(c, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || chr(10)) AS ct,
         list_transform(r, lambda x: '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || chr(10)) AS rt
  FROM shared
), ends AS (
  SELECT *, list_transform(range(1, len(ct) + 1), lambda i: list_sum(list_transform(ct[n + 1:i], lambda x: length(x)))) AS ce,
            list_transform(range(1, len(rt) + 1), lambda i: list_sum(list_transform(rt[n + 1:i], lambda x: length(x)))) AS re
  FROM texts
)
SELECT chosen_id, rejected_id, CAST(n AS INTEGER) AS n_shared,
       array_to_string(ct[1:n], '') AS prompt, array_to_string(ct[n + 1:], '') AS chosen, array_to_string(rt[n + 1:], '') AS rejected,
       array_to_string(list_transform(list_filter(range(n + 1, len(c) + 1), lambda i: c[i].role = 'assistant'),
         lambda i: CAST(ce[i] - length(coalesce(c[i].text, '')) - 1 AS VARCHAR) || '-' || CAST(ce[i] AS VARCHAR)), ',') AS chosen_spans,
       array_to_string(list_transform(list_filter(range(n + 1, len(r) + 1), lambda i: r[i].role = 'assistant'),
         lambda i: CAST(re[i] - length(coalesce(r[i].text, '')) - 1 AS VARCHAR) || '-' || CAST(re[i] AS VARCHAR)), ',') AS rejected_spans
FROM ends
"""

OP13 = r"""
WITH rules(kind, rank, base, pattern, part, least) AS (VALUES
  ('assign', 0, true,
   '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)',
   2, 12),
  ('access', 1, true, 'AKIA[A-Z0-9]+', 0, 18),
  ('hex', 2, true, '[0-9a-f]{16,}', 0, 16),
  ('private_key', 3, false, '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----', 0, 1),
  ('signed_token', 4, false, 'eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}', 0, 1),
  ('host_token', 5, false, '(ghp|gho|ghu|ghs|ghr|glpat|xoxb|xoxp)[_-][A-Za-z0-9-]{20,}', 0, 1),
  ('url_login', 6, false, '[a-z]{2,20}://[^/:@\x20\x09-\x0D]{1,100}:[^/@\x20\x09-\x0D]{1,100}@', 0, 1)
), docs AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT n, kind, rank, base, least, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern) AS hits,
         CASE WHEN part = 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern) END AS held
  FROM docs, rules WHERE regexp_matches(text, pattern)
), spans AS (
  SELECT n, kind, rank, base, length(hits[i]) AS size, length(held[i]) >= least AS kept,
         list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS begin
  FROM cut, unnest(range(1, len(hits) + 1)) AS r(i)
), written AS (
  SELECT *, kind || ':' || CAST(begin AS BIGINT) || ':' || CAST(begin + size AS BIGINT) AS span FROM spans WHERE kept
), found AS (
  SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY begin, rank) FILTER (base) AS base, string_agg(span, ',' ORDER BY begin, rank) AS spans
  FROM written GROUP BY n
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (n)
"""

OP12 = r"""
WITH kept AS (
  SELECT row_number() OVER () AS n, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS (
  SELECT n, vec_id, CAST(p AS INTEGER) AS p, v[p * 4 + 1:p * 4 + 4] AS x FROM kept, range(0, 16) AS r(p)
), books0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM cut WHERE vec_id IN (SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT 64)
), best0 AS (
  SELECT n, p, min(list_sum(list_transform(range(1, 5), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) * 64 + e) AS b
  FROM cut JOIN books0 USING (p) GROUP BY n, p
), books1 AS (
  SELECT p, e, coalesce(m, c) AS c FROM books0 LEFT JOIN (
    SELECT p, b % 64 AS e, [CAST(floor(sum(x[1]) / count(*)) AS BIGINT), CAST(floor(sum(x[2]) / count(*)) AS BIGINT),
           CAST(floor(sum(x[3]) / count(*)) AS BIGINT), CAST(floor(sum(x[4]) / count(*)) AS BIGINT)] AS m
    FROM cut JOIN best0 USING (n, p) GROUP BY p, b % 64) USING (p, e)
), best1 AS (
  SELECT n, p, min(list_sum(list_transform(range(1, 5), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) * 64 + e) AS b
  FROM cut JOIN books1 USING (p) GROUP BY n, p
), books2 AS (
  SELECT p, e, coalesce(m, c) AS c FROM books1 LEFT JOIN (
    SELECT p, b % 64 AS e, [CAST(floor(sum(x[1]) / count(*)) AS BIGINT), CAST(floor(sum(x[2]) / count(*)) AS BIGINT),
           CAST(floor(sum(x[3]) / count(*)) AS BIGINT), CAST(floor(sum(x[4]) / count(*)) AS BIGINT)] AS m
    FROM cut JOIN best1 USING (n, p) GROUP BY p, b % 64) USING (p, e)
), best2 AS (
  SELECT n, p, min(list_sum(list_transform(range(1, 5), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) * 64 + e) AS b
  FROM cut JOIN books2 USING (p) GROUP BY n, p
), coded AS (
  SELECT n, string_agg(printf('%02x', CAST(b % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(b // 64) AS BIGINT) AS error FROM best2 GROUP BY n
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM books2) AS codebooks_sha256
FROM coded JOIN kept USING (n)
"""

OP11 = r"""
WITH turns AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (  -- crc32: each byte is put in, then eight shifts
  SELECT c, t, CAST(xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(CAST(c AS VARCHAR)) + 1),
           lambda i: [CAST(ascii(substr(CAST(c AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 6 AS INTEGER) AS h
  FROM turns
), built AS (
  SELECT a.c, CASE WHEN b.t IS NULL THEN a.t[a.h + 1:] ELSE list_concat(b.t[1:a.h], a.t[a.h + 1:]) END AS s
  FROM hashed a LEFT JOIN turns b ON b.c = a.c - a.c % 100
), heads AS (
  SELECT c, d, s[1:d] AS head, d = len(s) AS ends FROM built, unnest(range(0, len(s) + 1)) AS r(d)
), named AS (
  SELECT c, d, ends, min(c) OVER same AS m, count(*) OVER same AS n, CASE WHEN d = 0 THEN 0 ELSE length(head[d].text) END AS size
  FROM heads WINDOW same AS (PARTITION BY d, head)
), nodes AS (
  SELECT v.d, v.m, max(v.n) AS n, max((v.n - 1) * v.size) AS saved, max(p.m) AS parent, string_agg(CAST(v.c AS VARCHAR), ',' ORDER BY v.c) FILTER (v.ends) AS ids
  FROM named v LEFT JOIN named p ON p.c = v.c AND p.d = v.d - 1 GROUP BY v.d, v.m
), children AS (
  SELECT d - 1 AS d, parent AS m, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL
), below AS (  -- the nodes that the least member passes on its way are those above
  SELECT up.d, up.m, sum(v.saved) AS saved, count(*) FILTER (kids IS NULL) AS leaves
  FROM nodes v LEFT JOIN children k ON k.d = v.d AND k.m = v.m JOIN named up ON up.c = v.m AND up.d <= v.d GROUP BY ALL
)
SELECT nodes.m AS conv_id, nodes.d AS depth, parent AS parent_conv_id, n AS n_convs, coalesce(kids, 0) AS n_children, leaves AS n_leaves,
       CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN below ON below.d = nodes.d AND below.m = nodes.m LEFT JOIN children k ON k.d = nodes.d AND k.m = nodes.m
"""

SQL = {
    "op3_jaccard_join": OP3,
    "op5_sharding": OP5,
    "op8_chat_formatting": OP8,
    "op9_quality_rules": OP9,
    "op11_prefix_trie": OP11,
    "op12_vector_codes": OP12,
    "op13_secret_scans": OP13,
}
