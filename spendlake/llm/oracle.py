"""DuckDB SQL of the operators that SQL can express; the others are tested against brute force."""
from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT u, v FROM common JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 80 * (a.n + b.n - k)),
both_ways AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach(u, v) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.u, e.v FROM reach r JOIN both_ways e ON e.u = r.v)
SELECT n.doc_id, n.n AS n_shingles, min(r.v) AS component_id FROM n JOIN reach r ON r.u = n.doc_id GROUP BY 1, 2
"""

_ESC = r"replace(replace(replace({0}, '\', '\b'), '<turn>', '\o'), '</turn>', '\c')"

OP4 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn>') + length(replace({_ESC.format("role")}, chr(10), '\n')) + 1 + length({_ESC.format("text")}) + length('</turn>') + 1)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

OP6 = rf"""
WITH r(rhost, rpath, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (
  SELECT row_number() OVER () AS k, page_id, {_LOWER.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
m AS (
  SELECT k, arg_max({{'rule': rhost || rpath, 'verdict': verdict}}, [length(rhost || rpath), length(rhost)]) AS best
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY k)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (k)
"""

OP9 = rf"""
WITH c AS (
  SELECT page_id, md5(coalesce(html, '')) AS h, sha256(coalesce(html, '')) AS body, strlen(coalesce(html, ''))::BIGINT AS size,
    page_id * 60 AS seconds, CASE WHEN contains(url, '://') THEN
      regexp_replace(regexp_replace({_LOWER.format("regexp_extract(url, '://(?:[^/?#@]*@)?([^/?#]*)', 1)")}, ':(80|443)$', ''), '^www\.', '')
      || regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/+$', '')
      || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)='))), '&'), ''), '') END AS canonical
  FROM pages),
m AS (
  SELECT a.page_id, a.canonical, a.h, arg_max({{'id': b.page_id, 'h': b.h, 'body': b.body, 'size': b.size}}, b.page_id) AS r
  FROM c a LEFT JOIN c b ON a.canonical = b.canonical AND b.seconds < a.seconds + 86400 GROUP BY ALL),
s AS (
  SELECT *, CASE WHEN r IS NULL THEN 'no_response'
    WHEN page_id % 2 = 0 THEN CASE WHEN substr(h, 1, 16) = substr(r.h, 1, 16) THEN 'resolved' ELSE 'changed' END
    ELSE CASE WHEN substr(h, 17, 8) = substr(r.h, 17, 8) THEN 'resolved' ELSE 'changed' END END AS status FROM m)
SELECT page_id * 2 + 1 AS record_id, canonical, status, r.id * 2 AS response_id,
  CASE WHEN status = 'resolved' THEN r.body END AS payload_sha256, CASE WHEN status = 'resolved' THEN r.size END AS payload_bytes,
  CASE WHEN status = 'resolved' THEN 'cache-control: max-age=600' || chr(10) || 'content-type: text/html' || chr(10)
    || 'etag: ' || CASE WHEN page_id % 2 = 0 THEN 'W/' ELSE '' END || '"' || substr(r.h, 1, 16) || '"' || chr(10)
    || 'last-modified: rev-' || substr(r.h, 17, 8) END AS headers
FROM s
"""

_WORDS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bk AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM bk, unnest(range(1, len(w) - k + 2)) t(i)),
dw AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM d, (SELECT DISTINCT k FROM bk) ks, unnest(range(1, len(w) - k + 2)) t(i)),
h AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM h, unnest(range(i, i + k)) t(p) GROUP BY 1),
item AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""

# crc32 of a decimal number: eight shifts a byte, 3988292384 is the reversed polynomial
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda e, f: CASE WHEN e % 2 = 1 THEN xor(e // 2, 3988292384::BIGINT) ELSE e // 2 END)))"""

OP11 = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
b AS (SELECT DISTINCT c, c - c % 100 AS base, ({_CRC.format("c")}) % 6 AS h FROM t),
s AS (
  SELECT b.c, 0 AS own, t.place, role, text FROM b JOIN t ON t.c = base AND place < h
  UNION ALL SELECT b.c, 1, t.place, role, text FROM b JOIN t ON t.c = b.c AND place >= h),
r AS (
  SELECT c, coalesce(list(sha256(length(role) || ':' || role || ':' || text) ORDER BY own, place) FILTER (own IS NOT NULL), []) AS k,
    list(length(text) ORDER BY own, place) AS z FROM b LEFT JOIN s USING (c) GROUP BY c),
p AS (SELECT c, d, k[1:d] AS prefix, CASE WHEN d > 0 THEN z[d] ELSE 0 END AS size, len(k) AS l FROM r, unnest(range(0, len(k) + 1)) u(d)),
n AS (
  SELECT d, prefix, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (l = d), '')) AS ends FROM p GROUP BY d, prefix),
f AS (SELECT x.*, y.c AS parent FROM n x LEFT JOIN n y ON x.d = y.d + 1 AND x.prefix[1:y.d] = y.prefix),
g AS (SELECT x.d, x.prefix, count(y.d) AS n_children FROM n x LEFT JOIN n y ON y.d = x.d + 1 AND y.prefix[1:x.d] = x.prefix GROUP BY ALL),
u AS (
  SELECT x.d, x.prefix, sum((n_children = 0)::INTEGER)::BIGINT AS n_leaves, sum(y.saved)::BIGINT AS saved_tokens
  FROM n x JOIN n y ON y.d >= x.d AND y.prefix[1:x.d] = x.prefix JOIN g ON g.d = y.d AND g.prefix = y.prefix GROUP BY ALL)
SELECT f.c AS conv_id, f.d::BIGINT AS depth, f.parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends AS ends_sha256
FROM f JOIN g USING (d, prefix) JOIN u USING (d, prefix)
"""

OP12 = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM w, unnest(range(1, 5)) s(n), unnest(range(1, len(w) - n + 2)) t(i)),
f AS (SELECT lang, n, phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE n = 1 GROUP BY 1),
c AS (SELECT lang, n, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE n > 1 AND f >= 30),
cut AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM c, unnest(range(1, c.n)) t(k) JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:c.n], ' ')),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cut),
longer AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most FROM c, unnest(range(2, n)) t(m), unnest(range(1, n - m + 2)) u(i) GROUP BY 1, 2)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT x.lang, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, x.phrase) AS rank, x.phrase, a, l, r, score
  FROM weakest x LEFT JOIN longer y ON y.lang = x.lang AND y.phrase = x.phrase
  WHERE o = 1 AND (most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)) JOIN total USING (lang) WHERE rank <= 2000
"""

OP13 = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
pair AS (
  SELECT q.k, q.vec_id AS query_id, c.vec_id, c.k AS ck, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda x: coalesce(x[1] * x[2], 0))), 0)::BIGINT AS score
  FROM v q JOIN v c ON c.k <> q.k WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST, ck) AS rank FROM pair)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE = {"op3_jaccard_join": OP3, "op4_chat_format": OP4, "op6_url_rules": OP6, "op9_warc_revisits": OP9, "op10_decontaminate": OP10, "op11_prefix_trie": OP11, "op12_collocations": OP12, "op13_bit_sliced": OP13}
