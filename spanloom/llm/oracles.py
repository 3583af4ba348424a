"""SQL twins (DuckDB) of the training-data queries that SQL can express."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(words) - 3, 1) + 1), lambda i: array_to_string(words[i:i + 3], ' '))) END AS sh FROM w
), u AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * common >= 85 * (len(x.sh) + len(y.sh) - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
"""

OP10 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), tm AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos FROM d),
cnt AS (SELECT term, count(*) AS many FROM tm GROUP BY term),
ph AS (SELECT DISTINCT phrase, n, string_split(phrase, ' ') AS terms FROM win),
rarest AS (
  SELECT phrase, n, terms, term, off FROM (SELECT p.*, coalesce(many, 0) AS many FROM (SELECT *, unnest(terms) AS term, generate_subscripts(terms, 1) - 1 AS off FROM ph) p LEFT JOIN cnt USING (term))
  QUALIFY min(many) OVER (PARTITION BY phrase) > 0 AND row_number() OVER (PARTITION BY phrase ORDER BY many, off) = 1
), close AS (
  SELECT DISTINCT doc_id, phrase FROM (SELECT tm.doc_id, phrase, n, terms, pos - off AS start FROM rarest JOIN tm USING (term) WHERE pos - off >= -2) JOIN d USING (doc_id)
  WHERE len(list_filter(range(0, n), lambda i: list_contains(w[greatest(start + i - 2, 0) + 1:greatest(start + i + 3, 0)], terms[i + 1]))) = n
), near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM close JOIN win USING (phrase) GROUP BY doc_id),
sizes AS (SELECT DISTINCT n FROM win), p AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hit AS (
  SELECT p.doc_id, p.i, p.n, win.item_id FROM p JOIN win ON p.phrase = win.phrase AND p.n = win.n
), pos AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id)
"""

OP9 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(5 * (j // 4) + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31 AS BIGINT) + 1, 1)), '') AS digest,
    max(page_id) OVER (PARTITION BY h, strlen(body)) AS newest FROM p
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM d
"""

# The pages of the test data hold their main text in one article element of p, h1, br and b.
OP6 = r"""
WITH a AS (
  SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1), '</?(?:p|h1|br)>') AS parts FROM pages
), b AS (
  SELECT page_id, url, list_filter(list_transform(parts, lambda x:
    trim(regexp_replace(replace(replace(regexp_replace(x, '</?b>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM a
)
SELECT page_id, url, array_to_string(blocks, chr(10)) AS text, CAST(length(array_to_string(blocks, chr(10))) AS BIGINT) AS n_chars FROM b
"""

# CRC-32 bit by bit: each digit's code, then eight shifts.
OP12 = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS part, pos, k, w FROM c JOIN t ON t.conv_id = c.base AND pos <= h UNION ALL SELECT c.conv_id, 1, pos, k, w FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
), s AS (
  SELECT c.conv_id, coalesce(ks, []) AS ks, coalesce(ws, []) AS ws FROM c LEFT JOIN (SELECT conv_id, list(k ORDER BY part, pos) AS ks, list(w ORDER BY part, pos) AS ws FROM r GROUP BY conv_id) USING (conv_id)
), g AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, coalesce(any_value(w), 0) AS w, string_agg(CASE WHEN ended THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
  FROM (SELECT conv_id, d, ks[1:d] AS path, CASE WHEN d > 0 THEN ws[d] END AS w, d = len(ks) AS ended FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM s)) GROUP BY path, d
), kids AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS kids FROM g WHERE d > 0 GROUP BY ALL),
f AS (SELECT g.*, coalesce(kids, 0) AS kids FROM g LEFT JOIN kids USING (path, d)),
sums AS (
  SELECT path[1:e] AS path, e AS d, sum((n - 1) * w) AS saved, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM f) GROUP BY ALL
)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, CAST(f.kids AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN sums USING (path, d) LEFT JOIN g p ON f.d > 0 AND p.d = f.d - 1 AND p.path = f.path[1:f.d - 1]
"""
