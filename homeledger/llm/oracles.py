"""SQL twins of the operators that SQL can express, for DuckDB. Values are spelled out here."""

from __future__ import annotations

WARC_REVISITS = r"""
WITH records AS (
  SELECT page_id * 2 AS capture_id, url, page_id * 60 + 1700000000 AS taken, 'response' AS kind, page_id, coalesce(html, '') AS body FROM pages
  UNION ALL
  SELECT page_id * 2 + 1, CASE WHEN page_id % 3 = 0 THEN url || '#again'
    WHEN page_id % 3 = 1 AND instr(url, '?') = 0 AND instr(url, '#') = 0 THEN url || '?utm_medium=revisit' ELSE url END,
    page_id * 60 + 1702592000, 'revisit', page_id, coalesce(html, '') FROM pages),
parsed AS (
  SELECT *, regexp_extract(url, '^[^:/?#]*://([^#]*)', 1) AS rest, sha256(body) AS sha,
    strftime(make_timestamp(taken * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS dated,
    strftime(make_timestamp(page_id * 3600000000), '%a, %d %b %Y %H:%M:%S GMT') AS modified,
    CASE WHEN kind = 'response' THEN substr(sha256(body), 1, 16) WHEN page_id % 5 = 0 THEN NULL
      WHEN page_id % 7 = 0 THEN 'changed' ELSE substr(sha256(body), 1, 16) END AS tag
  FROM records),
cut AS (
  SELECT *, regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS host,
    regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
      lambda kv: kv <> '' AND NOT regexp_matches(kv, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS pairs
  FROM parsed),
named AS (
  SELECT *, CASE WHEN rest <> '' THEN host || path || CASE WHEN len(pairs) > 0 THEN '?' || array_to_string(pairs, '&') ELSE '' END END AS canonical
  FROM cut),
found AS (
  SELECT r.capture_id, f.capture_id AS from_id, f.sha AS body, f.tag AS old_tag, f.modified AS old_modified,
    octet_length(encode(f.body)) AS old_length
  FROM named r JOIN named f ON r.canonical = f.canonical AND f.kind = 'response' AND (f.taken, f.capture_id) < (r.taken, r.capture_id)
  WHERE r.kind = 'revisit'
  QUALIFY row_number() OVER (PARTITION BY r.capture_id ORDER BY f.taken DESC, f.capture_id DESC) = 1),
judged AS (
  SELECT n.*, f.from_id, f.body AS old_body, f.old_tag, f.old_modified, f.old_length,
    CASE WHEN n.kind = 'response' THEN 'full' WHEN f.from_id IS NULL THEN 'missing'
      WHEN n.tag IS NOT NULL THEN CASE WHEN n.tag = f.old_tag THEN 'etag' ELSE 'mismatch' END
      WHEN n.page_id % 15 <> 0 THEN CASE WHEN n.modified = f.old_modified THEN 'last-modified' ELSE 'mismatch' END
      ELSE 'unverified' END AS status
  FROM named n LEFT JOIN found f USING (capture_id))
SELECT capture_id, canonical, kind, status, from_id,
  CASE WHEN status = 'full' THEN array_to_string(['cache-control: max-age=60', 'content-length: ' || octet_length(encode(body)),
      'content-type: text/html', 'date: ' || dated, 'etag: "' || tag || '"', 'last-modified: ' || modified], chr(10))
    WHEN status IN ('etag', 'last-modified') THEN array_to_string(['cache-control: max-age=120', 'content-length: ' || old_length,
      'content-type: text/html', 'date: ' || dated, 'etag: "' || old_tag || '"',
      'last-modified: ' || CASE WHEN page_id % 15 <> 0 THEN modified ELSE old_modified END], chr(10)) END AS headers,
  CASE WHEN status = 'full' THEN sha WHEN status IN ('etag', 'last-modified') THEN old_body END AS body_sha256
FROM judged
"""

NEAR_DUPLICATE_VECTORS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
smallest AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT s.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, s.vec_id = component_id AS kept
FROM smallest s LEFT JOIN counts USING (vec_id)
"""

JUMP_SHARDING = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS crc
  FROM bytes, crc_table),
jumps AS (
  SELECT doc_id, n::BIGINT AS n, (doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616 AS state, -1::BIGINT AS b, 0::BIGINT AS j
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES (40), (41)) AS v(n)
  UNION ALL
  SELECT doc_id, n, s, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / (s // 8589934592 + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS s FROM jumps WHERE j < n)),
shards AS (
  SELECT doc_id, max(b) FILTER (n = 40)::INTEGER AS shard, max(b) FILTER (n = 41)::INTEGER AS grown_shard FROM jumps WHERE j >= n GROUP BY doc_id),
placed AS (
  SELECT summed.doc_id, n_bytes + 16 AS size, crc::BIGINT AS text_crc32, shard, grown_shard,
    (SELECT greatest(1, least(1024, ceil(count(*) / 8000000.0)))::BIGINT FROM documents) AS chunks,
    ((((summed.doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616) * 2862933555777941757 + 1) % 18446744073709551616) AS s1
  FROM summed JOIN shards USING (doc_id)),
chunked AS (
  SELECT *, ((((((s1 * 2862933555777941757 + 1) % 18446744073709551616) * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592)::BIGINT + size + text_crc32) % chunks AS chunk
  FROM placed)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY chunk, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM chunked
"""

ASSOCIATION_URLS = r"""
WITH cut AS (
  SELECT row_number() OVER () AS r, page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda s: s <> '') AS steps,
    regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query
  FROM cut),
labelled AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS label FROM ruled),
slots AS (
  SELECT *, CASE WHEN host = '' THEN [] ELSE [
    'scheme=' || translate(regexp_extract(url, '^([^:]*)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    'tld=' || labels[-1],
    CASE WHEN len(labels) >= 2 THEN 'site=' || array_to_string(labels[-2:], '.') END,
    CASE WHEN len(labels) >= 3 THEN 'sub=' || array_to_string(labels[:-3], '.') END,
    'dir=' || steps[1],
    'next=' || substr(steps[2], 1, 1),
    'depth=' || len(steps),
    'ext=' || regexp_extract(steps[-1], '\.([A-Za-z0-9]+)$', 1),
    'keys=' || array_to_string(list_sort(list_distinct(list_transform(string_split(query, '&'), lambda kv: split_part(kv, '=', 1)))), '&'),
    CASE WHEN instr(url, '#') > 0 THEN 'mark=#' END] END AS every FROM labelled),
marked AS (
  SELECT r, page_id, host, path, rule, label,
    list_sort(list_filter(every, lambda t: t IS NOT NULL AND NOT suffix(t, '='))) AS tokens FROM slots),
combos AS (
  SELECT label, list_filter(tokens, lambda t, i: (m >> (i - 1)) % 2 = 1) AS items
  FROM (SELECT label, tokens, unnest(range(1, 1 << len(tokens))) AS m FROM marked WHERE rule IS NOT NULL)),
counted AS (
  SELECT items, label, count(*) AS hits, sum(count(*)) OVER (PARTITION BY items) AS all_hits FROM combos GROUP BY items, label),
rules AS (
  SELECT items, label, hits, hits::DOUBLE / all_hits::DOUBLE AS confidence FROM counted
  WHERE hits >= (SELECT ceil(0.005 * count(*)) FROM marked WHERE rule IS NOT NULL) AND hits::DOUBLE / all_hits::DOUBLE >= 0.9),
parts AS (SELECT items, label, confidence, unnest(list_transform(items, lambda t: list_filter(items, lambda u: u <> t))) AS part FROM rules WHERE len(items) > 1),
implied AS (
  SELECT DISTINCT p.items, p.label FROM parts p JOIN rules r ON r.items = p.part AND r.label = p.label AND r.confidence >= p.confidence),
kept AS (SELECT * FROM rules ANTI JOIN implied USING (items, label)),
best AS (
  SELECT r, max({'confidence': confidence, 'hits': hits, 'size': len(items), 'label': k.label}) AS b
  FROM marked m JOIN kept k ON list_has_all(m.tokens, k.items) WHERE m.rule IS NULL GROUP BY r)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN label ELSE coalesce(b.label, 'allow') END AS verdict,
  CASE WHEN rule IS NULL THEN b.confidence END AS confidence
FROM marked LEFT JOIN best USING (r)
"""

PREFIX_TRIE = """
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, list({'role': role, 'said': said} ORDER BY turn NULLS FIRST,
    left(sha256(length(role) || ':' || role || said), 32)) AS own FROM turns GROUP BY conv_id),
dealt AS (
  SELECT conv_id, own, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) % 6 AS h
  FROM convs, crc_table),
rebuilt AS (
  SELECT d.conv_id, list_concat(coalesce(b.own[1:d.h], []), d.own[d.h + 1:]) AS whole
  FROM dealt d LEFT JOIN convs b ON b.conv_id = d.conv_id - d.conv_id % 100),
nodes AS (
  SELECT depth, whole[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    count(*) FILTER (depth = len(whole)) AS n_ended,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len(whole)), '')) AS ends_sha256
  FROM rebuilt, unnest(range(len(whole) + 1)) AS u(depth) GROUP BY depth, path),
children AS (
  SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.path[n.depth].said) END AS saved
  FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path),
below AS (
  SELECT up AS depth, path[1:up] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM counted, unnest(range(depth + 1)) AS u(up) GROUP BY 1, 2)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN below b ON b.depth = n.depth AND b.path = n.path
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""

ORACLES: dict[str, str] = {
    "op2_warc_revisits": WARC_REVISITS,
    "op3_itq_near_duplicates": NEAR_DUPLICATE_VECTORS,
    "op5_jump_sharding": JUMP_SHARDING,
    "op9_association_urls": ASSOCIATION_URLS,
    "op12_prefix_trie": PREFIX_TRIE,
}
