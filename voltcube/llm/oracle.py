"""DuckDB statements for the queries that SQL can express on whole tables."""

from __future__ import annotations

#: The ASCII white space that ends words and is stripped from lines.
_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEY = f"translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS nr
  FROM documents
), keyed AS (
  SELECT doc_id, nr, line, {_KEY} AS k FROM lines
), common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (c.k IS NOT NULL AND c.keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (c.k IS NULL OR c.keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (k) GROUP BY doc_id
"""

OP5 = r"""
WITH docs AS (
  SELECT doc_id, source, '=' || source AS named, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source COLLATE "binary" ASC NULLS LAST) - 1) % 3 + 1 AS w
  FROM docs GROUP BY source
), capped AS (
  SELECT *, 3 * source_size AS cap, 3 * source_size / w AS ratio FROM per_source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source COLLATE "binary" NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER (ORDER BY ratio, source COLLATE "binary" NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM capped
), targets AS (
  SELECT source, source_size, CASE WHEN ratio < l.level THEN cap::DOUBLE ELSE w * l.level END AS target
  FROM levels, (SELECT arg_min(level, (ratio, coalesce(source, chr(1114111)))) AS level FROM levels WHERE ratio >= level) l
), cells AS (
  SELECT source, size, count(*) AS n, greatest(256, (SELECT count(*) FROM docs) // 100000) AS per_group FROM docs GROUP BY source, size
), placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size * 4294967296 + 0.5)::HUGEINT ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(d.named, '')), 1, 8))::BIGINT AS u,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size,
           CASE WHEN c.n > c.per_group THEN ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 8))::BIGINT % ceil(c.n / c.per_group)::BIGINT ELSE 0 END,
           d.doc_id) - 1 AS i
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
  JOIN cells c ON d.source IS NOT DISTINCT FROM c.source AND d.size = c.size
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (((u + rate * (i + 1)) // 4294967296 - (u + rate * i) // 4294967296) * size)::BIGINT AS taken
FROM placed
"""

OP9 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages
), digests AS (
  SELECT *, bit_string AS bits FROM (
    SELECT page_id, payload, first_id,
           list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || substr(sha1(payload), i::INTEGER, 1))::INTEGER), 4, '0')), 'string_agg', '') AS bit_string
    FROM payloads)
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (list_sum(list_transform(range(5), lambda b: substr(bits, (5 * j + b + 1)::INTEGER, 1)::INTEGER * (16 >> b::INTEGER))) + 1)::INTEGER, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, TRUE AS intact
FROM digests
"""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored QUALIFY rank <= 20
"""

OP10 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                               ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS s FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least AS component_id FROM sets JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) ON a = doc_id
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), counted AS (
  SELECT lang, m, phrase, count(*) AS f
  FROM (SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') for i in range(1, len(w) - m + 2)]) AS phrase FROM words, range(1, 6) t(m) WHERE len(w) >= m)
  GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1
), alone AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates x WHERE x.lang = c.lang AND len(x.w) > len(c.w) AND 100 * x.a >= 100 * c.a AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, p.f AS l, s.f AS r, n, ((1000::HUGEINT * c.a * n) // (p.f::HUGEINT * s.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, len(w))) AS k FROM alone) c JOIN total USING (lang)
  JOIN counted p ON p.lang = c.lang AND p.phrase = array_to_string(w[1:k], ' ')
  JOIN counted s ON s.lang = c.lang AND s.phrase = array_to_string(w[k + 1:], ' ')
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank, phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000
"""

OP13 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), judged AS (
  SELECT u.*, (SELECT arg_max(h || p || ' ' || v, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS won FROM urls u
)
SELECT page_id, host, path, string_split(won, ' ')[1] AS rule, coalesce(string_split(won, ' ')[2], 'allow') AS verdict FROM judged
"""

ORACLE: dict[str, str] = {"op4_line_dedup": OP4, "op5_mix_sources": OP5, "op8_exact_topk": OP8, "op9_warc": OP9, "op10_jaccard_join": OP10,
                          "op12_phrases": OP12, "op13_url_rules": OP13}
