"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# op1: what the archives must say of each page.
OP1 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), g AS (
  SELECT d, min(page_id) AS head, count(*) AS c FROM p WHERE n >= 100 GROUP BY d
)
SELECT page_id, url, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN c > 1 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN c > 1 AND page_id <> head THEN head END AS refers_to
FROM p JOIN (SELECT page_id, url FROM pages) USING (page_id) LEFT JOIN g USING (d)
"""

# op5: all inner products, summed in component order in double precision.
OP5 = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x)
), r AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s
)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""

# op8: shared shingles by an inverted list, then reachability.
OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM w, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS t(i) WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, reach.r FROM reach JOIN both_ways e ON e.a = reach.doc_id
)
SELECT reach.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id
"""

# op9: base measures, and the line rules with max(20, 5 %) documents a host.
# Documents are told apart by their whole normalised text.
OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT k, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d
), win AS (
  SELECT k, i, array_to_string(ws[i:i + 4], ' ') AS g FROM w, unnest(generate_series(1, len(ws) - 4)) AS u(i) WHERE len(ws) >= 5
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT k, count(DISTINCT i + o) AS n_repeat_words FROM twice, unnest([0, 1, 2, 3, 4]) AS u(o) GROUP BY k
), raw_lines AS (
  SELECT k, unnest(ls) AS l, unnest(range(len(ls))) AS line_no FROM (SELECT k, string_split(t, chr(10)) AS ls FROM d)
), lines AS (
  SELECT k, line_no, l, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm FROM raw_lines
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), per_doc AS (
  SELECT k, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY k
), sketch AS (
  SELECT d.k, coalesce(md5(string_agg(norm, chr(10) ORDER BY line_no)), '') AS sk FROM d LEFT JOIN lines ON lines.k = d.k GROUP BY d.k
), hosts AS (
  SELECT source, count(DISTINCT sk) AS docs FROM d LEFT JOIN sketch USING (k) GROUP BY source
), bad AS (
  SELECT source, norm FROM lines JOIN d USING (k) JOIN sketch USING (k) JOIN hosts USING (source)
  GROUP BY source, norm HAVING count(DISTINCT sk) > 20 AND count(DISTINCT sk) > 0.05 * max(docs)
), gone AS (
  SELECT k, count(*) FILTER (b.norm IS NOT NULL) AS n_removed_lines, sum(length(norm)) AS size,
         coalesce(sum(length(norm)) FILTER (b.norm IS NOT NULL), 0) AS lost
  FROM lines JOIN d USING (k) LEFT JOIN bad b USING (source, norm) GROUP BY k
), m AS (
  SELECT k, doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(size, 0) AS size, coalesce(lost, 0) AS lost
  FROM d JOIN w USING (k) LEFT JOIN per_doc USING (k) LEFT JOIN covered USING (k) LEFT JOIN gone USING (k)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, CAST(n_removed_lines AS BIGINT) AS n_removed_lines,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (n_removed_lines > 0 AND size - lost < 0.3 * size) AS kept
FROM m
"""

# op11: crc32 by its table, near words by equal words less one letter, forms followed.
OP11 = r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, CAST(i AS UINTEGER) FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UINTEGER)) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
         unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents WHERE text IS NOT NULL
), low AS (
  SELECT d, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k FROM runs GROUP BY ALL
), coded AS (
  SELECT w, k, string_split(hex(encode(d || ':' || w)), '') AS hx FROM low
), bytes AS (
  SELECT w, k, [4294967295] || list_transform(range(1, len(hx), 2), lambda i: 16 * (instr('0123456789ABCDEF', hx[i]) - 1) + instr('0123456789ABCDEF', hx[i + 1]) - 1) AS b FROM coded
), hashed AS (
  SELECT w, k, xor(list_reduce(b, lambda c, x: xor(c >> 8, CAST(tab[CAST((xor(c, x) & 255) AS INTEGER) + 1] AS BIGINT))), 4294967295) AS h FROM bytes, crc
), cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(w, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, k FROM hashed
), v AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), less AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS d FROM v, unnest(range(length(word))) u(i)
), pairs AS (
  SELECT a.word AS a, b.word AS b, b.n AS n FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN v b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN v b ON a.d = b.word
), best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS f, max(n) AS fn FROM pairs GROUP BY a
), forms AS (
  SELECT word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN fn >= 2 * v.n THEN f END AS form, CASE WHEN fn >= 2 * v.n THEN fn END AS form_n
  FROM v LEFT JOIN best USING (word)
), chain(word, tail) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.tail WHERE forms.form IS NOT NULL
)
SELECT forms.word, forms.n, forms.n_near, forms.form, forms.form_n, tail AS root
FROM forms JOIN chain ON chain.word = forms.word JOIN forms AS l ON l.word = chain.tail AND l.form IS NULL
"""

# op13: the longest rule that fits, else the words of the host.
OP13 = r"""
WITH p AS (
  SELECT row_number() OVER () AS k, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT k, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p
), s AS (
  SELECT k, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), rules(rhost, rpath, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fit AS (
  SELECT k, page_id, host, path, first(rhost || rpath ORDER BY length(rhost || rpath) DESC) FILTER (rhost IS NOT NULL) AS rule,
         first(v ORDER BY length(rhost || rpath) DESC) FILTER (rhost IS NOT NULL) AS v
  FROM s LEFT JOIN rules ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath) GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(host, 'spam|cheap-pills|casino|viagra|porn|xxx-|payday-loan|phishing|malware')
       THEN 'block' ELSE 'allow' END) AS verdict FROM fit
"""

ORACLES: dict[str, str] = {"op1_warc": OP1, "op5_one_bit_search": OP5, "op8_jaccard_join": OP8, "op9_quality_rules": OP9,
                           "op11_spelling_variants": OP11, "op13_url_filters": OP13}
