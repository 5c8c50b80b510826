"""DuckDB SQL of the queries that SQL can express on whole tables, written
from the contracts (explicit windows and words, no hashes)."""

from __future__ import annotations

from panelcast.llm import chat, line_dedup, warc

SUBSTRING = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, k, array_to_string(w[k:k + 34], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, k FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM r),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.p) FILTER (WHERE x.p IS NULL) AS kept, count(x.p) AS n_removed
      FROM p LEFT JOIN x ON p.doc_id = x.doc_id AND p.p = x.p GROUP BY p.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

WINNOWING = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS n
      FROM (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark) WHERE len(w) > 0),
i AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM b)),
h AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
m AS (SELECT h.doc_id, h.k, h.n, i.item_id FROM h JOIN i ON h.g = i.g AND h.n = i.n),
x AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY doc_id),
y AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
c AS (SELECT a, b FROM l UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least_id, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS least_id FROM c GROUP BY a) m ON m.a = d.doc_id
"""

SIGNATURE_SEARCH = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM documents),
q AS (SELECT item_id, t, count(*) AS k
      FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
c AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY doc_id),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM n),
m AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // l) AS m FROM n, g),
f AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM c GROUP BY t), g),
s AS (SELECT item_id, doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (t) JOIN c USING (t) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""

PERIODIC_RUNS = r"""
WITH RECURSIVE bits AS (          -- crc32 of the id, bit by bit
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM documents
  UNION ALL
  SELECT doc_id, id, k + 1, CASE WHEN k % 9 = 0 THEN xor(c, CAST(ascii(substr(id, k // 9 + 1, 1)) AS BIGINT))
                                 ELSE xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)) END
  FROM bits WHERE k < 9 * length(id)),
h AS (SELECT doc_id, xor(c, CAST(4294967295 AS BIGINT)) AS h FROM bits WHERE k = 9 * length(id)),
d AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g
      FROM (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents) JOIN h USING (doc_id)),
x AS (SELECT doc_id, n, i, w[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END] AS word
      FROM (SELECT *, unnest(range(n)) AS i FROM d)),
e AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM x l JOIN x r ON l.doc_id = r.doc_id AND l.word = r.word AND r.i > l.i
      WHERE 2 * (r.i - l.i) <= l.n),
s AS (SELECT doc_id, q, min(i) AS s, min(i) + count(*) + q AS e
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e)
      GROUP BY doc_id, q, island HAVING count(*) >= q AND count(*) + q >= 12),
r AS (SELECT doc_id, q, s, e, e - s AS length FROM s
      WHERE NOT EXISTS (SELECT 1 FROM s z WHERE z.doc_id = s.doc_id AND z.q < s.q AND s.q % z.q = 0 AND z.s <= s.s AND z.e >= s.e)),
l AS (SELECT doc_id, string_agg(concat(s, ',', length, ',', q, chr(10)), '' ORDER BY s, q) AS listed, count(*) AS n_runs FROM r GROUP BY doc_id),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, s, q) AS place FROM r) WHERE place = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM r),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE gone.i IS NULL) AS kept
      FROM x LEFT JOIN gone ON x.doc_id = gone.doc_id AND x.i = gone.i GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.s AS start, b.length, b.q AS period, 1000 * b.length // b.q AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN l USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)
"""

SQL: dict[str, str] = {
    "op2_perspective_rotation": chat.SQL,
    "op3_warc_round_trip": warc.SQL,
    "op4_substring_dedup": SUBSTRING,
    "op5_winnowing_decontamination": WINNOWING,
    "op7_site_line_dedup": line_dedup.SQL,
    "op8_ngram_trie_join": NGRAM_JOIN,
    "op11_signature_search": SIGNATURE_SEARCH,
    "op12_periodic_runs": PERIODIC_RUNS,
}
