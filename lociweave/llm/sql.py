"""DuckDB SQL with the results of the operators' queries, where SQL can express them."""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, n AS line_no, piece,
         translate(regexp_replace(regexp_replace(piece, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS n
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS pieces FROM documents))
), held AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT l.*, h.key IS NOT NULL AND l.doc_id <> h.last_doc AS dropped
  FROM lines l LEFT JOIN held h ON l.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(piece, chr(10) ORDER BY line_no) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

EXACT_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), best AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM best
"""

DECONTAMINATION = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS v
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS v
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.v = x.v
), hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

WARC = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), kinds AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS last_id FROM payloads
)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM kinds
"""

SUBSTRING_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS v
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts)
), firsts AS (
  SELECT v, min(doc_id) AS first_doc FROM windows GROUP BY v HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, unnest(range(i, i + 50)) AS k FROM windows JOIN firsts USING (v) WHERE first_doc < doc_id)
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM texts
), kept AS (
  SELECT w.doc_id, count(g.k) AS n_removed, string_agg(w.word, ' ' ORDER BY w.k) FILTER (WHERE g.k IS NULL) AS body
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.k = g.k GROUP BY w.doc_id
)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""


def _codebooks(rounds: int) -> str:
    """CTEs near1, book1, ... near{rounds + 1}: (row, p, e, d) of the nearest entries of a round and the entries (p, e, j, c) after it."""
    out = []
    for k in range(rounds + 1):
        out.append(f"""near{k} AS MATERIALIZED (
  SELECT row, p, CAST(min(d * 16 + e) % 16 AS BIGINT) AS e, min(d) AS d
  FROM (SELECT x.row, x.p, b.e, CAST(sum((x.x - b.c) * (x.x - b.c)) AS BIGINT) AS d
        FROM parts x JOIN book{k} b ON x.p = b.p AND x.j = b.j GROUP BY x.row, x.p, b.e)
  GROUP BY row, p
)""")
        if k < rounds:
            out.append(f"""mean{k} AS MATERIALIZED (
  SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM parts JOIN near{k} USING (row, p) GROUP BY p, e, j
), book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j, CASE WHEN m.n IS NULL THEN b.c ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS c
  FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e AND b.j = m.j
)""")
    return ", ".join(out)


VECTOR_CODES = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS MATERIALIZED (
  SELECT row, (i - 1) // (n // 8) AS p, (i - 1) % (n // 8) AS j, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT row, len(v) AS n, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept)
), book0 AS MATERIALIZED (
  SELECT p, row AS e, j, x AS c FROM parts WHERE row < 16
), {_codebooks(6)}, coded AS (
  SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near6 GROUP BY row
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM book6) AS codebooks_sha256
FROM coded JOIN kept USING (row)
"""
