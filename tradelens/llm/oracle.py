"""DuckDB SQL of the pipeline operators that SQL can express."""

from __future__ import annotations

#: A-Z to a-z and nothing else.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 of a word's bytes: the table by eight conditional shifts per byte, then
# one table step per byte of the word.
_CRC = """
crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
crcs AS (
  SELECT w, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length(encode(w))), lambda i:
        CAST(('0x' || substr(hex(encode(w)), 2 * i + 1, 2)) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM (SELECT w FROM doc_words UNION ALL SELECT w FROM target_words)), crc_table
)"""

_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

RESAMPLING = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
doc_words AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM docs) GROUP BY ALL),
target_words AS (SELECT unnest({_WORDS}) AS w FROM benchmark),{_CRC},
s AS (SELECT bucket, sum(n) AS s FROM doc_words JOIN crcs USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target_words JOIN crcs USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT sum(s) FROM s) AS all_s, (SELECT sum(t) FROM t) AS all_t),
gains AS (
  SELECT w, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(all_t, 0) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM crcs LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums
),
weights AS (SELECT doc_id, CAST(floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE) AS BIGINT) AS weight FROM doc_words JOIN gains USING (w) GROUP BY doc_id),
noise AS (
  SELECT doc_id, CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS g
  FROM documents
),
scored AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + g AS score
  FROM docs LEFT JOIN weights USING (doc_id) JOIN noise USING (doc_id)
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
grams AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, phrase, k, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM f WHERE n >= 100),
cuts AS (
  SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM frequent WHERE k > 1
),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, l.n AS l, r.n AS r, t.n AS n, c.j,
    CAST((c.a::HUGEINT * t.n::HUGEINT * 1000) // (l.n::HUGEINT * r.n::HUGEINT) AS BIGINT) AS score
  FROM cuts c
  JOIN frequent l ON l.lang = c.lang AND l.k = c.j AND l.phrase = array_to_string(c.w[1 : c.j], ' ')
  JOIN frequent r ON r.lang = c.lang AND r.k = c.k - c.j AND r.phrase = array_to_string(c.w[c.j + 1 : c.k], ' ')
  JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT DISTINCT lang, w, k, a FROM cuts), (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 6)) AS i)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL
),
kept AS (
  SELECT best.* FROM best LEFT JOIN inner_phrases USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
    CAST(n AS BIGINT) AS n, score FROM kept
) WHERE rank <= 2000"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(ws) < 3 THEN ws ELSE ws[i : i + 2] END, ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM docs WHERE len(ws) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
components AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)"""

WARC = """
WITH payloads AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS lowest FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> lowest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> lowest THEN lowest END AS refers_to
FROM firsts"""

SQL = {"op4_near_duplicates": NEAR_DUPLICATES, "op7_warc": WARC, "op12_resampling": RESAMPLING, "op13_collocations": COLLOCATIONS}
