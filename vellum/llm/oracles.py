"""DuckDB SQL for the queries that SQL can express over whole tables."""

#: CRC-32 of a list of bytes as UBIGINT, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes}),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)::BIGINT"""


def _crc_of_digits(number: str) -> str:
    return _CRC32.format(bytes=f"list_transform(string_split({number}::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)")


ORACLES = {
    "op3_secret_scans": r"""
WITH cut AS (
  SELECT doc_id, 'assign' AS kind, 0 AS place, string_split_regex(t, p) AS b,
    regexp_extract_all(t, p, 0) AS m, regexp_extract_all(t, p, 2) AS g, 6 AS least
  FROM (SELECT doc_id, coalesce(text, '') AS t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS p FROM documents)
  UNION ALL
  SELECT doc_id, 'access', 1, string_split_regex(coalesce(text, ''), 'AKIA[A-Z0-9]+'),
    regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), 20 FROM documents
  UNION ALL
  SELECT doc_id, 'hex', 2, string_split_regex(coalesce(text, ''), '[0-9a-f]+'),
    regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), 24 FROM documents
  UNION ALL
  SELECT doc_id, 'pem', 3, string_split_regex(coalesce(text, ''), '-----BEGIN [A-Z ]*PRIVATE KEY-----'),
    regexp_extract_all(coalesce(text, ''), '-----BEGIN [A-Z ]*PRIVATE KEY-----'), regexp_extract_all(coalesce(text, ''), '-----BEGIN [A-Z ]*PRIVATE KEY-----'), 0 FROM documents
  UNION ALL
  SELECT doc_id, 'forge', 4, string_split_regex(coalesce(text, ''), 'gh[pousr]_[A-Za-z0-9]{36,}'),
    regexp_extract_all(coalesce(text, ''), 'gh[pousr]_[A-Za-z0-9]{36,}'), regexp_extract_all(coalesce(text, ''), 'gh[pousr]_[A-Za-z0-9]{36,}'), 0 FROM documents),
pieces AS (
  SELECT doc_id, kind, place, least, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(g) AS g, unnest(b[1:len(m)]) AS b FROM cut),
spans AS (
  SELECT doc_id, kind, place, length(g) >= least AS valid, length(m) AS n,
    sum(length(b) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS e FROM pieces),
found AS (SELECT doc_id, kind, place, e - n AS s, kind || ':' || (e - n)::VARCHAR || ':' || e::VARCHAR AS x FROM spans WHERE valid),
docs AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(x, ',' ORDER BY s, place) FILTER (place < 3), '') AS base, coalesce(string_agg(x, ',' ORDER BY s, place), '') AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN docs USING (doc_id)
""",
    "op6_source_mixing": r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix-' || coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
numbered AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS no, 3 * source_size AS most FROM sums),
filled AS (SELECT *, row_number() OVER (ORDER BY most / w, no) AS seat,
    sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
    sum(w) OVER (ORDER BY most / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM numbered),
level AS (SELECT free, share, seat FROM filled WHERE free::HUGEINT * w <= most::HUGEINT * share ORDER BY seat LIMIT 1),
targets AS (SELECT f.source, f.source_size, CASE WHEN f.seat < l.seat THEN most::DOUBLE ELSE (w * l.free)::DOUBLE / l.share::DOUBLE END AS target, most
  FROM filled f, level l),
quotas AS (SELECT *, least(floor(target + 0.5)::BIGINT, most) AS quota FROM targets),
shares AS (
  SELECT *, ((sum(quota) OVER (ORDER BY source NULLS LAST) - quota)::HUGEINT * 4294967296 // sum(quota) OVER ())::BIGINT AS low,
    (sum(quota) OVER (ORDER BY source NULLS LAST)::HUGEINT * 4294967296 // sum(quota) OVER ())::BIGINT AS high FROM quotas),
slots AS (
  SELECT slot, ((slot % 65536) * 2654435769 + ((slot // 65536) % 65536 * 2654435769) % 65536 * 65536) % 4294967296 AS point
  FROM (SELECT unnest(range(ceil(sum(quota) / 64.0)::BIGINT)) AS slot FROM quotas)),
drawn AS (SELECT s.source, count(*) AS n FROM slots p JOIN shares s ON p.point >= s.low AND p.point < s.high GROUP BY s.source),
ends AS (SELECT q.*, least(coalesce(d.n, 0) * 64, most) AS words FROM quotas q LEFT JOIN drawn d ON q.source IS NOT DISTINCT FROM d.source),
placed AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM docs)
SELECT p.doc_id, p.size, q.source_size, q.target,
  (CASE WHEN q.source_size = 0 THEN 0 ELSE (q.words // q.source_size) * p.size + greatest(0, least(p.a + p.size, q.words % q.source_size) - p.a) END)::BIGINT AS taken
FROM placed p JOIN ends q ON p.source IS NOT DISTINCT FROM q.source
""",
    "op8_exact_dedup": r"""
WITH docs AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM docs WINDOW best AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
""",
    "op9_hamming_topk": r"""
WITH codes AS (
  SELECT vec_id, list_sum(list_transform(range(1, len(embedding) + 1), lambda i: CASE WHEN embedding[i] > 0 THEN 1::HUGEINT << (i - 1)::INTEGER ELSE 0::HUGEINT END))::UBIGINT AS code
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbour_id, bit_count(xor(q.code, c.code))::INTEGER AS distance
  FROM codes q, codes c WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INTEGER AS rank, neighbour_id, distance
FROM pairs QUALIFY rank <= 10
""",
    "op11_cohort_retention": f"""
WITH once AS (SELECT DISTINCT * FROM clicks WHERE ts IS NOT NULL AND client_id IS NOT NULL),
marked AS (SELECT *, {_crc_of_digits("click_id")} AS h FROM once),
seen AS (
  SELECT client_id, ts, kind, coalesce(floor(100 * value + 0.5)::BIGINT, 0) AS cents,
    arrived_at + to_days(CASE WHEN h % 3 = 0 THEN (h % 100)::INTEGER ELSE 0 END) < TIMESTAMP '2024-02-15 00:00:00' AS early FROM marked),
states AS (SELECT 0 AS state, * FROM seen WHERE early UNION ALL SELECT 1, * FROM seen),
starts AS (SELECT state, client_id, min(ts) AS start, min(ts)::DATE - DATE '1970-01-01' AS cohort FROM states WHERE kind = 'signup' GROUP BY 1, 2),
moves AS (SELECT client_id, count(DISTINCT cohort) > 1 AS moved, {_crc_of_digits("client_id")} AS mark FROM starts GROUP BY 1),
named AS (SELECT client_id, min(segment) AS segment FROM clients GROUP BY 1),
users AS (
  SELECT state, s.client_id, s.cohort::BIGINT AS cohort, ((epoch_us(ts) - epoch_us(start)) // 86400000000)::BIGINT AS period, sum(cents) AS cents
  FROM states JOIN starts s USING (state, client_id) WHERE ts >= start GROUP BY ALL)
SELECT state, coalesce(segment, '') AS segment, cohort, period, count(*) AS users, sum(mark)::BIGINT AS users_crc32,
  count(*) FILTER (moved) AS moved, sum(cents)::BIGINT AS cents
FROM users JOIN moves USING (client_id) LEFT JOIN named USING (client_id) GROUP BY ALL
""",
    "op13_importance_resampling": rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
goal AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
tokens AS (SELECT row, unnest(words) AS word FROM docs),
known AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM tokens UNION SELECT word FROM goal)),
coded AS (SELECT word, {_CRC32.format(bytes="list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::UBIGINT)")} % 10000 AS bucket FROM known),
source AS (SELECT bucket, count(*) AS s FROM tokens JOIN coded USING (word) GROUP BY 1),
target AS (SELECT bucket, count(*) AS t FROM goal JOIN coded USING (word) GROUP BY 1),
gains AS (
  SELECT s.bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM tokens) + 10000))::DOUBLE
    / ((s + 1) * ((SELECT count(*) FROM goal) + 10000))::DOUBLE))::BIGINT AS gain
  FROM source s LEFT JOIN target t ON s.bucket = t.bucket),
weights AS (SELECT row, sum(gain)::BIGINT AS weight FROM tokens JOIN coded USING (word) JOIN gains USING (bucket) GROUP BY 1),
scored AS (
  SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id::VARCHAR)[1:8])::UBIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (row)),
placed AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS most FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= most THEN rank END AS rank FROM scored LEFT JOIN placed USING (row)
""",
}
