"""DuckDB SQL of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

# Control characters are escaped by one backslash each; a turn is "### Role: text</turn>\n".
ORACLE["op1_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *,
    CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
         ELSE 1 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) END AS role_chars,
    length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS text_chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + role_chars + 2 + text_chars + 8) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLE["op2_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))) AS okey
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0 * source_size AS cap,
    (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER (
        ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM src),
targets AS (
  SELECT source, source_size, CAST(least(cap, (SELECT max(level) FROM levels) * weight) AS DOUBLE) AS target FROM levels),
queued AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY okey, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget - (budget // source_size) * source_size - start)) END AS BIGINT) AS taken
FROM queued
"""

ORACLE["op3_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS words
  FROM (SELECT d.doc_id, d.w, k.n, unnest(range(1, len(d.w) - k.n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM win) k WHERE len(d.w) >= k.n)),
hit AS (SELECT p.doc_id, p.s, p.n, win.item_id FROM places p JOIN win ON p.n = win.n AND p.words = win.words),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
  FROM (SELECT DISTINCT doc_id, coalesce(CAST(item_id AS VARCHAR), 'null') AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op7_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (
  SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS last
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM g
"""

ORACLE["op8_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
g AS (
  SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS group_size,
    first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""

ORACLE["op11_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
counted AS (
  SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
items AS (
  SELECT item, item_id, term, count(*) AS reps FROM (
    SELECT row_number() OVER () AS item, item_id,
      unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
occurs AS (
  SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM occurs, counted GROUP BY term),
scored AS (
  SELECT item, item_id, doc, doc_id, CAST(sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM occurs JOIN items USING (term) JOIN weights USING (term), counted GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE["op12_collocations"] = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
pieces AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM docs),
words AS MATERIALIZED (SELECT id, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS p FROM pieces),
spans AS MATERIALIZED (
  SELECT lang, w1, lead(w1, 1) OVER (PARTITION BY id ORDER BY p) AS w2, lead(w1, 2) OVER (PARTITION BY id ORDER BY p) AS w3 FROM words),
one AS MATERIALIZED (SELECT lang, w1, count(*) AS n FROM spans GROUP BY ALL),
size AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM one GROUP BY lang),
two AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS n FROM spans WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS n FROM spans WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
inside AS (
  SELECT lang, w1, w2, max(n) AS n FROM (SELECT lang, w1, w2, n FROM three UNION ALL SELECT lang, w2, w3, n FROM three) GROUP BY ALL),
cuts AS (
  SELECT lang, concat_ws(' ', two.w1, two.w2) AS phrase, 1 AS k, two.n AS a, x.n AS l, y.n AS r
  FROM two JOIN one x USING (lang, w1) JOIN one y ON y.lang = two.lang AND y.w1 = two.w2 LEFT JOIN inside i ON (i.lang, i.w1, i.w2) = (two.lang, two.w1, two.w2)
  WHERE i.n IS NULL OR 100 * i.n < 50 * two.n
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.w1, t.w2, t.w3), 1, t.n, x.n, y.n
  FROM three t JOIN one x ON (x.lang, x.w1) = (t.lang, t.w1) JOIN two y ON (y.lang, y.w1, y.w2) = (t.lang, t.w2, t.w3)
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.w1, t.w2, t.w3), 2, t.n, x.n, y.n
  FROM three t JOIN two x ON (x.lang, x.w1, x.w2) = (t.lang, t.w1, t.w2) JOIN one y ON (y.lang, y.w1) = (t.lang, t.w3)),
scored AS (
  SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, size.n, score
FROM weakest JOIN size USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000
"""
