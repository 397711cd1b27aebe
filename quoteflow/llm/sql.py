"""The registered queries in SQL, where SQL can express them. The tables are views of the same names."""

SPACE = r"\x20\x09-\x0D"

OP4 = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^{SPACE}]+')), 0) AS size,
    greatest(coalesce(1 - length(regexp_replace(text, '[\p{{L}}{SPACE}]+', '', 'g')) / greatest(length(text), 1), 0), 0.25::DOUBLE)
      AS weight,
    (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE + 0.5)
      / 4503599627370496::DOUBLE AS u
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [1::DOUBLE, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS ratio,
    ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(3.0::DOUBLE * source_size) OVER (
        ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
targets AS (
  SELECT source, source_size, CASE WHEN ratio <= level THEN cap
    ELSE (SELECT arg_min(level, ratio) FROM levels WHERE ratio > level) * weight END AS target
  FROM levels),
ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY -ln(s.u) / s.weight, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + (before + size / 2 <= target - epochs * source_size)::INT))::BIGINT AS taken
FROM ordered
"""

OP8 = r"""
WITH lines AS (
  SELECT d.rowid_ AS r, d.doc_id, x.line, x.pos FROM (
    SELECT row_number() OVER () AS rowid_, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
    LATERAL (SELECT unnest(l) AS line, generate_subscripts(l, 1) AS pos) x),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'null')) >= 3),
judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""
OP10_BOILERPLATE = (
    "(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|accept (all )?cookies"
    "|subscribe to (our|the) newsletter|sign (in|up) to|log in to|enable javascript|skip to content"
    "|(licensed|released) under (the|a|cc) )"
)
OP10 = rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w FROM documents),
lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM split),
judged AS (
  SELECT r, line, len(regexp_extract_all(line, '[^{SPACE}]+')) AS n,
    length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols,
    len(regexp_extract_all(line, '(^|[{SPACE}])[|»›>•·]([{SPACE}]|\z)')) AS bars,
    len(regexp_extract_all(line, '\p{{Lu}}')) AS capitals, len(regexp_extract_all(line, '\p{{Ll}}')) AS small
  FROM lines),
lost AS (
  SELECT r, sum(CASE WHEN n > 0 AND ((bars >= 3 AND bars * 6 >= n)
      OR (n <= 30 AND regexp_matches(line, '{OP10_BOILERPLATE}')) OR symbols > 0.2::DOUBLE * n
      OR (capitals >= 20 AND capitals > small * 2)
      OR (n >= 4 AND NOT regexp_matches(line, '[.!?:;…。！？][''"”’»)\]]*[{SPACE}]*\z'))) THEN n ELSE 0 END) AS n_lost,
    count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines
  FROM judged GROUP BY r),
windows AS (
  SELECT r, pos, w[pos] || chr(32) || w[pos + 1] || chr(32) || w[pos + 2] AS three
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS pos FROM split WHERE len(w) >= 3)),
twice AS (
  SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, three) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT r, count(DISTINCT pos + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
base AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[{SPACE}]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    l.n_dup_lines::BIGINT AS n_dup_lines, coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words, l.n_lost
  FROM split s JOIN lost l USING (r) LEFT JOIN covered c USING (r)),
failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_lost <= 0.5::DOUBLE * n_words AS kept
FROM failed
"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * k + 1}, 5))::INT >> {shift}) & 31) + 1, 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)
OP6 = f"""
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS f FROM hashed)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN f IS NOT NULL AND f IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f IS DISTINCT FROM page_id THEN f END AS refers_to
FROM firsts
"""

OP11 = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
lowered AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs),
pairs AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS text, count(*) AS n FROM lowered GROUP BY ALL),
table_ AS (
  SELECT list(list_reduce([b::BIGINT] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc
  FROM range(256) t(b)),
hashed AS (
  SELECT run, n, xor(list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode(text))),
      lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM pairs, table_),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed),
counted AS (SELECT word, sum(n)::BIGINT AS n FROM words GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
cut AS (SELECT word, n, length(word) AS l, unnest(range(length(word))) AS i FROM counted),
shorter AS (SELECT word, n, l, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM cut),
near AS (
  SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.l = b.l AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN counted b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN counted b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
forms AS (
  SELECT c.word, c.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * c.n THEN other END AS form,
    CASE WHEN other_n >= 2 * c.n THEN other_n END AS form_n
  FROM counted c LEFT JOIN best USING (word)),
steps AS (
  SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM forms
  UNION ALL
  SELECT s.word, coalesce(f.form, s.root), f.form IS NULL FROM steps s JOIN forms f ON s.root = f.word WHERE NOT s.done)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM steps WHERE done) USING (word)
"""

OP13 = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
counted AS (SELECT r, doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
sized AS (SELECT r, sum(tf)::BIGINT AS n FROM counted GROUP BY r),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sized),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), total),
scored AS (
  SELECT a.item_id, c.r, c.doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // t.words))))::BIGINT AS score
  FROM asked a JOIN weighed USING (term) JOIN counted c USING (term) JOIN sized USING (r), total t
  GROUP BY a.item_id, c.r, c.doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

ORACLE = {
    "op6_warc": OP6,
    "op4_mix_sources": OP4,
    "op8_line_dedup": OP8,
    "op10_quality_rules": OP10,
    "op11_spelling": OP11,
    "op13_ranked_search": OP13,
}
