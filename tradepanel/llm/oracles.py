"""SQL that must give the same rows, written from the contracts alone."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS said
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents
), stretches AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS said
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM windows))
), hits AS (
  SELECT doc_id, i, size, item FROM stretches JOIN windows USING (size, said)
), inside AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN inside USING (doc_id) LEFT JOIN items USING (doc_id)
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), formatted AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS safe,
         regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') AS safe_role
  FROM turns
), said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, safe_role, safe) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, safe_role, safe) FILTER (role = 'assistant'), '') AS loss,
         sum(length(safe) + length(safe_role) + 17) AS formatted_chars
  FROM formatted GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS said
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.said = b.said AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
), worded AS (
  SELECT doc_id, line_no, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS w FROM lines
), said AS (
  SELECT doc_id, line_no, w, array_to_string(w, ' ') AS s, struct_pack(d := doc_id, l := line_no) AS pos
  FROM worded WHERE len(w) >= 1
), firsts AS (
  SELECT s, min(pos) AS pos, any_value(w) AS w FROM said GROUP BY s
), variants AS (
  SELECT s, pos, p, len(w) - 1 AS n, array_to_string(list_concat(w[1 : p - 1], w[p + 1 :]), ' ') AS v
  FROM (SELECT s, pos, w, unnest(range(1, len(w) + 1)) AS p FROM firsts WHERE len(w) >= 8)
), near AS (
  SELECT x.s, y.pos FROM variants x JOIN variants y ON x.v = y.v AND x.p = y.p AND x.n = y.n AND y.pos < x.pos
  UNION ALL SELECT x.s, y.pos FROM variants x JOIN firsts y ON x.v = y.s AND len(y.w) >= 8 AND y.pos < x.pos
  UNION ALL SELECT y.s, x.pos FROM variants x JOIN firsts y ON x.v = y.s AND len(y.w) >= 8 AND x.pos < y.pos
), earliest AS (
  SELECT s, min(pos) AS keeper FROM near GROUP BY s
), gone AS (
  SELECT said.doc_id, said.line_no, coalesce(keeper, firsts.pos) AS k, CASE WHEN keeper IS NULL THEN 0 ELSE 1 END AS edits
  FROM said JOIN firsts USING (s) LEFT JOIN earliest USING (s)
  WHERE keeper IS NOT NULL OR firsts.pos <> said.pos
), dropped AS (
  SELECT doc_id, count(*) AS n, string_agg(line_no || ':' || k.d || ':' || k.l || ':' || edits, ',' ORDER BY line_no) AS entries
  FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text
  FROM lines ANTI JOIN gone USING (doc_id, line_no) GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_dropped, coalesce(entries, '') AS dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN dropped USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
words AS (
    SELECT row_no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3
),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
found AS (
    SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM words w JOIN kept USING (lang, term)
    GROUP BY w.lang, w.source, w.term
),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM found GROUP BY lang, source),
groups AS (
    SELECT DISTINCT d.lang, d.source, coalesce(t.total, 0)::HUGEINT AS total FROM docs d LEFT JOIN totals t USING (lang, source)
),
prices AS (
    SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(f.n, 0) + 1) // (g.total + l.v) AS p,
        1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.v) AS lang_p
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM prices a JOIN prices b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - lang_p) * (p - lang_p) // lang_p FROM prices WHERE n > 0 AND p > lang_p
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 200
"""
