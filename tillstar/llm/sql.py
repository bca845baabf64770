"""DuckDB SQL of the named queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED}, '{SPACED}') AS w
  FROM documents
),
sets AS (
  SELECT DISTINCT rid, w[i] || ' ' || w[i + 1] AS s
  FROM docs, unnest(range(1, len(w))) AS t(i) WHERE len(w) > 1
  UNION ALL
  SELECT rid, w[1] AS s FROM docs WHERE len(w) = 1
),
sizes AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
shared AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.s = b.s AND a.rid <> b.rid GROUP BY a.rid, b.rid
),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.rid = x JOIN sizes b ON b.rid = y
  WHERE 100 * c >= 80 * (a.n + b.n - c)
),
reach AS (
  SELECT rid AS x, rid AS y FROM docs
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
),
least_id AS (
  SELECT r.x AS rid, min(d.doc_id) AS component_id
  FROM reach r JOIN docs d ON d.rid = r.y GROUP BY r.x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN least_id USING (rid) LEFT JOIN sizes USING (rid)
"""

DECONTAMINATION = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED}, '{ALNUM}') AS w
  FROM documents
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWERED}, '{ALNUM}') AS w
  FROM benchmark WHERE item_id IS NOT NULL
),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM items, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0
),
places AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM docs, (SELECT DISTINCT n FROM windows) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
),
hits AS (SELECT rid, i, places.n, item FROM places JOIN windows USING (s)),
hit_words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid
),
hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""

QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w
  FROM documents
),
base AS (
  SELECT rid, doc_id, text, w, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{SPACED}')] AS lines
  FROM docs
),
windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS times
  FROM docs, unnest(range(1, len(w) - 1)) AS t(i)
),
repeats AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT rid, unnest(range(i, i + 3)) AS p FROM windows WHERE times > 1) GROUP BY rid
),
words AS (SELECT rid, i, w[i] AS x FROM docs, unnest(range(1, len(w) + 1)) AS t(i)),
shapes AS (
  SELECT rid,
         count(*) FILTER (strlen(x) > 1 AND regexp_matches(x, '[A-Z]')
                          AND NOT regexp_matches(x, '[a-z]')) AS capitals,
         count(*) FILTER (regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')) AS letters
  FROM words GROUP BY rid
),
common AS (
  SELECT rid, max(n) AS n FROM (SELECT rid, count(*) AS n FROM words GROUP BY rid, x) GROUP BY rid
),
parts AS (
  SELECT rid, bool_or(20 * kinds < n) AS dull
  FROM (
    SELECT rid, count(*) AS n, count(DISTINCT x) AS kinds
    FROM words GROUP BY rid, (i - 1) // 1000
  ) GROUP BY rid
),
told AS (
  SELECT base.*, coalesce(repeats.n, 0) AS n_repeat_words,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(list_sum([length(x) FOR x IN lines]), 0)
           - coalesce(list_sum([length(x) FOR x IN list_distinct(lines)]), 0) AS dup_chars,
         len(regexp_extract_all(text, '[!?]')) AS marks, capitals, letters,
         common.n AS most, dull
  FROM base LEFT JOIN repeats USING (rid) LEFT JOIN shapes USING (rid)
  LEFT JOIN common USING (rid) LEFT JOIN parts USING (rid)
),
failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM told
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 10 * n_symbols > n_words
            OR 10 * dup_chars > 3 * length(text)
            OR 10 * capitals > 3 * n_words
            OR 5 * marks > n_words
            OR 10 * letters < 7 * n_words
            OR 10 * most > 3 * n_words
            OR dull) AS kept
FROM failed
"""


COLLOCATIONS = rf"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, {LOWERED} AS t FROM documents),
parts AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs
),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM parts),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, phrase, count(*) AS a
  FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM pieces, (VALUES (1), (2), (3), (4)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i)
  ) GROUP BY lang, k, phrase HAVING count(*) >= 30
),
candidates AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1
),
cuts AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS head,
         array_to_string(w[j + 1:k], ' ') AS tail
  FROM candidates, unnest(range(1, k)) AS t(j)
),
scores AS (
  SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r,
         CAST(CAST(c.a AS HUGEINT) * 2000000 // (x.a + y.a) AS BIGINT) AS score
  FROM cuts c
  JOIN grams x ON x.lang = c.lang AND x.phrase = c.head
  JOIN grams y ON y.lang = c.lang AND y.phrase = c.tail
),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM scores
),
inner_parts AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (2), (3)) AS s(m), unnest(range(1, k - m + 2)) AS t(i)
  WHERE m < k GROUP BY ALL
),
best AS (
  SELECT o.lang, o.phrase, o.a, l, r, score,
         row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, o.a DESC, o.phrase) AS rank
  FROM lowest o LEFT JOIN inner_parts p ON p.lang = o.lang AND p.phrase = o.phrase
  WHERE place = 1 AND (longer IS NULL OR 100 * longer < 80 * o.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM best JOIN sizes USING (lang) WHERE rank <= 2000
"""


#: The sample pages mark their main text: it is the article, which holds headings, paragraphs, bold
#: text and line breaks, and references to two characters, some of them cut short.
MAIN_TEXT = r"""
WITH articles AS (
  SELECT page_id, url, row_number() OVER () AS rid,
         regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS html
  FROM pages
),
parts AS (
  SELECT rid, generate_subscripts(parts, 1) AS place, unnest(parts) AS part
  FROM (SELECT rid, string_split_regex(html, '</?(?:p|h1)>') AS parts FROM articles)
),
blocks AS (
  SELECT rid, place, trim(regexp_replace(
           regexp_replace(
             regexp_replace(replace(regexp_replace(part, '</?b>', '', 'g'), '<br>', ' '),
                            '&quot;?', '"', 'g'),
             '&amp;?', '&', 'g'),
           '[ \t\n\r\f\v]+', ' ', 'g')) AS block
  FROM parts
),
texts AS (
  SELECT rid, string_agg(block, chr(10) ORDER BY place) AS text
  FROM blocks WHERE block <> '' GROUP BY rid
)
SELECT page_id, url, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars
FROM articles LEFT JOIN texts USING (rid)
"""

#: CRC-32 is taken byte by byte, by its usual table; a word's links end at its root.
SPELLING = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))
),
runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
                     '{UPPER}', '{LOWER}') AS run
    FROM documents)
  GROUP BY id, run
),
bytes AS (
  SELECT run, n, hex(id || ':' || run) AS h FROM runs WHERE length(run) >= 7
),
hashed AS (
  SELECT run, n, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i:
             CAST('0x' || h[i:i + 1] AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc_table
),
spelled AS (
  SELECT n, CASE WHEN h % 31 <> 0 THEN run
    ELSE substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
    END AS word
  FROM hashed
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
holes AS (
  SELECT word, i, substr(word, 1, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS hole
  FROM words, unnest(range(1, length(word) + 1)) AS u(i)
),
near AS (
  SELECT a.word, b.word AS other FROM holes a JOIN holes b USING (i, hole) WHERE a.word <> b.word
  UNION
  SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.hole
  UNION
  SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.hole
),
best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS form_n,
         arg_min(other, struct_pack(n := -o.n, w := other)) AS form
  FROM near JOIN words o ON o.word = near.other GROUP BY near.word
),
forms AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= 10 * n THEN form END AS form,
         CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
follow AS (
  SELECT word, word AS place FROM forms
  UNION ALL
  SELECT follow.word, forms.form FROM follow JOIN forms ON forms.word = place
  WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, e.word AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN follow ON follow.word = f.word
JOIN forms e ON e.word = place AND e.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_near_duplicates": NEAR_DUPLICATES,
        "op5_decontamination": DECONTAMINATION,
        "op7_quality": QUALITY,
        "op11_spelling": SPELLING,
        "op12_collocations": COLLOCATIONS,
        "op13_main_text": MAIN_TEXT,
    }
