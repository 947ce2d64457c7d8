"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

ESCAPED = r"replace(replace(replace({0}, '\', '\b'), '###', '\h'), '</turn>', '\t')"

OP1 = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), ranked AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
  SELECT *, length({ESCAPED.format('text')}) + 7 + CASE WHEN before = role THEN 0
    ELSE 6 + length(replace({ESCAPED.format('role')}, ':', '\c')) + CASE WHEN k > 1 THEN 1 ELSE 0 END END AS size
  FROM ranked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) + 1 AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_WORD = r"[^\x20\x09-\x0D]+"
_NAV = r"(\s[|»•>·]\s.*)(\s[|»•>·]\s.*)(\s[|»•>·]\s.*)"
_BOILER = (
    r"all rights reserved|terms of (use|service)|privacy policy|accept (all )?cookies|enable javascript"
    r"|click here|sign (in|up) (to|for|now)|subscribe to our|skip to (main )?content|lorem ipsum|^\s*licen[sc]ed under"
    r"|^\s*released under the|work is licensed under|^\s*copyright "
)

OP4 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '{_WORD}') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines FROM docs
), windows AS (
  SELECT id, i, words[i : i + 2] AS gram FROM worded, unnest(range(1, len(words) - 1)) AS r(i)
), repeated AS (
  SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, gram) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT id, count(DISTINCT i + k) AS n FROM repeated, unnest([0, 1, 2]) AS r(k) GROUP BY id
), judged AS (
  SELECT id, l, length(l) AS chars,
    len(regexp_extract_all(l, '{_WORD}')) AS nw,
    length(regexp_replace(l, '[^#*$%&|<>!~^]', '', 'g')) AS noise
  FROM (SELECT id, unnest(lines) AS l FROM worded)
), kept_lines AS (
  SELECT id, sum(chars) AS line_chars, sum(CASE WHEN
      (nw >= 6 AND NOT regexp_matches(l, '[.!?:;…。！？]["''”’)\]]*(\s|$)'))
      OR noise * 3 > nw + 6 OR regexp_matches(l, '{_NAV}') OR regexp_matches(l, '{_BOILER}', 'i')
      THEN chars ELSE 0 END) AS lost_chars
  FROM judged GROUP BY id
), counted AS (
  SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, coalesce(k.line_chars, 0) AS line_chars, coalesce(k.lost_chars, 0) AS lost_chars
  FROM worded w LEFT JOIN covered c USING (id) LEFT JOIN kept_lines k USING (id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  CAST(line_chars AS BIGINT) AS line_chars, CAST(lost_chars AS BIGINT) AS lost_chars,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 40 * line_chars AS kept
FROM counted
"""

OP8 = """
WITH q AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda x: coalesce(x[1] * x[2], 0))) AS BIGINT) AS score
  FROM q a, q b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

OP11 = """
WITH own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), taken AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]))) % 9 AS h
  FROM own, crc
), rebuilt AS (
  SELECT t.conv_id, list_concat(coalesce(b.turns[1:t.h], []), t.turns[t.h + 1:]) AS turns
  FROM taken t LEFT JOIN own b ON b.conv_id = t.conv_id - t.conv_id % 5
), members AS (
  SELECT conv_id, d, turns[1:d] AS prefix, d = len(turns) AS ends, CASE WHEN d > 0 THEN strlen(turns[d].text) ELSE 0 END AS size
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS r(d)
), nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY prefix, d
), families AS (
  SELECT n.*, p.conv_id AS parent_conv_id, count(c.d) AS children
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.prefix = n.prefix[1:n.d - 1]
  LEFT JOIN nodes c ON c.d = n.d + 1 AND c.prefix[1:n.d] = n.prefix
  GROUP BY ALL
), below AS (
  SELECT prefix[1:e] AS prefix, e AS d, sum((n - 1) * size) AS saved, count(*) FILTER (children = 0) AS leaves
  FROM families, unnest(range(0, d + 1)) AS r(e) GROUP BY ALL
)
SELECT f.conv_id, f.d AS depth, f.parent_conv_id, f.n AS n_convs, f.children AS n_children, b.leaves AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM families f JOIN below b USING (prefix, d)
"""

OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), words AS (
  SELECT id, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT *, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs)
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), sources AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), cells AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
  FROM (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n FROM sources s JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term))
  JOIN langs USING (lang)
), valued AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN cells x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN cells y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT c.lang, c.source, 'term', c.term, c.p - (1 + (1000000000 * (k.n + 5)) // (g.total + 5 * g.v)) AS value
  FROM cells c JOIN kept k USING (lang, term) JOIN langs g USING (lang) WHERE c.n > 0 AND value > 0
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM valued QUALIFY part = 'pair' OR rank <= 50
"""

_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(symbols, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])))"""

OP13 = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(lower(rest), '[0-9]', '0', 'g'), '[^a-z0/.\-_?=&#%:~+@]', '*', 'g') || '$' AS symbols
  FROM cut
), ruled AS (
  SELECT *, CASE WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts
), told AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled FROM ruled
), labelled AS (
  SELECT symbols, ruled, {_CRC} % 5 = 0 AS calibrates FROM told, crc WHERE ruled IS NOT NULL
), grams AS (
  SELECT substr('^' || symbols, i - k, k) AS context, substr('^' || symbols, i, 1) AS symbol,
    count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
  FROM labelled, unnest(range(2, 2 + length(symbols))) AS r(i), unnest([0, 1, 2, 3, 4]) AS o(k)
  WHERE k < i AND NOT calibrates GROUP BY ALL
), states AS (
  SELECT context FROM grams GROUP BY context ORDER BY sum(a + b) DESC, length(context), context LIMIT 4096
), cells AS (
  SELECT s.context, x.symbol, coalesce(a, 0) AS a, coalesce(b, 0) AS b,
    sum(a) OVER (PARTITION BY s.context) AS na, sum(b) OVER (PARTITION BY s.context) AS nb
  FROM states s, unnest(string_split('abcdefghijklmnopqrstuvwxyz0/.-_?=&#%:~+@*$', '')) AS x(symbol)
  LEFT JOIN grams g ON g.context = s.context AND g.symbol = x.symbol
), smoothed AS (
  SELECT context, symbol, (a + 4 * (CAST(1 AS DOUBLE) / 42)) / (na + CAST(4 AS DOUBLE)) AS pa,
    (b + 4 * (CAST(1 AS DOUBLE) / 42)) / (nb + CAST(4 AS DOUBLE)) AS pb FROM cells WHERE context = ''
  UNION ALL
  SELECT c.context, c.symbol, (c.a + 4 * p.pa) / (c.na + CAST(4 AS DOUBLE)), (c.b + 4 * p.pb) / (c.nb + CAST(4 AS DOUBLE))
  FROM cells c JOIN smoothed p ON p.context = substr(c.context, 2) AND p.symbol = c.symbol WHERE c.context <> ''
), steps AS (
  SELECT symbols, i, max_by(context, length(context)) AS context
  FROM (SELECT DISTINCT symbols FROM told), unnest(range(2, 2 + length(symbols))) AS r(i), unnest([0, 1, 2, 3, 4]) AS o(k)
  JOIN states ON context = substr('^' || symbols, i - k, k) WHERE k < i GROUP BY ALL
), scores AS (
  SELECT symbols, sum(ln(pa) - ln(pb)) / any_value(length(symbols)) AS score
  FROM steps JOIN smoothed p ON p.context = steps.context AND p.symbol = substr(symbols, i - 1, 1) GROUP BY symbols
), kinds AS (
  SELECT count(*) FILTER (ruled = 'allow') > 0 AND count(*) FILTER (ruled = 'block') > 0 AS ready FROM labelled WHERE NOT calibrates
), judged AS (
  SELECT told.*, CASE WHEN ready THEN coalesce(score, 0) ELSE 0 END AS score FROM told CROSS JOIN kinds LEFT JOIN scores USING (symbols)
), bins AS (
  SELECT greatest(-1000, least(1000, floor(score * 100))) AS step, count(*) FILTER (l.ruled = 'allow') AS a, count(*) FILTER (l.ruled = 'block') AS b
  FROM labelled l JOIN (SELECT DISTINCT symbols, score FROM judged) USING (symbols) WHERE calibrates GROUP BY ALL
), rates AS (
  SELECT step, coalesce(lag(step) OVER (ORDER BY step) + 1, step) AS above, sum(a) OVER () AS na, sum(b) OVER () AS nb, coalesce(sum(a) OVER w, 0) AS lost, coalesce(sum(b) OVER w, 0) AS caught
  FROM bins WINDOW w AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), best AS (
  SELECT (above + step) / 200 AS least FROM rates WHERE na > 0 AND nb > 0 ORDER BY caught * na - lost * nb DESC, step LIMIT 1
)
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN score < coalesce((SELECT least FROM best), 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""

SQL = {
    "op1_chat_format": OP1, "op4_line_quality": OP4, "op8_exact_topk": OP8, "op11_prefix_trie": OP11, "op12_source_divergence": OP12,
    "op13_url_filter": OP13,
}
