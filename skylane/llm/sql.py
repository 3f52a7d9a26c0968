"""DuckDB SQL for the operators that SQL can express."""

HOSTS = r"""
WITH parts AS (
  SELECT page_id, regexp_replace(CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END,
    '[?#].*$', '', 's') AS rest
  FROM pages),
seen AS (
  SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(split_part(rest, '/', 1)) + 1) AS path
  FROM parts),
outcome AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE (quality IS NOT NULL OR toxic IS NOT NULL) AND doc_id IS NOT NULL GROUP BY doc_id),
hosts0 AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM seen JOIN outcome USING (page_id) GROUP BY host),
named AS (
  SELECT *, string_split(host, '.') AS names,
    list_aggregate(list_slice(string_split(host, '.'), -2, -1), 'string_agg', '.') AS two FROM hosts0),
hosts AS (
  SELECT host, n, bad, CASE WHEN long THEN two ELSE list_extract(names, -1) END AS suffix,
    CASE WHEN long THEN list_aggregate(list_slice(names, -3, -1), 'string_agg', '.') ELSE two END AS domain
  FROM (SELECT *, two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.in', 'co.nz', 'com.cn') AS long FROM named)),
strengths AS (SELECT 0.5::DOUBLE * power(2000::DOUBLE, i / 32.0::DOUBLE) AS s FROM range(33) AS r(i)),
root AS (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) AS mean FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(root.mean) AS mean FROM hosts, root GROUP BY suffix),
ss AS (
  SELECT s, sum(lgamma(bad + s * mean) - lgamma(s * mean) + lgamma(n - bad + s * (1 - mean)) - lgamma(s * (1 - mean))
    - lgamma(n + s) + lgamma(s)) AS likelihood
  FROM s0, strengths WHERE n > 1 GROUP BY s),
sw AS (SELECT coalesce((SELECT s FROM ss ORDER BY likelihood DESC, s DESC LIMIT 1), 1000.0) AS w),
s1 AS (SELECT suffix, (bad + w * mean) / (n + w) AS mean FROM s0, sw),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(s1.mean) AS mean FROM hosts JOIN s1 USING (suffix) GROUP BY domain, suffix),
ds AS (
  SELECT s, sum(lgamma(bad + s * mean) - lgamma(s * mean) + lgamma(n - bad + s * (1 - mean)) - lgamma(s * (1 - mean))
    - lgamma(n + s) + lgamma(s)) AS likelihood
  FROM d0, strengths WHERE n > 1 GROUP BY s),
dw AS (SELECT coalesce((SELECT s FROM ds ORDER BY likelihood DESC, s DESC LIMIT 1), 1000.0) AS w),
d1 AS (SELECT domain, (bad + w * mean) / (n + w) AS mean FROM d0, dw),
h0 AS (SELECT host, n, bad, d1.mean FROM hosts JOIN d1 USING (domain)),
hs AS (
  SELECT s, sum(lgamma(bad + s * mean) - lgamma(s * mean) + lgamma(n - bad + s * (1 - mean)) - lgamma(s * (1 - mean))
    - lgamma(n + s) + lgamma(s)) AS likelihood
  FROM h0, strengths WHERE n > 1 GROUP BY s),
hw AS (SELECT coalesce((SELECT s FROM hs ORDER BY likelihood DESC, s DESC LIMIT 1), 1000.0) AS w),
h AS (SELECT host, (bad + w * mean) / (n + w) AS rate, n + w AS worth FROM h0, hw),
judged AS (
  SELECT page_id, host, path, CASE WHEN rate - 2.0 * sqrt(rate * (1 - rate) / (worth + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS learned
  FROM seen LEFT JOIN h USING (host)),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM judged)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' ELSE learned END AS verdict
FROM ruled
"""

RULES = r"""
WITH words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
runs AS (
  SELECT doc_id, i, w, lag(w) OVER o AS before, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2, w3, w4) AS times FROM runs WHERE w4 IS NOT NULL),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) AS r(k) WHERE times > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, count(CASE WHEN w = before THEN 1 END) AS n_stutters FROM runs GROUP BY doc_id),
tops AS (SELECT doc_id, max(n) AS top_word FROM (SELECT doc_id, w, count(*) AS n FROM words GROUP BY doc_id, w) GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
m AS (
  SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
    length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_upper,
    length(regexp_replace(text, '[^\p{Nd}]', '', 'g')) AS n_digits, length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks,
    coalesce(top_word, 0) AS top_word, coalesce(n_stutters, 0) AS n_stutters
  FROM texts t LEFT JOIN counts USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN tops USING (doc_id)),
f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_letters < 40 * word_chars THEN 64 ELSE 0 END + CASE WHEN 100 * n_upper > 50 * n_letters THEN 128 ELSE 0 END
    + CASE WHEN 100 * n_digits > 50 * word_chars THEN 256 ELSE 0 END + CASE WHEN 100 * n_marks > 30 * n_words THEN 512 ELSE 0 END
    + CASE WHEN 100 * top_word > 50 * n_words THEN 1024 ELSE 0 END + CASE WHEN 100 * n_stutters > 30 * n_words THEN 2048 ELSE 0 END
    )::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""

DECONTAMINATION = r"""
WITH lowered AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM lowered),
items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS run
  FROM (SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS run
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, sizes WHERE len(ws) >= n)),
hits AS (SELECT doc_id, i, n, item FROM runs JOIN windows USING (n, run)),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, range(10) AS r(k) WHERE k < n GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
trimmed AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM lines),
numbered AS (
  SELECT doc_id, i, t, row_number() OVER o AS k, lead(t, 1) OVER o AS t1, lead(t, 2) OVER o AS t2,
    lead(i, 1) OVER o AS i1, lead(i, 2) OVER o AS i2
  FROM trimmed WHERE t <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
windows AS (
  SELECT *, row_number() OVER (PARTITION BY t, t1, t2 ORDER BY doc_id, k) AS nth FROM numbered WHERE k = 1 OR t2 IS NOT NULL),
gone AS (
  SELECT doc_id, i FROM windows WHERE nth > 1
  UNION SELECT doc_id, i1 FROM windows WHERE nth > 1 AND i1 IS NOT NULL
  UNION SELECT doc_id, i2 FROM windows WHERE nth > 1 AND i2 IS NOT NULL),
kept AS (
  SELECT t.doc_id, string_agg(line, chr(10) ORDER BY t.i) FILTER (g.i IS NULL) AS text,
    count(*) FILTER (t.t <> '') AS n_lines, count(g.i) AS n_removed
  FROM trimmed t LEFT JOIN gone g ON t.doc_id = g.doc_id AND t.i = g.i GROUP BY t.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL WHEN n_removed > 0 AND n_removed = n_lines THEN '' ELSE k.text END AS text,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
seen AS (SELECT d, lang, source, unnest(ws) AS term FROM docs),
kept AS (SELECT lang, term FROM seen GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM seen JOIN kept USING (lang, term) GROUP BY lang, source, term),
own AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counted USING (lang, source) GROUP BY lang, source),
cells AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 5)::HUGEINT) // (total + 5 * v)::HUGEINT AS p
  FROM own JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counted USING (lang, source, term)),
overall AS (
  SELECT lang, term, 1 + (1000000000 * (n + 5)::HUGEINT) // (total + 5 * v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counted GROUP BY lang, term) JOIN (SELECT lang, sum(total) AS total FROM own GROUP BY lang) USING (lang) JOIN sizes USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN cells x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN cells y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
terms AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM cells JOIN overall USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms))
WHERE part = 'pair' OR rank <= 50
"""
