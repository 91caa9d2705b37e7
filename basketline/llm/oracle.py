"""SQL with the same results, where SQL can express an operator."""

from __future__ import annotations

#: Systematic sampling: the same order, offsets and prefix counts as one statement.
MIXING = """
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 6) AS BIGINT) % 256 AS piece
  FROM documents
), classed AS (
  SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) AS class FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(source_size * 2.0::DOUBLE) OVER (
                 ORDER BY source_size * 2.0::DOUBLE / w, source IS NULL, source
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY source_size * 2.0::DOUBLE / w, source IS NULL, source
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), targets AS (
  SELECT source, source_size,
         least(source_size * 2.0::DOUBLE, coalesce(
           (SELECT level FROM levels WHERE level * w < source_size * 2.0::DOUBLE
            ORDER BY source_size * 2.0::DOUBLE / w, source IS NULL, source LIMIT 1) * w,
           source_size * 2.0::DOUBLE)) AS target
  FROM levels
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, piece, size, doc_id NULLS FIRST) AS rank FROM classed
), rated AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, r.rank,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('7:' || CASE WHEN r.source IS NULL THEN '-' ELSE '+' || r.source END), 1, 5) AS BIGINT)
           / 1048576.0::DOUBLE AS u
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(u + rate * rank) - floor(u + rate * (rank - 1)), ceil(rate)) AS BIGINT) * size AS taken
FROM rated
"""

#: Every kept term against every group and every pair of groups, in wide integers.
DIVERGENCE = """
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), found AS (
  SELECT lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs) GROUP BY ALL HAVING count(*) >= 3
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, source, sum(n) AS size FROM counts GROUP BY ALL
), vocabulary AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (coalesce(s.size, 0) + v.v)::HUGEINT AS p
  FROM groups g JOIN kept k USING (lang) JOIN vocabulary v USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
), whole AS (
  SELECT lang, term, 1 + (1000000000 * (sum(n) + 1)::HUGEINT) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v))::HUGEINT AS q
  FROM counts JOIN vocabulary USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM results QUALIFY part = 'pair' OR rank <= 200
"""

#: Every phrase as text, counted, cut and ranked.
COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang
), places AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM worded, (VALUES (1), (2), (3), (4)) sizes(size)
), phrases AS (
  SELECT lang, size, w[i:i + size - 1] AS words, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT * FROM phrases WHERE size >= 2
), cuts AS (
  SELECT c.lang, c.words, c.f, k, l.f AS l, r.f AS r, (2000000 * c.f::HUGEINT) // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN phrases l ON l.lang = c.lang AND l.words = c.words[1:k]
  JOIN phrases r ON r.lang = c.lang AND r.words = c.words[k + 1:]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), parts AS (
  SELECT lang, f, words[i:i + part - 1] AS inner_words
  FROM (SELECT *, unnest(range(1, size - part + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS part FROM candidates))
), held AS (
  SELECT lang, inner_words, max(f) AS longer FROM parts GROUP BY ALL
), ranked AS (
  SELECT lo.lang, array_to_string(lo.words, ' ') AS phrase, lo.f AS a, lo.l, lo.r, t.n, lo.score
  FROM lowest lo JOIN totals t USING (lang) LEFT JOIN held h ON h.lang = lo.lang AND h.inner_words = lo.words
  WHERE h.longer IS NULL OR 100 * h.longer < 80 * lo.f
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked QUALIFY rank <= 2000
"""
