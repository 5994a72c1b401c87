"""The same results as SQL, where SQL can express an operator."""

from __future__ import annotations

from kerbside.llm.common import UPPER, WORD
from kerbside.llm.mixing import BLOCK_ROWS, UNIT

ORACLES: dict[str, str] = {}

# The level is found in one pass: with sources ordered by the level at which they reach
# their cap, it is that of the first source which stays below its own.
ORACLES["op1_mix_sources"] = f"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, key, count(*) AS n_docs, CAST(sum(size) AS BIGINT) AS source_size
  FROM d GROUP BY source, key),
r AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
    3 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, key) AS k,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
      / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS lev
  FROM r WINDOW before AS (ORDER BY cap / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT key, source_size, (n_docs + {BLOCK_ROWS - 1}) // {BLOCK_ROWS} AS blocks,
    least(w * (SELECT min_by(lev, k) FROM o WHERE w * lev <= cap), CAST(cap AS DOUBLE)) AS target,
    CAST('0x' || substr(md5('mix' || key), 1, 6) AS BIGINT) AS offset_
  FROM r),
b AS (SELECT d.*, source_size, target, offset_,
    CASE WHEN source_size = 0 THEN 0
      ELSE CAST(round(target / source_size * {UNIT}) AS BIGINT) END AS rate,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % blocks AS block
  FROM d JOIN t USING (key)),
p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY block,
    CASE WHEN block % 2 = 0 THEN size ELSE -size END, doc_id NULLS FIRST) AS place FROM b),
c AS (SELECT *, ((place * rate + offset_) >> 24) - (((place - 1) * rate + offset_) >> 24) AS copies
  FROM p)
SELECT doc_id, size, source, source_size, target, copies, size * copies AS taken FROM c
"""

ORACLES["op3_url_filter"] = rf"""
WITH u AS (SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r (h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m USING (page_id)
"""

ORACLES["op12_phrase_collocations"] = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
spots AS (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
  FROM w, (SELECT unnest(range(1, 6)) AS size)),
f AS (SELECT lang, size, phrase, count(*) AS f
  FROM (SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase FROM spots)
  GROUP BY lang, size, phrase),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
often AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND f >= 100),
inner_size AS (SELECT lang, ws, a, size, unnest(range(2, size)) AS m FROM often WHERE size > 2),
inner_at AS (SELECT lang, ws, a, m, unnest(range(1, size - m + 2)) AS i FROM inner_size),
longer AS (SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM inner_at) GROUP BY lang, phrase),
kept AS (SELECT o.* FROM often o LEFT JOIN longer USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (SELECT lang, phrase, a, ws, size, unnest(range(1, size)) AS k FROM kept),
scored AS (SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
    CAST(1000 * CAST(a AS HUGEINT) * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN total t ON t.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1:c.size], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scored)
  WHERE o = 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score FROM best)
SELECT * FROM ranked WHERE rank <= 2000
"""
