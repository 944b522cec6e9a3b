"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

SPACE = "[\\x20\\x09-\\x0D]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP8 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT rid, text, regexp_extract_all(text, '{NOT_SPACE}+') AS w FROM docs
), windows AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM worded)
), repeated AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(range(i, i + 5)) AS p
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1
  ) GROUP BY rid
), lines AS (
  SELECT rid, source, line,
         ('0x' || substr(md5(trim(regexp_replace(regexp_replace(translate(line, {LOW}), '[0-9]', '0', 'g'),
            '{SPACE}+', ' ', 'g'), ' ')), 1, 15))::BIGINT AS h,
         len(regexp_extract_all(line, '{NOT_SPACE}+')) AS n
  FROM (SELECT rid, source, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{NOT_SPACE}')
), held AS (
  SELECT rid, source, h, list_sort(list(h) OVER (PARTITION BY rid))::VARCHAR AS family FROM (SELECT DISTINCT rid, source, h FROM lines)
), bad AS (
  SELECT source, h FROM held GROUP BY source, h
  HAVING count(DISTINCT family) >= 10
), removed AS (
  SELECT rid, sum(n) AS n FROM lines JOIN bad ON lines.h = bad.h AND lines.source IS NOT DISTINCT FROM bad.source
  GROUP BY rid
), dup AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid
), figures AS (
  SELECT d.doc_id, len(w.w)::BIGINT AS n_words,
         length(array_to_string(w.w, ''))::BIGINT AS word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         coalesce(x.n, 0)::BIGINT AS n_removed_words
  FROM docs d JOIN worded w USING (rid) LEFT JOIN repeated r USING (rid)
  LEFT JOIN removed x USING (rid) LEFT JOIN dup USING (rid)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures
)
SELECT *, NOT base_failed AND n_words - n_removed_words >= 10
          AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept
FROM judged
"""

BLOCKED = (
    "ads|adserver|advert|banners|popunder|doubleclick|casino|poker|viagra|porn|xxx|escort|torrent|phishing|malware"
)

OP10 = f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url, position('://' IN coalesce(url, '')) AS mark FROM pages
), split AS (
  SELECT *, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM parts
), told AS (
  SELECT page_id, url, translate(regexp_extract(rest, '(?s)^[^/?#]*'), {LOW}) AS host,
         regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path, translate(url, {LOW}) AS low
  FROM split
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM told
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(low, '(?s)(^|[^0-9a-z])({BLOCKED})([^0-9a-z]|$)') THEN 'block'
    WHEN regexp_matches(low, '(?s)(^|[^0-9a-z])track([^0-9a-z]|$).*([^0-9a-z])click([^0-9a-z]|$)') THEN 'block'
    WHEN regexp_matches(low, '(?s)(^|[^0-9a-z])affiliate([^0-9a-z]|$).*([^0-9a-z])redirect([^0-9a-z]|$)') THEN 'block'
    ELSE 'allow'
  END AS verdict
FROM ruled
"""

CHECKS = {"op8_line_quality": OP8, "op10_url_verdicts": OP10}
