"""SQL of the corpus queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from tallyhouse.llm.linededup import MIN_CHARS, MIN_DOCS
from tallyhouse.llm.quality import LineLimits
from tallyhouse.llm.urls import BLOCK_ABOVE, BOUND, RULES

_SPACE = r"[\x20\x09-\x0D]+"
_LIMITS = LineLimits()
_WORDS = f"list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda x: x <> '')"
_TRIM = r"trim({0}, E' \t\n\x0b\x0c\r')"

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, {_WORDS} AS words FROM d),
windows AS (
  SELECT doc_id, k, array_to_string(words[k : k + 12], ' ') AS said
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS k FROM w)
),
known AS (SELECT doc_id, k, min(doc_id) OVER (PARTITION BY said) AS least FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS place FROM known WHERE least < doc_id
),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS said
  FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed,
       sha256(coalesce(kept.said, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

_RULE_ORDER = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r))
_FITS = [
    f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
    for host, path, _ in _RULE_ORDER
]
_RULE = " ".join(f"WHEN {f} THEN '{r[0] + r[1]}'" for f, r in zip(_FITS, _RULE_ORDER))
_VERDICT = " ".join(f"WHEN {f} THEN '{r[2]}'" for f, r in zip(_FITS, _RULE_ORDER))
_URL = "coalesce(url, '')"


def _strength(groups: str) -> str:
    v = "parent * (1 - parent)"
    rho = f"""(sum(n * pow(bad / nullif(n, 0) - parent, 2)) FILTER (n > 0) - sum({v}) FILTER (n > 0))
      / nullif(sum({v} * (n - 1)) FILTER (n > 0), 0)"""
    return f"(SELECT 1 / least(greatest(coalesce({rho}, 0), 0.0001), 0.5) - 1 AS k FROM {groups})"


URL_FILTERS = f"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract({_URL}, '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract({_URL}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
known AS (
  SELECT doc_id AS page_id, max(CAST(quality = 0 OR toxic = 1 AS INTEGER)) AS bad
  FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id
),
hosts AS (
  SELECT host, string_split(host, '.')[-1] AS suffix,
         array_to_string(string_split(host, '.')[-2:], '.') AS domain,
         CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad
  FROM p LEFT JOIN known USING (page_id) GROUP BY host
),
overall AS (SELECT coalesce(sum(bad), 0) / greatest(sum(n), 1) AS parent FROM hosts),
s AS (
  SELECT suffix, n, bad, parent
  FROM (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix), overall
),
s2 AS (SELECT suffix, (bad + k * parent) / (n + k) AS mean FROM s, {_strength("s")}),
g AS (
  SELECT suffix, domain, n, bad, s2.mean AS parent
  FROM (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain)
  JOIN s2 USING (suffix)
),
g2 AS (SELECT suffix, domain, (bad + k * parent) / (n + k) AS mean FROM g, {_strength("g")}),
h AS (SELECT host, n, bad, g2.mean AS parent FROM hosts JOIN g2 USING (suffix, domain)),
posterior AS (
  SELECT host, k * parent + bad AS a, k * (1 - parent) + n - bad AS b FROM h, {_strength("h")}
),
judged AS (
  SELECT host, a / (a + b) - {BOUND} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS lower
  FROM posterior
)
SELECT page_id, host, path, CASE {_RULE} END AS rule,
       CASE {_VERDICT} ELSE CASE WHEN lower > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END END AS verdict
FROM p JOIN judged USING (host)
"""

QUALITY_RULES = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, {_WORDS} AS words FROM d),
windows AS (
  SELECT doc_id, k, array_to_string(words[k : k + 4], ' ') AS said
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS k FROM w)
),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (
    SELECT doc_id, unnest(range(k, k + 5)) AS place
    FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, said) AS times FROM windows)
    WHERE times > 1
  ) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, source, text, {_TRIM.format("line")} AS line, {_TRIM.format("lower(line)")} AS said
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE {_TRIM.format("line")} <> ''
),
frequent AS (
  SELECT source, said FROM lines GROUP BY source, said
  HAVING count(DISTINCT text) > {_LIMITS.min_documents}
),
removed AS (
  SELECT doc_id, CAST(sum(len(regexp_split_to_array(line, '{_SPACE}'))) AS BIGINT) AS n
  FROM lines l SEMI JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.said = f.said
  GROUP BY doc_id
),
figures AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    (SELECT CAST(len(x) - len(list_distinct(x)) AS BIGINT) FROM (SELECT
      list_filter(string_split(text, chr(10)), lambda y: {_TRIM.format("y")} <> '') AS x)) AS n_dup_lines,
    coalesce(repeats.n, 0) AS n_repeat_words, coalesce(removed.n, 0) AS removed_words
  FROM w LEFT JOIN repeats USING (doc_id) LEFT JOIN removed USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND n_words - removed_words >= {_LIMITS.min_kept} * n_words AS kept,
  removed_words
FROM figures
"""

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(said) AS line, unnest(range(1, len(said) + 1)) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS said FROM documents)
),
keyed AS (
  SELECT *, translate({_TRIM.format("line")}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
),
judged AS (
  SELECT doc_id, line, pos, coalesce(doc_id < last, false) AS gone
  FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SQL = {
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op7_url_filters": URL_FILTERS,
    "op8_quality_rules": QUALITY_RULES,
    "op12_line_dedup": LINE_DEDUP,
}
