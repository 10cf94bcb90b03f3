"""SQL twins of the dealt queries that SQL can express."""

from crowdpulse.llm.quality_rules import LEAST_WORDS, LEFT, MOST_DOCUMENTS, MOST_REPEATED

QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
again AS (SELECT id, win FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT id, count(DISTINCT i + k) AS n
  FROM (SELECT windows.id, i, unnest([0, 1, 2]) AS k FROM windows JOIN again USING (id, win)) GROUP BY id),
normal AS (
  SELECT id, source, text, array_to_string(words, ' ') AS line, len(words) AS n
  FROM (SELECT id, source, text,
      regexp_extract_all(regexp_replace(lower(unnest(lines)), '[1-9]', '0', 'g'), '[^\x20\x09-\x0D]+') AS words FROM d)),
often AS (SELECT source, line FROM normal GROUP BY ALL HAVING count(DISTINCT text) > {MOST_DOCUMENTS}),
gone AS (
  SELECT id, sum(n) AS n FROM normal n JOIN often o ON n.source IS NOT DISTINCT FROM o.source AND n.line = o.line GROUP BY 1),
base AS (
  SELECT doc_id, len(words) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS removed
  FROM d LEFT JOIN covered USING (id) LEFT JOIN gone USING (id)),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - removed >= {LEFT} * n_words AS kept
FROM judged
"""

ORACLE = {"op4_quality_rules": QUALITY_RULES}
