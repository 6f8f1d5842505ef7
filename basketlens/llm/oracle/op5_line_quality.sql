WITH d AS (
  SELECT doc_id, source, text AS raw, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, unnest(generate_series(1, len(words) - 2)) AS i, words FROM d WHERE len(words) > 2
), named AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS n FROM grams
), repeats AS (
  SELECT doc_id, count(DISTINCT k) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM named WHERE n > 1) GROUP BY doc_id
), each AS (
  SELECT doc_id, source, raw, unnest(lines) AS line FROM d
), normal AS (
  SELECT doc_id, source, raw,
         regexp_replace(regexp_replace(lower(trim(line, ' ')), '[ \t\n\x0B\f\r]+', ' ', 'g'), '[0-9]+', '0', 'g') AS line,
         len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
  FROM each
), hosts AS (
  SELECT source, count(DISTINCT raw) AS texts FROM d WHERE len(words) > 0 GROUP BY source
), often AS (
  SELECT source, line, min(doc_id) AS first, count(DISTINCT raw) AS documents FROM normal
  WHERE length(regexp_replace(line, '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '', 'g')) >= 16
  GROUP BY source, line HAVING count(DISTINCT raw) > 10
), common AS (
  SELECT o.source, o.line, o.first FROM often o JOIN hosts h ON o.source IS NOT DISTINCT FROM h.source
  WHERE 100 * o.documents > 2 * h.texts
), lost AS (
  SELECT n.doc_id, sum(n.words) AS lost, count(DISTINCT n.line) AS lines_removed
  FROM normal n JOIN common c ON n.source IS NOT DISTINCT FROM c.source AND n.line = c.line
  WHERE n.doc_id <> c.first GROUP BY n.doc_id
), counted AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(lost, 0) AS lost, CAST(coalesce(lines_removed, 0) AS INTEGER) AS lines_removed
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN lost USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - lost >= 0.2 * n_words AS kept, lines_removed
FROM judged
