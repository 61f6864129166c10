"""Queries of the operators once more as SQL, where SQL can express them."""

from __future__ import annotations

# A word and its absence, as the contract of the quality rules has them.
WORD = r"[^\x20\x09-\x0D]+"

QUALITY_RULES = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT row, doc_id, text, regexp_extract_all(text, '{WORD}') AS words FROM texts
), windows AS (
  SELECT row, i, array_to_string(words[i:i + 7], ' ') AS eight
  FROM (SELECT row, words, unnest(generate_series(1, len(words) - 7)) AS i FROM worded)
), again AS (
  SELECT row, i, coalesce(lead(i) OVER (PARTITION BY row ORDER BY i), i + 8) AS next
  FROM (SELECT row, i, count(*) OVER (PARTITION BY row, eight) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT row, CAST(sum(least(8, next - i)) AS BIGINT) AS n_repeat_words FROM again GROUP BY row
), lines AS (
  SELECT row, text, line, regexp_extract_all(line, '{WORD}') AS w,
         regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare
  FROM (SELECT row, text, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{WORD}')
), common AS (
  SELECT bare AS common_line FROM (SELECT DISTINCT bare, text FROM lines WHERE len(w) <= 30) GROUP BY bare
  HAVING count(*) >= 20 AND 100 * count(*) >= (SELECT count(DISTINCT text) FROM lines)
), judged AS (
  SELECT row, line, strlen(line) AS size,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > CAST(0.3 AS DOUBLE) * len(w)
         OR len(list_filter(w, lambda x: x IN ('|', '>', '>>', '»', '·', '•', '/', '-', '<', '<<')))
            > CAST(0.2 AS DOUBLE) * len(w)
         OR (len(w) <= 3 AND NOT regexp_matches(line, '(\.|!|\?|:|;|"|''|\)|\]|”|…)[\x20\x09-\x0D]*$'))
         OR len(list_filter(w, lambda x: regexp_matches(x, '(!!|\?\?|\.\.)$'))) > CAST(0.7 AS DOUBLE) * len(w)
         OR (len(w) <= 30 AND regexp_matches(line, '(?i)lorem ipsum|javascript|cookie|privacy policy'
             '|terms of (?:use|service)|all rights reserved|copyright \(c\)|subscribe to|sign up'
             '|log ?in to|click here|read more|share this|page not found'))
         OR (len(w) <= 30 AND common_line IS NOT NULL) AS fails
  FROM lines LEFT JOIN common ON bare = common_line
), by_line AS (
  SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (WHERE fails) AS n_lines_removed,
         coalesce(sum(size) FILTER (WHERE fails), 0) AS lost, sum(size) AS total
  FROM judged GROUP BY row
), counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
         CAST(coalesce(n_lines_removed, 0) AS BIGINT) AS n_lines_removed,
         coalesce(lost, 0) AS lost, coalesce(total, 0) AS total
  FROM worded LEFT JOIN by_line USING (row) LEFT JOIN repeats USING (row)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost <= CAST(0.5 AS DOUBLE) * total AS kept, n_lines, n_lines_removed
FROM based
"""

# Bytes are written as two hexadecimal digits, so a string of 50 bytes is 100 characters.
SUFFIX_DEDUP = """
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, 9223372036854775807) AS rank,
         hex(encode(coalesce(text, ''))) AS raw
  FROM documents
), strings AS (
  SELECT row, rank, pos, substring(raw, 2 * pos + 1, 100) AS fifty
  FROM (SELECT row, rank, raw, unnest(range(greatest(length(raw) // 2 - 49, 0))) AS pos FROM texts)
), gone AS (
  SELECT row, pos FROM (
    SELECT row, rank, pos, min(rank) OVER (PARTITION BY fifty) AS first_rank FROM strings)
  WHERE first_rank < rank
), chained AS (
  SELECT row, pos, pos - lag(pos) OVER (PARTITION BY row ORDER BY pos) AS step FROM gone
), runs AS (
  SELECT row, run, min(pos) AS start_byte, max(pos) + 50 AS end_byte FROM (
    SELECT row, pos, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END)
             OVER (PARTITION BY row ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run
    FROM chained)
  GROUP BY row, run
), pieces AS (
  SELECT row, run, start_byte, end_byte,
         coalesce(lag(end_byte) OVER (PARTITION BY row ORDER BY start_byte), 0) AS prior
  FROM runs
), kept AS (
  SELECT row, sum(end_byte - start_byte) AS n_removed, count(*) AS n_spans, max(end_byte) AS end_byte,
         string_agg(substring(raw, 2 * prior + 1, 2 * (start_byte - prior)), '' ORDER BY start_byte) AS rest
  FROM pieces JOIN texts USING (row) GROUP BY row
)
SELECT doc_id, CAST(length(raw) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(rest || substring(raw, 2 * end_byte + 1), raw))) AS kept_sha256
FROM texts LEFT JOIN kept USING (row)
"""

WARC = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM payloads GROUP BY payload_digest
), joined AS (
  SELECT *, payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again
  FROM payloads JOIN firsts USING (payload_digest)
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM joined
"""

# The CRC-32 of a text's bytes, a bit at a time; takes the text as hexadecimal digits.
def _crc32(digits: str) -> str:
    byte = f"CAST('0x' || substring({digits}, 2 * i + 1, 2) AS BIGINT)"
    bits = f"flatten(list_transform(range(length({digits}) // 2), lambda i: list_transform(range(8), lambda b: ({byte} >> b) & 1)))"
    step = "xor(crc >> 1, CASE WHEN xor(crc & 1, b) = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda crc, b: {step}), 4294967295)"


PERIODIC_RUNS = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
         CASE WHEN doc_id IS NOT NULL THEN {_crc32("hex(encode(CAST(doc_id AS VARCHAR)))")} END AS h
  FROM documents
), placed AS (
  SELECT *, len(words) AS n, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM texts
), turned AS (
  SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed
), looped AS (
  SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
         THEN list_transform(range(n), lambda i: CASE WHEN i >= a THEN words[1 + a + (i - a) % p] ELSE words[1 + i] END)
         ELSE words END AS words
  FROM turned
), flat AS (
  SELECT row, n, unnest(range(n)) AS i, unnest(words) AS word FROM looped
), matched AS (
  SELECT x.row, x.i, x.i - y.i AS lag
  FROM flat x JOIN flat y ON x.row = y.row AND x.word = y.word AND x.i > y.i AND 4 * (x.i - y.i) <= x.n
), chained AS (
  SELECT row, lag, i, i - row_number() OVER (PARTITION BY row, lag ORDER BY i) AS chain FROM matched
), stretches AS (
  SELECT row, min(i) - lag AS start, count(*) + lag AS length, lag FROM chained
  GROUP BY row, lag, chain HAVING count(*) + lag >= greatest(6, 4 * lag)
), runs AS (
  SELECT row, start, length, min(lag) AS period FROM stretches GROUP BY row, start, length
), summed AS (
  SELECT row, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         arg_min({{'s': start, 'l': length, 'p': period}}, (-length, start, period)) AS longest
  FROM runs GROUP BY row
), dropped AS (
  SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs
), left_over AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS collapsed FROM flat ANTI JOIN dropped USING (row, i) GROUP BY row
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, coalesce(n_runs, 0) AS n_runs,
       CAST(longest.s AS BIGINT) AS start, CAST(longest.l AS BIGINT) AS length,
       CAST(longest.p AS BIGINT) AS period,
       CAST(1000 * longest.l // longest.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256,
       CAST(n - (SELECT count(*) FROM dropped d WHERE d.row = looped.row) AS BIGINT) AS n_kept,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM looped LEFT JOIN summed USING (row) LEFT JOIN left_over USING (row)
"""

RESAMPLING = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, 'd' AS side, doc_id, text FROM documents
  UNION ALL SELECT row_number() OVER (), 'b', NULL, text FROM benchmark
), worded AS (
  SELECT row, side, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts
), flat AS (
  SELECT row, side, unnest(words) AS word FROM worded
), hashed AS (
  SELECT word, {_crc32("digits")} % 10000 AS bucket
  FROM (SELECT word, hex(encode(word)) AS digits FROM flat GROUP BY word)
), counts AS (
  SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t
  FROM flat JOIN hashed USING (word) GROUP BY bucket
), totals AS (
  SELECT CAST(sum(s) AS BIGINT) AS all_s, CAST(sum(t) AS BIGINT) AS all_t FROM counts
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE
                                      / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counts, totals
), weights AS (
  SELECT row, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM flat JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
         + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8)
                                          AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM worded LEFT JOIN weights USING (row) WHERE side = 'd'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM placed
"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 16) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left,
         coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS spent, count(*) OVER before AS place
  FROM sources
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min((budget - spent) / weight_left, place) AS height FROM filled
  WHERE most >= (budget - spent) / weight_left * weight
), wanted AS (
  SELECT source, source_size, least(most, height * weight) AS target FROM filled, level
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM wanted
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size DESC
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before))
            AS BIGINT) AS taken
FROM placed JOIN budgets ON placed.source IS NOT DISTINCT FROM budgets.source
"""

ORACLE_SQL = {
    "op3_quality_rules": QUALITY_RULES,
    "op9_suffix_dedup": SUFFIX_DEDUP,
    "op10_warc": WARC,
    "op11_periodic_runs": PERIODIC_RUNS,
    "op12_resampling": RESAMPLING,
    "op13_mixing": MIXING,
}
