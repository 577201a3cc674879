"""DuckDB SQL for the queries that SQL can express, stated independently of the Spark code."""

from __future__ import annotations

_TOKENS = """list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""

_WORDS = "list_filter(string_split_regex(coalesce({}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

# The phrases of boilerplate lines.
_PHRASES = (
    "all rights reserved|this work is licensed under|terms of use|terms of service|privacy policy|cookie policy|use cookies|"
    "enable javascript|subscribe to our newsletter|powered by|skip to content"
)

# Ends of sentences of other scripts, and the letters of Thai and Lao, which mark none.
_OTHER_ENDS = "।॥؟۔؛።፧։។៕။།༎｡．。！？ก-๎ກ-໎"

SQL = {
    "op1_decontaminate": f"""
WITH docs AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_TOKENS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i : i + size - 1], ' ') AS s
  FROM (SELECT item, w, least(len(w), 13) AS size,
               unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i FROM items WHERE len(w) > 0)),
spots AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT doc_id, item, i, size FROM spots JOIN windows USING (size, s)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits h USING (doc_id) LEFT JOIN named m USING (doc_id)""",
    "op3_chat_format": """
WITH all_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(role) + length(text)
    + 4 * (length(role || text) - length(replace(role || text, '&', '')))
    + 3 * (length(role || text) - length(replace(replace(role || text, '<', ''), '>', ''))) + 15 AS chars
  FROM all_rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op8_quality_rules": f"""
WITH docs AS (SELECT doc_id, text, {_WORDS.format('text')} AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM docs WHERE len(w) > 2)),
again AS (SELECT doc_id, s FROM windows GROUP BY doc_id, s HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(generate_series(i, i + 2)) AS p FROM windows JOIN again USING (doc_id, s))
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, i, line, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS has_words, length(line) AS chars,
         regexp_matches(line, '[.!?…。！？:;]([\\s"''»”’)\\]]|$)|[{_OTHER_ENDS}]') AS ends,
         lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS following
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
placed AS (
  SELECT *, count(*) FILTER (NOT has_words) OVER (PARTITION BY doc_id ORDER BY i) AS paragraph,
         coalesce(regexp_matches(following, '[^\\x20\\x09-\\x0D]') AND (
           chars >= 25 AND chars >= 0.6 * length(following)
           OR regexp_matches(following, '^[\\x20\\x09-\\x0D]*["''(\\[]?\\p{{Ll}}')), false) AS goes_on
  FROM lines),
ended AS (
  SELECT *, bool_or(ends) OVER (PARTITION BY doc_id, paragraph ORDER BY i DESC) AS ends_later FROM placed),
counted AS (
  SELECT doc_id, line, chars, count(*) OVER (PARTITION BY doc_id) AS n_lines, NOT ends AND NOT (goes_on AND ends_later) AS unfinished,
         len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols, len(regexp_extract_all(line, '[|›»·]')) AS bars
  FROM ended WHERE has_words),
marks AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>›»·]')) AS n FROM documents),
judged AS (
  SELECT c.*, (n_lines > 1 AND unfinished)
      OR (chars <= 300 AND regexp_matches(lower(line), '{_PHRASES}'))
      OR (symbols >= 3 AND symbols * 12 >= chars) OR (bars >= 3 AND bars * 40 >= chars) AS fails
  FROM counted c),
totals AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (fails) AS n_failed_lines, CAST(sum(chars) AS BIGINT) AS line_chars,
         CAST(coalesce(sum(chars) FILTER (fails), 0) AS BIGINT) AS lost_chars
  FROM judged GROUP BY doc_id),
rated AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines,
         coalesce(line_chars, 0) AS line_chars, coalesce(lost_chars, 0) AS lost_chars
  FROM docs LEFT JOIN repeated r USING (doc_id) LEFT JOIN totals USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 1000 * lost_chars <= 400 * line_chars AS kept
FROM rated""",
    "op12_fill_middle": """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || doc_id) AS h FROM documents),
drawn AS (
  SELECT *, len(w) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || h[i : i + 7] AS BIGINT)) AS d FROM docs),
cut AS (
  SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 90 THEN 'plain'
              WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(w[1 : a], '') AS p, array_to_string(w[a + 1 : b], '') AS m, array_to_string(w[b + 1 :], '') AS s
  FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts""",
    # The checksum is that of ISO 3309, bit by bit; near words are found by the words that they have in common with one
    # code point less, or as words of one length that differ in one place.
    "op13_spelling": """
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run
        FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run),
steps AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]),
          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM (SELECT unnest(generate_series(0::BIGINT, 255)) AS i))),
summed AS (
  SELECT run, times, xor(list_reduce(
      list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))),
      lambda a, x: xor(a // 256, t[xor(a, x) % 256 + 1])), 4294967295) AS h
  FROM runs, steps),
counted AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word
        FROM summed) WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (
  SELECT DISTINCT word, n, word[1 : i - 1] || word[i + 1 :] AS rest FROM (
    SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM counted)),
holes AS (
  SELECT word, n, word[1 : i - 1] || '*' || word[i + 1 :] AS rest FROM (
    SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM counted)),
near AS (
  SELECT l.word, c.word AS other, c.n AS other_n FROM less l JOIN counted c ON l.rest = c.word
  UNION SELECT c.word, l.word, l.n FROM less l JOIN counted c ON l.rest = c.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN holes b ON a.rest = b.rest AND a.word <> b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS form, max(other_n) AS form_n
  FROM near GROUP BY word),
formed AS (
  SELECT c.word, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
         CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM counted c LEFT JOIN best USING (word)),
path AS (
  SELECT word, word AS place, form AS onward FROM formed
  UNION ALL SELECT p.word, f.word, f.form FROM path p JOIN formed f ON p.onward = f.word)
SELECT f.word, form, place AS root, n, n_near, form_n FROM formed f JOIN path p ON f.word = p.word AND p.onward IS NULL""",
}
