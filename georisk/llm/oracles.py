"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_key AS k FROM (
    SELECT doc_id, i, line,
      translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key
    FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)))),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN shared USING (k) GROUP BY doc_id
"""

QUALITY_RULES = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lists AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM lists),
windows AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p AS gram
  FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows WHERE gram IS NOT NULL)
  WHERE n >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
line_facts AS (SELECT doc_id, sum(n) AS n_lines, sum(n - 1) AS n_dup FROM lines GROUP BY doc_id),
stutters AS (
  SELECT doc_id, count(*) AS stutters
  FROM (SELECT doc_id, word, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM words)
  WHERE word = last GROUP BY doc_id),
word_facts AS (
  SELECT doc_id, sum(n) AS n_words, sum(n * length(word)) AS word_chars, max(n) AS most,
    sum(n) FILTER (WHERE ends_with(word, '!')) AS bangs,
    sum(n) FILTER (WHERE NOT regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS bare
  FROM (SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word) GROUP BY doc_id),
facts AS (
  SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
    CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
    coalesce(stutters, 0) AS stutters, coalesce(bangs, 0) AS bangs, coalesce(bare, 0) AS bare, coalesce(most, 0) AS most
  FROM docs LEFT JOIN stutters USING (doc_id) LEFT JOIN word_facts USING (doc_id) LEFT JOIN line_facts USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
    OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 2 * capitals > letters
    OR 10 * bangs > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 5 * bare > 2 * n_words OR 10 * most > 3 * n_words OR 10 * stutters > 3 * n_words) AS kept
FROM facts
"""

EMBEDDINGS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN counts USING (vec_id)
"""

WARC = """
WITH payloads AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
marked AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM marked
"""

SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS head, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (SELECT head, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY head, run),
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
bytes AS (
  SELECT head, run, times, hex(encode(head || run)) AS h FROM counted),
sums AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(range(1, length(h), 2), lambda p:
        CAST(instr('0123456789ABCDEF', substr(h, CAST(p AS INTEGER), 1)) * 16
          + instr('0123456789ABCDEF', substr(h, CAST(p AS INTEGER) + 1, 1)) - 17 AS BIGINT))),
    lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS INTEGER) + 1]))) AS crc
  FROM bytes, crc_table),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN crc % 97 = 0
      THEN left(run, CAST(crc % length(run) AS INTEGER)) || substr(run, CAST(crc % length(run) AS INTEGER) + 2)
      ELSE run END AS word FROM sums)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
gaps AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INTEGER) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b USING (i, rest)
  WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION
  SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.rest = w.word
  UNION
  SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.rest = w.word),
ranked AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
rated AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
    CASE WHEN r.other_n >= 2 * w.n THEN r.other END AS form,
    CASE WHEN r.other_n >= 2 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
ways AS (
  SELECT word, form AS spot, 1 AS steps FROM rated WHERE form IS NOT NULL
  UNION ALL
  SELECT ways.word, rated.form, steps + 1 FROM ways JOIN rated ON rated.word = ways.spot WHERE rated.form IS NOT NULL),
ends AS (SELECT word, arg_max(spot, steps) AS root FROM ways GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM rated LEFT JOIN ends USING (word)
"""

FILL_MIDDLE = r"""
WITH draws AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
cut AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
    CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM draws),
ranks AS (
  SELECT doc_id, t, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b, u,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
    array_to_string(u[b + 1:n], '') AS suffix FROM ranks)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM parts
"""

SUFFIXES = r"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k
  FROM (SELECT doc_id, h, CAST(unnest(range(length(h) // 2 - 99)) AS INTEGER) AS i FROM docs WHERE length(h) >= 200)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS place FROM windows)
  WHERE place > 1),
runs AS (
  SELECT doc_id, min(i) AS low, max(i) + 100 AS high FROM (
    SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
      SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new
      FROM later))
  GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, low, high, lead(low) OVER (PARTITION BY doc_id ORDER BY low) AS next_low,
    row_number() OVER (PARTITION BY doc_id ORDER BY low) AS place FROM runs),
cut AS (
  SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans,
    string_agg(CASE WHEN place = 1 THEN substr(h, 1, 2 * low) ELSE '' END
      || CASE WHEN next_low IS NULL THEN substr(h, 2 * high + 1) ELSE substr(h, 2 * high + 1, 2 * (next_low - high)) END,
      '' ORDER BY low) AS kept
  FROM pieces JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op5_quality_rules": QUALITY_RULES,
    "op6_embedding_near_dedup": EMBEDDINGS,
    "op7_line_dedup": LINE_DEDUP,
    "op8_warc_zip": WARC,
    "op11_spelling_variants": SPELLING,
    "op12_fill_in_middle": FILL_MIDDLE,
    "op13_suffix_dedup": SUFFIXES,
}
