"""DuckDB SQL of the queries that SQL can express, over the same tables, whole."""

from __future__ import annotations

OP1 = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (j // 4) AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (j % 4) AS INTEGER)) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to,
  url AS target_uri,
  CAST(CASE WHEN page_id <> top THEN 0 ELSE payload_bytes END AS BIGINT) AS stored_bytes
FROM r
"""

OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
m AS (SELECT w.r, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS BIGINT) AS n_capitals, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.r = rep.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
cuts AS (
  SELECT 'symbols' AS rule, unnest([2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05]) AS cutoff, unnest(range(0, 7)) AS step UNION ALL
  SELECT 'dup_lines', unnest([0.6, 0.5, 0.4, 0.3]), unnest(range(0, 4)) UNION ALL
  SELECT 'repeats', unnest([0.45, 0.4, 0.35, 0.3]), unnest(range(0, 4)) UNION ALL
  SELECT 'long_words', unnest([12.0, 10.0, 9.0, 8.0, 7.0]), unnest(range(0, 5)) UNION ALL
  SELECT 'capitals', unnest([0.5, 0.4, 0.3, 0.2, 0.1]), unnest(range(0, 5))),
v AS (
  SELECT r, doc_id, coalesce(lang, '') AS stratum, base_failed, unnest(['symbols', 'dup_lines', 'repeats', 'long_words', 'capitals']) AS rule,
    unnest(CASE WHEN n_words = 0 THEN [0.0, 0.0, 0.0, 0.0, 0.0] ELSE
      [CAST(n_symbols AS DOUBLE) / n_words, CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1), CAST(n_repeat_words AS DOUBLE) / n_words,
       CAST(word_chars AS DOUBLE) / n_words, CAST(n_capitals AS DOUBLE) / word_chars] END) AS x FROM b),
l AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id),
s AS (SELECT stratum, v.rule, step, CAST(cutoff AS DOUBLE) AS cutoff, sum(good) AS n,
  sum(CASE WHEN x > CAST(cutoff AS DOUBLE) AND good = 1 THEN 1 ELSE 0 END) AS k, sum(CASE WHEN x > CAST(cutoff AS DOUBLE) AND good = 0 THEN 1 ELSE 0 END) AS caught
  FROM v JOIN l USING (doc_id) JOIN cuts ON cuts.rule = v.rule WHERE NOT base_failed GROUP BY ALL),
tested AS (SELECT *, CASE WHEN k > n * 0.004 THEN 1.0 ELSE
    list_sum(list_transform(range(0, CAST(k + 1 AS BIGINT)), lambda i: exp(lgamma(CAST(n + 1 AS DOUBLE)) - lgamma(CAST(i + 1 AS DOUBLE)) - lgamma(CAST(n - i + 1 AS DOUBLE))
      + i * ln(0.004) + (n - i) * ln(0.996)))) END > 0.05 / (5 * (SELECT greatest(1, count(DISTINCT stratum)) FROM s)) AS failed FROM s),
passed AS (SELECT *, sum(CAST(failed AS INTEGER)) OVER (PARTITION BY stratum, rule ORDER BY step) AS failures FROM tested),
best AS (SELECT stratum, rule, arg_max(cutoff, caught * 1000 + cutoff) AS cutoff FROM passed WHERE failures = 0 AND caught > 0 GROUP BY ALL),
bad AS (SELECT DISTINCT r FROM v JOIN best ON v.stratum = best.stratum AND v.rule = best.rule WHERE x > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.r IS NULL AS kept
FROM b LEFT JOIN bad ON b.r = bad.r
"""

# what the template adds to a turn, and the control strings that it escapes
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
           "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _escaped(text: str) -> str:
    """SQL of an escaped text: control strings share no part, so they may be replaced one after the other."""
    out = f"replace({text}, '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


OP8 = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, row_number() OVER o - 1 AS i, lag(role) OVER o AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS FIRST, role DESC, text DESC) = 1 AS last
  FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
q AS (SELECT *, NOT ((role = 'system' AND before IS NULL) OR (role = 'user' AND (before IS NULL OR before IN ('system', 'assistant')))
    OR (role = 'assistant' AND before IS NOT DISTINCT FROM 'user')) OR (last AND role <> 'assistant') AS problem FROM p)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY i), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length({_escaped('text')}) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
  CAST(sum(CASE WHEN problem THEN 1 ELSE 0 END) AS BIGINT) AS n_problems
FROM q GROUP BY conv_id
"""

OP9 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
w AS (SELECT item_id, least(13, len(words)) AS n, array_to_string(words[s:s + 12], ' ') AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS s FROM i WHERE len(words) > 0)),
n AS (SELECT DISTINCT n FROM w),
places AS (SELECT r, n, s, array_to_string(words[s:s + n - 1], ' ') AS phrase
  FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, n WHERE len(words) >= n)),
hit AS (SELECT r, s, w.n, item_id FROM places JOIN w ON places.phrase = w.phrase AND places.n = w.n),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

# CRC-32 from its polynomial: a table of the 256 bytes' remainders, then a byte at a time
OP11 = r"""
WITH steps AS (SELECT list_transform(range(0, 256), lambda b: list_reduce(range(0, 8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, b::BIGINT)) AS rest),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
w AS (SELECT r, unnest(words) AS word FROM d),
codes AS (SELECT word, hex(word) AS h FROM (SELECT DISTINCT word FROM w UNION SELECT DISTINCT word FROM b)),
bucketed AS (SELECT word, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, x: xor(c >> 8, rest[CAST((xor(c, x) & 255) + 1 AS BIGINT)]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket FROM codes, steps),
s AS (SELECT bucket, count(*) AS n FROM w JOIN bucketed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN bucketed USING (word) GROUP BY bucket),
g AS (SELECT k.bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
    / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT unnest(range(0, 10000)) AS bucket) k LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
totals AS (SELECT r, sum(gain) AS total FROM w JOIN bucketed USING (word) JOIN g USING (bucket) GROUP BY r),
scored AS (SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_features,
  CASE WHEN len(words) = 0 THEN 0 ELSE CAST((total - ((total % len(words)) + len(words)) % len(words)) // len(words) AS BIGINT) END AS weight,
  CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN totals USING (r)),
final AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, n_features) AS rank FROM final WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= (SELECT count(*) FROM drawn) * 10 // 100 THEN rank END AS rank
FROM final LEFT JOIN drawn USING (r)
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, i, lines[i] AS line, translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
common AS (SELECT key, max(doc_id) AS top FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT r, l.doc_id, i, line, top IS NOT NULL AND l.doc_id <> top AS dropped FROM l LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

OP13 = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

SQL = {"op1_warc": OP1, "op6_quality_rules": OP6, "op8_chat": OP8, "op9_decontamination": OP9, "op11_resampling": OP11,
       "op12_line_dedup": OP12, "op13_hard_negatives": OP13}
