"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op2_exact_dedup": r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
WINDOW w AS (PARTITION BY text_sha256)
""",
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)
),
again AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, s + o AS i FROM again, range(20) AS r(o)),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.i) AS t FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i
  WHERE gone.i IS NULL GROUP BY word.doc_id
),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
runs AS (SELECT doc_id, count(*) AS n_spans FROM (
  SELECT doc_id, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM gone) WHERE step IS NULL OR step > 1 GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN runs USING (doc_id)
""",
    "op3_mixing": r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('mix-1|' || coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(md5(text), '-')) AS o
  FROM documents
),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM doc GROUP BY source
),
-- hand the excess of the sources that are full to the others until none is above its limit
fill AS (
  SELECT 0 AS step, []::VARCHAR[] AS filled
  UNION ALL
  SELECT step + 1, f FROM (
    SELECT step, filled, (
      SELECT list(coalesce(source, chr(0))) FROM src WHERE list_contains(filled, coalesce(source, chr(0))) OR weight * (
        (SELECT 1.5 * sum(source_size) FROM src) - coalesce((SELECT sum(2.0 * source_size) FROM src WHERE list_contains(filled, coalesce(source, chr(0)))), 0)
      ) / (SELECT sum(weight) FROM src WHERE NOT list_contains(filled, coalesce(source, chr(0)))) > 2.0 * source_size
    ) AS f FROM fill
  ) WHERE f IS NOT NULL AND len(f) > len(filled)
),
full_ AS (SELECT filled FROM fill ORDER BY step DESC LIMIT 1),
level AS (
  SELECT filled, ((SELECT 1.5 * sum(source_size) FROM src) - coalesce((SELECT sum(2.0 * source_size) FROM src WHERE list_contains(filled, coalesce(source, chr(0)))), 0))
    / (SELECT sum(weight) FROM src WHERE NOT list_contains(filled, coalesce(source, chr(0)))) AS l
  FROM full_
),
target AS (
  SELECT source, source_size, n_rows, CASE WHEN list_contains(filled, coalesce(source, chr(0))) THEN 2.0 * source_size ELSE l * weight END AS target FROM src, level
),
-- every quotient of every source, highest first
quotient AS (
  SELECT source, target / (2 * s + 1) AS q, s FROM (SELECT source, target, unnest(range(ceil(source_size / 8.0)::BIGINT)) AS s FROM target WHERE target > 0)
),
won AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, row_number() OVER (ORDER BY q DESC, source NULLS LAST, s) AS r FROM quotient
  ) WHERE r <= (SELECT round(sum(target) / 16) FROM target) GROUP BY source
),
sharded AS (
  SELECT doc.*, target, source_size, quota, ('0x' || o[1:8])::BIGINT % ceil(n_rows / 1000.0)::BIGINT AS shard
  FROM doc JOIN target ON doc.source IS NOT DISTINCT FROM target.source LEFT JOIN won ON doc.source IS NOT DISTINCT FROM won.source
),
part AS (SELECT source, shard, sum(size)::BIGINT AS shard_size, any_value(quota) AS quota FROM sharded GROUP BY source, shard),
part_quotient AS (
  SELECT source, shard, quota, shard_size / (2 * s + 1) AS q, s FROM (SELECT *, unnest(range(ceil(shard_size / 8.0)::BIGINT)) AS s FROM part WHERE shard_size > 0)
),
part_won AS (
  SELECT source, shard, count(*) AS blocks FROM (
    SELECT source, shard, quota, row_number() OVER (PARTITION BY source ORDER BY q DESC, shard, s) AS r FROM part_quotient
  ) WHERE r <= quota GROUP BY source, shard
),
placed AS (
  SELECT s.*, p.shard_size, least(coalesce(b.blocks, 0) * 16, 2 * p.shard_size) AS upto,
    coalesce(sum(size) OVER (PARTITION BY s.source, s.shard ORDER BY o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at_
  FROM sharded s JOIN part p ON s.source IS NOT DISTINCT FROM p.source AND s.shard = p.shard
  LEFT JOIN part_won b ON s.source IS NOT DISTINCT FROM b.source AND s.shard = b.shard
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, upto - at_)) + greatest(0, least(size, upto - at_ - shard_size)))::BIGINT AS taken FROM placed
""",
    "op9_quality_rules": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
tri AS (
  SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, w[s], w[s + 1], w[s + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM d WHERE len(w) >= 3)
),
rep AS (SELECT doc_id, count(DISTINCT s + o) AS n_repeat_words FROM tri, range(3) AS r(o) WHERE n > 1 GROUP BY doc_id),
line AS (
  SELECT doc_id, source, text, x, row_number() OVER (PARTITION BY doc_id, x) > 1 AS again, regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS xw
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
),
dup AS (SELECT doc_id, count(*) FILTER (again) AS n_dup_lines FROM line GROUP BY doc_id),
freq AS (SELECT source, xw, count(DISTINCT text) AS n_docs FROM line GROUP BY source, xw),
bad AS (SELECT source, xw FROM freq WHERE n_docs > 20),
cut AS (SELECT doc_id, sum(len(line.xw))::BIGINT AS removed_words FROM line JOIN bad ON line.source IS NOT DISTINCT FROM bad.source AND line.xw = bad.xw GROUP BY doc_id),
c AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed_words, 0) AS removed_words
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN cut USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= 50 AND n_words - removed_words >= 0.5 * n_words AS kept
FROM c
""",
    "op10_chat_format": r"""
WITH rows_ AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), t AS (
  SELECT *, lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn) || '>' || role AS step,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS is_last,
    length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '</?s>|\[/?(?:SYS|INST|TOOL|ROLE)[\] ]'))
      + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'tool' THEN 15 WHEN 'assistant' THEN 9 ELSE 16 + length(role) END AS chars
  FROM rows_
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and(step IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'user>tool', 'assistant>user', 'assistant>tool', 'tool>assistant'))
    AND bool_or(is_last AND role = 'assistant') AS valid
FROM t GROUP BY conv_id
""",
    "op11_source_divergence": r"""
WITH doc AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
one AS (SELECT r, lang, source, t, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS t FROM doc) GROUP BY r, lang, source, t),
known AS (SELECT lang, t, sum(n)::HUGEINT AS lang_n FROM one GROUP BY lang, t HAVING count(*) >= 10),
held AS (SELECT lang, source, t, sum(n)::HUGEINT AS n FROM one SEMI JOIN known USING (lang, t) GROUP BY lang, source, t),
total AS (SELECT lang, source, sum(n) AS total FROM held GROUP BY lang, source),
lang AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM known GROUP BY lang),
grp AS (SELECT g.lang, g.source, coalesce(total, 0)::HUGEINT AS total, v, lang_total FROM (SELECT DISTINCT lang, source FROM doc) g
  LEFT JOIN total ON total.lang = g.lang AND total.source = g.source LEFT JOIN lang ON lang.lang = g.lang),
every AS (SELECT grp.lang, grp.source, known.t, coalesce(held.n, 0) AS n, 1 + (1000000000 * (coalesce(held.n, 0) + 2)) // (total + 2 * v) AS p,
  1 + (1000000000 * (lang_n + 2)) // (lang_total + 2 * v) AS q FROM grp JOIN known ON known.lang = grp.lang
  LEFT JOIN held ON held.lang = grp.lang AND held.source = grp.source AND held.t = known.t),
priced AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM every a JOIN every b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced ON priced.lang = a.lang AND priced.source = a.source AND priced.item = b.source),
term AS (SELECT lang, source, 'term' AS part, t AS item, ((p - q) * (p - q)) // (p + q) AS value FROM every WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op13_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS w,
  [('0x' || substr(h, 1, 8))::UBIGINT, ('0x' || substr(h, 9, 8))::UBIGINT, ('0x' || substr(h, 17, 8))::UBIGINT, ('0x' || substr(h, 25, 8))::UBIGINT] AS r FROM d),
cut AS (SELECT *, len(w) AS n, least(r[1] % (len(w) + 1)::UBIGINT, r[2] % (len(w) + 1)::UBIGINT)::BIGINT AS a,
  greatest(r[1] % (len(w) + 1)::UBIGINT, r[2] % (len(w) + 1)::UBIGINT)::BIGINT AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
    WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
part AS (SELECT doc_id, text, n, form, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM part
""",
}
