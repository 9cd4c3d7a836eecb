"""The quality rules as DuckDB SQL, from the same parameters."""

from __future__ import annotations

from tidemark.llm.quality_rules import ERROR, RISK, RULES, STRATA

_GRID = ", ".join(f"('{r.measure}', {j}, {c}::DOUBLE)" for r in RULES for j, c in enumerate(r.cutoffs))
_LONG = " UNION ALL ".join(f"SELECT rid, stratum, '{r.measure}' AS measure, {r.measure} AS v FROM m WHERE NOT base_failed" for r in RULES)
_BROKEN = ", ".join(f"CASE WHEN max(CASE WHEN c.measure = '{r.measure}' THEN {r.measure} > cutoff END) THEN '{r.measure}' END" for r in RULES)
_MOST = max(len(r.cutoffs) for r in RULES)
_KNOWN = ", ".join(f"'{s}'" for s in STRATA[:-1])

SQL = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN lang IN ({_KNOWN}) THEN lang ELSE '{STRATA[-1]}' END AS stratum, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
places AS (SELECT rid, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w),
windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n FROM places),
marked AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM windows, range(3) r(k) WHERE n > 1 GROUP BY 1),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM w),
dups AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
b AS MATERIALIZED (
  SELECT w.rid, doc_id, stratum, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
  FROM w LEFT JOIN marked USING (rid) LEFT JOIN dups USING (rid)),
m AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, coalesce(n_symbols / nullif(word_chars, 0), 0.0) AS symbol_share,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0.0) AS dup_line_share, coalesce(n_repeat_words / nullif(n_words, 0), 0.0) AS repeat_share,
         coalesce(n_upper / nullif(word_chars, 0), 0.0) AS upper_share, coalesce(word_chars / nullif(n_words, 0), 0.0) AS mean_word_chars
  FROM b),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY 1 HAVING min(quality) = 1),
long AS (SELECT l.* FROM ({_LONG}) l JOIN m USING (rid) JOIN good USING (doc_id)),
texts AS MATERIALIZED (SELECT DISTINCT stratum, md5(t) AS key, md5(t) < '8' AS aim, measure, v FROM long JOIN w USING (rid, stratum)),
grid(measure, step, cutoff) AS (VALUES {_GRID}),
lost AS (SELECT stratum, measure, step, count(*) AS n, count(*) FILTER (v > cutoff) AS k FROM texts JOIN grid USING (measure) WHERE aim GROUP BY 1, 2, 3),
aims AS (SELECT stratum, measure, max(step) AS aim FROM lost WHERE k <= {RISK}::DOUBLE / {2 * len(RULES)} * n GROUP BY 1, 2),
settings AS MATERIALIZED (SELECT stratum, short, measure, cutoff FROM aims JOIN grid g USING (measure) CROSS JOIN range({_MOST}) r(short) WHERE g.step = aim - short),
ready AS (SELECT DISTINCT stratum FROM lost),
tested AS (SELECT stratum, key, short, coalesce(bool_or(v > cutoff), false) AS over FROM texts JOIN ready USING (stratum) CROSS JOIN range({_MOST}) r(short)
  LEFT JOIN settings s USING (stratum, short, measure) WHERE NOT texts.aim GROUP BY 1, 2, 3),
counts AS MATERIALIZED (SELECT stratum, short, count(*) AS n, count(*) FILTER (over) AS k FROM tested GROUP BY 1, 2),
tails AS (SELECT *, CASE WHEN k > n * {RISK}::DOUBLE THEN 1 ELSE (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({RISK}::DOUBLE) + (n - i) * ln(1 - {RISK}::DOUBLE))) FROM range(k + 1) r(i)) END AS p FROM counts),
tried AS (SELECT *, max(p > {ERROR}::DOUBLE / {len(STRATA)}) OVER (PARTITION BY stratum ORDER BY short DESC) AS failed FROM tails),
best AS (SELECT stratum, min(short) AS short FROM tried WHERE NOT failed GROUP BY 1),
cuts AS (SELECT stratum, measure, cutoff FROM settings JOIN best USING (stratum, short)),
judged AS (
  SELECT rid, any_value(doc_id) AS doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
         any_value(n_dup_lines) AS n_dup_lines, any_value(n_repeat_words) AS n_repeat_words, any_value(base_failed) AS base_failed,
         concat_ws(',', {_BROKEN}) AS broken
  FROM m LEFT JOIN cuts c USING (stratum) GROUP BY rid)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND broken = '' AS kept, broken
FROM judged
"""
