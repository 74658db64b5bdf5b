"""DuckDB SQL of the operators whose results SQL expresses."""

from __future__ import annotations

import re

from snapflow.llm.line_rules import BOILERPLATE, SYMBOLS, TERMINAL, LineRules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x20\x09-\x0D]+"

# rows of one id are one document when documents are counted (rows without id: one); each row is judged by itself
LINE_DEDUP = f"""
WITH parts AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT row, doc_id, i, ls[i] AS line, translate(trim(ls[i], {_SPACES}), '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT row, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM parts)),
held AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'none')) >= 5),
judged AS (
  SELECT l.row, l.doc_id, l.i, l.line, (h.key IS NOT NULL AND l.doc_id IS DISTINCT FROM h.keeper) AS gone
  FROM lines l LEFT JOIN held h ON l.key = h.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def line_rules_sql(r: LineRules = LineRules()) -> str:
    # characters outside words are doubled, so that two phrases do not share the one between them
    mark, ends = r"[^\p{L}\p{M}\p{N}]", []
    for p in BOILERPLATE:
        doubled = "".join(re.escape(c) if c.isalnum() else re.escape(c) * 2 for c in p)
        ends.append(f"(?:^|{mark}){doubled}" + (f"(?:$|{mark})" if p[-1].isalnum() else ""))
    phrases = _quoted("|".join(ends))
    hits = f"regexp_extract_all(regexp_replace(lower(line), '({mark})', '\\1\\1', 'g'), {phrases})"
    furniture = f"""(coalesce(list_sum([len(regexp_extract_all(x, '[^ ]+')) FOR x IN {hits}]), 0) > 0
      AND (len(lw) < {r.min_words} OR 100 * coalesce(list_sum([len(regexp_extract_all(x, '[^ ]+')) FOR x IN {hits}]), 0) > {r.max_phrase_pct} * len(lw)))"""
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
win AS (
  SELECT doc_id, i, ws[i:i + {r.window - 1}] AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {r.window - 2})) AS i FROM w WHERE len(ws) >= {r.window})),
twice AS (
  SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + j) AS n
  FROM win JOIN twice USING (doc_id, k), (SELECT unnest(range(0, {r.window})) AS j) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, regexp_extract_all(line, '{_WORD}') AS lw
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
judged AS (
  SELECT doc_id, line, list_sum([length(x) for x in lw]) AS chars,
    (contains({_quoted(TERMINAL)}, right(lw[-1], 1))
      OR (len(lw) >= {r.min_open_words} AND len([x for x in lw if contains('.!?…', right(x, 1))]) > 0))
    AND 100 * (length(line) - length(regexp_replace(line, '[{SYMBOLS}]', '', 'g'))) <= {r.max_symbol_pct} * len(lw)
    AND 100 * len([x for x in lw if contains(x, '!!')]) <= {r.max_shout_pct} * len(lw)
    AND NOT {furniture} AS passes
  FROM lines WHERE len(lw) > 0),
per AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dup, coalesce(sum(chars) FILTER (WHERE passes), 0) AS kept_chars
  FROM judged GROUP BY doc_id),
counted AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in ws]), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(per.dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    coalesce(per.kept_chars, 0) AS kept_chars
  FROM w LEFT JOIN per ON w.doc_id = per.doc_id LEFT JOIN rep ON w.doc_id = rep.doc_id),
based AS (
  SELECT *, (n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_pct} * n_words) AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND 100 * kept_chars >= {r.min_kept_pct} * word_chars) AS kept
FROM based"""
