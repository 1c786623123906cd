"""The queries in SQL, where SQL can express them."""

from __future__ import annotations

from clickloom.llm import quality_rules as q

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RUN = r"[^\x20\x09-\x0D]+"

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, source, i, line, trim(regexp_replace(line, '[ \x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
          unnest(range(len(string_split(text, chr(10))))) AS i
        FROM documents)),
counted AS (
  SELECT *, plain <> '' AND len(plain) - len(replace(plain, ' ', '')) >= 2 AS counts FROM lines),
spread AS (
  SELECT plain, min(doc_id) AS first_id FROM counted WHERE counts
  GROUP BY plain HAVING count(DISTINCT source) >= 5),
marked AS (
  SELECT c.*, c.counts AND s.plain IS NOT NULL AND c.doc_id <> s.first_id AS gone
  FROM counted c LEFT JOIN spread s ON c.plain = s.plain)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""

BENCHMARK_HITS = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS win
  FROM (SELECT item_id, ws, least(10, len(ws)) AS size,
          unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
        FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, size, i, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS win
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM w, (SELECT DISTINCT size FROM bw) WHERE len(ws) >= size)),
hits AS (
  SELECT doc_id, i, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id LEFT JOIN items t ON w.doc_id = t.doc_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{_RUN}') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS g
  FROM (SELECT doc_id, ws, least(4, len(ws)) AS size,
          unnest(range(1, len(ws) - least(4, len(ws)) + 2)) AS i
        FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM inter JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
sym AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM w UNION
  SELECT r.doc_id, s.y FROM reach r JOIN sym s ON r.seen = s.x),
comp AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN comp ON w.doc_id = comp.doc_id LEFT JOIN n ON w.doc_id = n.doc_id
"""


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _concat_chars(s: str) -> str:
    """A text literal with control characters written by their codes."""
    parts = [f"chr({ord(c)})" if ord(c) < 32 else _text(c) for c in s]
    return " || ".join(parts)


def _word_list(words: list[str]) -> str:
    return "[" + ", ".join(map(_text, words)) + "]"


def _distance(left: str, n_left: str, right: str, n_right: str) -> str:
    x, y = f"({left}[i] / {n_left})", f"({right}[i] / {n_right})"
    part = lambda v: f"CASE WHEN {v} > 0 THEN {v} * log2({v} / (({x} + {y}) / 2)) ELSE 0 END"
    terms = f"list_transform(range(1, len({left}) + 1), lambda i: {part(x)} + {part(y)})"
    return f"sqrt(greatest(list_sum({terms}) / 2, 0))"


def _quality_rules() -> str:
    classes = (q.SPACE, *q.CLASSES)
    counts = ", ".join(
        f"len(t) - len(translate(t, {_concat_chars(c)}, ''))" for c in classes
    )
    lists = " ".join(
        f"WHEN lang = {_text(k)} THEN {_word_list(v)}" for k, v in q.COMMON_WORDS.items()
    )
    n_bins, n_words = len(classes) + 1, len(q.ALL_COMMON)
    sums = lambda name, n: ", ".join(f"sum({name}[{i + 1}])" for i in range(n))
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, regexp_extract_all(t, '{_RUN}') AS ws,
    regexp_extract_all(lower(translate(t, {_concat_chars(q.PUNCTUATION)}, '')), '{_RUN}') AS plain,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls,
    [{counts}] AS cls,
    CASE {lists} ELSE {_word_list(q.ALL_COMMON)} END AS listed
  FROM base),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n
  FROM (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 2), ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM split WHERE len(ws) >= 3))),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM win WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT s.doc_id, lang, len(t) AS n_chars, len(ws) AS n_words, len(t) - cls[1] AS word_chars,
    cls[2] AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(n_repeat, 0) AS n_repeat_words,
    list_append(cls, len(t) - list_sum(cls)) AS chars,
    list_transform(listed, lambda x: len(list_filter(plain, lambda w: w = x))) AS common,
    len(ws) < {q.MIN_WORDS}
      OR 100 * coalesce(n_repeat, 0) > {q.REPEAT_PERCENT} * len(ws) AS base_failed
  FROM split s LEFT JOIN rep r ON s.doc_id = r.doc_id),
ref AS (
  SELECT lang, [{sums('chars', n_bins)}] AS r_chars, [{sums('common', n_words)}] AS r_common,
    sum(n_chars) AS r_n_chars, sum(n_words) AS r_n_words
  FROM m WHERE NOT base_failed GROUP BY lang),
j AS (
  SELECT m.*, r_chars, r_n_chars, r_n_words,
    list_append(common, n_words - list_sum(common)) AS words,
    list_append(r_common[1:len(common)], r_n_words - list_sum(r_common[1:len(common)])) AS r_words
  FROM m LEFT JOIN ref ON m.lang = ref.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(
    (n_words >= {q.CHAR_TEST_WORDS}
      AND {_distance('chars', 'n_chars', 'r_chars', 'r_n_chars')} > {q.MAX_CHAR_DISTANCE})
    OR (n_words >= {q.WORD_TEST_WORDS}
      AND {_distance('words', 'n_words', 'r_words', 'r_n_words')} > {q.MAX_WORD_DISTANCE}), FALSE) AS kept
FROM j
"""


ORACLES = {
    "op6_line_dedup": LINE_DEDUP,
    "op7_benchmark_hits": BENCHMARK_HITS,
    "op8_quality_rules": _quality_rules(),
    "op9_near_duplicates": NEAR_DUPLICATES,
}
