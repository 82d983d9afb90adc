"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

from tidewatch.llm.secrets import BASE_RULES, MORE_RULES

SUBSTRINGS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS k FROM w, unnest(range(1, len(ws) - 18)) AS t(p)
        WHERE len(ws) >= 20),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM win)
          WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p + o AS q FROM later, range(0, 20) AS r(o)),
each_word AS (SELECT doc_id, q, ws[q] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(q)),
kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.q) AS text, count(*) AS n
         FROM each_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.q = g.q GROUP BY e.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""

LINES = r"""
WITH l AS (
  SELECT doc_id, i, parts[i] AS raw, trim(parts[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS s
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       unnest(range(1, len(parts) + 1)) AS t(i)),
d AS (SELECT s, length(s) AS n, row_number() OVER (ORDER BY doc_id, i) AS place FROM (
        SELECT s, doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM l WHERE s <> '')
      WHERE k = 1),
half AS (
  SELECT s, n, place, unnest([n || '<' || left(s, n // 2), n || '>' || substr(s, n // 2 + 1),
    (n - 1) || '<' || left(s, (n - 1) // 2), (n - 1) || '>' || right(s, n - 1 - (n - 1) // 2)]) AS k
  FROM d WHERE n >= 20),
pair AS (SELECT DISTINCT a.s AS early, b.s AS late FROM half a JOIN half b ON a.k = b.k
         WHERE a.place < b.place AND abs(a.n - b.n) <= 1),
near AS (
  SELECT DISTINCT late FROM pair, unnest(range(0, greatest(length(early), length(late)))) AS t(p)
  WHERE left(early, p) = left(late, p) AND substr(early, p + CASE WHEN length(early) >= length(late) THEN 2 ELSE 1 END)
    = substr(late, p + CASE WHEN length(late) >= length(early) THEN 2 ELSE 1 END)),
judged AS (
  SELECT doc_id, i, raw, s <> '' AS counted,
         s <> '' AND (row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 OR s IN (SELECT late FROM near)) AS gone
  FROM l)
SELECT doc_id, count(*) FILTER (counted) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws, least(10, len(ws)) AS n FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS k
       FROM b, unnest(range(1, len(ws) - n + 2)) AS t(p) WHERE n > 0),
dw AS (SELECT doc_id, p, n, array_to_string(ws[p:p + n - 1], ' ') AS k
       FROM d, (SELECT DISTINCT n FROM iw) AS sizes, unnest(range(1, len(ws) - n + 2)) AS t(p) WHERE len(ws) >= n),
found AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.n = iw.n),
hit AS (SELECT doc_id, count(DISTINCT p + o) AS n_hit FROM found, range(0, 10) AS r(o) WHERE o < n GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""


def _secrets() -> str:
    each = []
    for kind, rule in enumerate((*BASE_RULES, *MORE_RULES)):
        pattern = rule.pattern.replace("'", "''")
        each.append(
            f"""SELECT doc_id, {kind} AS kind, '{rule.name}' AS name, i, length(gaps[i]) AS gap, length(found[i]) AS n,
  length(parts[i]) >= {rule.least} AS enough
FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '{pattern}') AS gaps,
        regexp_extract_all(coalesce(text, ''), '{pattern}', 0) AS found,
        regexp_extract_all(coalesce(text, ''), '{pattern}', {rule.group}) AS parts FROM documents),
     unnest(range(1, len(found) + 1)) AS t(i)"""
        )
    base = len(BASE_RULES)
    return f"""
WITH m AS ({" UNION ALL ".join(each)}),
placed AS (SELECT *, sum(gap + n) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM m),
spans AS (SELECT doc_id, kind, stop - n AS start, name || ':' || (stop - n)::BIGINT || ':' || stop::BIGINT AS span
          FROM placed WHERE enough),
told AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
           count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY start, kind) FILTER (kind < {base}) AS base,
           string_agg(span, ',' ORDER BY start, kind) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN told ON d.doc_id = told.doc_id"""


EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
           FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER ranked)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW ranked AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER ranked <= 5"""


ORACLE = {
    "op3_substring_dedup": SUBSTRINGS,
    "op4_line_dedup": LINES,
    "op9_decontamination": DECONTAMINATION,
    "op10_secret_scan": _secrets(),
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_exact_dedup": EXACT,
}
