"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
_SPACED = "'[^\\x20\\x09-\\x0D]+'"

def _round(k: int) -> str:
    """One round of votes of the distinct lines that belong to no template yet."""
    return f"""
), mode{k} AS (
  SELECT leaf, spot, min(struct_pack(a := -n, token := token)).token AS token FROM (
    SELECT leaf, spot, token, count(*) AS n FROM (
      SELECT leaf, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS spot FROM rest{k}
    ) GROUP BY leaf, spot, token
  ) GROUP BY leaf, spot
), shape{k} AS (
  SELECT leaf, list(token ORDER BY spot) AS shape FROM mode{k} GROUP BY leaf
), judged{k} AS (
  SELECT leaf, line, tokens, len(list_filter(list_zip(tokens, shape), lambda x: x[1] = x[2])) >= 0.7 * len(tokens) AS agrees
  FROM rest{k} JOIN shape{k} USING (leaf)
), rest{k + 1} AS (
  SELECT leaf, line, tokens FROM judged{k} WHERE NOT agrees"""


OP3 = """
WITH RECURSIVE raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), masked AS (
  SELECT doc_id, pos, trim(regexp_replace(regexp_replace(line, '[^ \\t\\x0B\\f\\r]*[0-9][^ \\t\\x0B\\f\\r]*', '<*>', 'g'), '[ \\t\\x0B\\f\\r]+', ' ', 'g'), ' ') AS line
  FROM raw
), parsed AS (
  SELECT doc_id, pos, line, string_split(line, ' ') AS tokens FROM masked WHERE line <> ''
), named AS (
  SELECT *, concat_ws(' ', len(tokens), array_to_string(tokens[1:3], ' ')) AS leaf FROM parsed
), open AS (
  SELECT leaf FROM named GROUP BY leaf HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT line) > 1
), rest0 AS (
  SELECT DISTINCT leaf, line, tokens FROM named SEMI JOIN open USING (leaf)""" + "".join(_round(k) for k in range(2)) + """
), judged2(k, leaf, line, tokens, agrees, part) AS (  -- from the third round on, lines that do not agree part and vote again
  SELECT 1, leaf, line, tokens, false, leaf FROM rest2
  UNION ALL (
    WITH rest AS (
      SELECT k + 1 AS k, part AS leaf, line, tokens FROM judged2 WHERE NOT agrees
    ), votes AS (
      SELECT leaf, spot, token, count(*) AS n FROM (
        SELECT leaf, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS spot FROM rest
      ) GROUP BY leaf, spot, token
    ), mode AS (
      SELECT leaf, spot, min(struct_pack(a := -n, token := token)).token AS token, count(*) AS kinds FROM votes GROUP BY leaf, spot
    ), shape AS (
      SELECT leaf, list(token ORDER BY spot) AS shape, (min(struct_pack(kinds := kinds, spot := spot)) FILTER (WHERE kinds > 1)).spot AS spot
      FROM mode GROUP BY leaf
    )
    SELECT k, leaf, line, tokens, len(list_filter(list_zip(tokens, shape), lambda x: x[1] = x[2])) >= 0.7 * len(tokens),
           concat_ws(' ', leaf, spot, tokens[spot])
    FROM rest JOIN shape USING (leaf)
  )
), general AS (
  SELECT line, 'leaf 0 ' || leaf AS template FROM judged0 WHERE agrees
  UNION ALL SELECT line, 'leaf 1 ' || leaf FROM judged1 WHERE agrees
  UNION ALL SELECT line, 'leaf ' || k || ' ' || leaf FROM judged2 WHERE agrees
), templates AS (
  SELECT doc_id, pos, coalesce(g.template, 'line ' || line) AS template FROM named LEFT JOIN general g USING (line)
), recurring AS (
  SELECT template, min(doc_id) AS keeper FROM templates GROUP BY template HAVING count(DISTINCT doc_id) >= 3
), gone AS (
  SELECT doc_id, pos FROM templates JOIN recurring USING (template) WHERE doc_id > keeper
), kept AS (
  SELECT r.doc_id, coalesce(string_agg(r.line, chr(10) ORDER BY r.pos) FILTER (WHERE g.pos IS NULL), '') AS text,
         count(*) AS n_lines, count(g.pos) AS n_dropped
  FROM raw r LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.pos = g.pos GROUP BY r.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN sha256(k.text) END AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

OP7 = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS part
  FROM item, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS part
  FROM doc, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)
), hits AS (
  SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, part)
), hit_words AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP9 = f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS part FROM doc, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)
), firsts AS (
  SELECT part, min(doc_id) AS first_id FROM windows GROUP BY part HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS spot FROM windows JOIN firsts USING (part) WHERE doc_id > first_id
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS spot FROM doc
), kept AS (
  SELECT doc_id, count(g.spot) AS n_removed, string_agg(word, ' ' ORDER BY words.spot) FILTER (WHERE g.spot IS NULL) AS text
  FROM words LEFT JOIN gone g USING (doc_id, spot) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

OP13 = f"""
WITH doc AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents
), full_doc AS (
  SELECT k, doc_id, w, len(w) AS n FROM doc WHERE len(w) > 0
), size AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM full_doc
), posting AS (
  SELECT k, n, term, count(*) AS tf FROM (SELECT k, n, unnest(w) AS term FROM full_doc) GROUP BY k, n, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS wt FROM posting, size GROUP BY term
), item AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM benchmark
), query AS (
  SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest(w) AS term FROM item) GROUP BY item_id, term
), scored AS (
  SELECT item_id, k, sum(repeats * wt * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM query JOIN weight USING (term) JOIN posting USING (term), size GROUP BY item_id, k
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored JOIN full_doc USING (k) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {"op3_line_templates": OP3, "op7_decontaminate": OP7, "op9_substrings": OP9, "op13_ranked_search": OP13}
