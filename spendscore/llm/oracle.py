"""DuckDB SQL for the queries of this subpackage that SQL can express.

Written from the definitions, not from the operators: pairs are compared by brute
force, repeated windows are found by their text, and so on.
"""

from __future__ import annotations

from spendscore.llm.licenses import TEMPLATES

#: Words between blanks, and words of letters and digits.
BLANK_WORDS = r"'[^\x20\x09-\x0D]+'"
PLAIN_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Components of ``link(a, b)`` (both directions) over ``node(id)``.
COMPONENTS = """
reach(id, other) AS (
  SELECT id, id FROM node
  UNION
  SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.other
),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

OP1 = f"""
WITH RECURSIVE vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
),
unit AS (
  SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS u FROM vec
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(v, v) > 0
),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM unit x JOIN unit y
  ON x.vec_id <> y.vec_id AND len(x.u) = len(y.u) AND list_inner_product(x.u, y.u) >= 0.95
),
node AS (SELECT vec_id AS id FROM embeddings),
{COMPONENTS}
SELECT id AS vec_id, (SELECT count(*) FROM link WHERE a = id) AS n_links, component_id, component_id = id AS kept FROM component
"""

OP2 = f"""
WITH RECURSIVE word AS (SELECT doc_id, regexp_extract_all({LOWER}, {BLANK_WORDS}) AS w FROM documents),
gram AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(greatest(1, len(w) - 2)),
    lambda i: array_to_string(w[i + 1:i + 3], chr(31))))) AS g
  FROM word WHERE len(w) > 0
),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
rare AS (SELECT g FROM gram GROUP BY g HAVING count(*) > 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m
  FROM gram x JOIN rare USING (g) JOIN gram y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL
),
link AS (
  SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * m >= 90 * (p.n + q.n - m)
),
node AS (SELECT doc_id AS id FROM documents),
{COMPONENTS}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id FROM component LEFT JOIN size ON size.doc_id = id
"""

OP3 = """
WITH page AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
named AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY h, payload_bytes) AS last,
    array_to_string(flatten(list_transform(range(8), lambda i: list_transform([15, 10, 5, 0],
      lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) >> s) & 31), 1)))), '') AS payload_digest
  FROM page
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM named
"""

#: Lines left of ``doc(doc_id, text)`` after the cuts: (doc_id, text, n_lines, n_cut).
LINE_CUTS = """
line AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM doc)
),
full_line AS (
  SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(13)) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM line WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
),
win AS (
  SELECT x.doc_id, x.k, x.i AS f, z.i AS u, x.t AS a, y.t AS b, z.t AS c
  FROM full_line x JOIN full_line y ON y.doc_id = x.doc_id AND y.k = x.k + 1 JOIN full_line z ON z.doc_id = x.doc_id AND z.k = x.k + 2
),
later AS (
  SELECT doc_id, f, u FROM (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS turn FROM win) WHERE turn > 1
),
cut AS (SELECT DISTINCT doc_id, unnest(range(f, u + 1)) AS i FROM later),
left_over AS (
  SELECT line.doc_id, coalesce(string_agg(line, chr(10) ORDER BY line.i) FILTER (WHERE cut.i IS NULL), '') AS text,
    count(*) AS n_lines, count(cut.i) AS n_cut
  FROM line LEFT JOIN cut ON cut.doc_id = line.doc_id AND cut.i = line.i GROUP BY line.doc_id
)
"""

OP5 = f"""
WITH doc AS (SELECT doc_id, text FROM documents),
{LINE_CUTS}
SELECT doc_id, left_over.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_cut, 0) AS n_cut
FROM documents LEFT JOIN left_over USING (doc_id)
"""

#: Passages of ``benchmark`` in ``doc(doc_id, text)``: every alignment with enough equal words, compared window by window.
PASSAGES = f"""
doc_word AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS pos FROM (SELECT doc_id, regexp_extract_all({LOWER}, {PLAIN_WORDS}) AS w FROM doc)),
item AS (SELECT item_id, regexp_extract_all({LOWER}, {PLAIN_WORDS}) AS w FROM benchmark),
item_word AS (SELECT item_id, len(w) AS n, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS pos FROM item WHERE len(w) >= 5),
equal AS (
  SELECT doc_id, item_id, n, d.pos - i.pos AS shift, i.pos AS pos FROM doc_word d JOIN item_word i USING (t)
),
alignment AS (
  SELECT doc_id, item_id, n, least(n, 13) AS span, shift, count(*) AS n_equal_item, list_sort(list(pos)) AS places
  FROM equal GROUP BY doc_id, item_id, n, shift HAVING 100 * count(*) >= 80 * least(n, 13)
),
part AS (
  SELECT doc_id, item_id, n, span, shift, n_equal_item, s, len(list_filter(places, lambda p: p >= s AND p < s + span)) AS n_equal
  FROM (SELECT *, unnest(range(n - span + 1)) AS s FROM alignment)
),
passage AS (
  SELECT doc_id, item_id, arg_max({{'start': shift + s, 'n_equal': n_equal, 'span': span, 'n_equal_item': n_equal_item, 'n_item': n}},
    (n_equal, n_equal_item, -(shift + s))) AS p
  FROM part WHERE 100 * n_equal >= 80 * span GROUP BY doc_id, item_id
)
"""

OP8 = f"""
WITH doc AS (SELECT doc_id, text FROM documents),
{PASSAGES}
SELECT doc_id, item_id, CAST(p.start AS INTEGER) AS start, CAST(p.n_equal AS INTEGER) AS n_equal, CAST(p.span AS INTEGER) AS span,
  CAST(p.n_equal AS DOUBLE) / p.span AS overlap, CAST(p.n_equal_item AS INTEGER) AS n_equal_item, CAST(p.n_item AS INTEGER) AS n_item
FROM passage
"""


def mixture(entropy: float, repeats: float, budget: float) -> str:
    """Draws of ``doc(doc_id, text, source)``: (doc_id, source, n_tokens, block, place)."""
    return f"""
sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {BLANK_WORDS})) AS n_tokens FROM doc),
source_size AS (SELECT source, sum(n_tokens) AS tokens FROM sized WHERE n_tokens > 0 GROUP BY source),
share AS (SELECT source, tokens, tokens / (SELECT sum(tokens) FROM source_size) AS p FROM source_size),
entropy_step(k, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT k + 1, CASE WHEN below THEN low ELSE (low + high) / 2 END, CASE WHEN below THEN (low + high) / 2 ELSE high END
  FROM (SELECT k, low, high, (SELECT ln(sum(pow(p, (low + high) / 2))) - (low + high) / 2 * sum(pow(p, (low + high) / 2) * ln(p)) / sum(pow(p, (low + high) / 2))
    < {entropy} * ln(count(*)) FROM share) AS below FROM entropy_step WHERE k < 24)
),
repeat_step(k, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT k + 1, CASE WHEN fits THEN low ELSE (low + high) / 2 END, CASE WHEN fits THEN (low + high) / 2 ELSE high END
  FROM (SELECT k, low, high, (SELECT max(pow(p, (low + high) / 2 - 1)) * {budget} / sum(pow(p, (low + high) / 2)) <= {repeats} + 1e-6 FROM share) AS fits
    FROM repeat_step WHERE k < 24)
),
chosen AS (
  SELECT CASE WHEN (SELECT count(*) FROM share) < 2 THEN 1 ELSE round(greatest(
    CASE WHEN (SELECT -sum(p * ln(p)) >= {entropy} * ln(count(*)) FROM share) THEN 1 ELSE (SELECT high FROM entropy_step WHERE k = 24) END,
    CASE WHEN (SELECT max(1 / p) * {budget} / count(*) <= {repeats} + 1e-6 FROM share) THEN 0 ELSE (SELECT high FROM repeat_step WHERE k = 24) END), 6) END AS a
),
wanted AS (
  SELECT source, tokens, CAST(floor(pow(p, a) / (SELECT sum(pow(p, a)) FROM share, chosen) * {budget} * (SELECT sum(tokens) FROM share) + 1e-6) AS BIGINT) AS w
  FROM share, chosen
),
plan AS (SELECT source, w // CAST(tokens AS BIGINT) AS whole, w % CAST(tokens AS BIGINT) AS rest FROM wanted),
last_block AS (
  SELECT doc_id, s.source, n_tokens, whole, rest, sum(n_tokens) OVER (PARTITION BY s.source ORDER BY md5(doc_id || ':' || whole)) AS through
  FROM sized s JOIN plan ON plan.source IS NOT DISTINCT FROM s.source WHERE n_tokens > 0
),
draw AS (
  SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(block AS BIGINT) AS block, md5(doc_id || ':' || block) AS place
  FROM (SELECT *, unnest(range(whole + CASE WHEN through <= rest THEN 1 ELSE 0 END)) AS block FROM last_block)
)
"""


OP9 = f"WITH RECURSIVE doc AS (SELECT doc_id, text, source FROM documents), {mixture(0.97, 4.0, 1.0)} SELECT doc_id, source, n_tokens, block, place FROM draw"


def _license_sql() -> str:
    rows = ", ".join(
        f"({k}, '{t.label}', string_split('{t.words}', ' '), string_split('{t.key}', ' '), {t.key_start}, {t.base})" for k, t in enumerate(TEMPLATES)
    )
    return f"""
WITH doc AS (SELECT doc_id, regexp_extract_all({LOWER}, {PLAIN_WORDS}) AS w FROM documents),
template(k, label, words, key, lead, base) AS (VALUES {rows}),
word AS (SELECT doc_id, w, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS pos FROM doc),
found AS (
  SELECT doc_id, pos, label, base, len(list_filter(range(len(words)), lambda j: w[pos - lead + j + 1] = words[j + 1] AND pos - lead + j >= 0)) / len(words) AS share
  FROM word JOIN template ON t = key[1] WHERE w[pos + 1:pos + len(key)] = key
),
summed AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(pos) FILTER (WHERE base) AS first_word, max(pos) FILTER (WHERE base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM found GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM doc LEFT JOIN summed USING (doc_id)
"""

#: Main text of pages that mark it by an article element of headings and paragraphs, as the given ones do.
OP12 = r"""
WITH part AS (
  SELECT page_id, url, regexp_split_to_array(
    regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1), '</?(?:p|h1)>') AS raw
  FROM pages
),
block AS (
  SELECT page_id, url, list_filter(list_transform(raw, lambda x: trim(regexp_replace(
    regexp_replace(regexp_replace(replace(regexp_replace(x, '</?b>', '', 'g'), '<br>', ' '), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
    '[\s\x{00A0}]+', ' ', 'g'))), lambda x: x <> '') AS blocks
  FROM part
),
joined AS (SELECT page_id, url, array_to_string(blocks, chr(10) || chr(10)) AS text FROM block)
SELECT page_id, url, text, length(text) AS n_chars FROM joined
"""

OP13 = """
WITH usable AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
),
usual AS (SELECT len(x) AS d FROM usable GROUP BY 1 ORDER BY count(*) DESC, d DESC LIMIT 1),
vec AS (SELECT DISTINCT vec_id, label, x FROM usable, usual WHERE len(x) = d),
scored AS (
  SELECT DISTINCT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM vec a, vec b WHERE a.vec_id % 100 = 0
),
positive AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor_label ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER own AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positive p JOIN scored s USING (anchor_id, anchor_label)
WHERE s.label <> anchor_label AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW own AS (PARTITION BY anchor_id, anchor_label, positive_id, positive_score ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER own <= 5
"""


ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": OP1,
    "op2_ngram_jaccard_join": OP2,
    "op3_warc": OP3,
    "op5_line_dedup": OP5,
    "op8_benchmark_decontamination": OP8,
    "op9_mixing": OP9,
    "op10_license_scan": _license_sql(),
    "op12_html_extraction": OP12,
    "op13_hard_negatives": OP13,
}
