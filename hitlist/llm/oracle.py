"""DuckDB twins of the operators that SQL can express, over the same whole tables.

They work on rows of words, windows and shingles, not in the way of the operators."""

from __future__ import annotations

ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TEXT = "coalesce(text, '')"
#: Words between ASCII white space; words of letters, digits and non-ASCII characters.
SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
PLAIN = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {SPACED.format(ASCII_LOWER.format(TEXT))} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b, s.n = x.n AND s.n = y.n AS same FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY 1),
copies AS (SELECT a, count(*) AS n, min(b) AS first FROM links WHERE same GROUP BY 1),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1),
others AS (
  SELECT l.a, count(DISTINCT least(coalesce(c.first, l.b), l.b)) AS n
  FROM links l LEFT JOIN copies c ON c.a = l.b WHERE NOT same GROUP BY 1)
SELECT d.doc_id, least(coalesce(root, d.doc_id), d.doc_id) AS class_id,
       least(coalesce(copies.first, d.doc_id), d.doc_id) AS text_id,
       coalesce(copies.n, 0) + 1 AS n_copies, coalesce(counts.n, 0) AS n_links, coalesce(others.n, 0) AS n_linked_texts
FROM documents d LEFT JOIN roots ON roots.a = d.doc_id LEFT JOIN copies ON copies.a = d.doc_id
LEFT JOIN counts ON counts.a = d.doc_id LEFT JOIN others ON others.a = d.doc_id
"""

OP3 = f"""
WITH words AS (SELECT doc_id, {SPACED.format(TEXT)} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
judged AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) < doc_id AS gone FROM windows),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM judged WHERE gone),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT p.doc_id, count(r.p) AS n_removed, string_agg(word, ' ' ORDER BY p.p) FILTER (r.p IS NULL) AS t
  FROM placed p LEFT JOIN removed r ON r.doc_id = p.doc_id AND r.p = p.p GROUP BY 1)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id
"""

OP5 = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {PLAIN.format(ASCII_LOWER.format(TEXT))} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(g) AS n FROM grams),
docs AS (SELECT doc_id, {PLAIN.format(ASCII_LOWER.format(TEXT))} AS w FROM documents),
windows AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM windows JOIN grams USING (g)),
places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(places.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, places.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN places ON places.doc_id = docs.doc_id LEFT JOIN listed ON listed.doc_id = docs.doc_id
"""

_RULES = ["too_short", "repetitive", "symbols", "dup_lines"]


def _shrunk(rule: str) -> str:
    m, v = f"m_{rule}", f"v_{rule}"
    strength = f"coalesce(greatest(1.0, least(1000.0, CASE WHEN {v} <> 0 THEN {m} * (1 - {m}) / {v} - 1 END)), 1000.0)"
    return f"({rule} + {m} * {strength}) / (n + {strength})"


OP10 = rf"""
WITH docs AS (
  SELECT doc_id, source AS host, {TEXT} AS t, {SPACED.format(TEXT)} AS w,
         list_filter(string_split({TEXT}, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) > 2)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM windows WHERE n > 1) GROUP BY 1),
counted AS (
  SELECT docs.doc_id, host, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(n, 0) AS n_repeat_words
  FROM docs LEFT JOIN repeated ON repeated.doc_id = docs.doc_id),
failed AS (
  SELECT *, n_words < 50 AS too_short, 100 * n_repeat_words > 50 * n_words AS repetitive,
         n_symbols > 0.5 * n_words AS symbols, n_dup_lines > 0.5 * n_lines AS dup_lines FROM counted),
hosts AS (
  SELECT host, count(*) AS n, {", ".join(f"sum(CAST({r} AS INT)) AS {r}" for r in _RULES)} FROM failed GROUP BY 1),
prior AS (
  SELECT {", ".join(f"sum({r}) / sum(n) AS m_{r}, sum({r} * {r} / n) / sum(n) - (sum({r}) / sum(n)) ** 2 AS v_{r}" for r in _RULES)}
  FROM hosts),
verdicts AS (SELECT host, greatest({", ".join(map(_shrunk, _RULES))}) > 0.9 AS rejected FROM hosts, prior)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, too_short OR repetitive AS base_failed,
       NOT (too_short OR repetitive) AND NOT rejected AS kept, f.host, rejected AS host_rejected
FROM failed f JOIN verdicts v ON f.host IS NOT DISTINCT FROM v.host
"""

TERM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH found AS (SELECT doc_id, unnest({TERM.format(ASCII_LOWER.format(TEXT))}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM found GROUP BY 1),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY 1, 2),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY 1),
items AS (SELECT DISTINCT item_id, unnest({TERM.format(ASCII_LOWER.format(TEXT))}) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (doc_id), totals GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


def _field(value: str) -> str:
    return f"coalesce(CAST(octet_length(encode({value})) AS VARCHAR) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(map(_field, values))})"


#: CRC-32 of a text, byte by byte and bit by bit.
CRC32 = (
    "xor(list_reduce(list_transform(string_split({}, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda a, b: "
    "list_reduce([CAST(i AS BIGINT) FOR i IN range(8)], "
    "lambda d, i: CASE WHEN d % 2 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END, xor(a, b)), 4294967295), 4294967295)"
)

OP12 = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
         CASE WHEN {CRC32.format("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf(ASCII_LOWER.format("text"))} ELSE {_leaf("text")} END AS copy
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM rows),
nodes AS (
  SELECT tree, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY tree) AS size FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), any_value((size + 7) // 8)
  FROM nodes WHERE size > 1 GROUP BY tree, level, place // 8),
high AS (
  SELECT 0 AS level, tree AS place, node, count(*) OVER () AS size FROM nodes WHERE size = 1
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), any_value((size + 7) // 8)
  FROM high WHERE size > 1 GROUP BY level, place // 8),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY 1),
everything AS (
  SELECT tree, level, place, node FROM nodes WHERE size > 1
  UNION ALL SELECT t.tree, t.height + h.level, h.place, h.node FROM heights t, high h WHERE h.size > 1),
steps AS (
  SELECT p.doc_id, p.leaf, p.place, p.tree, e.level,
         CASE WHEN e.level < t.height THEN p.place // CAST(8 ** e.level AS BIGINT)
              ELSE p.tree // CAST(8 ** (e.level - t.height) AS BIGINT) END AS own, e.place AS other, e.node
  FROM placed p JOIN heights t USING (tree) JOIN everything e USING (tree)),
beside AS (
  SELECT tree, place, level, coalesce(string_agg(node, '' ORDER BY other) FILTER (other < own), '') AS l,
         coalesce(string_agg(node, '' ORDER BY other) FILTER (other > own), '') AS r
  FROM steps WHERE own // 8 = other // 8 GROUP BY tree, place, level),
folds AS (
  SELECT tree, place, 0 AS level, copy AS node FROM placed
  UNION ALL
  SELECT f.tree, f.place, f.level + 1, sha256(b.l || f.node || b.r) FROM folds f JOIN beside b
  ON b.tree = f.tree AND b.place = f.place AND b.level = f.level),
folded AS (SELECT tree, place, arg_max(node, level) AS node FROM folds GROUP BY 1, 2),
proven AS (SELECT tree, place, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM beside GROUP BY 1, 2)
SELECT p.doc_id, p.leaf, s.node AS subroot, h.node AS root, coalesce(proof, sha256('')) AS proof_sha256,
       f.node AS folded_root, f.node = h.node AS verified
FROM placed p JOIN nodes s ON s.tree = p.tree AND s.size = 1 JOIN high h ON h.size = 1
JOIN folded f ON f.tree = p.tree AND f.place = p.place LEFT JOIN proven v ON v.tree = p.tree AND v.place = p.place
"""

ORACLE = {
    "op1_ngram_jaccard_join": OP1,
    "op3_substring_dedup": OP3,
    "op5_benchmark_decontamination": OP5,
    "op10_quality_rules": OP10,
    "op11_ranked_search": OP11,
    "op12_merkle_manifest": OP12,
}
