"""SQL over the given tables for the operators that SQL can express, as brute force over all pairs."""

from shelfmark.llm import licences

NEAR_DUPLICATES = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
    FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)] END) AS shingle FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
    GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * COUNT(*) >= 85 * (nx.n + ny.n - COUNT(*))),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.other),
c AS (SELECT doc_id, MIN(other) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, COALESCE(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
e AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id
    AND list_dot_product(p.x, q.x) / (sqrt(list_dot_product(p.x, p.x)) * sqrt(list_dot_product(q.x, q.x))) >= 0.95),
reach AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT reach.vec_id, e.b FROM reach JOIN e ON e.a = reach.other),
c AS (SELECT vec_id, MIN(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a, COUNT(*) AS n_links FROM e GROUP BY a)
SELECT vec_id, COALESCE(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n ON a = vec_id"""

REPEATED_LINES = """
WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, no, parts[no] AS line, trim(parts[no], ' ') AS body, trim(parts[no], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) = '' AS blank
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS no FROM t)),
d AS (SELECT body, MIN({'doc': doc_id, 'no': no}) AS place,
    CASE WHEN contains(body, ' ') OR length(body) < 20 THEN string_split(body, ' ')
    ELSE [chr(10) || substring(body, i, 1) FOR i IN range(1, length(body) + 1)] END AS ws
    FROM l WHERE NOT blank GROUP BY body),
v AS (SELECT ws, body, place, i, md5(array_to_string(CASE WHEN i = 0 THEN ws ELSE list_concat(ws[1:i - 1], ws[i + 1:]) END, ' ')) AS key
    FROM (SELECT ws, body, place, unnest(range(0, len(ws) + 1)) AS i FROM d WHERE len(ws) >= 5)),
near AS (SELECT DISTINCT a.body FROM v a JOIN v b ON a.key = b.key AND b.place < a.place
    AND (a.i = b.i AND a.i > 0 OR (a.i = 0) <> (b.i = 0))),
kept AS (SELECT doc_id, no, line FROM l WHERE blank OR
    (body NOT IN (SELECT body FROM near) AND {'doc': doc_id, 'no': no} = (SELECT place FROM d WHERE d.body = l.body))),
r AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS text FROM kept GROUP BY doc_id)
SELECT doc_id, len(parts) AS n_lines, COALESCE(length(text), 0) AS n_chars_left, md5(COALESCE(text, '')) AS text_md5
FROM t LEFT JOIN r USING (doc_id)"""

COLLOCATIONS = """
WITH p AS (SELECT COALESCE(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
n AS (SELECT lang, CAST(SUM(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
    FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, COUNT(*) AS f FROM g GROUP BY lang, m, phrase HAVING COUNT(*) >= 10),
cuts AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.m > b.m
    AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * f.f >= 50 * b.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY rank <= 3"""


def licence_sql() -> str:
    """Every block against every template, by the same fixed phrases and templates."""
    sets = [(label, licences.template_words(text)) for label, text in licences.TEMPLATES]
    values = ", ".join(
        f"('{label}', {words!r}, {licences.needed(len(words))}, {len(words) >= licences.WIDE})" for label, words in sets
    )
    phrases = ", ".join(f"('{phrase}', '{label}')" for phrase, label in licences.PHRASES.items())
    return f"""
WITH t(label, words, need, wide) AS (VALUES {values}),
b(phrase, label) AS (VALUES {phrases}),
d AS (SELECT doc_id, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
w AS (SELECT doc_id, body, regexp_extract_all(body, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM d),
places AS (SELECT doc_id, label, len(string_split(phrase, ' ')) AS k, phrase, ws, unnest(range(0, len(ws))) AS i FROM w, b),
base AS (SELECT doc_id, COUNT(*) AS n_base, MIN(i) AS first_word, MAX(i) AS last_word, list(DISTINCT label) AS labels
    FROM places WHERE array_to_string(ws[i + 1:i + k], ' ') = phrase GROUP BY doc_id),
blocks AS (SELECT doc_id, FALSE AS wide, unnest(string_split(body, chr(10))) AS block FROM w
    UNION ALL SELECT doc_id, TRUE, unnest(regexp_split_to_array(body, '\\n(?:[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]*\\n)+')) FROM w),
met AS (SELECT doc_id, label, need, len(words) AS size,
    len(list_intersect(words, regexp_extract_all(block, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))) AS shared
    FROM blocks JOIN t USING (wide)),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, MAX(shared / size) AS share FROM met WHERE shared >= need GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word,
    array_to_string(list_sort(COALESCE(base.labels, [])), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(COALESCE(base.labels, []), COALESCE(more.labels, [])))), ',') AS labels,
    CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE COALESCE(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)"""


ORACLE = {
    "op3_graph_near_dedup": NEAR_VECTORS,
    "op5_minhash_near_dedup": NEAR_DUPLICATES,
    "op6_line_dedup": REPEATED_LINES,
    "op11_phrase_collocations": COLLOCATIONS,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_licence_scan": licence_sql(),
}
