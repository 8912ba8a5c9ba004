"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from clickpath.llm import quality as q

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER_TEXT = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), '{_UPPER}', '{_UPPER.lower()}') AS k FROM lines),
hot AS (
  SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE last_doc IS NOT NULL AND doc_id <> last_doc) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE last_doc IS NULL OR doc_id = last_doc), '')) AS kept_sha256
FROM keyed LEFT JOIN hot USING (k) GROUP BY doc_id
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER_TEXT}, '{_WORD}') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_distinct([array_to_string(ws[i:i+4], ' ') FOR i IN range(1, len(ws) - 3)])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * both_n >= 85 * (na.n + nb.n - both_n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
comp AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp c ON c.doc_id = d.doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _quality() -> str:
    classes = {" ": r"[\x20\x09-\x0D]", "A": "[A-Z]", "0": "[0-9]", ".": r"[.,;:!?''\x22()-]", "#": "[#*$%&|<>]"}
    assert list(classes) == list(q.CLASSES)
    removed = ", ".join(f"length(text) - length(regexp_replace(text, '{c}', '', 'g'))" for c in classes.values())
    common = ", ".join(f"({_quoted(lang)}, {i}, {_quoted(w)})" for lang, ws in q.COMMON_WORDS.items() for i, w in enumerate(ws))
    other = len(next(iter(q.COMMON_WORDS.values())))

    def distance(hist: str, ref: str) -> str:
        term = lambda a: f"CASE WHEN {a} > 0 THEN {a} * log2({a} / ((p + r) / 2)) ELSE 0 END"
        return f"""
  SELECT doc_id, round(sqrt(greatest(sum(({term('p')} + {term('r')}) / 2), 0)), 8) AS dist FROM (
    SELECT doc_id, v / sum(v) OVER (PARTITION BY doc_id) AS p, ref_v / sum(ref_v) OVER (PARTITION BY doc_id) AS r
    FROM {hist} JOIN {ref} USING (lang, bin)) GROUP BY doc_id"""

    def reference(hist: str) -> str:
        return f"""
  SELECT lang, bin, sum(m)::DOUBLE AS ref_v FROM (
    SELECT lang, bin, floor(v * 1000000 / sum(v) OVER (PARTITION BY doc_id)) AS m
    FROM {hist} JOIN base USING (doc_id) WHERE NOT base_failed) JOIN judged USING (lang) GROUP BY lang, bin"""

    at = lambda kind: f"floor({kind}_distance * {q.STEPS})"
    scores = " UNION ALL ".join(f"SELECT lang, '{kind}' AS kind, {at(kind)} AS step FROM far WHERE NOT base_failed" for kind in q.LIMITS)
    limits = ", ".join(f"max(CASE WHEN kind = '{kind}' THEN greatest(median + {times} * (quartile - median), {least}) END) AS {kind}_limit"
                       for kind, (times, least, _) in q.LIMITS.items())
    fits = " AND ".join(f"coalesce({at(kind)} <= coalesce({kind}_limit, {otherwise}), TRUE)" for kind, (*_, otherwise) in q.LIMITS.items())
    return rf"""
WITH docs AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
listed AS (SELECT doc_id, lang, regexp_extract_all(text, '{_WORD}') AS ws FROM docs),
w AS (SELECT doc_id, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM listed),
grams AS (
  SELECT doc_id, pos, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
again AS (SELECT doc_id, pos FROM grams WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM again, range(5) t(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, length(text) AS chars, len(ws) AS n_words, [{removed}, strlen(text) - length(text)] AS c, strlen(text) AS bytes
  FROM docs JOIN listed USING (doc_id, lang)),
base AS (
  SELECT doc_id, lang, chars, n_words::BIGINT AS n_words, chars - c[1] AS word_chars, c[5] AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, n_words < 10 OR 100 * coalesce(covered.n, 0) > 20 * n_words AS base_failed
  FROM counts LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT lang FROM base WHERE NOT base_failed GROUP BY lang HAVING sum(n_words) >= {q.MIN_REFERENCE_WORDS}),
class_hist AS (
  SELECT doc_id, lang, unnest(list_append(c, bytes - list_sum(c)))::DOUBLE AS v, unnest(range({q.BINS})) AS bin FROM counts),
common(lang, bin, word) AS (VALUES {common}),
found AS (
  SELECT doc_id, lang, bin, count(*) AS n FROM w JOIN common c USING (lang)
  WHERE w.w = c.word OR w.w = upper(c.word[1]) || c.word[2:] GROUP BY doc_id, lang, bin),
word_hist AS (
  SELECT doc_id, lang, bin, coalesce(n, 0)::DOUBLE AS v FROM base JOIN (SELECT DISTINCT lang, bin FROM common) USING (lang)
    LEFT JOIN found USING (doc_id, lang, bin)
  UNION ALL
  SELECT doc_id, lang, {other}, (n_words - coalesce((SELECT sum(n) FROM found f WHERE f.doc_id = base.doc_id), 0))::DOUBLE
  FROM base WHERE lang IN (SELECT lang FROM common)),
class_ref AS ({reference('(SELECT doc_id, lang, bin, v FROM class_hist)').replace('JOIN base USING (doc_id)', 'JOIN (SELECT doc_id, base_failed FROM base) USING (doc_id)')}),
word_ref AS ({reference('(SELECT doc_id, lang, bin, v FROM word_hist)').replace('JOIN base USING (doc_id)', 'JOIN (SELECT doc_id, base_failed FROM base) USING (doc_id)')}),
class_far AS ({distance('class_hist', 'class_ref')}),
share_hist AS (SELECT doc_id, lang, (bin = {other})::INT AS bin, sum(v) AS v FROM word_hist GROUP BY ALL),
share_ref AS (SELECT lang, (bin = {other})::INT AS bin, sum(ref_v) AS ref_v FROM word_ref GROUP BY ALL),
share_far AS ({distance('share_hist', 'share_ref')}),
listed_far AS ({distance(f'(SELECT * FROM word_hist WHERE bin < {other})', f'(SELECT * FROM word_ref WHERE bin < {other})')}),
n_common AS (SELECT doc_id, sum(v) AS n FROM word_hist WHERE bin < {other} GROUP BY doc_id),
far AS (
  SELECT base.*, CASE WHEN chars >= {q.MIN_JUDGED_CHARS} THEN cf.dist END AS char_distance,
         CASE WHEN n_words >= {q.MIN_JUDGED_WORDS} THEN sf.dist END AS share_distance,
         CASE WHEN n_words >= {q.MIN_JUDGED_WORDS} AND nc.n >= {q.MIN_JUDGED_COMMON} THEN lf.dist END AS word_distance
  FROM base LEFT JOIN class_far cf USING (doc_id) LEFT JOIN share_far sf USING (doc_id) LEFT JOIN listed_far lf USING (doc_id)
    LEFT JOIN n_common nc USING (doc_id)),
scores AS ({scores}),
middle AS (
  SELECT lang, kind, quantile_disc(step, 0.5) AS median, quantile_disc(step, 0.75) AS quartile
  FROM scores WHERE step IS NOT NULL GROUP BY lang, kind HAVING count(*) >= {q.MIN_LIMIT_DOCS}),
limits AS (SELECT lang, {limits} FROM middle GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {fits} AS kept,
       char_distance, share_distance, word_distance
FROM far LEFT JOIN limits ON far.lang IS NOT DISTINCT FROM limits.lang
"""


SUBSTRINGS = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
wins AS (SELECT rid, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
seqs AS (SELECT rid, i, array_to_string(ws[i:i+34], ' ') AS s FROM wins),
rep AS (SELECT rid, i FROM seqs QUALIFY count(*) OVER (PARTITION BY s) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM rep),
lost AS (SELECT rid, list(p) AS ps FROM gone GROUP BY rid),
kept AS (
  SELECT doc_id, len(ws) AS n_words, list_filter(ws, lambda x, p: ps IS NULL OR NOT list_contains(ps, p)) AS ks
  FROM w LEFT JOIN lost USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_words - len(ks) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(ks, ' '), '')) AS kept_sha256
FROM kept
"""

CONVERSATION_TRIE = """
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS l FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, l, list_reduce(
    flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
    lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END), CAST(4294967295 AS BIGINT)) AS crc FROM own),
seqs AS (
  SELECT h.conv_id, list_concat(coalesce(base.l[1:xor(crc, 4294967295) % 6], []), h.l[xor(crc, 4294967295) % 6 + 1:]) AS s
  FROM h LEFT JOIN own base ON base.conv_id = h.conv_id - h.conv_id % 100),
members AS (SELECT conv_id, len(s) AS n, s[1:d] AS p, d FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM members GROUP BY p, d),
kids AS (SELECT p[1:d-1] AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.p = n.p),
up AS (
  SELECT p[1:a] AS p, a AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         sum(CASE WHEN d > 0 THEN (n_convs - 1) * length(p[d].text) ELSE 0 END) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY 1, 2)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, f.n_convs, f.n_children, up.n_leaves,
       CAST(up.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN up ON up.d = f.d AND up.p = f.p LEFT JOIN nodes parent ON parent.d = f.d - 1 AND parent.p = f.p[1:f.d-1]
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANKED_SEARCH = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER_TEXT}, '{_TERM}') AS ts FROM documents),
sized AS (SELECT rid, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM sized) GROUP BY rid, t),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER_TEXT}, '{_TERM}')) AS t FROM benchmark WHERE item_id IS NOT NULL),
weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole
  WHERE t IN (SELECT t FROM wanted) GROUP BY t, n_docs),
scored AS (
  SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN weight USING (t) JOIN tf USING (t) JOIN sized USING (rid), whole GROUP BY item_id, rid, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE_SQL = {
    "op1_quality_rules": _quality(),
    "op6_near_duplicates": NEAR_DUPLICATES,
    "op7_line_dedup": LINE_DEDUP,
    "op11_recompression_dedup": SUBSTRINGS,
    "op12_conversation_trie": CONVERSATION_TRIE,
    "op13_ranked_search": RANKED_SEARCH,
}
