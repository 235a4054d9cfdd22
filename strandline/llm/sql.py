"""DuckDB SQL for the queries that SQL can express, by other means than the operators use."""

from __future__ import annotations

from strandline.llm.licenses import COVER, DRIFT, NOTICES, PHRASES

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _values(rows) -> str:
    quoted = lambda v: str(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(quoted(v) for v in r) + ")" for r in rows)


_TEMPLATES = _values([(t, i, label, i < len(PHRASES)) for i, (t, label) in enumerate([*PHRASES, *NOTICES])])

LICENSES = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tpl AS (SELECT template, label, exact, string_split(t, ' ') AS w FROM (VALUES {_TEMPLATES}) v(t, template, label, exact)),
tp AS (SELECT template, label, exact, len(w) - 1 AS pairs, i - 1 AS j, w[i] AS a, w[i + 1] AS b FROM tpl, range(1, 100) g(i) WHERE i < len(w)),
dp AS (SELECT r, i - 1 AS p, w[i] AS a, w[i + 1] AS b FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM docs)),
hits AS (SELECT r, template, label, exact, pairs, p, j, p - j AS d FROM dp JOIN tp USING (a, b)),
diag AS (SELECT r, template, d, count(DISTINCT j) = any_value(pairs) AND any_value(exact) AS place FROM hits GROUP BY r, template, d),
runs AS (SELECT *, sum(CASE WHEN d - before <= {DRIFT} THEN 0 ELSE 1 END) OVER (PARTITION BY r, template ORDER BY d) AS run FROM (SELECT *, lag(d) OVER (PARTITION BY r, template ORDER BY d) AS before FROM diag)),
spans AS (SELECT r, template, run, any_value(label) AS label, any_value(exact) AS exact, count(DISTINCT j) / any_value(pairs) AS cover, min(p) AS lo, max(p) + 1 AS hi FROM hits JOIN runs USING (r, template, d) GROUP BY r, template, run),
found AS (SELECT r, label, NULL AS d, cover, concat_ws(':', label, lo, hi) AS span FROM spans WHERE NOT exact AND cover >= {COVER}
 UNION ALL SELECT r, label, d, 1.0, NULL FROM diag JOIN tpl USING (template) WHERE place)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, count(d) AS n_base, min(d) AS first_word, max(d) AS last_word,
 coalesce(string_agg(DISTINCT CASE WHEN d IS NOT NULL THEN label END, ',' ORDER BY CASE WHEN d IS NOT NULL THEN label END), '') AS base_labels,
 coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, CAST(coalesce(max(cover), 0) AS DOUBLE) AS score,
 coalesce(string_agg(DISTINCT span, ',' ORDER BY span), '') AS spans
FROM docs LEFT JOIN found USING (r) GROUP BY r, doc_id, w"""

JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i : i + 3], ' ') FOR i IN range(1, len(w) - 2)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
links AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(a, b) AS (SELECT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.least, doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) c USING (doc_id)"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.least, vec_id) AS component_id, coalesce(c.least, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) n USING (vec_id) LEFT JOIN (SELECT a AS vec_id, min(b) AS least FROM reach GROUP BY a) c USING (vec_id)"""

_ENDS = " || ".join(["' '", *(f"chr({i})" for i in range(9, 14))])

LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, i, lines[i] AS line, translate(trim(lines[i], {_ENDS}), '{_UP}', '{_LOW}') AS k FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)),
dead AS (SELECT k, max(doc_id) AS owner FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
m AS (SELECT l.*, dead.k IS NOT NULL AND (doc_id IS NULL OR doc_id <> owner) AS gone FROM l LEFT JOIN dead USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id"""

_MARKS = r"^[ \t]*((?:>[ \t]?)+)"

QUOTES = rf"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, text FROM conversations),
raw AS (SELECT conv_id, turn, k, unnest(string_split_regex(coalesce(text, ''), '\r?\n')) AS line FROM (SELECT *, 0 AS k FROM m)),
lines AS (SELECT conv_id, turn, len(regexp_replace(regexp_extract(line, '{_MARKS}', 1), '[^>]', '', 'g')) AS d,
 regexp_replace(regexp_replace(lower(regexp_replace(line, '{_MARKS}', '')), '\s+', ' ', 'g'), '^[\s[:punct:]]+|[\s[:punct:]]+$', '', 'g') AS n FROM raw),
q AS (SELECT * FROM lines WHERE n <> ''),
quoted AS (SELECT conv_id, turn, n, count(*) AS c FROM q WHERE d = 1 GROUP BY ALL),
source AS (SELECT n, conv_id, min(turn) AS t FROM q WHERE d = 0 GROUP BY ALL),
near AS (SELECT x.conv_id, x.turn, x.n, c, x.conv_id AS pc, t AS pt FROM quoted x JOIN source s ON s.n = x.n AND s.conv_id = x.conv_id WHERE t < x.turn),
far AS (SELECT x.conv_id, x.turn, x.n, c, s.conv_id AS pc, s.t AS pt FROM (SELECT * FROM quoted ANTI JOIN near USING (conv_id, turn, n)) x
 JOIN (SELECT n, arg_min(conv_id, (t, conv_id)) AS conv_id, min(t) AS t FROM source GROUP BY n) s ON s.n = x.n WHERE (s.t, s.conv_id) < (x.turn, x.conv_id)),
votes AS (SELECT conv_id, turn, pc, pt, sum(c) AS v FROM (SELECT * FROM near UNION ALL SELECT * FROM far) GROUP BY ALL),
chosen AS (SELECT conv_id, turn, arg_max(pc, (pc = conv_id, v, -pt, -pc)) AS pc, arg_max(pt, (pc = conv_id, v, -pt, -pc)) AS pt, sum(v) AS n_linked FROM votes GROUP BY conv_id, turn),
stats AS (SELECT conv_id, turn, count(*) AS n_quoted, max(d) AS deepest FROM q WHERE d > 0 GROUP BY conv_id, turn),
nodes AS (SELECT conv_id, turn, coalesce(pc, CASE WHEN prev IS NOT NULL THEN conv_id END) AS pc, coalesce(pt, prev) AS pt FROM
 (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL)) LEFT JOIN chosen USING (conv_id, turn)),
tree(conv_id, turn, rc, rt, depth) AS (SELECT conv_id, turn, conv_id, turn, 0 FROM nodes WHERE pt IS NULL UNION ALL SELECT n.conv_id, n.turn, rc, rt, depth + 1 FROM nodes n JOIN tree ON n.pc = tree.conv_id AND n.pt = tree.turn),
placed AS (SELECT *, row_number() OVER (PARTITION BY rc, rt ORDER BY depth, turn, conv_id) AS position FROM tree)
SELECT m.conv_id, m.turn, role, trim(array_to_string([x FOR x IN string_split_regex(text, '\r?\n') IF NOT regexp_matches(x, '{_MARKS}')], chr(10)), ' ' || chr(9) || chr(10) || chr(13)) AS body,
 coalesce(n_quoted, 0) AS n_quoted, CAST(coalesce(deepest, 0) AS BIGINT) AS deepest, CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, nodes.pc AS parent_conv, nodes.pt AS parent_turn, rc AS root_conv, rt AS root_turn,
 CAST(coalesce(depth, 0) AS BIGINT) AS depth, CAST(coalesce(position, 1) AS INT) AS position
FROM m LEFT JOIN placed USING (conv_id, turn) LEFT JOIN nodes USING (conv_id, turn) LEFT JOIN chosen USING (conv_id, turn) LEFT JOIN stats USING (conv_id, turn)"""
