"""DuckDB SQL of the registered queries, written from their contracts."""

from __future__ import annotations

# op1: links are pairs of cosine 0.95 and more; components by reachability.
OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.a, x.r FROM reach x JOIN links l ON l.b = x.vec_id),
low AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, low.component_id,
  low.component_id = e.vec_id AS kept, CAST(1.0 AS DOUBLE) AS recall
FROM embeddings e JOIN low ON e.vec_id = low.vec_id"""

# op3: user and system turns are calls, an assistant turn is the result of the last user turn before it.
OP3 = """
WITH t AS (SELECT *, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked FROM conversations),
calls AS (SELECT conv_id, CAST(turn AS VARCHAR) AS call_id, text, turn, CASE WHEN role = 'user' THEN 'reply' ELSE 'instruct' END AS name,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position FROM t WHERE role IN ('user', 'system')),
results AS (SELECT conv_id, coalesce(CAST(asked AS VARCHAR), '?' || turn) AS call_id, arg_min(text, turn) AS content, count(*) - 1 AS more
    FROM t WHERE role = 'assistant' GROUP BY 1, 2),
j AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.position, c.text, c.turn, c.name,
    r.content, coalesce(r.more, 0) AS n_repeats,
    CASE WHEN c.conv_id IS NULL THEN NULL WHEN c.text IS NULL THEN '$.text: missing' WHEN c.text = '' THEN '$.text: shorter than 1' END AS problem,
    c.conv_id IS NULL AS orphan, r.conv_id IS NULL AS open
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id),
s AS (SELECT *, CASE WHEN orphan THEN 'orphan' WHEN problem IS NOT NULL THEN 'invalid' WHEN open THEN 'unanswered' ELSE 'ok' END AS status FROM j)
SELECT conv_id, call_id, position, CAST(position AS INTEGER) AS level, status, problem, n_repeats,
  '{' || CASE WHEN orphan THEN '' ELSE '"arguments":{' || coalesce('"text":' || CAST(to_json(text) AS VARCHAR) || ',', '') || '"turn":' || turn || '},' END
  || '"id":' || CAST(to_json(call_id) AS VARCHAR) || coalesce(',"name":' || CAST(to_json(name) AS VARCHAR), '')
  || coalesce(',"result":' || CAST(to_json(content) AS VARCHAR), '') || ',"status":"' || status || '"}' AS json
FROM s"""

# op5: the row with the largest doc_id stays of texts that are equal after lower-casing A-Z.
OP5 = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n"""

# op7: character 4-grams over all texts; a count below 2 backs off with factor 0.4.
OP7 = """
WITH s AS (SELECT doc_id, repeat(chr(1), 3) || coalesce(text, '') AS z FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, length(z) - 2), lambda i: substr(z, i, 4))) AS g4 FROM s),
c4 AS (SELECT g4, count(*) AS n FROM g GROUP BY 1),
c3 AS (SELECT substr(g4, 2) AS g3, sum(n) AS n FROM c4 GROUP BY 1), c2 AS (SELECT substr(g3, 2) AS g2, sum(n) AS n FROM c3 GROUP BY 1),
c1 AS (SELECT substr(g2, 2) AS g1, sum(n) AS n FROM c2 GROUP BY 1),
x4 AS (SELECT left(g4, 3) AS x, sum(n) AS n FROM c4 GROUP BY 1), x3 AS (SELECT left(g3, 2) AS x, sum(n) AS n FROM c3 GROUP BY 1),
x2 AS (SELECT left(g2, 1) AS x, sum(n) AS n FROM c2 GROUP BY 1),
p1 AS (SELECT g1, ln(n / (SELECT sum(n) FROM c1)) AS p FROM c1),
p2 AS (SELECT g2, CASE WHEN c2.n >= 2 THEN ln(c2.n / x2.n) ELSE p + ln(0.4) END AS p FROM c2 JOIN x2 ON x = left(g2, 1) JOIN p1 ON g1 = substr(g2, 2)),
p3 AS (SELECT g3, CASE WHEN c3.n >= 2 THEN ln(c3.n / x3.n) ELSE p + ln(0.4) END AS p FROM c3 JOIN x3 ON x = left(g3, 2) JOIN p2 ON g2 = substr(g3, 2)),
p4 AS (SELECT g4, CASE WHEN c4.n >= 2 THEN ln(c4.n / x4.n) ELSE p + ln(0.4) END AS p FROM c4 JOIN x4 ON x = left(g4, 3) JOIN p3 ON g3 = substr(g4, 2)),
d AS (SELECT doc_id, count(*) AS n, sum(p) AS p FROM g JOIN p4 USING (g4) GROUP BY 1)
SELECT s.doc_id, coalesce(d.n, 0) AS n_units, round(coalesce(d.p, 0.0), 3) AS log_score, round(d.p / d.n, 6) AS mean_score
FROM s LEFT JOIN d USING (doc_id)"""

# op8: words covered by a 50-word run that also starts in a smaller document go.
OP8 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM w WHERE len(w) >= 50),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM p),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS lo FROM win) WHERE lo < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM w),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.pos) AS t FROM words x ANTI JOIN gone g ON x.doc_id = g.doc_id AND x.pos = g.pos GROUP BY 1)
SELECT w.doc_id, len(w) AS n_words, (SELECT count(*) FROM gone g WHERE g.doc_id = w.doc_id) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _kind(name: str, rank: int, pattern: str, value: str, test: str) -> str:
    """Spans of one kind: a match starts after all text between matches and the matches before it."""
    return f"""
SELECT doc_id, source, {rank} AS rank, '{name}' AS kind, stop - length(hit) AS s, stop AS e, {value} AS value FROM (
  SELECT doc_id, source, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY k) AS stop FROM (
    SELECT doc_id, source, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, unnest(range(1, len(hits) + 1)) AS k FROM (
      SELECT doc_id, source, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS gaps FROM d)))
WHERE {test}"""


# op9: base spans of three kinds; generic tokens held by at most 2 sources and 8 documents are added.
OP9 = ("WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents), base AS ("
       + _kind("assign", 0, _ASSIGN, f"regexp_extract(hit, '{_ASSIGN}', 1)",
               f"length(regexp_extract(hit, '{_ASSIGN}', 1)) >= 8") + " UNION ALL "
       + _kind("access", 1, "AKIA[A-Z0-9]{12,}", "hit", "true") + " UNION ALL "
       + _kind("hex", 2, "[0-9a-f]{32,}", "hit", "true") + "), more AS (SELECT * FROM ("
       + _kind("live", 3, "[A-Za-z0-9+/_-]{24,}", "hit",
               "regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[0-9]')")
       + """) m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.s < m.e AND m.s < b.e)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM more),
own AS (SELECT value, count(DISTINCT source) <= 2 AND count(DISTINCT doc_id) <= 8 AS live FROM every GROUP BY 1),
shown AS (SELECT every.* FROM every JOIN own USING (value) WHERE rank < 3 OR live),
b AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS t FROM base GROUP BY 1),
a AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS t FROM shown GROUP BY 1),
n AS (SELECT doc_id, count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example FROM every JOIN own USING (value) GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b.t, '')) AS base_sha256, coalesce(a.t, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN n USING (doc_id)""")

# op10: documents link when their sets of 4-word shingles overlap by 85 % of the union.
OP10 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 2)), lambda i: array_to_string(w[i:i + 3], ' '))) AS g FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, x.r FROM reach x JOIN links l ON l.b = x.doc_id),
low AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, low.component_id FROM w LEFT JOIN n USING (doc_id) JOIN low USING (doc_id)"""

# op11: every kept term of a language against every source of it; all divisions are of whole numbers.
OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
o AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY 1, 2 HAVING count(DISTINCT rid) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT o.lang, source, o.term, count(*) AS n FROM o JOIN k ON o.lang = k.lang AND o.term = k.term GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY 1), s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + v.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (v.n + v.v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source AS s1, b.source AS s2, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3) x
  ON x.lang = a.lang AND x.s1 = a.source AND x.s2 = b.source),
own AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r
WHERE part = 'pair' OR rank <= 200"""

# op12: phrases of every length exploded and counted one by one.
OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d)),
grams AS (SELECT lang, w[i:i + z - 1] AS g FROM (SELECT lang, w, z, unnest(range(1, len(w) - z + 2)) AS i
  FROM pieces, (SELECT unnest(range(1, 6)) AS z) WHERE len(w) >= z)),
f AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY 1, 2 HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY 1),
cuts AS (SELECT lang, g, f AS a, k, g[1:k] AS head, g[k + 1:] AS tail FROM (SELECT *, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1)),
scored AS (SELECT c.lang, c.g, a, h.f AS l, t.f AS r, n.n, (1000::HUGEINT * a * n.n) // (h.f::HUGEINT * t.f) AS score,
    row_number() OVER (PARTITION BY c.lang, c.g ORDER BY (1000::HUGEINT * a * n.n) // (h.f::HUGEINT * t.f), k) AS best
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.g = c.head JOIN f t ON t.lang = c.lang AND t.g = c.tail JOIN n ON n.lang = c.lang),
inner_ AS (SELECT DISTINCT lang, g[i:i + z - 1] AS g, f FROM (SELECT lang, g, f, z, unnest(range(1, len(g) - z + 2)) AS i
  FROM f, (SELECT unnest(range(2, 5)) AS z) WHERE len(g) > z)),
stay AS (SELECT * FROM scored s WHERE best = 1 AND NOT EXISTS (
  SELECT 1 FROM inner_ i WHERE i.lang = s.lang AND i.g = s.g AND 100 * i.f >= 100 * s.a)),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase,
  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank FROM stay)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""

ORACLES = {
    "op1_vector_graph": OP1, "op3_tool_calls": OP3, "op5_exact_dedup": OP5, "op7_lm_score": OP7,
    "op8_substring_dedup": OP8, "op9_secrets": OP9, "op10_ngram_join": OP10,
    "op11_divergence": OP11, "op12_collocations": OP12,
}
