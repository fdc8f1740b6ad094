"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""

# Lines with their quote level, runs of lines as passages, passages and their lines looked up by normalised text.
QUOTES = r"""
WITH m AS (SELECT row_number() OVER () AS r, conv_id, turn, role, string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS ls FROM conversations),
l AS (SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM m),
lv AS (SELECT *, length(regexp_replace(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1), '[ \t]', '', 'g')) AS level FROM l),
st AS (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY r ORDER BY i) THEN 0 ELSE 1 END AS starts FROM lv),
run AS (SELECT *, sum(starts) OVER (PARTITION BY r ORDER BY i) AS part FROM st),
pas AS (SELECT r, part, any_value(level) AS level, string_agg(line, chr(10) ORDER BY i) AS text FROM run WHERE level > 0 GROUP BY r, part),
own AS (SELECT r, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (level = 0), '') AS own, bool_or(level > 0) AS quoted FROM run GROUP BY r),
body AS (SELECT r, CASE WHEN quoted THEN trim(regexp_replace(own, '\n{3,}', chr(10) || chr(10), 'g'), chr(10) || ' ' || chr(9)) ELSE own END AS body FROM own),
said0 AS (SELECT r, unnest(list_distinct(list_concat([body], list_concat(regexp_split_to_array(body, '\n[ \t]*\n'), string_split(body, chr(10)))))) AS t FROM body),
said AS (SELECT conv_id, turn, lower(trim(regexp_replace(regexp_replace(t, '(?m)^[ \t]*(?:>[ \t]?)+', '', 'g'), '\s+', ' ', 'g'))) AS n FROM said0 JOIN m USING (r)),
ask0 AS (SELECT r, level, 0 AS part, row_number() OVER (PARTITION BY r ORDER BY part) - 1 AS pos, text AS t FROM pas
  UNION ALL SELECT r, level, 1, (SELECT count(*) FROM pas p WHERE p.r = run.r) + row_number() OVER (PARTITION BY r ORDER BY i) - 1, line FROM run WHERE level > 0),
ask AS (SELECT r, level, part, pos, lower(trim(regexp_replace(regexp_replace(t, '(?m)^[ \t]*(?:>[ \t]?)+', '', 'g'), '\s+', ' ', 'g'))) AS n FROM ask0),
firsts AS (SELECT n, min({'conv': conv_id, 'turn': turn}) AS f FROM said WHERE length(n) >= 12 GROUP BY n),
hit AS (SELECT a.r, a.level, a.part, a.pos, length(a.n) AS size, m.conv_id, (SELECT max(s.turn) FROM said s WHERE s.n = a.n AND s.conv_id = m.conv_id AND s.turn < m.turn) AS earlier,
  CASE WHEN f.f.conv IS DISTINCT FROM m.conv_id OR f.f.turn < m.turn THEN f.f END AS f FROM ask a JOIN m USING (r) LEFT JOIN firsts f USING (n) WHERE length(a.n) > 0),
best AS (SELECT r, CASE WHEN earlier IS NOT NULL THEN conv_id ELSE f.conv END AS c, CASE WHEN earlier IS NOT NULL THEN earlier ELSE f.turn END AS t FROM hit WHERE earlier IS NOT NULL OR f IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY level, part, size DESC, pos DESC) = 1),
prev AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS last FROM (SELECT DISTINCT conv_id, turn FROM conversations)),
res AS (SELECT m.conv_id AS conv_id, m.turn AS turn, m.role AS role, body AS content, (SELECT count(*) FROM pas WHERE pas.r = m.r) AS n_quotes,
  CASE WHEN best.r IS NOT NULL THEN best.c WHEN last IS NOT NULL THEN m.conv_id END AS reply_conv, CASE WHEN best.r IS NOT NULL THEN best.t ELSE last END AS reply_turn, best.r IS NOT NULL AS by_quote
FROM m JOIN body USING (r) LEFT JOIN best ON best.r = m.r LEFT JOIN prev ON prev.conv_id = m.conv_id AND prev.turn IS NOT DISTINCT FROM m.turn)
SELECT *, CAST(floor(turn / 1024) AS BIGINT) AS part, CASE WHEN conv_id IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, content NULLS FIRST, n_quotes, reply_conv NULLS FIRST, reply_turn NULLS FIRST, by_quote) - 1 END AS position FROM res"""

# Shingles as lists of words; components by repeated minima over links.
JACCARD = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh FROM d),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
sets AS (SELECT sh AS key, any_value(doc_id) AS x, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(sh) AS sh FROM s WHERE len(sh) > 0) GROUP BY sh),
reps AS (SELECT rep, key, len(key) AS n FROM sets),
t AS (SELECT rep, n, unnest(key) AS tok FROM reps),
common AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS shared FROM t a JOIN t b ON a.tok = b.tok AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * shared >= 75 * (an + bn - shared)),
two AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM two UNION SELECT reach.a, two.b FROM reach JOIN two ON reach.b = two.a),
comp AS (SELECT rep, least(rep, coalesce((SELECT min(b) FROM reach WHERE reach.a = reps.rep), rep)) AS c FROM reps),
of AS (SELECT doc_id, rep FROM (SELECT doc_id, list_sort(sh) AS key FROM s WHERE len(sh) > 0) JOIN reps USING (key))
SELECT n.doc_id AS doc_id, n.n AS n_shingles, coalesce(c, n.doc_id) AS component_id FROM n LEFT JOIN of USING (doc_id) LEFT JOIN comp USING (rep)"""

# Failed conditions as five bits, counted per part; every order and step is a sum over those counts.
FILTERS = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w, coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false) AS again FROM t),
lb AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, CAST(len(w) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INT) + 4 * CAST(100 * len(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * len(x) AS INT) + 8 * CAST(regexp_matches(x, '[#$%&*|]') AS INT) + 16 * CAST(again AS INT) AS mask,
  coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w LEFT JOIN lb USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
l(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM l a, l b, l c, l d, l e WHERE (a.b | b.b | c.b | d.b | e.b) = 31),
s AS (SELECT filter_order, s AS step, bits[s] AS own, CAST(list_sum(bits[1:s]) AS BIGINT) - bits[s] AS before FROM (SELECT *, unnest(range(1, 6)) AS s FROM o)),
r AS (SELECT part, filter_order, step, own, CAST(sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""

# All n-grams of pieces counted; cuts and longer phrases looked up among the frequent ones.
PHRASES = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3), (4)) v(n) WHERE len(w) >= n),
f AS (SELECT lang, n, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
tot AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS total FROM w GROUP BY lang),
c AS (SELECT lang, n, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE n > 1),
k AS (SELECT *, unnest(range(1, n)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.k, k.a, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * k.a // (x.f + y.f) AS BIGINT) AS score FROM k
  JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.ws[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.ws[k.k + 1:k.n], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT *, unnest(range(1, n - m + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS m FROM c)),
h AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM i GROUP BY ALL),
r AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score FROM b LEFT JOIN h ON b.lang = h.lang AND b.phrase = h.phrase WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT r.lang AS lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, total AS n, score FROM r JOIN tot ON tot.lang = r.lang WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_top_k": TOP_K, "op6_chat_quotes": QUOTES, "op10_jaccard_join": JACCARD, "op11_phrase_collocations": PHRASES, "op13_filter_audit": FILTERS}
