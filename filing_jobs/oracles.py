"""DuckDB SQL for the rows of the queries, straight from the relational tables, without XML."""

from __future__ import annotations

from filing_jobs.functions.tables import FORM_TITLES, LABEL_WORDS, NAME_WORDS, TYPE_NAMES
from filing_jobs.sources.samples import COVERED, PART_VERSIONS, SAMPLE_FIELDS, VERSIONS


def case(of: str, values: dict, other: str) -> str:
    return f"CASE {of} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in values.items()) + f" ELSE {other} END"


def quoted(x) -> str:
    return str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"


def listed(xs) -> str:
    return "[" + ", ".join(map(quoted, xs)) + "]"


def spaced(x: str) -> str:
    return f"regexp_replace({x}, '([a-z])([A-Z])', '\\1 \\2', 'g')"


def labelled(x: str) -> str:
    out = spaced(x)
    for a, b in LABEL_WORDS:
        out = f"replace({out}, '{a}', '{b}')"
    return f"trim({out})"


def worded(x: str) -> str:
    table = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in NAME_WORDS.items()) + "}"
    return f"array_to_string(list_transform(regexp_extract_all({x}, '[A-Z][a-z]*|[a-z]+'), lambda w: coalesce({table}[lower(w)], lower(w))), ' ')"


PATH = "lpad(CAST(k AS VARCHAR), 10, '0') || '.xml'"
BASE = f"""
base AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus AS st, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderdate, c_name,
    {case("year(o_orderdate)", VERSIONS, "NULL")} AS version,
    year(o_orderdate) IN (1995, 1996) AS older,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'EZ' WHEN o_orderpriority LIKE '2%' THEN 'PF' ELSE '' END AS form,
    CASE WHEN o_orderkey % 97 = 0 THEN 'malformed' WHEN o_orderkey % 89 = 0 THEN 'no_header' WHEN o_orderkey % 83 = 0 THEN 'no_data' ELSE 'ok' END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey),
pay AS (SELECT k, CASE WHEN st = 'O' THEN NULL WHEN st = 'P' THEN '' WHEN k % 10 = 0 AND st = 'F' THEN '0' ELSE CAST(price AS VARCHAR) END AS pay FROM base),
li AS (
  SELECT l_orderkey AS k, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS qty, l_returnflag AS flag, CAST(l_suppkey AS VARCHAR) AS city, strftime(l_shipdate, '%Y-%m-%d') AS ship,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS num
  FROM lineitem),
els AS (
  SELECT k, version, status, 'data' AS section, x.xpath AS xpath, x.text AS text, x.depth AS depth, 0 AS num FROM base JOIN pay USING (k),
    LATERAL (SELECT unnest([
      {{'xpath': '/IRS990', 'text': '', 'depth': 0}},
      {{'xpath': CASE WHEN form = '' THEN '/IRS990/TotalRevenueAmt' END, 'text': CAST(price + 1 AS VARCHAR), 'depth': 1}},
      {{'xpath': CASE WHEN k % 7 = 0 THEN '/IRS990/UnlistedThingAmt' END, 'text': CAST(k AS VARCHAR), 'depth': 1}},
      {{'xpath': CASE WHEN form <> '' THEN '/IRS990' || form END, 'text': '', 'depth': 0}},
      {{'xpath': CASE WHEN form <> '' THEN '/IRS990' || form || '/TotalRevenueAmt' END, 'text': CAST(price + 1 AS VARCHAR), 'depth': 1}},
      {{'xpath': CASE WHEN st <> 'O' THEN '/IRS990ScheduleJ' END, 'text': '', 'depth': 0}},
      {{'xpath': CASE WHEN st <> 'O' THEN '/IRS990ScheduleJ/' || CASE WHEN older THEN 'BaseCompensationFilingOrgAmt' ELSE 'BsCmpnstnFlngOrgAmt' END END, 'text': pay, 'depth': 1}}
    ]) AS x) WHERE status IN ('ok', 'no_header') AND x.xpath IS NOT NULL
  UNION ALL
  SELECT k, version, status, 'data', '/IRS990/ContractorCompensationGrp' || x.p, x.text, x.depth, num FROM base JOIN li USING (k),
    LATERAL (SELECT unnest([
      {{'p': '', 'text': '', 'depth': 1}}, {{'p': '/CompensationAmt', 'text': qty, 'depth': 2}}, {{'p': '/ServicesDesc', 'text': flag, 'depth': 2}},
      {{'p': '/ContractorAddress', 'text': '', 'depth': 2}}, {{'p': '/ContractorAddress/USAddress', 'text': '', 'depth': 3}},
      {{'p': '/ContractorAddress/USAddress/' || CASE WHEN older THEN 'City' ELSE 'CityNm' END, 'text': city, 'depth': 4}}, {{'p': '/StartDt', 'text': ship, 'depth': 2}}
    ]) AS x) WHERE status IN ('ok', 'no_header')
  UNION ALL
  SELECT k, version, status, 'root_fallback', x.p, x.text, x.depth, 0 FROM base,
    LATERAL (SELECT unnest([
      {{'p': '/TaxPeriodEndDt', 'text': strftime(o_orderdate, '%Y-%m-%d'), 'depth': 0}}, {{'p': '/ReturnTypeCd', 'text': '990' || form, 'depth': 0}}, {{'p': '/Filer', 'text': '', 'depth': 0}},
      {{'p': '/Filer/EIN', 'text': lpad(CAST(o_custkey AS VARCHAR), 9, '0'), 'depth': 1}}, {{'p': '/Filer/BusinessName', 'text': '', 'depth': 1}}, {{'p': '/Filer/BusinessName/BusinessNameLine1Txt', 'text': c_name, 'depth': 2}}
    ]) AS x) WHERE status = 'no_data')"""
HEADER = """CASE WHEN status = 'malformed' THEN '' ELSE version END AS return_version,
  CASE WHEN status IN ('malformed', 'no_header') THEN '' ELSE lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS ein,
  CASE WHEN status IN ('malformed', 'no_header') THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS tax_period,
  CASE WHEN status IN ('malformed', 'no_header') THEN '' ELSE c_name END AS org_name"""
FORM = "CASE WHEN status IN ('malformed', 'no_header') THEN '' ELSE '990' || form END AS form_type"

DICT = "dict(field, schedule, version, xpath) AS (VALUES " + ", ".join(f"({quoted(n)}, {quoted(s)}, {quoted(v)}, {quoted(x)})" for n, s, _, _, xs in SAMPLE_FIELDS for v, x in xs.items()) + ")"
OLDER_CITY = "CASE WHEN xpath LIKE '%/CityNm' THEN regexp_replace(xpath, 'Nm$', '') END"
INDEX = f"""{DICT}, idx0 AS (SELECT DISTINCT xpath, field FROM dict),
idx AS (SELECT * FROM idx0 UNION SELECT {OLDER_CITY}, field FROM idx0 WHERE {OLDER_CITY} IS NOT NULL AND {OLDER_CITY} NOT IN (SELECT xpath FROM idx0))"""
RESOLVE = f"""asked AS (SELECT DISTINCT version FROM base WHERE status <> 'malformed'),
keyed AS (SELECT d.field, a.version, d.xpath, d.version AS own, CAST(left(d.version, 4) AS INT) * 1000 + CAST(split_part(substr(d.version, 6), '.', 1) AS INT) * 10 + CAST(split_part(d.version, '.', 2) AS INT) AS key,
  CAST(left(a.version, 4) AS INT) * 1000 + CAST(split_part(substr(a.version, 6), '.', 1) AS INT) * 10 + CAST(split_part(a.version, '.', 2) AS INT) AS asked_key FROM dict d, asked a),
ruled AS (SELECT *, CASE WHEN own = version THEN 1 WHEN left(own, 4) = left(version, 4) THEN 2 WHEN key < asked_key THEN 3 ELSE 4 END AS rule FROM keyed),
res AS (SELECT field, version, xpath, rule FROM ruled QUALIFY row_number() OVER (PARTITION BY field, version ORDER BY rule, key DESC, own DESC) = 1)"""
SCALARS = [n for n, _, t, g, _ in SAMPLE_FIELDS if t != "(group)" and not g]

FP = """fp AS (SELECT k, version, xpath, count(*) AS n FROM els GROUP BY ALL),
said AS (SELECT k, xpath, left(arg_min(text, num), 100) AS sample FROM els WHERE text <> '' GROUP BY ALL),
paths AS (SELECT fp.*, coalesce(sample, '') AS sample FROM fp LEFT JOIN said USING (k, xpath))"""
STATS = f"""{FP}, stats AS (SELECT xpath, count(*) AS filing_count, list_sort(list(DISTINCT version)) AS versions, coalesce(arg_min(sample, k) FILTER (sample <> ''), '') AS sample, xpath IN (SELECT xpath FROM idx) AS known FROM paths GROUP BY xpath)"""
GUESS = """CASE WHEN sample = '' THEN 'unknown' WHEN lower(sample) IN ('true', 'false', '0', '1', 'x') THEN 'boolean' WHEN regexp_matches(sample, '^-?\\d+$') THEN 'integer' WHEN regexp_matches(sample, '^-?\\d+\\.\\d+$') THEN 'decimal'
  WHEN regexp_matches(sample, '^\\d{4}-\\d{2}-\\d{2}') THEN 'date' WHEN regexp_matches(sample, '^\\d{2}-\\d{7}$') THEN 'EIN' WHEN length(sample) > 50 THEN 'text_long' ELSE 'text' END"""
UNKNOWN = f"""{STATS}, unk AS (
  SELECT xpath, split_part(xpath, '/', -1) AS element_name, split_part(xpath, '/', 2) AS schedule, regexp_replace(xpath, '/[^/]*$', '') AS parent_xpath, filing_count, versions,
    NOT list_has_any(versions, list_filter(versions, lambda v: v NOT IN {tuple(COVERED)})) AS version_covered, {GUESS} AS guess, sample
  FROM stats s WHERE NOT known AND NOT (length(xpath) - length(replace(xpath, '/', '')) = 1 AND (xpath LIKE '/IRS%' OR xpath = '/ReturnHeader'))
    AND NOT (sample = '' AND EXISTS (SELECT 1 FROM idx WHERE starts_with(idx.xpath, s.xpath || '/')))),
unused AS (SELECT DISTINCT field FROM dict EXCEPT SELECT field FROM idx WHERE xpath IN (SELECT xpath FROM stats))"""

BIGRAMS = "list_distinct(list_transform(range(1, length({0})), lambda i: substr(lower({0}), i, 2)))"


def dice(a: str, b: str) -> str:
    x, y = BIGRAMS.format(a), BIGRAMS.format(b)
    return f"CASE WHEN length({a}) < 2 OR length({b}) < 2 THEN 0.0 ELSE 2.0 * len(list_intersect({x}, {y})) / (len({x}) + len({y})) END"


def part(a: str, b: str, same: str) -> str:
    return f"""CASE WHEN length({a}) > 5 AND length({b}) > 5 AND (contains(lower({a}), lower({b})) OR contains(lower({b}), lower({a}))) THEN CASE WHEN {same} THEN 0.75 ELSE 0.55 END
      WHEN length({a}) > 8 AND length({b}) > 8 AND right(lower({a}), 8) = right(lower({b}), 8) THEN CASE WHEN {same} THEN 0.6 ELSE 0.45 END ELSE 0.0 END"""


def fuzzy(unknown: str, leaves: str, unused: str) -> str:
    """The cascade over tables unknown(xpath, element_name, schedule, parent_xpath), lv(xpath) and free(candidate)."""
    return f"""u AS ({unknown}), lx AS ({leaves}),
lv AS (SELECT split_part(xpath, '/', -1) AS leaf, split_part(xpath, '/', 2) AS sched, min(xpath) AS cand FROM lx GROUP BY ALL),
lf AS (SELECT leaf, min(cand) AS cand, arg_min(sched, cand) AS sched, list(sched) AS scheds FROM lv GROUP BY leaf),
free AS ({unused}),
r1 AS (SELECT u.xpath, CASE WHEN schedule = sched THEN 0.9 ELSE 0.7 END AS score, CASE WHEN schedule = sched THEN 'exact leaf name, same schedule, different path' ELSE 'exact leaf name in different schedule' END AS reason, cand FROM u JOIN lv ON element_name = leaf QUALIFY row_number() OVER (PARTITION BY u.xpath ORDER BY score DESC, cand) = 1),
uw AS (SELECT *, {worded("element_name")} AS words FROM u), lw AS (SELECT *, {worded("leaf")} AS words FROM lf),
r2 AS (SELECT uw.xpath, CASE WHEN schedule = sched THEN 0.85 ELSE 0.65 END AS score, 'abbreviation match, ' || CASE WHEN schedule = sched THEN 'same' ELSE 'different' END || ' schedule' AS reason, cand FROM uw JOIN lw USING (words) QUALIFY row_number() OVER (PARTITION BY uw.xpath ORDER BY score DESC, cand) = 1),
pairs AS (SELECT DISTINCT element_name, leaf FROM u, lf),
p3 AS (SELECT xpath, {part("u.element_name", "lf.leaf", "list_contains(scheds, u.schedule)")} AS score, cand, element_name AS en, leaf, length(element_name) > 5 AND length(leaf) > 5 AS long FROM u, lf),
r3 AS (SELECT xpath, score, CASE WHEN long AND contains(lower(leaf), lower(en)) THEN '''' || en || ''' is substring of ''' || leaf || '''' WHEN long AND contains(lower(en), lower(leaf)) THEN '''' || leaf || ''' is substring of ''' || en || '''' ELSE 'shared suffix ''' || right(en, 8) || '''' END AS reason, cand FROM p3 WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY xpath ORDER BY score DESC, cand) = 1),
p4 AS (SELECT element_name, leaf, {dice("element_name", "leaf")} AS sim FROM pairs),
r4 AS (SELECT u.xpath, sim AS score, 'name similarity' AS reason, lv.cand FROM u JOIN p4 USING (element_name) JOIN lv ON lv.leaf = p4.leaf AND lv.sched = u.schedule WHERE sim >= 0.6 QUALIFY row_number() OVER (PARTITION BY u.xpath ORDER BY score DESC, lv.cand) = 1),
f5 AS (SELECT candidate, regexp_replace(candidate, '/[^/]*$', '') AS parent, split_part(candidate, '/', -1) AS leaf FROM free),
p5 AS (SELECT u.xpath, candidate AS cand, {dice("u.element_name", "f5.leaf")} AS sim FROM u JOIN f5 ON u.parent_xpath = f5.parent WHERE u.parent_xpath IN (SELECT xpath FROM lx)),
r5 AS (SELECT xpath, CASE WHEN sim > 0.3 THEN greatest(0.5, sim) ELSE 0.45 END AS score, 'same parent, unused field' AS reason, cand FROM p5 QUALIFY row_number() OVER (PARTITION BY xpath ORDER BY score DESC, cand) = 1),
c1 AS (SELECT u.xpath, coalesce(r1.score, 0.0) AS score, coalesce(r1.cand, '') AS cand, coalesce(r1.reason, '') AS reason FROM u LEFT JOIN r1 ON u.xpath = r1.xpath),
c2 AS (SELECT c1.xpath, CASE WHEN c1.score < 0.8 AND r2.score > c1.score THEN r2.score ELSE c1.score END AS score, CASE WHEN c1.score < 0.8 AND r2.score > c1.score THEN r2.cand ELSE c1.cand END AS cand, CASE WHEN c1.score < 0.8 AND r2.score > c1.score THEN r2.reason ELSE c1.reason END AS reason FROM c1 LEFT JOIN r2 ON c1.xpath = r2.xpath),
c3 AS (SELECT c2.xpath, CASE WHEN c2.score < 0.7 AND r3.score > c2.score THEN r3.score ELSE c2.score END AS score, CASE WHEN c2.score < 0.7 AND r3.score > c2.score THEN r3.cand ELSE c2.cand END AS cand, CASE WHEN c2.score < 0.7 AND r3.score > c2.score THEN r3.reason ELSE c2.reason END AS reason FROM c2 LEFT JOIN r3 ON c2.xpath = r3.xpath),
c4 AS (SELECT c3.xpath, CASE WHEN c3.score < 0.6 AND r4.score > c3.score THEN r4.score ELSE c3.score END AS score, CASE WHEN c3.score < 0.6 AND r4.score > c3.score THEN r4.cand ELSE c3.cand END AS cand, CASE WHEN c3.score < 0.6 AND r4.score > c3.score THEN r4.reason ELSE c3.reason END AS reason FROM c3 LEFT JOIN r4 ON c3.xpath = r4.xpath),
c5 AS (SELECT c4.xpath, CASE WHEN c4.score < 0.5 AND r5.score > c4.score THEN r5.score ELSE c4.score END AS score, CASE WHEN c4.score < 0.5 AND r5.score > c4.score THEN r5.cand ELSE c4.cand END AS cand, CASE WHEN c4.score < 0.5 AND r5.score > c4.score THEN r5.reason ELSE c4.reason END AS reason FROM c4 LEFT JOIN r5 ON c4.xpath = r5.xpath),
fz AS (SELECT xpath, cand AS match, round(CAST(score AS DOUBLE), 3) AS score, reason FROM c5 WHERE score >= 0.45)"""


FUZZY_CORPUS = fuzzy("SELECT xpath, element_name, schedule, parent_xpath FROM unk", "SELECT xpath FROM idx", "SELECT DISTINCT xpath AS candidate FROM dict WHERE field IN (SELECT field FROM unused)")

PASCAL = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), '')"
ELEMENTS = f"""e AS (
  SELECT 'IRS990Schedule' || {case("p_type", dict(zip(["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL"], "ABCDEF", strict=True)), "NULL")} AS schedule, 'Brand' || (CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) % 5) || 'Grp' AS grp,
    CASE WHEN p_partkey % 2 = 1 THEN regexp_replace({PASCAL}, '[aeiou]', '', 'g') ELSE {PASCAL} END || 'Amt' AS name, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END AS doc,
    {listed(PART_VERSIONS)}[p_size % 5 + 1] AS version, CAST(p_size % 5 + 1 AS BIGINT) AS vk, {listed(["USAmountType", "efile:IntegerType", "(group)"])}[p_partkey % 3 + 1] AS raw, p_partkey AS seq, p_size FROM part),
x AS (SELECT '/' || schedule || '/' || grp || '/' || name AS xpath, * FROM e)"""
EXACT = f"""{ELEMENTS},
ex AS (SELECT xpath, any_value(schedule) AS schedule, any_value(grp) AS grp, any_value(name) AS name, arg_max(raw, vk * 1000000000 + seq) AS raw, arg_max(doc, vk * 1000000000 + seq) FILTER (doc <> '') AS doc, list_sort(list(DISTINCT vk)) AS vks FROM x GROUP BY xpath),
exact AS (SELECT xpath, schedule, grp, grp || '_' || name AS cname, {labelled("name")} AS label, {case("raw", TYPE_NAMES, "raw")} AS type, raw, coalesce(doc, {spaced("name")} || ' (within ' || {spaced("grp")} || ')') AS description, vks FROM ex)"""
# a description has at most two names here, the whole and the abbreviated one, so the fold is one step
MERGE = f"""{EXACT},
s AS (SELECT *, lower(trim(description)) AS said, row_number() OVER (PARTITION BY schedule, grp, lower(trim(description)) ORDER BY vks[-1], xpath) AS rn, count(*) OVER (PARTITION BY schedule, grp, lower(trim(description))) AS n FROM exact),
merged AS (SELECT p.*, o.xpath AS oxpath, o.vks AS ovks FROM s p LEFT JOIN s o ON p.schedule = o.schedule AND p.grp = o.grp AND p.said = o.said AND p.rn = 2 AND o.rn = 1 AND NOT list_has_any(p.vks, o.vks)
  WHERE NOT (p.rn = 1 AND p.n = 2 AND EXISTS (SELECT 1 FROM s q WHERE q.schedule = p.schedule AND q.grp = p.grp AND q.said = p.said AND q.rn = 2 AND NOT list_has_any(p.vks, q.vks)))),
mv AS (SELECT * EXCLUDE (ovks), list_sort(list_concat(vks, coalesce(ovks, []))) AS allv FROM merged),
fields AS (SELECT CASE WHEN count(*) OVER (PARTITION BY cname) > 1 THEN schedule || '_' || cname ELSE cname END AS cname, * EXCLUDE (cname) FROM mv),
fx AS (SELECT cname, schedule, grp, v AS vk, {listed(PART_VERSIONS)}[v] AS version, CASE WHEN list_contains(vks, v) THEN xpath ELSE oxpath END AS xpath FROM (SELECT *, unnest(allv) AS v FROM fields)),
cur AS (SELECT cname, arg_max(xpath, vk) AS current, arg_min(xpath, version) AS first_path, arg_max(xpath, version) AS last_path FROM fx GROUP BY cname),
freq AS (SELECT cname, sum(p_size) / count(*) AS pct FROM x JOIN cur ON x.xpath = cur.current WHERE p_size % 2 = 0 GROUP BY cname)"""


def versions(vks: str, mark: str = ";") -> str:
    return f"array_to_string(list_transform({vks}, lambda v: {listed(PART_VERSIONS)}[v]), '{mark}')"


CATS = f"""{MERGE}, cats AS (SELECT cname, schedule, CASE WHEN grp = 'Brand0Grp' THEN [] WHEN grp = 'Brand1Grp' THEN [[schedule, left(label, 1)], ['Brand']] ELSE [[schedule, left(label, 1), grp]] END AS paths FROM fields),
cp AS (SELECT cname, schedule, unnest(paths) AS path FROM cats)"""
CHOSEN = "['Brand', 'IRS990ScheduleD > S', 'IRS990ScheduleE > R > Brand3Grp']"
CAND = f"""{CATS}, hit AS (SELECT DISTINCT cname FROM cp WHERE list_contains(list_transform({CHOSEN}, lambda c: array_to_string(path, ' > ') = c OR starts_with(array_to_string(path, ' > '), c || ' > ') OR starts_with(c, array_to_string(path, ' > ') || ' > ')), true)),
cand AS (SELECT * FROM fields WHERE schedule = 'IRS990ScheduleC' OR cname IN (SELECT cname FROM hit))"""
SELECTION = """sel AS (SELECT CASE WHEN seq % 15 = 0 THEN lower(schedule || '_' || grp || '_' || name) ELSE schedule || '_' || grp || '_' || name END AS field_name, ['high', 'medium', 'low'][min(seq) % 3 + 1] AS priority FROM e GROUP BY 1)"""
DOCS = f"""{ELEMENTS}, leaf AS (SELECT version, schedule, grp, name, arg_min(raw, seq) AS raw, arg_min(doc, seq) AS doc FROM e WHERE raw <> '(group)' GROUP BY ALL)"""
NAMED = f"""{DOCS}, named AS (
  SELECT DISTINCT version, schedule AS name, schedule || '.xsd' AS file, 'complexType[sequence]' AS pattern, schedule AS context, schedule AS schedule FROM leaf
  UNION ALL SELECT DISTINCT version, grp, schedule || '.xsd', 'simple_typed', schedule || '/' || grp, schedule FROM leaf
  UNION ALL SELECT version, name, schedule || '.xsd', 'simple_typed', '[type:' || grp || 'Type]/' || name, '' FROM leaf)"""
CLASSIFIED = f"""{NAMED}, kn AS (SELECT DISTINCT regexp_replace(xpath, '^/IRS990ScheduleC/', '/IRS990ScheduleCOld/') AS xpath FROM x), leaves AS (SELECT DISTINCT split_part(xpath, '/', -1) AS name FROM kn), inside AS (SELECT DISTINCT unnest(string_split(xpath, '/')) AS name FROM kn),
dx AS (SELECT name, pattern, schedule FROM named QUALIFY row_number() OVER (PARTITION BY name ORDER BY length(context) DESC, file) = 1),
cl AS (SELECT name, pattern, schedule, CASE WHEN name IN (SELECT name FROM leaves) THEN 'leaf' WHEN name IN (SELECT name FROM inside) THEN 'group' ELSE 'missing' END AS found FROM dx WHERE schedule <> '')"""


# first-fit decreasing file by file: the first bin with room takes it
PACKED = """WITH RECURSIVE f AS (SELECT row_number() OVER (ORDER BY u DESC, path) AS i, * FROM (SELECT lpad(CAST(doc_id AS VARCHAR), 12, '0') AS path, strlen(coalesce(text, '')) AS size, least(greatest((size + 63) // 64, 1), 1024) AS u FROM documents)),
r AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS loads, CAST(0 AS BIGINT) AS bin, CAST(0 AS BIGINT) AS size
  UNION ALL SELECT i, list_concat(list_concat(loads[1:k - 1], [coalesce(loads[k], 0) + u]), loads[k + 1:]), k, size
  FROM (SELECT f.i, f.u, f.size, r.loads, coalesce(nullif(list_position(list_transform(r.loads, lambda x: x + f.u <= 1024), true), 0), len(r.loads) + 1) AS k FROM r JOIN f ON f.i = r.i + 1))
SELECT CAST(bin - 1 AS INT) AS bin, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM r WHERE i > 0 GROUP BY bin"""


REPORT = f"""WITH {BASE}, {INDEX}, {UNKNOWN}, {FUZZY_CORPUS}, n AS (SELECT count(*) AS n FROM base),
sc AS (SELECT split_part(xpath, '/', 2) AS schedule, count(*) AS t, count(*) FILTER (known) AS m FROM stats GROUP BY 1),
seen AS (SELECT DISTINCT version FROM base WHERE status <> 'malformed'), known AS (SELECT DISTINCT version FROM dict),
um AS (SELECT unk.*, coalesce(split_part(match, '/', -1), '-') AS leaf FROM unk LEFT JOIN fz ON unk.xpath = fz.xpath),
often AS (SELECT count(*) AS c, count(*) FILTER (version_covered) AS v FROM unk, n WHERE filing_count >= greatest(2, n.n * 0.1)),
bands AS (SELECT count(*) AS c, count(*) FILTER (score >= 0.8) AS h, count(*) FILTER (score >= 0.6 AND score < 0.8) AS m, count(*) FILTER (score < 0.6) AS l FROM fz),
wn AS (SELECT 'MISSING VERSION' AS kind, version AS subject, 'Filings use schema version ' || version || ', which the dictionary lacks.' AS message FROM seen WHERE version NOT IN (SELECT version FROM known)
  UNION ALL SELECT 'HIGH-FREQUENCY UNKNOWNS', '', c || ' unknown paths occur in 10% of the filings or more; ' || v || ' of them in covered versions.' FROM often WHERE c > 0
  UNION ALL SELECT 'FUZZY MATCHES', '', c || ' unknown paths have probable matches: ' || h || ' high, ' || m || ' medium, ' || l || ' low.' FROM bands WHERE c > 0
  UNION ALL SELECT CASE WHEN schedule NOT IN (SELECT schedule FROM dict) THEN 'MISSING SCHEDULE' WHEN m = 0 THEN 'XPATH MISMATCH' ELSE 'LOW COVERAGE' END, schedule, m || ' of ' || t || ' paths are in the dictionary.' FROM sc WHERE m * 100.0 / t < 50 AND t > 5),
al AS (
  SELECT 'summary' AS part, row_number() OVER () AS ord, subject, detail FROM (SELECT unnest(['filings_audited', 'unique_xpaths_seen', 'matched_xpaths', 'unknown_xpaths', 'unknowns_version_covered', 'unknowns_version_missing', 'fuzzy_matched', 'unused_fields', 'missing_versions']) AS subject,
    unnest([CAST((SELECT count(*) FROM base) AS VARCHAR), CAST((SELECT count(*) FROM stats) AS VARCHAR), CAST((SELECT count(*) FROM stats WHERE known) AS VARCHAR), CAST((SELECT count(*) FROM unk) AS VARCHAR), CAST((SELECT count(*) FROM unk WHERE version_covered) AS VARCHAR), CAST((SELECT count(*) FROM unk WHERE NOT version_covered) AS VARCHAR), CAST((SELECT count(*) FROM fz) AS VARCHAR), CAST((SELECT count(*) FROM unused) AS VARCHAR), CAST((SELECT count(*) FROM seen WHERE version NOT IN (SELECT version FROM known)) AS VARCHAR)]) AS detail)
  UNION ALL SELECT 'warnings', row_number() OVER (ORDER BY kind, subject), kind || CASE WHEN subject = '' THEN '' ELSE ' ' || subject END, message FROM wn
  UNION ALL SELECT 'versions', row_number() OVER (ORDER BY version), version, CASE WHEN version NOT IN (SELECT version FROM known) THEN 'only in filings' WHEN version NOT IN (SELECT version FROM seen) THEN 'only in the dictionary' ELSE 'in both' END FROM (SELECT version FROM seen UNION SELECT version FROM known)
  UNION ALL SELECT 'schedules', row_number() OVER (ORDER BY schedule), schedule, m || ' of ' || t || ' paths are known' || CASE WHEN m * 100.0 / t < 50 AND t > 5 THEN ', low' ELSE '' END FROM sc
  UNION ALL SELECT 'matches', row_number() OVER (ORDER BY score DESC, xpath), xpath, CASE WHEN score >= 0.8 THEN 'HIGH' WHEN score >= 0.6 THEN 'MED' ELSE 'LOW' END || ' ' || match || ': ' || reason FROM fz
  UNION ALL SELECT 'gaps', row_number() OVER (ORDER BY filing_count DESC, xpath), xpath, filing_count || ' filings, ' || guess || ', ' || leaf FROM um WHERE version_covered
  UNION ALL SELECT 'uncovered', row_number() OVER (ORDER BY filing_count DESC, xpath), xpath, filing_count || ' filings, ' || array_to_string(versions, ' ') || ', ' || leaf FROM um WHERE NOT version_covered
  UNION ALL SELECT 'unused', row_number() OVER (ORDER BY field), field, '' FROM unused),
cut AS (SELECT part, ord, subject, detail FROM al WHERE ord <= 30 UNION ALL SELECT part, 31, '', 'and ' || (count(*) - 30) || ' more' FROM al GROUP BY part HAVING count(*) > 30)
SELECT part, CAST(ord AS INT) AS ord, subject, detail, (SELECT count(*) FROM cut) AS lines FROM cut"""


def oracle_sql() -> dict[str, str]:
    scalar_columns = ", ".join(
        f"coalesce(max(CASE WHEN field = {quoted(n)} THEN text END), '') AS \"{n}\"" for n in SCALARS
    )
    scalars = f"WITH {BASE}, {DICT}, {RESOLVE}, f AS (SELECT e.k, r.field, e.text FROM els e JOIN res r ON e.version = r.version AND e.xpath = r.xpath WHERE e.section = 'data' AND e.status = 'ok' AND e.num = 0), w AS (SELECT k, {scalar_columns} FROM base LEFT JOIN f USING (k) WHERE status = 'ok' GROUP BY k) SELECT {PATH} AS path, {HEADER}, {FORM}, w.* EXCLUDE (k) FROM w JOIN base USING (k)"
    groups = f"WITH {BASE} SELECT {PATH} AS path, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS ein, strftime(o_orderdate, '%Y-%m-%d') AS tax_period, CAST(num AS INT) AS instance_num, qty AS \"ContractorCompensationGrp_CompensationAmt\", city AS \"ContractorCompensationGrp_ContractorAddress_USAddress_CityNm\", flag AS \"ContractorCompensationGrp_ServicesDesc\" FROM base JOIN li USING (k) WHERE status = 'ok'"
    headers = f"WITH {BASE} SELECT {PATH} AS path, status, {HEADER}, {FORM}, CASE WHEN status IN ('malformed', 'no_header') THEN '' ELSE lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS legacy_ein, CASE WHEN status IN ('malformed', 'no_header') THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS legacy_period, CASE WHEN status IN ('malformed', 'no_header') THEN '' ELSE c_name END AS legacy_name FROM base"
    w = f"WITH {BASE}, {INDEX}, "
    full = f"{w}{UNKNOWN}, {FUZZY_CORPUS} "
    title = case("schedule", {k: v for k, v in FORM_TITLES.items() if k.startswith("IRS990Schedule")}, "schedule")
    dictionary_row = f"cname AS canonical_name, fields.schedule AS schedule, label, type, raw AS raw_type, description, grp AS \"group\", true AS repeating, {listed(PART_VERSIONS)}[allv[1]] AS version_start, {listed(PART_VERSIONS)}[allv[-1]] AS version_end"
    top = "CASE WHEN path IS NULL THEN 'Uncategorized' ELSE path[1] END"
    sub = "CASE WHEN path IS NULL OR len(path) = 1 THEN '(General)' ELSE array_to_string(path[2:], ' > ') END"
    return {
        "src_headers": headers,
        "src_headers_by_schema": headers,
        "src_packed": PACKED,
        "src_status": f"WITH {BASE} SELECT status, count(*) AS filings FROM base GROUP BY status",
        "src_first_filings": f"WITH {BASE} SELECT {PATH} AS path, status FROM base ORDER BY path LIMIT 500",
        "src_elements": f"WITH {BASE} SELECT xpath, section, true AS in_root_ns, count(*) AS n, count(DISTINCT k) AS filings, CAST(sum(length(text)) AS BIGINT) AS characters, CAST(sum(depth) AS BIGINT) AS depth FROM els GROUP BY xpath, section",
        "src_forms_present": f"WITH {BASE} SELECT {PATH} AS path, 'IRS990' || CASE WHEN form <> '' THEN ';IRS990' || form ELSE '' END || CASE WHEN st <> 'O' THEN ';IRS990ScheduleJ' ELSE '' END AS schedules, 'IRS990' || form AS form_type FROM base WHERE status IN ('ok', 'no_header')",
        "ext_resolve": f"WITH {BASE}, {DICT}, {RESOLVE} SELECT * FROM res",
        "ext_scalars": scalars,
        "ext_scalars_pivot": scalars,
        "ext_groups": groups,
        "ext_group_counts": f"WITH {BASE} SELECT 'ContractorCompensationGrp' AS group_name, count(*) AS instances FROM base JOIN li USING (k) WHERE status = 'ok'",
        "ext_preset_revenue": f"WITH {BASE} SELECT {PATH} AS path, {HEADER}, {FORM}, CAST(price + 1 AS VARCHAR) AS total_revenue FROM base WHERE status = 'ok'",
        "ext_preset_pay": f"WITH {BASE} SELECT {PATH} AS path, {HEADER}, {FORM}, coalesce(pay, '') AS officer_pay FROM base JOIN pay USING (k) WHERE status = 'ok'",
        "ext_preset_expenses": "SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.xml' AS path, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS ein, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS revenue, CAST(o_orderkey AS VARCHAR) AS expenses FROM orders",
        "ext_preset_support": "SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.xml' AS path, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS ein, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS public_support FROM orders",
        "ext_preset_assets": "SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.xml' AS path, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS ein, CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS net_assets FROM orders",
        "ext_officers": "SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '.xml' AS path, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS ein, '' AS tax_period, '/IRS990/Form990PartVIISectionA' || CASE WHEN year(o_orderdate) IN (1995, 1996) THEN '' ELSE 'Grp' END AS listed_in, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INT) AS number, CASE WHEN l_linenumber = 1 THEN 'Firm ' ELSE 'Person ' END || l_suppkey AS person, l_linestatus AS title, CASE WHEN l_returnflag = 'N' THEN '' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS pay FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
        "ext_older_names": f"WITH {BASE}, {INDEX} SELECT idx.field AS canonical_name, els.xpath AS xpath, count(*) AS n FROM els JOIN idx ON els.xpath = idx.xpath GROUP BY ALL",
        "dic_exact": f"WITH {EXACT} SELECT cname AS canonical_name, schedule, label, type, raw AS raw_type, description, grp AS \"group\", true AS repeating, {versions('vks')} AS versions, xpath FROM exact",
        "dic_merge": f"WITH {MERGE} SELECT xpath, {versions('allv')} AS versions, array_to_string(list_transform(allv, lambda v: CASE WHEN list_contains(vks, v) THEN xpath ELSE oxpath END), ';') AS paths FROM fields",
        "dic_fields": f"WITH {MERGE} SELECT {dictionary_row} FROM fields",
        "dic_index": f"WITH {MERGE} SELECT xpath, max(cname) AS canonical_name FROM fx GROUP BY xpath",
        "dic_aliases": f"{w}a AS (SELECT 1) SELECT field AS canonical_name, xpath, count(*) AS n FROM els JOIN idx USING (xpath) GROUP BY ALL",
        "dic_counts": f"WITH {MERGE} SELECT (SELECT count(*) FROM x) AS elements, (SELECT count(*) FROM fields) AS fields, (SELECT count(*) FROM fields) AS repeating, CAST(0 AS BIGINT) AS not_repeating",
        "fn_names": f"WITH {ELEMENTS}, n AS (SELECT DISTINCT xpath, schedule, grp, name, raw FROM x) SELECT xpath, raw AS xsd_type, grp || '_' || name AS canonical, {labelled('name')} AS label, {spaced('name')} || ' (within ' || {spaced('grp')} || ')' AS inferred, {case('raw', TYPE_NAMES, 'raw')} AS type, replace(raw, 'efile:', '') AS bare_type, grp AS group_name, '/' || schedule || '/' || grp AS group_prefix, name AS relative, schedule, name AS leaf, '/' || schedule || '/' || grp AS parent, {worded('name')} AS words, {title} AS title FROM n",
        "fn_versions": f"WITH {ELEMENTS} SELECT version, count(*) AS n, CAST(left(version, 4) AS INT) AS year, CAST(split_part(substr(version, 6), '.', 1) AS INT) AS major, CAST(split_part(version, '.', 2) AS INT) AS minor, CAST(left(version, 4) AS INT) AS filing_year, CAST(split_part(substr(version, 6), '.', 1) AS INT) * 10 + CAST(split_part(version, '.', 2) AS INT) AS filing_part FROM x GROUP BY version",
        "fn_values": f"WITH v AS (SELECT ['x', CAST(event_id AS VARCHAR), CAST(value AS VARCHAR), strftime(ts, '%Y-%m-%d'), lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST(event_id AS VARCHAR), 7, '0'), event_type, '0', 'n/a ', repeat(event_type, 12), ''][event_id % 10 + 1] AS sample, CAST(event_id % 110 AS DOUBLE) AS pct FROM events), t AS (SELECT trim(sample) AS sample, pct FROM v) SELECT {GUESS} AS guess, upper(sample) NOT IN ('', '0', '0.00', 'NONE', 'N/A') AS nontrivial, CASE WHEN pct >= 50 THEN 'green' WHEN pct >= 10 THEN 'orange' ELSE 'red' END AS band, CASE WHEN pct / 100 >= 0.8 THEN 'HIGH' WHEN pct / 100 >= 0.6 THEN 'MED' ELSE 'LOW' END AS confidence, count(*) AS n FROM t GROUP BY ALL",
        "fn_similarity": f"WITH {ELEMENTS}, n AS (SELECT name, list(DISTINCT schedule) AS s, {BIGRAMS.format('name')} AS bg FROM x GROUP BY name), p AS (SELECT a.name AS a, b.name AS b, list_has_any(a.s, b.s) AS same, CASE WHEN length(a.name) < 2 OR length(b.name) < 2 THEN CAST(0 AS DOUBLE) ELSE CAST(2 AS DOUBLE) * len(list_intersect(a.bg, b.bg)) / (len(a.bg) + len(b.bg)) END AS dice FROM n a, n b), q AS (SELECT a, b, dice, CAST({part('a', 'b', 'same')} AS DOUBLE) AS part FROM p) SELECT * FROM q WHERE dice >= 0.6 OR part > 0",
        "aud_filing_counts": f"WITH {BASE} SELECT {PATH} AS path, count(*) AS elements, count(DISTINCT xpath) AS distinct_xpaths FROM els GROUP BY k",
        "aud_path_stats": f"{w}{STATS} SELECT xpath, filing_count, array_to_string(versions, ';') AS versions, sample, known FROM stats",
        "aud_frequency": f"{w}{FP}, t AS (SELECT k, field, bool_or(upper(trim(sample)) NOT IN ('', '0', '0.00', 'NONE', 'N/A')) AS nt FROM paths JOIN idx USING (xpath) GROUP BY ALL), c AS (SELECT field, count(*) AS p, count(*) FILTER (nt) AS q FROM t GROUP BY field), n AS (SELECT count(*) AS n FROM base) SELECT d.field AS canonical_name, coalesce(p, 0) AS present_count, coalesce(p, 0) * 100.0 / n AS present_pct, coalesce(q, 0) AS nontrivial_count, coalesce(q, 0) * 100.0 / n AS nontrivial_pct FROM (SELECT DISTINCT field FROM dict) d LEFT JOIN c USING (field), n".replace("* 100.0 / n", "* CAST(100 AS DOUBLE) / n"),
        "aud_unknown": f"{w}{UNKNOWN} SELECT xpath, element_name, schedule, parent_xpath, filing_count, array_to_string(versions, ';') AS versions, version_covered, guess AS data_type_guess, sample AS sample_value FROM unk",
        "aud_missing_versions": f"WITH {BASE} SELECT DISTINCT version FROM base WHERE status <> 'malformed' AND version NOT IN {tuple(COVERED)}",
        "aud_unused": f"{w}{UNKNOWN} SELECT field AS canonical_name FROM unused",
        "aud_coverage": f"{w}{UNKNOWN}, c AS (SELECT count(*) AS seen, count(*) FILTER (known) AS matched, (SELECT count(*) FROM unk) AS unknown FROM stats) SELECT *, matched * CAST(100 AS DOUBLE) / (matched + unknown) AS coverage_pct FROM c",
        "aud_schedule_coverage": f"{w}{STATS}, c AS (SELECT split_part(xpath, '/', 2) AS schedule, count(*) AS total_xpaths, count(*) FILTER (known) AS matched FROM stats GROUP BY 1) SELECT *, total_xpaths - matched AS unknown, matched * CAST(100 AS DOUBLE) / total_xpaths AS coverage_pct FROM c",
        "aud_warnings": f"{full}, n AS (SELECT count(*) AS n FROM base), sc AS (SELECT split_part(xpath, '/', 2) AS schedule, count(*) AS t, count(*) FILTER (known) AS m FROM stats GROUP BY 1) SELECT 'MISSING VERSION' AS kind, version AS subject, CAST(1 AS BIGINT) AS count FROM (SELECT DISTINCT version FROM base WHERE status <> 'malformed' AND version NOT IN {tuple(COVERED)}) UNION ALL SELECT 'HIGH-FREQUENCY UNKNOWNS', '', c FROM (SELECT count(*) AS c FROM unk, n WHERE filing_count >= greatest(2, n.n * 0.1)) WHERE c > 0 UNION ALL SELECT 'FUZZY MATCHES', '', c FROM (SELECT count(*) AS c FROM fz) WHERE c > 0 UNION ALL SELECT CASE WHEN schedule NOT IN (SELECT schedule FROM dict) THEN 'MISSING SCHEDULE' WHEN m = 0 THEN 'XPATH MISMATCH' ELSE 'LOW COVERAGE' END, schedule, t FROM sc WHERE m * 100.0 / t < 50 AND t > 5",
        "aud_proposals": f"{full}, pr AS (SELECT CASE WHEN length(xpath) - length(replace(xpath, '/', '')) > 1 THEN array_to_string(string_split(xpath, '/')[3:], '_') ELSE xpath[2:] END AS canonical, unk.xpath, filing_count, match, score, CASE WHEN score >= 0.8 THEN 'PROBABLE_RENAME' WHEN score >= 0.6 THEN 'POSSIBLE_RENAME' ELSE 'NEEDS_REVIEW' END AS status FROM unk LEFT JOIN fz USING (xpath) WHERE filing_count >= 2) SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY xpath DESC) = 1",
        "aud_summary": f"{full} SELECT (SELECT count(*) FROM base) AS filings_audited, (SELECT count(*) FROM stats) AS unique_xpaths_seen, (SELECT count(*) FROM stats WHERE known) AS matched_xpaths, (SELECT count(*) FROM unk) AS unknown_xpaths, (SELECT count(*) FROM stats WHERE known) * CAST(100 AS DOUBLE) / ((SELECT count(*) FROM stats WHERE known) + (SELECT count(*) FROM unk)) AS coverage_pct, (SELECT count(*) FROM unk WHERE version_covered) AS unknowns_version_covered, (SELECT count(*) FROM unk WHERE NOT version_covered) AS unknowns_version_missing, (SELECT count(*) FROM unused) AS unused_fields, (SELECT count(DISTINCT version) FROM base WHERE status <> 'malformed' AND version NOT IN {tuple(COVERED)}) AS missing_versions, (SELECT count(*) FROM fz) AS fuzzy_matched",
        "fuz_parts": f"WITH {ELEMENTS}, {fuzzy(PART_UNKNOWN, PART_LEAVES, 'SELECT DISTINCT xpath AS candidate FROM x WHERE seq % 2 = 0')} SELECT * FROM fz",
        "brw_schedules": f"WITH {MERGE} SELECT schedule, count(*) FILTER (type <> '(group)') AS leaf_fields, count(*) FILTER (type = '(group)') AS groups FROM fields GROUP BY schedule HAVING count(*) FILTER (type <> '(group)') > 0",
        "brw_per_schedule": f"WITH {MERGE} SELECT schedule, count(*) AS fields FROM fields GROUP BY schedule",
        "brw_schedule_stats": f"WITH {MERGE} SELECT f.schedule, count(*) AS fields, (SELECT count(DISTINCT version) FROM fx WHERE fx.schedule = f.schedule) AS versions, round(coalesce(avg(pct), 0.0), 6) AS mean_present_pct FROM fields f LEFT JOIN freq USING (cname) GROUP BY f.schedule",
        "brw_overall": f"WITH {MERGE} SELECT count(*) AS fields, count(DISTINCT schedule) AS schedules, (SELECT count(DISTINCT version) FROM fx) AS versions FROM fields",
        "brw_filter": f"WITH {MERGE} SELECT cname AS canonical_name, label FROM fields LEFT JOIN freq USING (cname) WHERE schedule = 'IRS990ScheduleB' AND coalesce(pct, 0) >= 20 AND type = 'Dollar amount (USD)' AND list_contains(allv, 2) AND contains(lower(cname || ' ' || label || ' ' || description), 'ring')",
        "brw_categories": f"WITH {CATS} SELECT {top} AS top, {sub} AS sub, fields.cname AS canonical_name FROM fields LEFT JOIN cp USING (cname)",
        "brw_category_counts": f"WITH {CATS} SELECT {top} AS top, count(DISTINCT fields.cname) AS fields FROM fields LEFT JOIN cp USING (cname) GROUP BY 1",
        "brw_path_runs": f"WITH {MERGE} SELECT cname AS canonical_name, xpath, min(version) AS first, max(version) AS last, count(*) AS versions FROM fx GROUP BY ALL",
        "brw_facets": f"WITH {MERGE} SELECT DISTINCT 'type' AS facet, type AS value FROM fields WHERE schedule = 'IRS990ScheduleA' UNION SELECT DISTINCT 'version', version FROM fx",
        "cat_batches": f"WITH {MERGE}, r AS (SELECT cname, schedule, first_path, (row_number() OVER (PARTITION BY schedule ORDER BY cname) - 1) // 150 AS batch FROM fields JOIN cur USING (cname) WHERE grp <> 'Brand2Grp' AND schedule IN ('IRS990ScheduleA', 'IRS990ScheduleC')) SELECT schedule, batch, count(*) AS n, string_agg(cname, ';' ORDER BY cname) AS names, string_agg(first_path, ';' ORDER BY cname) AS xpaths FROM r GROUP BY ALL",
        "cat_tree": f"WITH {CATS}, nd AS (SELECT cname, path, unnest(range(1, len(path) + 1)) AS d FROM cp) SELECT array_to_string(path[1:d], ' > ') AS path, coalesce(string_agg(DISTINCT CASE WHEN d = len(path) THEN cname END, ';' ORDER BY CASE WHEN d = len(path) THEN cname END), '') AS fields, count(DISTINCT cname) AS fields_below, d AS depth FROM nd GROUP BY array_to_string(path[1:d], ' > '), d",
        "cat_paths": f"WITH {CATS} SELECT array_to_string(path, ' > ') AS path, count(*) AS n FROM cp GROUP BY 1",
        "sel_candidates": f"WITH {CAND} SELECT cname AS canonical_name FROM cand",
        "sel_overflow": f"WITH {CAND}, t AS (SELECT cname, schedule FROM cand JOIN freq USING (cname) WHERE pct > 0), a AS (SELECT * FROM t UNION ALL SELECT cname, schedule FROM cand WHERE (SELECT count(*) FROM t) = 0), b AS (SELECT * FROM a WHERE schedule = 'IRS990ScheduleC' AND cname IN (SELECT cname FROM hit)) SELECT cname AS canonical_name FROM a WHERE (SELECT count(*) FROM b) = 0 OR (SELECT count(*) FROM a) <= 20 OR cname IN (SELECT cname FROM b)",
        "sel_lines": f"WITH {CAND} SELECT cand.cname AS canonical_name, cand.cname || ' | ' || label || ' | ' || type || ' | ' || cand.schedule || ' | ' || description || ' | freq | cats:' || array_to_string(list_transform(paths, lambda p: array_to_string(p, ' > ')), '; ') AS line FROM cand JOIN cats USING (cname)",
        "sel_check": f"WITH {MERGE}, {SELECTION} SELECT cname IS NOT NULL AS valid, priority, schedule, count(*) AS n FROM sel LEFT JOIN fields ON field_name = cname GROUP BY ALL",
        "snk_selection": f"WITH {CATS}, {SELECTION} SELECT field_name, label, fields.schedule AS schedule, type, priority, array_to_string(list_transform(paths, lambda p: array_to_string(p, ' > ')), ' | ') AS categories, last_path AS sample_xpath FROM sel JOIN fields ON field_name = fields.cname JOIN cats ON cats.cname = field_name JOIN cur ON cur.cname = field_name".replace("priority, array", "CASE WHEN priority = 'low' THEN '?' ELSE priority END AS priority, array"),
        "snk_dictionary": f"WITH {MERGE} SELECT cname AS canonical_name, schedule, current AS xpath, label AS human_label, type AS data_type, raw AS raw_xsd_type, grp AS parent_group, true AS is_repeating, description, {listed(PART_VERSIONS)}[allv[1]] AS version_start, {listed(PART_VERSIONS)}[allv[-1]] AS version_end, {versions('allv')} AS versions, " + ", ".join(f"CASE WHEN list_contains(vks, {k}) THEN xpath WHEN list_contains(allv, {k}) THEN oxpath ELSE '' END AS \"xpath_{v}\"" for k, v in enumerate(PART_VERSIONS, 1)) + " FROM fields JOIN cur USING (cname)",
        "snk_reference": f"WITH {MERGE} SELECT schedule, {title} AS title, grp AS section, cname AS canonical_name, '#### ' || label || chr(10) || chr(10) || '| Property | Value |' || chr(10) || '|----------|-------|' || chr(10) || '| **Canonical Name** | `' || cname || '` |' || chr(10) || '| **Data Type** | ' || type || ' |' || chr(10) || '| **Description** | ' || description || ' |' || chr(10) || '| **First Version** | ' || {listed(PART_VERSIONS)}[allv[1]] || ' |' || chr(10) || '| **Latest Version** | ' || {listed(PART_VERSIONS)}[allv[-1]] || ' |' || chr(10) || '| **All Versions** | ' || {versions('allv', ', ')} || ' |' || chr(10) || '| **Repeating Group** | `' || grp || '` |' || chr(10) || '| **XPath** | `' || current || '` |' || CASE WHEN oxpath IS NOT NULL THEN chr(10) || '| **Note** | XPath changed across versions |' ELSE '' END AS markdown FROM fields JOIN cur USING (cname)",
        "snk_lookup": f"WITH {MERGE} SELECT count(*) AS total_fields, (SELECT array_to_string(list_transform(list_sort(list(DISTINCT vk)), lambda v: {listed(PART_VERSIONS)}[v]), ';') FROM fx) AS versions, count(*) AS fields, (SELECT count(DISTINCT xpath) FROM fx) AS paths FROM fields",
        "snk_specs": f"WITH {CATS} SELECT fields.cname AS field_name, label, fields.schedule AS schedule, type, description, '' AS priority, '' AS relevance, array_to_string(list_distinct(list_transform(paths, lambda p: p[1])), '; ') AS categories, 'dictionary:IRS990ScheduleA' AS source_files, 'group_' || grp AS output_file, first_path AS sample_xpath FROM fields JOIN cats USING (cname) JOIN cur USING (cname) WHERE fields.schedule = 'IRS990ScheduleA' AND type <> '(group)'".replace("list_distinct(list_transform(paths, lambda p: p[1]))", "list_transform(paths, lambda p: p[1])"),
        "ext_spec_groups": f"WITH {MERGE} SELECT grp AS group_name, '/IRS990ScheduleA/' || grp AS group_prefix, 'IRS990ScheduleA' AS schedule, string_agg(cname, ';' ORDER BY cname) AS children FROM fields WHERE schedule = 'IRS990ScheduleA' AND type <> '(group)' GROUP BY grp",
        "ext_exports": "WITH p AS (SELECT p_brand || '.json' AS file, p_partkey AS pos, p_name, p_type FROM part), g AS (SELECT p_name, array_to_string(list_sort(list(DISTINCT file)), ';') AS sources FROM p GROUP BY p_name), f AS (SELECT p_name, p_type FROM p QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY file, pos) = 1) SELECT p_name AS field_name, p_type AS label, sources FROM f JOIN g USING (p_name)",
        "xsd_elements": f"WITH {DOCS} SELECT '/' || schedule || '/' || grp || '/' || name AS xpath, name AS element_name, raw AS xsd_type, doc AS documentation, grp AS parent_group, true AS is_repeating, '' AS min_occurs, '' AS max_occurs, schedule, version FROM leaf UNION ALL SELECT DISTINCT '/' || schedule || '/' || grp, grp, '(group)', '', '', true, '', 'unbounded', schedule, version FROM leaf",
        "xsd_shared_types": f"""WITH {DOCS}, g AS (SELECT DISTINCT version, schedule, grp FROM leaf), f AS (SELECT DISTINCT version, schedule FROM leaf),
r AS (SELECT '/' || schedule || '/' || grp || '/' || name AS xpath, name AS element_name, CASE raw WHEN 'efile:IntegerType' THEN 'IntegerType' ELSE raw END AS xsd_type, doc AS documentation, grp AS parent_group, true AS is_repeating, '' AS min_occurs, '' AS max_occurs, schedule, version FROM leaf
UNION ALL SELECT '/' || schedule || '/' || grp, grp, '(group)', '', '', true, '', 'unbounded', schedule, version FROM g
UNION ALL SELECT '/' || schedule || '/' || grp || '/BaseId', 'BaseId', 't:IdType', '', grp, true, '', '', schedule, version FROM g
UNION ALL SELECT '/' || schedule || '/' || grp || '/NoteTxt', 'NoteTxt', 't:NoteType', '', grp, true, '', 'unbounded', schedule, version FROM g
UNION ALL SELECT '/' || schedule || '/Chain' || repeat('/Next', CAST(k AS INT)) || '/CodeCd', 'CodeCd', 't:CodeType', '', '', false, '', '', schedule, version FROM f, range(29) t(k)) SELECT * FROM r""",
        "val_named": f"WITH {NAMED} SELECT * FROM named",
        "val_dedup": f"WITH {NAMED} SELECT name, max(length(context)) AS size FROM named GROUP BY name",
        "val_shared": f"WITH {CLASSIFIED} SELECT schedule <> '' AS in_form, count(*) AS n FROM dx GROUP BY 1",
        "snk_missing": f"WITH {CLASSIFIED} SELECT name AS element_name, pattern, schedule FROM cl WHERE found = 'missing'",
        "snk_tables": scalars,
        "snk_group_tables": groups,
        "src_schema_files": f"WITH {DOCS}, n AS (SELECT version, schedule, count(DISTINCT grp) + count(*) + 1 AS elements FROM leaf GROUP BY ALL), v AS (SELECT version, count(*) AS files, CAST(sum(elements) AS BIGINT) AS elements FROM n GROUP BY version) SELECT *, false AS chosen FROM v UNION ALL SELECT *, true FROM v WHERE version = '2020v4.2'",
        "snk_report": REPORT,
        "snk_categories": f"WITH {CATS}, nd AS (SELECT cname, path, unnest(range(1, len(path) + 1)) AS d FROM cp) SELECT array_to_string(path[1:d], ' > ') AS path, coalesce(string_agg(DISTINCT CASE WHEN d = len(path) THEN cname END, ';' ORDER BY CASE WHEN d = len(path) THEN cname END), '') AS fields, count(DISTINCT cname) AS fields_below, d AS depth FROM nd GROUP BY array_to_string(path[1:d], ' > '), d",
        "src_filing_files": f"WITH {BASE} SELECT status, count(*) AS filings FROM base GROUP BY status",
        "src_lookup_file": f"WITH {MERGE} SELECT xpath, max(cname) AS canonical_name FROM fx GROUP BY xpath",
        "src_categories_file": f"WITH {CATS} SELECT array_to_string(path, ' > ') AS path, count(*) AS n FROM cp GROUP BY 1",
        "ext_export_specs": "WITH p AS (SELECT p_brand AS file, p_partkey AS pos, p_name, p_type FROM part), g AS (SELECT p_name, count(DISTINCT file) AS sources FROM p GROUP BY p_name), f AS (SELECT p_name, p_type FROM p QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY file, pos) = 1) SELECT p_name AS field_name, p_type AS label, sources, '/' || replace(p_name, ' ', '') AS sample_xpath FROM f JOIN g USING (p_name)",
        "val_classify": f"WITH {CLASSIFIED} SELECT name, found FROM cl",
        "val_missing_by_pattern": f"WITH {CLASSIFIED}, m AS (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY name) AS k FROM cl WHERE found = 'missing') SELECT pattern, count(*) AS n, string_agg(name, ';' ORDER BY name) FILTER (k <= 10) AS examples FROM m GROUP BY pattern",
        "val_missing_by_schedule": f"WITH {CLASSIFIED} SELECT schedule, count(*) AS n FROM cl WHERE found = 'missing' GROUP BY schedule",
        "w3_dictionary": f"WITH {DOCS}, lx AS (SELECT '/' || schedule || '/' || grp || '/' || name AS xpath, *, list_position({listed(PART_VERSIONS)}, version) AS vk FROM leaf), ex AS (SELECT xpath, any_value(schedule) AS schedule, any_value(grp) AS grp, any_value(name) AS name, arg_max(doc, vk) FILTER (doc <> '') AS doc, list_sort(list(DISTINCT vk)) AS vks FROM lx GROUP BY xpath UNION ALL SELECT '/' || schedule || '/' || grp, schedule, '', grp, NULL, list_sort(list(DISTINCT vk)) FROM lx GROUP BY schedule, grp), s AS (SELECT xpath, schedule, grp, CASE WHEN grp = '' THEN name ELSE grp || '_' || name END AS cname, coalesce(doc, {spaced('name')} || ' (within ' || {spaced(chr(39).join(['CASE WHEN grp = ', '', ' THEN schedule ELSE grp END']))} || ')') AS description, vks FROM ex), r AS (SELECT *, row_number() OVER (PARTITION BY schedule, grp, lower(trim(description)) ORDER BY vks[-1], xpath) AS rn, count(*) OVER (PARTITION BY schedule, grp, lower(trim(description))) AS n FROM s), m AS (SELECT p.*, coalesce(o.vks, []) AS ovks FROM r p LEFT JOIN r o ON p.schedule = o.schedule AND p.grp = o.grp AND lower(trim(p.description)) = lower(trim(o.description)) AND p.rn = 2 AND o.rn = 1 AND NOT list_has_any(p.vks, o.vks) WHERE NOT (p.rn = 1 AND p.n = 2 AND EXISTS (SELECT 1 FROM r q WHERE q.schedule = p.schedule AND q.grp = p.grp AND lower(trim(q.description)) = lower(trim(p.description)) AND q.rn = 2 AND NOT list_has_any(p.vks, q.vks)))) SELECT CASE WHEN count(*) OVER (PARTITION BY cname) > 1 THEN schedule || '_' || cname ELSE cname END AS canonical_name, schedule, description, {listed(PART_VERSIONS)}[list_min(list_concat(vks, ovks))] AS version_start, {listed(PART_VERSIONS)}[list_max(list_concat(vks, ovks))] AS version_end FROM m",
        "val_coverage": f"WITH {CLASSIFIED} SELECT count(*) AS elements, count(*) FILTER (found = 'leaf') AS leaves, count(*) FILTER (found = 'group') AS groups, count(*) FILTER (found = 'missing') AS missing, round(count(*) FILTER (found <> 'missing') * 100.0 / count(*), 6) AS coverage_pct FROM cl",
        "snk_unknown": f"{full} SELECT unk.xpath, element_name, schedule, parent_xpath, filing_count, filing_count * CAST(100 AS DOUBLE) / (SELECT count(*) FROM base) AS pct_of_filings, array_to_string(versions, ';') AS versions_seen, version_covered, guess AS data_type_guess, sample AS sample_value, coalesce(match, '') AS fuzzy_match, coalesce(score, 0.0) AS fuzzy_score, coalesce(reason, '') AS fuzzy_reason FROM unk LEFT JOIN fz USING (xpath)",
    }


MOVED = "CASE WHEN seq % 3 = 0 THEN 'IRS990ScheduleA' ELSE schedule END"
PART_UNKNOWN = f"SELECT DISTINCT '/' || {MOVED} || '/' || grp || '/' || name AS xpath, name AS element_name, {MOVED} AS schedule, '/' || {MOVED} || '/' || grp AS parent_xpath FROM x WHERE seq % 2 = 1"
PART_LEAVES = "SELECT DISTINCT xpath FROM x WHERE seq % 2 = 0 UNION SELECT DISTINCT '/' || schedule || '/' || grp FROM x WHERE seq % 2 = 0"
