"""DuckDB SQL for the queries of ``queries``; each string stands alone."""

from __future__ import annotations

from linkwright.functions import lexicon as lex
from linkwright.operators.blocking import STEPS
from linkwright.operators.features import NAMES
from linkwright.operators.metrics import GRID
from linkwright.plans.entities import KINDS
from linkwright.queries import K, THRESHOLD


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


E1 = """SELECT 'S' || (doc_id % 3 + 1) || '-' || doc_id AS id, (doc_id % 3 + 1)::INT AS src, array_to_string(string_split(text, ' ')[1:4], ' ') AS name,
array_to_string(string_split(text, ' ')[5:14], ' ') AS addr, lang AS country, text AS k FROM documents WHERE text IS NOT NULL"""

_KIND = "CASE p_size % 8 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END"
E2 = f"""WITH base AS (SELECT p_partkey AS k, p_name || ' ' || lower(p_type) || ' ' || {_KIND} AS nm, n_name AS nat,
CASE p_partkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'India' ELSE 'France' END AS land, (100 + p_partkey % 97)::VARCHAR AS h,
(CASE WHEN p_partkey % 3 = 1 THEN 110001 + p_partkey % 800000 ELSE 10001 + p_partkey % 80000 END)::VARCHAR AS z FROM part JOIN nation ON n_nationkey = p_partkey % 25)
SELECT 'S1-' || k AS id, 1 AS src, nm || ' Inc' AS name, h || ' ' || nat || ' Street ' || z AS addr, land AS country, k FROM base
UNION ALL SELECT 'S2-' || k, 2, CASE WHEN k % 7 = 0 THEN '' ELSE upper(nm) || ' LLC LLC' END, CASE WHEN k % 5 = 0 THEN '999' ELSE h END || ' ' || nat || ' Road ' || z, land, k FROM base WHERE k % 2 = 0
UNION ALL SELECT 'S3-' || k, 3, CASE WHEN k % 10 = 0 THEN array_to_string(list_transform(string_split(nm, ' ')[1:3], lambda w: w[1:1]), '') ELSE nm || ' www.site.com' END,
h || ' ' || nat || ' ' || CASE WHEN k % 4 = 0 THEN '10000' ELSE z END, CASE WHEN k % 11 = 0 THEN '' ELSE land END, k FROM base WHERE k % 5 < 2"""


def accents(x):
    return f"strip_accents({x})"


def urls(x):
    return f"regexp_replace({x}, '{lex.URL_PATTERN}', '', 'g')"


def legal(x):
    return f"regexp_replace({x}, '{lex.LEGAL_PATTERN}', '', 'g')"


def symbols(x):
    return rf"trim(regexp_replace(regexp_replace({x}, '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def words(x):
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def repeats(x):
    return f"(SELECT array_to_string(list_filter(ws, lambda w, i: i = 1 OR w <> ws[i - 1]), ' ') FROM (SELECT {words(x)} AS ws))"


def clean(x):
    return repeats(symbols(legal(urls(f"lower({accents(x)})"))))


def simple(x):
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


def grams(x, n=3, own=True):
    short = f"CASE WHEN {x} = '' THEN [] ELSE [{x}] END" if own else "[]"
    return f"CASE WHEN length({x}) < {n} THEN {short} ELSE list_distinct(list_transform(range(1, length({x}) - {n - 2}), lambda i: substr({x}, i, {n}))) END"


def tokens(nc, ac):
    return f"list_distinct(list_filter(string_split({nc} || ' ' || {ac}, ' '), lambda t: length(t) >= 3 AND t NOT IN {_in(lex.STOP_WORDS)}))"


def houses(x):
    return rf"list_distinct(regexp_extract_all({x}, '{lex.NUMBER_PATTERN}'))"


def joined(x):
    return f"array_to_string(list_sort({x}), '|')"


def land(x):
    return f"lower(trim(coalesce({x}, '')))"


def postal(a, c):
    six, five = (f"coalesce(regexp_extract_all({a}, '{p}', 1)[-1], '')" for p in (lex.SIX_DIGITS, lex.FIVE_DIGITS))
    return f"CASE WHEN {land(c)} IN {_in(lex.SIX_DIGIT_COUNTRIES)} THEN {six} WHEN {land(c)} IN {_in(lex.FIVE_DIGIT_COUNTRIES)} THEN {five} WHEN {six} <> '' THEN {six} ELSE {five} END"


def domain(n, a):
    found = rf"regexp_extract_all(lower({n} || ' ' || {a}), '\b[a-z]{{3,}}\b')"
    return "CASE " + " ".join(f"WHEN list_has_any({found}, {list(k)}) THEN '{d}'" for d, k in lex.DOMAINS.items()) + " ELSE '' END"


def acronym(a, b):
    def one(s, x):
        w = words(x)
        every = f"array_to_string(list_transform({w}, lambda w: w[1:1]), '')"
        some = f"array_to_string(list_transform(list_filter({w}, lambda w: w NOT IN {_in(lex.CONNECTIVES)}), lambda w: w[1:1]), '')"
        return rf"(length({s}) <= 6 AND regexp_full_match({s}, '[a-z]+') AND len({w}) >= 2 AND (starts_with({every}, {s}) OR starts_with({some}, {s})))"

    return f"CASE WHEN {a} <> '' AND {b} <> '' AND ({one(a, b)} OR {one(b, a)}) THEN 1.0 ELSE 0.0 END"


def house1(a):
    return rf"regexp_extract({a}, '{lex.FIRST_HOUSE}')"


def keys(n, a, c):
    w = f"list_filter(regexp_extract_all(lower(trim({n})), '[a-z0-9]+'), lambda w: length(w) >= 3)"
    long_ = "list_reduce(list_prepend('', w), lambda m, x: CASE WHEN length(x) > length(m) THEN x ELSE m END)"
    parts = [
        "CASE WHEN len(w) > 0 THEN c || '_n4_' || substr(w[1], 1, 4) END",
        "CASE WHEN len(w) > 0 THEN c || '_n3_' || substr(w[1], 1, 3) END",
        "CASE WHEN len(w) > 0 AND h <> '' THEN c || '_h_' || h || '_' || substr(w[1], 1, 3) END",
        "CASE WHEN length(w[2]) >= 4 THEN c || '_w2_' || substr(w[2], 1, 4) END",
        f"CASE WHEN length({long_}) >= 5 THEN c || '_long_' || substr({long_}, 1, 5) END",
        "CASE WHEN len(w) = 0 AND h <> '' THEN c || '_h_' || h END",
    ]
    return f"(SELECT list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL) FROM (SELECT {w} AS w, {house1(f'lower({a})')} AS h, {land(c)} AS c))"


def longest2(w):
    return f"list_transform(list_sort(list_transform({w}, lambda x, i: {{'l': -length(x), 'i': i, 'w': x}})), lambda s: s.w)[1:2]"


def jac(a, b):
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) END"


def ratio2(a, b):
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE {jac(grams(a, 2), grams(b, 2))} END"


def sorted_words(x):
    return f"array_to_string(list_sort({words(x)}), ' ')"


def frac(n, d):
    return f"CASE WHEN {d} > 0 THEN {n} / {d} ELSE 0.0 END"


def fbeta(p, r):
    return f"CASE WHEN 0.25 * ({p}) + ({r}) > 0 THEN 1.25 * ({p}) * ({r}) / (0.25 * ({p}) + ({r})) ELSE 0.0 END"


def prep(e: str) -> str:
    """CTEs e and r: entities, and with nulls as '' and cleaned name (nc) and address (ac)."""
    return f"""WITH e AS MATERIALIZED ({e}), r0 AS (SELECT id, src, coalesce(name, '') AS name, coalesce(addr, '') AS addr, coalesce(country, '') AS country, k FROM e),
r1 AS (SELECT *, {words(symbols(legal(urls(f"lower({accents('name')})"))))} AS nw0, {words(symbols(legal(urls(f"lower({accents('addr')})"))))} AS aw0 FROM r0),
r AS MATERIALIZED (SELECT id, src, name, addr, country, k, array_to_string(list_filter(nw0, lambda w, i: i = 1 OR w <> nw0[i - 1]), ' ') AS nc,
array_to_string(list_filter(aw0, lambda w, i: i = 1 OR w <> aw0[i - 1]), ' ') AS ac FROM r1)"""


P1, P2 = prep(E1), prep(E2)
PAIR = f"""SELECT a.id AS s1, b.id AS id, (((a.k * 31 + b.k * 17 + b.src * 7) % 1000) / 1000.0)::DOUBLE AS prob, (a.k = b.k)::INT AS label FROM e a, e b
WHERE a.src = 1 AND b.src > 1 AND b.k IN (a.k, a.k + 1, a.k + 5)"""
PAIRS = f"{P2}, pairs AS MATERIALIZED ({PAIR}), p AS MATERIALIZED (SELECT s1, pairs.id, prob, label, s.nc AS sn, s.ac AS sa, c.nc AS cn, c.ac AS ca, s.name AS s_name, c.name AS c_name, s.addr AS s_addr, c.addr AS c_addr, s.country AS s_country, c.country AS c_country, c.src AS c_src FROM pairs JOIN r s ON s.id = s1 JOIN r c ON c.id = pairs.id)"
SCORED = f"WITH e AS MATERIALIZED ({E2}), scored AS MATERIALIZED ({PAIR}), ents AS (SELECT id AS s1 FROM e WHERE src = 1), gt AS (SELECT a.id AS s1, b.id FROM e a JOIN e b ON a.k = b.k WHERE a.src = 1 AND b.src > 1)"


def pair(x):
    return f"{PAIRS} SELECT s1, id, round(({x})::DOUBLE, 6) AS value FROM p"


def index(p):
    return f"{p}, idx AS MATERIALIZED (SELECT unnest({tokens('nc', 'ac')}) AS token, src, id FROM r WHERE src > 1)"


def look(p):
    nw = f"list_filter({words('nc')}, lambda w: length(w) >= 3)"
    aw = f"list_filter({words('ac')}, lambda w: length(w) >= 3 AND w NOT IN {_in(lex.STOP_WORDS)})"
    return f"""{index(p)}, l0 AS (SELECT id AS s1, {nw} AS nw, {aw} AS aw, regexp_extract(addr, '{lex.NUMBER_PATTERN}') AS h FROM r WHERE src = 1),
look AS MATERIALIZED (SELECT s1, nw[1] AS n0, nw[2] AS n1, nullif(h, '') AS h, {longest2('nw')}[1] AS p3a, {longest2('nw')}[2] AS p3b, {longest2('aw')}[1] AS p4a, {longest2('aw')}[2] AS p4b FROM l0)"""


def hits(step):
    if step in ("p1", "p2"):
        other = "n1" if step == "p1" else "h"
        return f"SELECT s1, a.src, a.id FROM look JOIN idx a ON a.token = n0 JOIN idx b ON b.id = a.id AND b.token = {other}"
    return f"SELECT s1, src, id FROM look JOIN idx ON token = {step}"


def one_step(p, step, k=K):
    return f"{look(p)}, h AS ({hits(step)}) SELECT s1, src, id FROM h QUALIFY row_number() OVER (PARTITION BY s1 ORDER BY src, id) <= {k}"


def chain(p, k=K):
    """CTE pool: candidates by the six lookups."""
    out, prev = look(p), None
    for i, step in enumerate(STEPS):
        h = f"SELECT s1, src, id, row_number() OVER (PARTITION BY s1 ORDER BY src, id) AS rn FROM ({hits(step)})"
        if prev is None:
            out += f", pool{i} AS MATERIALIZED (SELECT s1, src, id FROM ({h}) WHERE rn <= {k})"
        else:
            out += f", used{i} AS (SELECT s1, count(*) AS n FROM {prev} GROUP BY s1), pool{i} AS MATERIALIZED (SELECT s1, src, id FROM {prev} UNION SELECT h.s1, src, id FROM ({h}) h LEFT JOIN used{i} u ON u.s1 = h.s1 WHERE rn <= {k} - coalesce(n, 0))"
        prev = f"pool{i}"
    return out + f", pool AS (SELECT * FROM {prev})"


def key_pairs(e, k=150):
    return f"""WITH e AS MATERIALIZED ({e}), kk AS MATERIALIZED (SELECT DISTINCT id, src, unnest({keys("coalesce(name, '')", "coalesce(addr, '')", "coalesce(country, '')")}) AS key FROM e),
kp AS (SELECT DISTINCT a.id AS s1, b.src, b.id FROM kk a JOIN kk b ON a.key = b.key WHERE a.src = 1 AND b.src > 1),
cand AS MATERIALIZED (SELECT s1, src, id FROM kp QUALIFY row_number() OVER (PARTITION BY s1 ORDER BY src, id) <= {k})"""


def accepted(e):
    ng, ag = grams(simple("coalesce(name, '')"), 3, False), grams(simple("coalesce(name, '') || ' ' || coalesce(addr, '')"), 3, False)
    ok = f"{jac('s.ag', 'c.ag')} >= 0.38 OR (s.h <> '' AND s.h = c.h AND {jac('s.ng', 'c.ng')} >= 0.35) OR ({jac('s.ng', 'c.ng')} >= 0.65 AND {jac('s.ag', 'c.ag')} >= 0.28)"
    return f"""{key_pairs(e)}, g AS MATERIALIZED (SELECT id, {ng} AS ng, {ag} AS ag, {house1("coalesce(addr, '')")} AS h FROM e),
acc AS (SELECT s1, cand.id FROM cand JOIN g s ON s.id = s1 JOIN g c ON c.id = cand.id WHERE {ok})"""


def lists(e):
    return f"{accepted(e)} SELECT e.id AS s1, coalesce(string_agg(acc.id, ',' ORDER BY acc.id), '') AS ids FROM e LEFT JOIN acc ON acc.s1 = e.id WHERE e.src = 1 GROUP BY e.id"


def jaro_cte(pairs):
    """CTEs ``jp`` (a, b) and ``jw`` (a, b, v): similarity of each distinct pair, its letters matched one by one from the left."""
    free = "list_filter(range(greatest(0, i - w), least(length(b), i + w + 1)), lambda j: substr(b, (j + 1)::INT, 1) = substr(a, i + 1, 1) AND NOT list_contains(used, j))[1]"
    prefix = "CASE WHEN substr(a, 1, 1) <> substr(b, 1, 1) THEN 0 WHEN substr(a, 2, 1) <> substr(b, 2, 1) OR least(length(a), length(b)) < 2 THEN 1 WHEN substr(a, 3, 1) <> substr(b, 3, 1) OR least(length(a), length(b)) < 3 THEN 2 WHEN substr(a, 4, 1) <> substr(b, 4, 1) OR least(length(a), length(b)) < 4 THEN 3 ELSE 4 END"
    return f"""jp AS MATERIALIZED (SELECT DISTINCT a, b FROM ({pairs})),
jg AS (SELECT a, b, 0 AS i, []::BIGINT[] AS used, '' AS l FROM jp WHERE a <> '' AND b <> '' AND a <> b
UNION ALL SELECT a, b, i + 1, CASE WHEN j IS NULL THEN used ELSE list_append(used, j) END, CASE WHEN j IS NULL THEN l ELSE l || substr(a, i + 1, 1) END FROM (SELECT *, {free} AS j FROM (SELECT *, greatest(greatest(length(a), length(b)) // 2 - 1, 0) AS w FROM jg WHERE i < length(a)))),
jm AS (SELECT a, b, length(l)::DOUBLE AS m, l, list_sort(used) AS u FROM jg WHERE i = length(a)),
jt AS (SELECT a, b, m, len(list_filter(range(1, m::INT + 1), lambda k: substr(l, k::INT, 1) <> substr(b, (u[k] + 1)::INT, 1))) / 2.0 AS t FROM jm),
js AS (SELECT a, b, CASE WHEN m = 0 THEN 0.0 ELSE (m / length(a) + m / length(b) + (m - t) / m) / 3.0 END AS sim, m, {prefix} AS pre FROM jt),
jw AS (SELECT a, b, CASE WHEN m = 0 THEN 0.0 ELSE least(1.0, sim + 0.1 * pre * (1.0 - sim)) END AS v FROM js UNION ALL SELECT a, b, CASE WHEN a <> '' AND a = b THEN 1.0 ELSE 0.0 END FROM jp WHERE a = '' OR b = '' OR a = b)"""


def jaro_sql(a, b):
    return f"{recursive(PAIRS)}, {jaro_cte(f'SELECT {a} AS a, {b} AS b FROM p')} SELECT s1, id, round(v, 6) AS value FROM p JOIN jw ON jw.a = {a} AND jw.b = {b}"


def recursive(ctes):
    return "WITH RECURSIVE" + ctes.lstrip().removeprefix("WITH")


def all_feature_sql():
    """The 30 features and both Jaro-Winkler columns."""
    base = feature_sql(", sn, cn, sa, ca")
    cut = base.rindex(" FROM x")
    head, last = base[:cut].rsplit("SELECT s1, id, ", 1)
    both = jaro_cte("SELECT sn AS a, cn AS b FROM p UNION ALL SELECT sa, ca FROM p")
    return f"{recursive(head.rstrip())}, {both}, f AS (SELECT s1, id, {last} FROM x) SELECT f.* EXCLUDE (sn, cn, sa, ca), round(n.v, 6) AS name_jaro, round(d.v, 6) AS addr_jaro FROM f JOIN jw n ON n.a = sn AND n.b = cn JOIN jw d ON d.a = sa AND d.b = ca"


def feature_sql(more="", source=PAIRS):
    T = {"sn": words("sn"), "cn": words("cn"), "sa": words("sa"), "ca": words("ca")}
    q = f"""{source}, w AS (SELECT *, list_distinct({T['sn']}) AS nt1, list_distinct({T['cn']}) AS nt2, list_distinct({T['sa']}) AS at1, list_distinct({T['ca']}) AS at2, {T['sn']} AS w1, {T['cn']} AS w2,
{grams('sn')} AS g1, {grams('cn')} AS g2, {grams('sa')} AS h1, {grams('ca')} AS h2, {sorted_words('sn')} AS ns1, {sorted_words('cn')} AS ns2, {sorted_words('sa')} AS as1, {sorted_words('ca')} AS as2,
list_sort({houses('s_addr')}) AS u1, list_sort({houses('c_addr')}) AS u2, {land('s_country')} AS l1, {land('c_country')} AS l2, {postal('s_addr', 's_country')} AS z1, {postal('c_addr', 'c_country')} AS z2, {domain('sn', 'sa')} AS d1, {domain('cn', 'ca')} AS d2 FROM p),
x AS (SELECT *, len(list_intersect(nt1, nt2)) AS o, len(list_intersect(at1, at2)) AS q FROM w)"""
    flag = lambda c: f"CASE WHEN {c} THEN 1.0 ELSE 0.0 END"
    f = {
        "name_jaccard": jac("nt1", "nt2"), "name_char_jaccard": jac("g1", "g2"), "name_ratio": ratio2("sn", "cn"), "name_sort_ratio": ratio2("ns1", "ns2"), "name_exact": flag("sn <> '' AND sn = cn"),
        "name_containment": frac("o", "least(len(nt1), len(nt2))"), "name_s1_in_cand": frac("o", "len(nt1)"), "name_cand_in_s1": frac("o", "len(nt2)"), "name_len_diff": "abs(len(nt1) - len(nt2))",
        "name_len_ratio": frac("least(len(nt1), len(nt2))", "greatest(len(nt1), len(nt2))"), "first_word_match": flag("coalesce(w1[1], '') <> '' AND w1[1] = w2[1]"), "last_word_match": flag("coalesce(w1[-1], '') <> '' AND w1[-1] = w2[-1]"),
        "acronym_match": acronym("sn", "cn"), "addr_jaccard": jac("at1", "at2"), "addr_char_jaccard": jac("h1", "h2"), "addr_sort_ratio": ratio2("as1", "as2"), "addr_containment": frac("q", "least(len(at1), len(at2))"),
        "addr_s1_in_cand": frac("q", "len(at1)"), "addr_cand_in_s1": frac("q", "len(at2)"), "addr_exact": flag("sa <> '' AND sa = ca"), "both_match_score": f"({jac('nt1', 'nt2')}) * ({jac('at1', 'at2')})", "both_exact": flag("sn <> '' AND sn = cn AND sa <> '' AND sa = ca"),
        "house_num_match": "CASE WHEN len(u1) = 0 OR len(u2) = 0 THEN 0.0 WHEN u1 = u2 THEN 1.0 WHEN list_has_any(u1, u2) THEN 0.5 ELSE 0.0 END", "house_num_conflict": flag("len(u1) > 0 AND len(u2) > 0 AND NOT list_has_any(u1, u2)"),
        "postal_match": flag("z1 <> '' AND z1 = z2"), "postal_conflict": flag("z1 <> '' AND z2 <> '' AND z1 <> z2 AND (l1 = '' OR l2 = '' OR l1 = l2)"), "domain_match": flag("d1 <> '' AND d1 = d2"), "domain_conflict": flag("d1 <> '' AND d2 <> '' AND d1 <> d2"),
        "country_match": flag("l1 <> '' AND l1 = l2"), "is_s2": flag("c_src = 2"),
    }
    return f"{q} SELECT s1, id, " + ", ".join(f"round(({f[n]})::DOUBLE, 6) AS {n}" for n in NAMES if n in f) + f"{more} FROM x"


def resolved():
    """Candidates, the country filter, features, three fixed votes, the threshold and both lists of every reference."""
    source = PAIRS.replace(P2, chain(P2), 1).replace(PAIR, "SELECT s1, id, 0.0::DOUBLE AS prob, 0 AS label FROM pool")
    head, last = feature_sql(", l1, l2", source).rsplit("SELECT s1, id, ", 1)
    return f"""{head}, f AS (SELECT s1, id, {last}),
y AS (SELECT s1, id FROM f WHERE (l1 = '' OR l2 = '' OR l1 = l2) AND round(0.5 * name_jaccard + 0.3 * name_char_jaccard + 0.2 * addr_jaccard, 5) >= 0.5),
ml AS (SELECT s1, string_agg(id, ',' ORDER BY id) AS ids FROM y GROUP BY s1), cl AS (SELECT s1, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT s1, id FROM pool) GROUP BY s1)
SELECT e.id AS s1, coalesce(cl.ids, '') AS candidates, coalesce(ml.ids, '') AS matched FROM e LEFT JOIN cl ON cl.s1 = e.id LEFT JOIN ml ON ml.s1 = e.id WHERE e.src = 1"""


def entity_f(tp="tp", fp="fp", gt="gt"):
    p, r = frac(tp, f"({tp} + {fp})"), frac(tp, gt)
    return f"CASE WHEN {gt} = 0 THEN CASE WHEN {fp} = 0 THEN 1.0 ELSE 0.0 END ELSE {fbeta(p, r)} END"


COUNTS = f"""{SCORED}, yes AS (SELECT s1, sum(label) AS tp, sum(1 - label) AS fp FROM scored WHERE prob >= {THRESHOLD} GROUP BY s1), g AS (SELECT s1, count(*) AS gt FROM gt GROUP BY s1),
counts AS (SELECT ents.s1, coalesce(tp, 0)::BIGINT AS tp, coalesce(fp, 0)::BIGINT AS fp, coalesce(gt, 0)::BIGINT AS gt FROM ents LEFT JOIN yes USING (s1) LEFT JOIN g USING (s1))"""
CURVE = f"""{SCORED}, t AS (SELECT unnest({GRID!r}::DOUBLE[]) AS threshold), g AS (SELECT s1, count(*) AS gt FROM gt GROUP BY s1),
yes AS (SELECT threshold, s1, sum(label) AS tp, sum(1 - label) AS fp FROM t JOIN scored ON prob >= threshold GROUP BY threshold, s1),
curve AS (SELECT t.threshold, avg({entity_f("coalesce(tp, 0)", "coalesce(fp, 0)", "coalesce(gt, 0)")}) AS macro_f05 FROM t CROSS JOIN ents LEFT JOIN yes ON yes.threshold = t.threshold AND yes.s1 = ents.s1 LEFT JOIN g ON g.s1 = ents.s1 GROUP BY t.threshold)"""
BEST = "(SELECT CASE WHEN max(macro_f05) > 0 THEN arg_max(threshold, {'m': macro_f05, 't': -threshold}) ELSE 0.5 END FROM curve)"

_S1 = "CASE WHEN k % 50 = 7 THEN 'S1-' || (k - 1) WHEN k % 61 = 5 THEN 'S1-9' || k ELSE 'S1-' || k END"


def lines(kind):
    rest = "'S2-' || k || ',S3-' || k" if kind == "candidate" else "'S3-' || k || CASE WHEN k % 9 = 0 THEN ',S2-0' ELSE '' END"
    ids = f"CASE WHEN k % 4 = 0 THEN '' WHEN k % 20 = 1 THEN 'S2-' || k || ',S2-' || k WHEN k % 20 = 2 THEN 'S1-' || k WHEN k % 20 = 3 THEN 'X9-' || k ELSE {rest} END"
    return f"SELECT k + 1 AS line_no, CASE WHEN k % 97 = 11 THEN NULL ELSE {_S1} END AS s1, CASE WHEN k % 97 = 11 THEN NULL ELSE {ids} END AS ids, CASE WHEN k % 97 = 11 THEN 'no tab ' || k END AS bad FROM (SELECT p_partkey AS k FROM part WHERE p_partkey > 0)"


def parsed(kind, name):
    return f"{name} AS (SELECT line_no, s1, CASE WHEN ids = '' THEN []::VARCHAR[] ELSE string_split(ids, ',') END AS ids FROM ({lines(kind)}) WHERE bad IS NULL)"


FINDINGS = f"""WITH e AS ({E2}), {parsed('matching', 'm')}, req AS (SELECT 'S1-' || p_partkey AS id FROM part), one AS (SELECT s1, unnest(ids) AS id FROM m),
f AS (SELECT DISTINCT * FROM (SELECT 'V5' AS rule, line_no::VARCHAR AS offender FROM ({lines('matching')}) WHERE bad IS NOT NULL
UNION ALL SELECT 'V6', s1 FROM m GROUP BY s1 HAVING count(*) > 1
UNION ALL SELECT 'V7', s1 FROM m WHERE len(ids) <> len(list_distinct(ids))
UNION ALL SELECT 'V8', id FROM one WHERE id LIKE 'S1-%'
UNION ALL SELECT 'V9', id FROM one WHERE NOT regexp_matches(id, '^S[123]-')
UNION ALL SELECT 'V11', id FROM req WHERE id NOT IN (SELECT s1 FROM m)
UNION ALL SELECT 'V12', s1 FROM m WHERE s1 NOT IN (SELECT id FROM req)
UNION ALL SELECT 'V10', id FROM one WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT id FROM e WHERE src > 1)))"""

_VOTE = "(CASE WHEN n % 3 <> 0 THEN (0.5 * prob + 0.3 * (n * 7 % 1000) / 1000.0 + 0.2 * (n * 11 % 1000) / 1000.0) / (0.5 + 0.3 + 0.2) ELSE (0.5 * prob + 0.3 * (n * 7 % 1000) / 1000.0) / (0.5 + 0.3) END)"
VOTES = f"{SCORED}, v AS (SELECT s1, id, {_VOTE} AS p FROM (SELECT *, round(prob * 1000)::INT AS n FROM scored))"


def oracle_sql() -> dict[str, str]:
    nm, ad, co = "coalesce(name, '')", "coalesce(addr, '')", "coalesce(country, '')"
    e1, e2 = f"WITH e AS ({E1})", f"WITH e AS ({E2})"
    show = lambda e, x: f"{e} SELECT id, {x} AS value FROM e"
    conf = f"SELECT count(*) FILTER (prob >= {THRESHOLD} AND label = 1) AS tp, count(*) FILTER (prob >= {THRESHOLD} AND label = 0) AS fp, count(*) FILTER (prob < {THRESHOLD} AND label = 1) AS fn, count(*) FILTER (prob < {THRESHOLD} AND label = 0) AS tn FROM scored"
    pr, rc = frac("tp", "(tp + fp)"), frac("tp", "(tp + fn)")
    curve = " SELECT round(threshold, 6) AS threshold, round(macro_f05, 6) AS macro_f05 FROM "
    r_words = "list_distinct(list_filter(regexp_split_to_array(lower({}), '\\s+'), lambda w: w <> ''))"
    rank_p = f"""{look(P2)}, h AS ({' UNION '.join(f"(SELECT s1, src, id FROM ({hits(s)}) QUALIFY row_number() OVER (PARTITION BY s1 ORDER BY src, id) <= 400)" for s in STEPS)}),
s AS (SELECT id AS s1, list_filter({words('nc')}, lambda w: length(w) >= 3) AS nw, list_filter({words('ac')}, lambda w: length(w) >= 3 AND w NOT IN {_in(lex.STOP_WORDS)}) AS aw, {houses('addr')} AS u, {land('country')} AS l FROM r WHERE src = 1),
c AS (SELECT id, {r_words.format('name')} AS nw, {r_words.format('addr')} AS aw, list_filter(regexp_split_to_array(lower(name), '\\s+'), lambda w: w <> '')[1] AS f, {houses('addr')} AS u, {land('country')} AS l FROM r WHERE src > 1),
x AS (SELECT h.s1, h.src, h.id, len(list_intersect(list_distinct(s.nw), c.nw)) AS n, len(list_intersect(list_distinct(s.aw), c.aw)) AS a, coalesce(s.nw[1], '') AS f1, coalesce(c.f, '') AS f2, s.u AS u1, c.u AS u2 FROM h JOIN s ON s.s1 = h.s1 JOIN c ON c.id = h.id WHERE s.l = '' OR c.l = '' OR s.l = c.l),
y AS (SELECT s1, src, id, (n * 4 + CASE WHEN n >= 2 THEN 5 ELSE 0 END + a * 2 + CASE WHEN a >= 2 THEN 4 ELSE 0 END + CASE WHEN f1 <> '' AND f1 = f2 THEN 3 ELSE 0 END
+ CASE WHEN length(f1) >= 4 AND length(f2) >= 4 AND substr(f1, 1, 4) = substr(f2, 1, 4) THEN 2 ELSE 0 END
+ CASE WHEN len(u1) > 0 AND len(u2) > 0 THEN CASE WHEN list_sort(u1) = list_sort(u2) THEN 3 WHEN NOT list_has_any(u1, u2) THEN -1 ELSE 0 END ELSE 0 END)::INT AS score FROM x)
SELECT s1, id, score, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, src, id)::INT AS rank FROM y QUALIFY rank <= 10"""
    return {
        "sc1_head": f"{e2} SELECT id, name, addr, country FROM e WHERE src = 1 ORDER BY id LIMIT 50",
        "sc3_slice": f"{e2} SELECT id, name FROM e WHERE src = 1 ORDER BY k LIMIT 50 OFFSET 20",
        "sc5_null_to_empty": f"{e2} SELECT id, coalesce(nullif(country, 'US'), '') AS country FROM e",
        "sc6_union_tagged": f"{e2} SELECT id, 'source' || src AS dataset FROM e WHERE src > 1",
        "sc7_ids": f"{e1} SELECT trim(id) AS id FROM e",
        "sc8_tolerant_results": f"SELECT coalesce(bad, s1) AS s1, coalesce(ids, '') AS ids FROM ({lines('matching')})",
        "sc9_preview": f"{e2} SELECT id, name FROM e WHERE src > 1 ORDER BY id LIMIT 10",
        "sc12_truth": f"WITH {parsed('matching', 'm')} SELECT DISTINCT s1, unnest(ids) AS id FROM m",
        "tx1_remove_accents": show(e1, accents(nm)),
        "tx2_lower": show(e1, f"lower({accents(nm)})"),
        "tx3_strip_urls": show(e2, urls(f"lower({nm})")),
        "tx4_strip_legal": show(e2, legal(f"lower({nm})")),
        "tx5_strip_symbols": show(e2, symbols(f"lower({ad})")),
        "tx6_drop_repeats": show(e1, repeats(symbols(f"lower({accents(ad)})"))),
        "tx7_clean_text": f"WITH e AS (SELECT id, name, addr FROM ({E1}) UNION ALL SELECT id, name, addr FROM ({E2})) SELECT id, {clean(nm)} AS name, {clean(ad)} AS addr FROM e",
        "tx9_digits": show(e2, rf"regexp_replace({ad}, '\D', '', 'g')"),
        "tx10_country": show(e2, land(f"' ' || {co}")),
        "tx11_simple_clean": show(e1, simple(nm)),
        "ex1_tokens": f"{P1} SELECT id, {joined(tokens('nc', 'ac'))} AS value FROM r",
        "ex2_house_numbers": show(e2, joined(houses(f"{ad} || '-' || {ad}"))),
        "ex3_postal_code": f"{e2} SELECT id, {postal(ad, co)} AS value, {postal(ad, chr(39) * 2)} AS unknown FROM e",
        "ex4_domain": f"{P2} SELECT id, {domain('nc', 'ac')} AS value FROM r",
        "ex5_acronym_match": pair(acronym("sn", "cn")),
        "ex6_char_ngrams": f"{P2} SELECT id, {joined(grams('nc'))} AS value FROM r",
        "ex7_simple_grams": show(e2, joined(grams(simple(nm), 3, False))),
        "ex8_first_house": show(e2, house1(ad)),
        "ex9_blocking_keys": show(e2, f"array_to_string({keys(nm, ad, co)}, '|')"),
        "ex10_first_last_word": f"{P1} SELECT id, coalesce({words('nc')}[1], '') AS first, coalesce({words('nc')}[-1], '') AS last FROM r",
        "ex11_longest_two": f"{P1} SELECT id, array_to_string({longest2(words('ac'))}, '|') AS value FROM r",
        "ex12_profile": f"{P2} SELECT id, nc AS name_c, ac AS addr_c, len(list_distinct({words('nc')}))::INT AS nt, len({grams('nc')})::INT AS ng, len({grams('ac')})::INT AS ag, coalesce({words('nc')}[1], '') AS fw, coalesce({words('nc')}[-1], '') AS lw, {joined(houses('addr'))} AS house, {land('country')} AS land, {postal('addr', 'country')} AS postal, {domain('nc', 'ac')} AS dom FROM r",
        "ex13_token_index": f"{index(P1)} SELECT token, src, id FROM idx",
        "bl1_postings": one_step(P1, "p3a"),
        "bl2_conjunction": one_step(P1, "p1"),
        "bl4_name_house": one_step(P2, "p2"),
        "bl6_address_tokens": one_step(P1, "p4a"),
        "bl5_second_name_token": one_step(P1, "p3b"),
        "bl6_second_address_token": one_step(P1, "p4b"),
        "bl8_candidates": f"{chain(P1)} SELECT s1, src, id FROM pool",
        "bl8_candidates_parts": f"{chain(P2)} SELECT s1, src, id FROM pool",
        "bl9_ranked": rank_p,
        "bl10_attributes": f"{chain(P1)} SELECT s1, pool.id, e.name, e.country FROM pool JOIN e ON e.id = pool.id",
        "bl12_key_candidates": f"{key_pairs(E2)} SELECT s1, src, id FROM cand",
        "bl13_country_filter": f"{PAIRS} SELECT s1, id FROM p WHERE {land('s_country')} = '' OR {land('c_country')} = '' OR {land('s_country')} = {land('c_country')}",
        "bl14_labels": f"{chain(P1)} SELECT s1, pool.id, (a.k = b.k)::INT AS label FROM pool JOIN e a ON a.id = s1 JOIN e b ON b.id = pool.id",
        "bl15_truth_of_chunk": f"{e2} SELECT a.id AS s1, b.id FROM e a JOIN e b ON a.k = b.k WHERE a.src = 1 AND b.src > 1 AND a.id IN (SELECT id FROM e WHERE src = 1 QUALIFY row_number() OVER (ORDER BY id DESC) > 50)",
        "bl16_holdout": f"{e2} SELECT id FROM e WHERE src = 1 QUALIFY row_number() OVER (ORDER BY id DESC) > 50",
        "bl17_complete": f"""WITH {parsed('matching', 'm')}, {parsed('candidate', 'c')}, req AS (SELECT 'S1-' || p_partkey AS id FROM part), ml AS (SELECT s1, arg_max(ids, line_no) AS ids FROM m GROUP BY s1), cl AS (SELECT s1, arg_max(ids, line_no) AS ids FROM c GROUP BY s1)
SELECT req.id AS s1, array_to_string(coalesce(ml.ids, []), ',') AS matched, {joined("list_distinct(list_concat(coalesce(cl.ids, ml.ids, []), coalesce(ml.ids, [])))")} AS candidates FROM req LEFT JOIN ml ON ml.s1 = req.id LEFT JOIN cl ON cl.s1 = req.id""",
        "sm1_jaccard": pair(jac(f"list_distinct({words('sn')})", f"list_distinct({words('cn')})")),
        "sm2_string_ratio": pair(ratio2("sn", "cn")),
        "sm3_token_sort_ratio": f"{PAIRS}, q AS (SELECT s1, id, {sorted_words('sa')} AS x, {sorted_words('ca')} AS y FROM p) SELECT s1, id, round({ratio2('x', 'y')}, 6) AS value FROM q",
        "sm5_containment": pair(frac(f"len(list_intersect({words('sa')}, {words('ca')}))", f"least(len(list_distinct({words('sa')})), len(list_distinct({words('ca')})))")),
        "sm6_gram_jaccard": f"{PAIRS}, q AS (SELECT s1, id, {grams(simple('s_name'), 3, False)} AS x, {grams(simple('c_name'), 3, False)} AS y FROM p) SELECT s1, id, round({jac('x', 'y')}, 6) AS value FROM q",
        "sm7_rule_accepts": f"{accepted(E2)} SELECT s1, id FROM acc",
        "sm8_f_beta": f"{SCORED} SELECT s1, id, round({fbeta('prob', '1 - prob')}, 6) AS value FROM scored",
        "f30_pair_features": feature_sql(),
        "f32_pair_features": all_feature_sql(),
        "resolve_parts": resolved(),
        "sm4_jaro_winkler": jaro_sql("sn", "cn"),
        "ag15_confusion_matrix": f"{SCORED} SELECT label AS actual, count(*) FILTER (prob < {THRESHOLD}) AS predicted_no, count(*) FILTER (prob >= {THRESHOLD}) AS predicted_yes, round(count(*) FILTER (prob < {THRESHOLD}) / count(*), 6) AS rate_no, round(count(*) FILTER (prob >= {THRESHOLD}) / count(*), 6) AS rate_yes FROM scored GROUP BY label",
        "solver_rules": lists(E2),
        "solver_rules_documents": lists(E1),
        "ml5_blend": f"{VOTES} SELECT s1, id, round(p, 6) AS p FROM v",
        "ml6_decide": f"{VOTES} SELECT s1, id, (round(p, 6) >= {THRESHOLD})::INT AS yes FROM v",
        "ag1_ag2_confusion": f"{SCORED}, n AS ({conf}), q AS (SELECT *, {pr} AS p, {rc} AS r FROM n) SELECT tp, fp, fn, tn, round(p, 6) AS cand_prec, round(r, 6) AS cand_rec, round({fbeta('p', 'r')}, 6) AS cand_f05 FROM q",
        "ag3_entity_counts": f"{COUNTS} SELECT s1, tp, fp, gt FROM counts",
        "ag4_entity_f05": f"{COUNTS} SELECT s1, round({entity_f()}, 6) AS f05 FROM counts",
        "ag5_ag7_macro": f"{COUNTS} SELECT round(avg({entity_f()}), 6) AS macro_f05, count(*) FILTER (gt = 0 AND fp = 0) AS correct_singletons, count(*) FILTER (gt = 0 AND fp > 0) AS false_singletons FROM counts",
        "ag6_blocking_recall": f"{SCORED} SELECT round((SELECT sum(label) FROM scored) / (SELECT count(*) FROM gt) * 100.0, 6) AS blocking_recall",
        "ag8_threshold_curve": CURVE + curve + "curve",
        "ag8_best_threshold": f"{CURVE} SELECT round(threshold, 6) AS threshold, round(macro_f05, 6) AS macro_f05 FROM curve WHERE threshold = {BEST}",
        "ag9_micro_curve": f"""{SCORED}, t AS (SELECT unnest({GRID!r}::DOUBLE[]) AS threshold), n AS (SELECT threshold, count(*) FILTER (prob >= threshold AND label = 1) AS tp, count(*) FILTER (prob >= threshold AND label = 0) AS fp, count(*) FILTER (label = 1) AS pos FROM t CROSS JOIN scored GROUP BY threshold)
SELECT round(threshold, 6) AS threshold, round({fbeta(frac('tp', '(tp + fp)'), frac('tp', 'pos'))}, 6) AS macro_f05 FROM n""",
        "ag9_retrieved_curve": f"""{SCORED}, t AS (SELECT unnest({GRID!r}::DOUBLE[]) AS threshold), n AS (SELECT threshold, s1, count(*) FILTER (prob >= threshold AND label = 1) AS tp, count(*) FILTER (prob >= threshold AND label = 0) AS fp, count(*) FILTER (label = 1) AS gt FROM t CROSS JOIN scored GROUP BY threshold, s1)
SELECT round(threshold, 6) AS threshold, round(avg({entity_f()}), 6) AS macro_f05 FROM n GROUP BY threshold""",
        "ag10_matches": f"{SCORED} SELECT ents.s1, coalesce(string_agg(scored.id, ',' ORDER BY scored.id), '') AS ids FROM ents LEFT JOIN scored ON scored.s1 = ents.s1 AND prob >= {THRESHOLD} GROUP BY ents.s1",
        "ag11_ag16_token_frequency": f"{index(P1)} SELECT token, count(*) AS n FROM idx GROUP BY token HAVING count(*) > 20",
        "ag12_groups": f"{SCORED} SELECT DISTINCT s1 FROM scored",
        "ag13_counters": f"{SCORED} SELECT (SELECT count(DISTINCT s1) FROM scored WHERE prob >= {THRESHOLD}) AS non_empty, (SELECT count(*) FROM ents) AS n",
        "ag14_report": f"""{CURVE}, b AS (SELECT {BEST} AS threshold), n AS (SELECT b.threshold, count(*) FILTER (prob >= b.threshold AND label = 1) AS tp, count(*) FILTER (prob >= b.threshold AND label = 0) AS fp, count(*) FILTER (prob < b.threshold AND label = 1) AS fn, count(*) FILTER (prob < b.threshold AND label = 0) AS tn FROM b CROSS JOIN scored GROUP BY b.threshold),
q AS (SELECT *, {pr} AS p, {rc} AS r FROM n) SELECT tp, fp, fn, tn, round(p, 6) AS cand_prec, round(r, 6) AS cand_rec, round({fbeta('p', 'r')}, 6) AS cand_f05, round((SELECT sum(label) FROM scored) / (SELECT count(*) FROM gt) * 100.0, 6) AS blocking_recall, round((SELECT macro_f05 FROM curve WHERE curve.threshold = q.threshold), 6) AS macro_f05, round(threshold, 6) AS threshold FROM q""",
        "so1_intersect": f"{index(P1)} SELECT id FROM idx WHERE token = 'the' INTERSECT SELECT id FROM idx WHERE token = 'and'",
        "so2_union": f"{chain(P1)} SELECT id FROM pool UNION SELECT b.id FROM e a JOIN e b ON a.k = b.k WHERE a.src = 1 AND b.src > 1",
        "so4_difference": f"{chain(P1)} SELECT id FROM e WHERE src > 1 EXCEPT SELECT id FROM pool",
        "so5_first_of_each": f"{e1} SELECT name, arg_min(id, {{'s': src, 'i': id}}) AS id FROM e WHERE src > 1 GROUP BY name",
        "so7_examples": f"{FINDINGS}, x AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY offender) AS rn FROM f) SELECT rule, count(*) AS total, string_agg(offender, ', ' ORDER BY offender) FILTER (rn <= 5) AS shown FROM x GROUP BY rule",
        "v5_v12_findings": f"{FINDINGS} SELECT rule, offender FROM f",
        "v13_outside_candidates": f"WITH {parsed('matching', 'm')}, {parsed('candidate', 'c')}, ml AS (SELECT s1, arg_max(ids, line_no) AS ids FROM m GROUP BY s1), cl AS (SELECT s1, arg_max(ids, line_no) AS ids FROM c GROUP BY s1) SELECT 'V13' AS rule, ml.s1 AS offender FROM ml LEFT JOIN cl ON cl.s1 = ml.s1 WHERE len(list_filter(ml.ids, lambda x: NOT list_contains(coalesce(cl.ids, []), x))) > 0",
        "v16_statistics": f"WITH {parsed('matching', 'm')} SELECT count(*) AS n, count(*) FILTER (len(ids) = 0) AS empty, count(*) FILTER (len(ids) > 0) AS non_empty FROM m",
        "sk1_candidate_lines": f"{chain(P1)} SELECT s1 || chr(9) || string_agg(id, ',' ORDER BY id) AS line FROM pool GROUP BY s1",
    }
