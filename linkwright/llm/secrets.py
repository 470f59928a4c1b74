"""Secret scans in DataFrame functions only: base patterns, and weak parts that count where complementary parts are near."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwright.llm.common import documents, keyed_rows

#: Code points between the starts of two parts of one credential.
SCOPE = 300
#: kind: (pattern, group whose length counts, its least length, what the match must also look like).
#: Fixed patterns: the first three are the base kinds, reported always; the others only in company.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ()),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, ()),
    "hex": (r"[0-9a-f]{24,}", 0, 24, ()),
    "ident": (r"""(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{16,}|(?i:client|account|access_?key|key|user)_?(?i:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}""", 0, 8, ()),
    "weak": (r"[A-Za-z0-9+/]{32,}", 0, 32, ("[A-Z]", "[a-z]", "[0-9]")),
    "endpoint": (r"""(?:https?|postgres|postgresql|mysql|redis|amqp|mongodb|s3)://[A-Za-z0-9._:@-]+""", 0, 8, ()),
}
BASE = ("assign", "access", "hex")
NAMES = list(KINDS)
WHO = ("access", "ident")
WHAT = ("assign", "hex", "weak")


def _found(kind: str) -> Column:
    """array<struct<kind, nth, gap, size, ok>>: matches from the left with the code points before each since the last one."""
    pattern, group, least, looks = KINDS[kind]
    text, p = F.col("text"), F.lit(pattern)
    parts = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, p, 0), F.regexp_extract_all(text, p, group))

    def one(x: Column, i: Column) -> Column:
        hit, counted = x.getField("1"), x.getField("2")
        ok = F.length(counted) >= least
        for look in looks:
            ok = ok & hit.rlike(look)
        return F.struct(F.lit(NAMES.index(kind)).alias("kind"), i.alias("nth"), F.length(x.getField("0")).alias("gap"), F.length(hit).alias("size"), ok.alias("ok"))

    # The text after the last match comes without a match: its size is null.
    none = F.array().cast("array<struct<kind:int,nth:int,gap:int,size:int,ok:boolean>>")
    return F.when(text.rlike(pattern), F.transform(parts, one)).otherwise(none)


def spans(docs: DataFrame, id_cols: list[str], scope: int = SCOPE) -> DataFrame:
    """``id_cols`` and ``found`` (array of (start, kind, end) in order) of each row; code points, ends exclusive.

    Matches become rows of a few numbers each; one shuffle by row brings those of a text together. Their starts are
    running sums; a range frame over starts then joins each part with those at most ``scope`` away: an access key or
    identifier counts as *who*, a base match or a weak secret as *what*. Weak parts stay where their complement is
    near: ident near a what, weak near a who, endpoint near both. Null texts are empty; rows with no match have an
    empty array; equal rows stay apart.
    """
    # Columns to keep travel as one struct, so their names can't clash with those here.
    rows = docs.select(F.monotonically_increasing_id().alias("_rid"), F.struct(*id_cols).alias("_ids"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select("_rid", "_ids", F.explode_outer(F.concat(*[_found(k) for k in KINDS])).alias("m")).select("_rid", "_ids", "m.*")
    each = Window.partitionBy("_rid", "kind").orderBy("nth")
    before = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(each.rowsBetween(Window.unboundedPreceding, 0)) - F.coalesce("size", F.lit(0))
    rows = rows.repartition("_rid").withColumn("start", before.cast("int")).withColumn("ok", F.coalesce(F.col("ok") & F.col("size").isNotNull(), F.lit(False)))
    near = Window.partitionBy("_rid").orderBy("start").rangeBetween(-scope, scope)
    is_in = lambda kinds: F.col("ok") & F.col("kind").isin([NAMES.index(k) for k in kinds])
    who, what = (F.max(F.when(is_in(k), 1).otherwise(0)).over(near) == 1 for k in (WHO, WHAT))
    rows = rows.withColumn("who", who).withColumn("what", what)
    ident, weak, endpoint = (NAMES.index(k) for k in ("ident", "weak", "endpoint"))
    stays = F.col("ok") & (
        is_in(BASE) | ((F.col("kind") == ident) & F.col("what")) | ((F.col("kind") == weak) & F.col("who")) | ((F.col("kind") == endpoint) & F.col("who") & F.col("what"))
    )
    span = F.when(stays, F.struct("start", "kind", (F.col("start") + F.col("size")).alias("end")))
    return rows.groupBy("_rid").agg(F.first("_ids").alias("_ids"), F.sort_array(F.collect_list(span)).alias("found")).select("_ids.*", "found")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each found span in ``text`` replaced by ``mark`` (overlapping ones together); null texts stay null.

    A column ``n_chars`` follows the new text where it changed. Every row stays.
    """
    rows = keyed_rows(docs)
    found = spans(rows.select("_key", "_row.text"), ["_key"]).where(F.size("found") > 0)
    rows = rows.join(found, "_key", "left")
    text = F.col("_row.text")
    piece = lambda a, b: F.substring(text, a + 1, b - a)

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        out = F.when(apart, F.concat(acc["out"], piece(acc["at"], s["start"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate("found", zero, step, lambda acc: F.concat(acc["out"], piece(acc["at"], F.length(text))))
    rows = rows.withColumn("_new", F.when(F.col("found").isNotNull(), new).otherwise(text))
    changed = {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("found").isNotNull(), F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return rows.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def _digest(found: Column) -> Column:
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == NAMES.index(k))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("found")).alias("spans"))


def _sql_kind(k: int, kind: str) -> str:
    pattern, group, least, looks = KINDS[kind]
    p = pattern.replace("'", "''")
    ok = " AND ".join([f"length(grp) >= {least}", *[f"regexp_matches(hit, '{x}')" for x in looks]])
    return (
        f"SELECT rid, {k} AS kind, nth, gap, hit, ({ok}) AS ok FROM (SELECT rid, unnest(range(1, len(h) + 1)) AS nth, unnest(s[1:len(h)]) AS gap, unnest(h) AS hit, unnest(g) AS grp FROM "
        f"(SELECT rid, regexp_extract_all(t, '{p}', 0) AS h, regexp_extract_all(t, '{p}', {group}) AS g, string_split_regex(t, '{p}') AS s FROM d WHERE regexp_matches(t, '{p}')))"
    )


def op1_sql() -> str:
    """The same rows in DuckDB SQL."""
    index = lambda kinds: "(" + ", ".join(str(NAMES.index(k)) for k in kinds) + ")"
    names = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
    near = f"OVER (PARTITION BY rid ORDER BY start RANGE BETWEEN {SCOPE} PRECEDING AND {SCOPE} FOLLOWING)"
    text = f"string_agg({names}[kind + 1] || ':' || start || ':' || (start + length(hit)), ',' ORDER BY start, kind)"
    counts = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{n}" for k, n in enumerate(BASE))
    zeros = ", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n in BASE)
    ident, weak, endpoint = (NAMES.index(k) for k in ("ident", "weak", "endpoint"))
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_sql_kind(k, n) for k, n in enumerate(NAMES))}),
p AS (SELECT *, (sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY nth) - length(hit))::INT AS start FROM m),
n AS (SELECT *, max((ok AND kind IN {index(WHO)})::INT) {near} AS who, max((ok AND kind IN {index(WHAT)})::INT) {near} AS what FROM p),
x AS (SELECT * FROM n WHERE ok AND (kind < {len(BASE)} OR (kind = {ident} AND what = 1) OR (kind = {weak} AND who = 1) OR (kind = {endpoint} AND who = 1 AND what = 1))),
g AS (SELECT rid, {counts}, coalesce({text.replace("ORDER BY start, kind)", f"ORDER BY start, kind) FILTER (kind < {len(BASE)})")}, '') AS base, {text} AS spans FROM x GROUP BY rid)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)"""
