"""Rules of the tab-separated output contract, as findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATCH_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")
RULES = {
    "V1": "file not found", "V2": "file is empty", "V3": "header has commas and no tab", "V4": "unexpected header", "V5": "row without a tab",
    "V6": "duplicate reference row", "V7": "repeated id in a list", "V8": "reference id in a list", "V9": "id without S2- or S3- prefix", "V10": "unknown id",
    "V11": "required reference missing", "V12": "reference not in the test set", "V13": "match not among candidates", "V14": "check not possible", "V15": "unreadable file",
}


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) from 1 in file order, without bringing lines to the driver: counts of partitions are summed there."""
    rows = spark.read.text(path).withColumn("_i", F.monotonically_increasing_id())
    part, low = F.shiftright("_i", 33), F.col("_i").bitwiseAND((1 << 33) - 1)
    base, bases = 0, []
    for p, n in sorted((r[0], r[1]) for r in rows.groupBy(part.alias("p")).count().collect()):
        bases.append((p, base))
        base += n
    bases = spark.createDataFrame(bases, "p long, base long")
    return rows.withColumn("p", part).join(F.broadcast(bases), "p").select((F.col("base") + low + 1).alias("line_no"), F.regexp_replace("value", "\r$", "").alias("value"))


def parse(lines: DataFrame) -> DataFrame:
    """(line_no, s1, ids) of body lines with a tab; a blank list is empty."""
    body = lines.where((F.col("line_no") > 1) & F.col("value").contains("\t"))
    rest = F.expr("substring(value, instr(value, '\t') + 1)")
    return body.select("line_no", F.substring_index("value", "\t", 1).alias("s1"), F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ",", -1)).alias("ids"))


def header_finding(lines: DataFrame, expected: tuple[str, str]) -> str | None:
    """V2, V3 or V4, or None: the driver looks at the first line only."""
    first = lines.where("line_no = 1").first()
    if first is None:
        return "V2"
    if "\t" not in first["value"] and "," in first["value"]:
        return "V3"
    return None if [c.strip().lower() for c in first["value"].split("\t")] == list(expected) else "V4"


def list_findings(lines: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """(rule, offender), distinct: V5 to V12 of a file with a good header. ``required`` and ``valid`` have a column id."""
    rows = parse(lines)
    one = rows.select("s1", F.explode("ids").alias("id"))
    out = [
        ("V5", lines.where((F.col("line_no") > 1) & ~F.col("value").contains("\t") & (F.trim("value") != "")).select(F.col("line_no").cast("string").alias("offender"))),
        ("V6", rows.groupBy("s1").count().where("count > 1").select(F.col("s1").alias("offender"))),
        ("V7", rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.col("s1").alias("offender"))),
        ("V8", one.where(F.col("id").startswith("S1-")).select(F.col("id").alias("offender"))),
        ("V9", one.where(~F.col("id").rlike("^S[123]-")).select(F.col("id").alias("offender"))),
        ("V11", required.join(rows, required["id"] == rows["s1"], "left_anti").select(F.col("id").alias("offender"))),
        ("V12", rows.join(required, required["id"] == rows["s1"], "left_anti").select(F.col("s1").alias("offender"))),
    ]
    if valid is not None:
        out.append(("V10", one.where(F.col("id").rlike("^S[23]-")).join(valid.select("id"), "id", "left_anti").select(F.col("id").alias("offender"))))
    return reduce(DataFrame.union, [df.distinct().select(F.lit(r).alias("rule"), "offender") for r, df in out])


def outside_candidates(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """V13: references with a match that isn't among their candidates; a repeated reference's last row counts."""
    last = lambda p, name: p.groupBy("s1").agg(F.max_by("ids", "line_no").alias(name))
    both = last(matched, "m").join(last(candidates, "c"), "s1", "left")
    return both.where(F.size(F.array_except("m", F.coalesce("c", F.array().cast("array<string>")))) > 0).select(F.lit("V13").alias("rule"), F.col("s1").alias("offender"))


def statistics(lines: DataFrame) -> DataFrame:
    """V16: rows, empty, non-empty."""
    return parse(lines).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("ids") == 0).alias("empty"), F.count_if(F.size("ids") > 0).alias("non_empty"))


def examples(findings: DataFrame, n: int = 5) -> DataFrame:
    """(rule, total, shown): the first ``n`` offenders of each rule."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("rule").orderBy("offender")
    first = findings.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("offender")), ", ").alias("shown"))
    return findings.groupBy("rule").agg(F.count(F.lit(1)).alias("total")).join(first, "rule")


def validate(spark: SparkSession, match_path: str, required: DataFrame, candidate_path: str | None = None, valid: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """(errors, warnings) as texts with up to five offenders each; fails closed on unreadable files."""
    errors, warnings, parsed = [], [], {}
    if valid is None:
        warnings.append("V14: ids aren't checked for existence")
    for name, path, header in (("matching", match_path, MATCH_HEADER), ("candidate", candidate_path, CANDIDATE_HEADER)):
        if path is None:
            warnings.append("V14: no candidate file")
            continue
        try:
            lines = numbered_lines(spark, path).persist()
            rule = header_finding(lines, header)
        except Exception as e:  # noqa: BLE001
            missing = "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)
            if missing and name == "candidate":
                warnings.append("V14: candidate file not found")
            else:
                errors.append(f"{'V1' if missing else 'V15'}: {name}: {RULES['V1' if missing else 'V15']}")
            continue
        if rule:
            errors.append(f"{rule}: {name}: {RULES[rule]}")
            continue
        found = examples(list_findings(lines, required, valid)).collect()
        errors += [f"{r['rule']}: {name}: {RULES[r['rule']]}: {r['total']} total, e.g. {r['shown']}" for r in sorted(found)]
        parsed[name] = parse(lines)
    if len(parsed) == 2:
        warnings += [f"V13: {RULES['V13']}: {r['total']} total, e.g. {r['shown']}" for r in examples(outside_candidates(parsed["matching"], parsed["candidate"])).collect()]
    return errors, warnings


def complete(required: DataFrame, matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1, matched, candidates) for every required reference: missing lists are empty, candidates take in the matches."""
    none = F.array().cast("array<string>")
    out = required.select(F.col("id").alias("s1")).join(matched.select("s1", F.col("ids").alias("m")), "s1", "left").join(candidates.select("s1", F.col("ids").alias("c")), "s1", "left")
    m = F.coalesce("m", none)
    return out.select("s1", m.alias("matched"), F.array_union(F.coalesce("c", m), m).alias("candidates"))
