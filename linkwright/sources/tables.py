"""Tab-separated sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")


def _resolve(df: DataFrame, names: tuple[str, ...]) -> list:
    """Columns by name, else by position."""
    return [F.col(f"`{n}`") if n in df.columns else F.col(f"`{df.columns[i]}`") for i, n in enumerate(names)]


def _tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, escape='"', inferSchema=False)


def read_source(spark: SparkSession, path: str, src: int, limit: int | None = None, offset: int = 0) -> DataFrame:
    """(id, src, name, addr, country, ordinal) as strings, nulls ''; ``ordinal`` follows file order.

    With ``limit`` or ``offset``, rows offset to offset + limit of the file: counts of partitions give line numbers.
    """
    df = _tsv(spark, path)
    i, n, a, c = _resolve(df, COLUMNS)
    out = df.select(i.alias("id"), F.lit(src).alias("src"), *[F.coalesce(x, F.lit("")).alias(k) for x, k in ((n, "name"), (a, "addr"), (c, "country"))], F.monotonically_increasing_id().alias("ordinal"))
    if limit is None and not offset:
        return out
    part, low = F.shiftright("ordinal", 33), F.col("ordinal").bitwiseAND((1 << 33) - 1)
    base, bases = 0, []
    for p, size in sorted((r[0], r[1]) for r in out.groupBy(part.alias("p")).count().collect()):
        bases.append((p, base))
        base += size
    bases = spark.createDataFrame(bases, "p long, base long")
    row = F.col("base") + low
    out = out.withColumn("p", part).join(F.broadcast(bases), "p").where(row >= offset)
    if limit is not None:
        out = out.where(row < offset + limit)
    return out.drop("p", "base")


def read_records(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """Union of sources, each tagged with its number; equal ids keep the first."""
    both = reduce(DataFrame.unionByName, [read_source(spark, p, n) for n, p in sorted(paths.items())])
    first = both.groupBy("id").agg(F.min_by(F.struct("src", "name", "addr", "country"), F.struct("src", "ordinal")).alias("r"))
    return first.select("id", "r.*")


def truth_pairs(df: DataFrame) -> DataFrame:
    """(s1, id) from (s1, comma list); null or empty lists give none."""
    s1, ids = _resolve(df, TRUTH)
    return df.select(s1.alias("s1"), F.explode(F.filter(F.transform(F.split(F.coalesce(ids, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")).alias("id")).distinct()


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return truth_pairs(_tsv(spark, path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Only the id column is parsed."""
    df = _tsv(spark, path)
    return df.select(F.trim(_resolve(df, COLUMNS[:1])[0]).alias("id")).where(F.col("id") != "")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """(s1, ids) of a results file; a line without a tab has an empty list."""
    from linkwright.operators.validate import numbered_lines

    return parse_results(numbered_lines(spark, path).where("line_no > 1"))


def parse_results(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t", 2)
    rest = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    return lines.where(F.trim("value") != "").select(F.get(parts, F.lit(0)).alias("s1"), F.when(rest == "", F.array().cast("array<string>")).otherwise(F.split(rest, ",")).alias("ids"))


def write_lists(lists: DataFrame, path: str, column: str, ordinal: str | None = None, files: int | None = 1) -> None:
    """Writes (s1, ids) as (source1_entity_id, ``column``) lines with a header, empty lists as nothing after the tab.

    ``ordinal`` gives the order. One file by contract; ``files=None`` keeps parallel parts in order of their names.
    """
    out = lists.select(*([ordinal] if ordinal else []), F.col("s1").alias("source1_entity_id"), F.array_join("ids", ",").alias(column))
    if ordinal:
        out = out.orderBy(ordinal).drop(ordinal)
    if files:
        out = out.coalesce(files)
    out.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", quote="")
