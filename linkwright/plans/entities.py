"""Entity views over the test tables; columns id, src, name, addr, country."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("hospital", "hotel", "school", "garage", "bakery", "bank", "legal", "plain")


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by doc_id mod 3; the name is the first four words, the address the next ten; ``k`` is the text."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("text").isNotNull())
    w = F.split("text", " ", -1)
    src = (F.pmod("doc_id", F.lit(3)) + 1).cast("int")
    return d.select(F.concat(F.lit("S"), src, F.lit("-"), "doc_id").alias("id"), src.alias("src"), F.array_join(F.slice(w, 1, 4), " ").alias("name"), F.array_join(F.slice(w, 5, 10), " ").alias("addr"), F.col("lang").alias("country"), F.col("text").alias("k"))


def from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Businesses made of parts and nations with suffixes, addresses, codes and noise; ``k`` is the part."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    k = F.col("p_partkey")
    p = p.withColumn("nk", F.pmod(k, F.lit(25)).cast("int")).join(n, F.col("nk") == F.col("n_nationkey"))
    kind = F.get(F.array(*[F.lit(x) for x in KINDS]), F.pmod("p_size", F.lit(8)))
    nm = F.concat_ws(" ", "p_name", F.lower("p_type"), kind)
    land = F.get(F.array(F.lit("US"), F.lit("India"), F.lit("France")), F.pmod(k, F.lit(3)).cast("int"))
    h = (100 + F.pmod(k, F.lit(97))).cast("string")
    z = F.when(F.pmod(k, F.lit(3)) == 1, 110001 + F.pmod(k, F.lit(800000))).otherwise(10001 + F.pmod(k, F.lit(80000))).cast("string")
    base = p.select(k.alias("k"), nm.alias("nm"), F.col("n_name").alias("nat"), land.alias("land"), h.alias("h"), z.alias("z"))
    kk = F.col("k")
    each = lambda m: F.pmod(kk, F.lit(m))
    initials = F.array_join(F.transform(F.slice(F.split("nm", " "), 1, 3), lambda w: F.substring(w, 1, 1)), "")
    one = base.select(F.concat(F.lit("S1-"), kk).alias("id"), F.lit(1).alias("src"), F.concat("nm", F.lit(" Inc")).alias("name"), F.concat("h", F.lit(" "), "nat", F.lit(" Street "), "z").alias("addr"), F.col("land").alias("country"), "k")
    two = base.where(each(2) == 0).select(
        F.concat(F.lit("S2-"), kk), F.lit(2), F.when(each(7) == 0, "").otherwise(F.concat(F.upper("nm"), F.lit(" LLC LLC"))),
        F.concat(F.when(each(5) == 0, "999").otherwise(F.col("h")), F.lit(" "), "nat", F.lit(" Road "), "z"), "land", "k",
    )
    three = base.where(each(5) < 2).select(
        F.concat(F.lit("S3-"), kk), F.lit(3), F.when(each(10) == 0, initials).otherwise(F.concat("nm", F.lit(" www.site.com"))),
        F.concat("h", F.lit(" "), "nat", F.lit(" "), F.when(each(4) == 0, "10000").otherwise(F.col("z"))), F.when(each(11) == 0, "").otherwise(F.col("land")), "k",
    )
    return one.union(two).union(three)


def truth(entities: DataFrame) -> DataFrame:
    """(s1, id): records with the reference's ``k``."""
    a = entities.where("src = 1").select(F.col("id").alias("s1"), "k")
    return a.join(entities.where("src > 1").select("id", "k"), "k").select("s1", "id")


def test_pairs(entities: DataFrame) -> DataFrame:
    """(s1, id, prob, label): records of parts k, k + 1 and k + 5 with a probability that is a ratio of the keys."""
    a = entities.where("src = 1").select(F.col("id").alias("s1"), F.col("k").alias("k1"), F.explode(F.array(*[F.col("k") + d for d in (0, 1, 5)])).alias("k"))
    prob = F.pmod(F.col("k1") * 31 + F.col("k") * 17 + F.col("src") * 7, F.lit(1000)) / 1000.0
    return a.join(entities.where("src > 1").select("id", "src", "k"), "k").select("s1", "id", prob.alias("prob"), (F.col("k1") == F.col("k")).cast("int").alias("label"))
