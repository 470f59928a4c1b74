"""Two-pass external shuffle: seeded scatter into memory-sized buckets, then Fisher-Yates inside each bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkwright.llm.common import checkpoint, documents, fresh_path, keyed_rows, running_bases, text_or_empty

#: Bytes of records a bucket holds on average; one task permutes one bucket at a time.
BUCKET_BYTES = 16 << 20
SHARDS = 16
#: Buckets up to this number have their places in the order broadcast (16 bytes each); those of more are joined.
BROADCAST_BUCKETS = 500_000


def two_pass_shuffle(records: DataFrame, size_col: str, shards: int, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``records`` plus ``shard`` and ``slot``: a seeded random order dealt over shards in turn.

    Pass 1 scatters rows by a seeded hash of their position in the input, so that repeated rows, null keys or a hot key
    scatter like any other; the buckets are the files of one exchange. Pass 2 permutes each bucket with Spark's
    ``shuffle`` (Fisher-Yates). Partition b is bucket b and holds nothing else, and the generator of a partition begins
    with the seed plus its number: each bucket is seeded by its id, and as its rows are sorted before, a task run again
    gives the same slots. The number of buckets follows from the bytes alone, so the order doesn't
    depend on partitions, executors or settings, only on the rows' places in their files. Row i of the order gets
    shard i mod ``shards`` and slot i div ``shards``: counts are at most one apart and slots gapless. An empty input
    gives no rows; columns called like the helpers here don't clash, as a row travels as one struct; ``shard`` and
    ``slot`` in the input are replaced.
    """
    spark = records.sparkSession
    records = records.drop("shard", "slot")
    total = records.agg(F.sum(F.col(f"`{size_col}`").cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    h = F.xxhash64(F.lit(seed), "_key")
    row = keyed_rows(records).select(F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"), h.alias("h"), F.col("_key").alias("rid"), F.col("_row").alias("row"))
    # Where each bucket begins in the order: running sums over one small row a bucket.
    counts = checkpoint(row.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    bases = running_bases(counts.withColumn("group", F.floor(F.col("bucket") / 1024)), "group", "bucket", "n").select("bucket", "base")
    rows = row.select("bucket", F.struct("h", "rid", "row").alias("item")).repartitionById(buckets, F.col("bucket"))
    mixed = rows.groupBy("bucket").agg(F.shuffle(F.sort_array(F.collect_list("item")), F.lit(seed)).alias("items"))
    place = F.col("base") + F.col("pos")
    return mixed.join(F.broadcast(bases) if buckets <= BROADCAST_BUCKETS else bases, "bucket").select("base", F.posexplode("items")).select("col.row.*", F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.floor(place / shards).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in slot order within each file; reruns overwrite.

    Each task writes the rows of its own buckets, so that the documents aren't shuffled once more.
    """
    sharded.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of ``write_shards``; ``schema`` is that of what was written, as no rows leave no files."""
    return spark.read.schema(schema).parquet(path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 of all documents under the law ``rows``; null texts have size 1 and checksum 0.

    Whole documents are shuffled and written; all columns are what the written shards give.
    """
    docs, text = documents(spark, sf_dir), text_or_empty()
    size = (F.octet_length(text) + 1).cast("long")
    sharded = two_pass_shuffle(docs.withColumn("_octets", size), "_octets", SHARDS)
    path = fresh_path(spark, "shards")
    sharded = sharded.drop("_octets")
    write_shards(sharded, path)
    return read_shards(spark, path, sharded.schema).select(
        "doc_id", size.alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
