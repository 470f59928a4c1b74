"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import bounded_batches, checkpoint, documents, fresh_path, keyed_rows

WORDS = 5
CONTAINED = 0.8
#: The bit set of sketches has at most 2^28 bits (32 MB); that many serve four million hashes well, and more at a higher rate of false ones.
MOST_BITS = 28
#: Sketch hashes, and rows found, up to these numbers go to the executors by broadcast; more are joined.
BROADCAST_SKETCHES, BROADCAST_ROWS = 200_000, 200_000
GAP = re.compile(r"\W+")
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def normal(text: str | None) -> str:
    """Lower-case words (letters, digits, underscores), one space between them."""
    return GAP.sub(" ", (text or "").lower()).strip()


def shingles(words: str, k: int = WORDS) -> list[str]:
    """Runs of ``k`` words of a normalised text; the whole text where it has fewer words; none where it has no word."""
    w = words.split()
    return [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


class ShingleHasher:
    """64-bit hashes of all shingles of a text at once, from a prefix sum over its bytes."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, 2 * len(self.power))
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE)], dtype=np.uint64)
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, INVERSE)], dtype=np.uint64)

    def __call__(self, words: str, k: int = WORDS) -> np.ndarray:
        raw = np.frombuffer(words.encode(), dtype=np.uint8)
        if not len(raw):
            return np.empty(0, np.uint64)
        self._grow(len(raw) + 1)
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw + np.uint64(1)) * self.power[: len(raw)], out=total[1:])
        gaps = np.flatnonzero(raw == 32)
        start, end = np.r_[0, gaps + 1], np.r_[gaps, len(raw)]
        if len(start) >= k:
            start, end = start[: len(start) - k + 1], end[k - 1 :]
        else:
            start, end = start[:1], end[-1:]
        h = (total[end] - total[start]) * self.inverse[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def sketch(text: str | None, hasher: ShingleHasher, contained: float = CONTAINED, k: int = WORDS) -> tuple[int, int, np.ndarray]:
    """(size, need, hashes) of an item: its number of distinct shingles, how many of them a text must hold, and its
    bottom-k MinHash sketch, the size - need + 1 least hashes. A text that holds ``need`` shingles holds one of these."""
    distinct = dict.fromkeys(shingles(normal(text), k))
    if not distinct:
        return 0, 0, np.empty(0, np.uint64)
    need = int(np.ceil(contained * len(distinct) - 1e-9))
    return len(distinct), need, np.unique(np.concatenate([hasher(s, len(s)) for s in distinct]))[: len(distinct) - need + 1]


def part_of(size: int) -> int:
    """Size partition: items of 1, 2-3, 4-7, ... distinct shingles."""
    return size.bit_length() - 1


class Bloom:
    """A bit set of bounded size that holds every sketch's hashes; it lets others pass at a rate that ``bits`` set."""

    PROBES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = words

    def places(self, h: np.ndarray, probe: int) -> np.ndarray:
        return (h * self.PROBES[probe]) >> np.uint64(64 - self.bits)

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Those of ``h`` that may be in the set."""
        for probe in range(len(self.PROBES)):
            if len(h):
                at = self.places(h, probe)
                h = h[(self.words[(at >> np.uint64(6)).astype(np.intp)] >> (at & np.uint64(63))) & np.uint64(1) > 0]
        return h


def build_bloom(sketches: DataFrame, n: int) -> Bloom:
    """The set of all sketches' hashes, or-ed together on the executors; the driver gets at most 2^``MOST_BITS`` bits."""
    bits = min(MOST_BITS, max(20, (64 * n).bit_length()))
    bloom = Bloom(bits)

    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            at = np.concatenate([bloom.places(h, p) for p in range(len(bloom.PROBES))])
            bit = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bit)], names=["word", "bit"])

    found = sketches.select("hash").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bloom.words = np.zeros(1 << (bits - 6), np.uint64)
    bloom.words[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return bloom


def contained_rows(docs: DataFrame, items: DataFrame, contained: float = CONTAINED, words: int = WORDS) -> DataFrame:
    """(_key, item_id, n_found, n_shingles): ``docs`` (_key, text) with the items they hold; nothing of a benchmark's size is
    held by the driver or a task.

    Items are sketched on the executors, in size partitions. Each partition has its own bound, its greatest sketch hash:
    a text's sketch for the partition is its hashes up to there, if the text has enough shingles for the partition's
    least item. Texts are read once: hashes within a bound and in a bit set of all sketches go on with their text, few
    others do. They meet the sketches by hash, under the item's own size, and each pair found is verified exactly.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = checkpoint(items.select(F.monotonically_increasing_id().alias("iid"), F.col("item_id").cast("long"), "text"))

    def sketched(batches):
        hasher = ShingleHasher()
        for batch in batches:
            for iid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size, need, h = sketch(text, hasher, contained, words)
                if size:
                    n = len(h)
                    cols = [pa.array(h.view(np.int64)), pa.array([part_of(size)] * n, pa.int32()), pa.array([iid] * n, pa.int64()), pa.array([need] * n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, names=["hash", "part", "iid", "need"])

    sketches = checkpoint(items.select("iid", "text").mapInArrow(sketched, "hash long, part int, iid long, need long"))
    # One row for each partition; hashes are unsigned, which a flipped sign bit puts in order.
    flipped = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))
    stats = sketches.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max(flipped).alias("top"), F.min("need").alias("need")).collect()
    n = sum(r["n"] for r in stats)
    bounds = [(r["need"], np.uint64(r["top"] + (1 << 63))) for r in stats]
    bloom = spark.sparkContext.broadcast(build_bloom(sketches, n))
    survivor = pa.schema([("_key", pa.string()), ("text", pa.string()), ("m", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def scan(batches):
        hasher = ShingleHasher()
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = hasher(normal(text), words)
                m = len(h)
                if len(h := bloom.value.holds(h)):
                    top = max((bound for need, bound in bounds if need <= m), default=None)
                    if top is not None and len(h := np.unique(h[h <= top])):
                        rows.append((key, text, m, h.view(np.int64).tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), survivor, strict=True)], schema=survivor)

    path = fresh_path(spark, "survivors")
    docs.select("_key", "text").mapInArrow(scan, "_key string, text string, m long, hashes array<long>").write.option("compression", "zstd").parquet(path)
    found = spark.read.schema("_key string, text string, m long, hashes array<long>").parquet(path)
    small = (lambda df: F.broadcast(df)) if n <= BROADCAST_SKETCHES else (lambda df: df)
    pairs = found.select("_key", "m", F.explode("hashes").alias("hash")).join(small(sketches), "hash").where("m >= need").select("_key", "iid").distinct()
    pairs = pairs.join(small(items.select("iid", "item_id", F.col("text").alias("item"))), "iid").join(found.select("_key", "text"), "_key")
    out = pa.schema([("_key", pa.string()), ("item_id", pa.int64()), ("n_found", pa.int64()), ("n_shingles", pa.int64())])

    def verify(batches):
        last, text_words, padded, known = None, "", "", {}
        for batch in batches:
            rows = []
            for key, item_id, item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last:
                    last, text_words = key, normal(text)
                    padded = f" {text_words} "
                if item not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[item] = list(dict.fromkeys(shingles(normal(item), words)))
                distinct = known[item]
                if text_words.count(" ") + 1 < words:
                    held = sum(s == text_words for s in distinct)
                else:
                    held = sum(f" {s} " in padded for s in distinct if s.count(" ") + 1 == words)
                if held >= int(np.ceil(contained * len(distinct) - 1e-9)):
                    rows.append((key, item_id, held, len(distinct)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    return pairs.select("_key", "item_id", "item", "text").mapInArrow(verify, "_key string, item_id long, n_found long, n_shingles long")


def contained_items(docs: DataFrame, items: DataFrame, contained: float = CONTAINED, words: int = WORDS) -> DataFrame:
    """(doc_id, item_id, n_found, n_shingles): items with a share ``contained`` or more of their distinct shingles in a document.

    A text of fewer than five words is one shingle, so such an item is found only in a text that is as short. Null and
    empty texts hold nothing and are contained in nothing; repeated rows on either side give repeated rows.
    """
    rows = keyed_rows(docs)
    found = contained_rows(rows.select("_key", F.col("_row.text").alias("text")), items, contained, words)
    return _few(rows.select("_key", F.col("_row.doc_id").cast("long").alias("doc_id")), found).select("doc_id", "item_id", "n_found", "n_shingles")


def _few(rows: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with what was found in a few of them, which is broadcast if it is small."""
    found = checkpoint(found)
    return rows.join(F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, "_key", how)


def drop_contaminated(docs: DataFrame, items: DataFrame, contained: float = CONTAINED, words: int = WORDS) -> DataFrame:
    """``docs`` without the rows that contain an item, under the rules of ``contained_items``."""
    rows = keyed_rows(docs)
    found = contained_rows(rows.select("_key", F.col("_row.text").alias("text")), items, contained, words).select("_key").distinct()
    return _few(rows, found, "left_anti").select("_row.*")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The same pairs in DuckDB SQL: every shingle of every document joined with those of the items.
OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT rid, doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) > 0),
bs AS (SELECT DISTINCT iid, item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b WHERE len(w) > 0),
n AS (SELECT iid, count(*) AS n_shingles FROM bs GROUP BY iid)
SELECT ds.doc_id, bs.item_id, count(*) AS n_found, any_value(n.n_shingles) AS n_shingles
FROM ds JOIN bs USING (s) JOIN n USING (iid) GROUP BY ds.rid, ds.doc_id, bs.iid, bs.item_id
HAVING count(*) >= ceil(0.8 * any_value(n.n_shingles) - 1e-9)
"""
