"""Removal of repeated substrings: sparse suffix arrays over anchors that equal strings share.

Each string of ``LENGTH`` bytes belongs to one anchor: the leftmost least hash of ``GRAM`` bytes inside it, so equal
strings have equal anchors at equal places. Anchors that occur once end here. For the others, the bytes of all strings
that belong to an occurrence (its context) are gathered by anchor; equal contexts collapse, and the rest of an
anchor's contexts are sorted by what follows the anchor and by what precedes it (deep-shallow sorting). A string
occurs twice if two occurrences are in one interval of both arrays at its lengths right and left of the anchor.
Anchors with many different contexts are split by place of the string relative to the anchor, which makes longer
anchors, down to whole strings, where all is equal and collapses.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import checkpoint, documents, fresh_path, text_or_empty
from linkwright.llm.decontamination import ShingleHasher
from linkwright.llm.suffix_sort import deep_shallow

LENGTH = 400
GRAM = 32
#: Different contexts of one anchor that are sorted together; anchors with more are split.
GROUP = 4096
#: Contexts that one call sorts.
BLOCK = 4096
#: Hot anchors up to this number go to the executors by broadcast (8 bytes each); more are joined, in this many salted parts.
HOT_ANCHORS, SALTS = 100_000, 64
#: Numbers of neighbouring places that keep together when an anchor is split, by level.
WIDTHS = (93, 24, 6, 2, 1)

_HASHER = ShingleHasher()


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first, last) of each anchor: it owns the strings that start at first..last."""
    n = len(raw)
    if n < length:
        e = np.empty(0, np.int64)
        return e, e, e, e
    _HASHER._grow(n + 1)
    b = np.frombuffer(raw, dtype=np.uint8)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((b + np.uint64(1)) * _HASHER.power[:n], out=total[1:])
    h = (total[gram:] - total[:-gram]) * _HASHER.inverse[: n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    w, m = length - gram + 1, len(h)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    blocks = np.full(-(-m // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[:m] = key
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: m - w + 1], ahead[w - 1 : m])
    owner = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    at = owner[new]
    return h[at].view(np.int64), at, new, np.r_[new[1:], len(owner)] - 1


def repeated(contexts: list[bytes], offsets: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each context (with its anchor's offset), which of its strings occur in another of the contexts given."""
    n = len(contexts)
    after, lcp_after = deep_shallow([c[o:] for c, o in zip(contexts, offsets, strict=True)], length)
    before, lcp_before = deep_shallow([c[:o][::-1] for c, o in zip(contexts, offsets, strict=True)], length)
    off = np.array(offsets)
    strings = np.array([len(c) - length + 1 for c in contexts])
    out = [np.zeros(s, dtype=bool) for s in strings]
    left, right = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(int(off.max(initial=-1)) + 1):
        start = off - a
        own = np.flatnonzero((start >= 0) & (start < strings))
        if len(own) < 2:
            continue
        right[after] = np.cumsum(lcp_after < length - a)
        left[before] = np.cumsum(lcp_before < a) if a else 0
        key = left[own] * (n + 1) + right[own]
        order = np.argsort(key, kind="stable")
        k = key[order]
        same = np.zeros(len(k), dtype=bool)
        eq = k[1:] == k[:-1]
        same[1:] |= eq
        same[:-1] |= eq
        for i in own[order[same]].tolist():
            out[i][off[i] - a] = True
    return out


def runs(mask: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Byte ranges that the strings starting at the mask's true places cover."""
    edge = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    merged: list[tuple[int, int]] = []
    for s, e in zip(edge[::2].tolist(), (edge[1::2] + length - 1).tolist(), strict=True):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], e)
        else:
            merged.append((s, e))
    return merged


CONTEXT = pa.schema([("ck", pa.binary()), ("gh", pa.int64()), ("off", pa.int32()), ("ctx", pa.binary()), ("w", pa.int64()), ("parent", pa.binary()), ("shift", pa.int32())])
CONTEXT_DDL = "ck binary, gh long, off int, ctx binary, w long, parent binary, shift int"


def _batch(rows: list[tuple], schema: pa.Schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _key(gh: int, off: int, ctx: bytes) -> bytes:
    """128 bits that stand for a context: contexts are too many for 64."""
    import xxhash

    return xxhash.xxh3_128_digest(ctx, seed=(gh ^ off) & 0xFFFFFFFFFFFFFFFF)


def _split(width: int):
    """Contexts cut at places that are multiples of ``width`` from the anchor; what all strings of a part share is its new anchor."""
    import xxhash

    def run(batches):
        for b in batches:
            rows = []
            for ck, gh, off, ctx, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                last = len(ctx) - LENGTH
                for k in range((off - last) // width, off // width + 1):
                    i0, i1 = max(0, off - (k + 1) * width + 1), min(last, off - k * width)
                    if i0 > i1:
                        continue
                    core = ctx[off - k * width : off + LENGTH - (k + 1) * width + 1]
                    g = int.from_bytes(xxhash.xxh64_digest(core, seed=(gh + 31 * k) & 0xFFFFFFFFFFFFFFFF), "big", signed=True)
                    c = ctx[i0 : i1 + LENGTH]
                    rows.append((_key(g, off - i0, c), g, off - i0, c, w, ck, i0))
            if rows:
                yield _batch(rows, CONTEXT)

    return run


INTERVAL = pa.schema([("ck", pa.binary()), ("s", pa.int32()), ("e", pa.int32())])


def _sort_groups(batches):
    """Rows (ck, gh, off, ctx, w) sorted by gh: covered ranges of contexts that occur once, block by block."""
    group: list[tuple] = []
    held: list[tuple] = []

    def solve():
        found = repeated([r[3] for r in held], [r[2] for r in held])
        out = [(r[0], s, e) for r, mask in zip(held, found, strict=True) if r[4] < 2 for s, e in runs(mask)]
        held.clear()
        return [_batch(out, INTERVAL)] if out else []

    def close():
        # An anchor's contexts matter if there are at least two and one of them occurs once.
        if len(group) > 1 and min(r[4] for r in group) < 2:
            held.extend(group)
        group.clear()

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if group and row[1] != group[-1][1]:
                close()
                if len(held) >= BLOCK:
                    yield from solve()
            group.append(row)
    close()
    if held:
        yield from solve()


def _covered(rows: DataFrame, level: int = 0) -> DataFrame:
    """(ck, s, e): covered byte ranges of each distinct context in ``rows`` (CONTEXT).

    Contexts are never joined by anchor, which may hold half of them: the hot anchors' ids are held against all rows,
    the other anchors meet by a shuffle of their own. (A shuffle that only confirms a join's partitioning is left out by
    the planner, and adaptive execution may then read the join's rows in other partitions.)
    """
    spark = rows.sparkSession
    path = fresh_path(spark, "contexts")
    rows.groupBy("ck").agg(F.first("gh").alias("gh"), F.first("off").alias("off"), F.first("ctx").alias("ctx"), F.sum("w").alias("w")).write.option("compression", "zstd").parquet(path)
    found = spark.read.parquet(path).select("ck", "gh", "off", "ctx", "w")
    out = found.where("w > 1").select("ck", F.lit(0).alias("s"), F.length("ctx").cast("int").alias("e"))
    few = found
    if level < len(WIDTHS):
        hot = checkpoint(found.groupBy("gh").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > GROUP).select("gh"))
        if n_hot := hot.count():
            few, many = _held_against(found, hot, n_hot, "left_anti"), _held_against(found, hot, n_hot, "left_semi")
            below = fresh_path(spark, "contexts")
            many.mapInArrow(_split(WIDTHS[level]), CONTEXT_DDL).write.option("compression", "zstd").parquet(below)
            children = spark.read.parquet(below)
            up = _covered(children, level + 1).join(children.select("ck", "parent", "shift"), "ck")
            out = out.union(up.select(F.col("parent").alias("ck"), (F.col("s") + F.col("shift")).alias("s"), (F.col("e") + F.col("shift")).alias("e")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return out.union(few.repartition(parts, "gh").sortWithinPartitions("gh").mapInArrow(_sort_groups, "ck binary, s int, e int"))


def _held_against(found: DataFrame, hot: DataFrame, n_hot: int, how: str) -> DataFrame:
    """Rows of ``found`` whose anchor is hot (left_semi) or isn't (left_anti); a hot anchor's rows never meet in one task."""
    if n_hot <= HOT_ANCHORS:
        return found.join(F.broadcast(hot), "gh", how).select(*found.columns)
    salted = hot.select("gh", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return found.withColumn("salt", F.pmod(F.xxhash64("ck"), F.lit(SALTS)).cast("int")).join(salted, ["gh", "salt"], how).select(*found.columns)


def _anchor_rows(batches):
    schema = pa.schema([("gh", pa.int64()), ("digest", pa.binary()), ("at", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])
    for b in batches:
        for digest, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            h, at, first, last = anchors(text.encode())
            if len(h):
                i32 = pa.int32()
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([digest] * len(h), pa.binary()), pa.array(at.astype(np.int32), i32), pa.array(first.astype(np.int32), i32), pa.array(last.astype(np.int32), i32)], schema=schema)


def _context_rows(batches):
    for b in batches:
        rows = []
        for digest, text, found in zip(*(c.to_pylist() for c in b.columns), strict=True):
            raw = text.encode()
            for a in found:
                ctx = raw[a["first"] : a["last"] + LENGTH]
                off = a["at"] - a["first"]
                rows.append((_key(a["gh"], off, ctx), a["gh"], off, ctx, 1, digest, a["first"]))
            if len(rows) > 5000:
                yield _batch(rows, CONTEXT)
                rows = []
        if rows:
            yield _batch(rows, CONTEXT)


def _cut(batches):
    schema = pa.schema([("digest", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int32())))])
    for b in batches:
        rows = []
        for digest, text, copies, found in zip(*(c.to_pylist() for c in b.columns), strict=True):
            raw = text.encode()
            if copies > 1 and len(raw) >= LENGTH:
                found = [{"s": 0, "e": len(raw)}]
            spans: list[list[int]] = []
            for r in sorted(found or [], key=lambda r: (r["s"], r["e"])):
                if spans and r["s"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r["e"])
                else:
                    spans.append([r["s"], r["e"]])
            h, at = hashlib.sha256(), 0
            for s, e in spans:
                h.update(raw[at:s])
                at = e
            h.update(raw[at:])
            rows.append((digest, len(raw), sum(e - s for s, e in spans), len(spans), h.hexdigest(), spans))
        if rows:
            yield _batch(rows, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed) of each row: bytes in a 400-byte string that starts anywhere else too.

    ``removed`` holds the [start, end) byte ranges. Equal texts are one while searched, and go wholly if they have
    400 bytes. Null and short texts keep everything. Rows repeat as in the input; an empty input gives none.
    """
    spark = docs.sparkSession
    digest = F.unhex(F.sha2(text_or_empty().cast("binary"), 256))
    keyed = docs.select(F.col("doc_id").cast("long"), digest.alias("digest"), text_or_empty().alias("text"))
    # Distinct texts, bucketed by digest: what joins with them later doesn't move them again.
    table = f"texts_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = keyed.groupBy("digest").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    texts.write.bucketBy(parts, "digest").sortBy("digest").option("compression", "zstd").option("path", fresh_path(spark, "texts")).saveAsTable(table)
    texts = spark.table(table)
    path = fresh_path(spark, "anchors")
    texts.select("digest", "text").mapInArrow(_anchor_rows, "gh long, digest binary, at int, first int, last int").write.parquet(path)
    found = spark.read.parquet(path)
    often = found.groupBy("gh").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gh")
    found = found.join(often, "gh").groupBy("digest").agg(F.collect_list(F.struct("gh", "at", "first", "last")).alias("found"))
    path = fresh_path(spark, "contexts")
    texts.join(found, "digest").select("digest", "text", "found").mapInArrow(_context_rows, CONTEXT_DDL).write.option("compression", "zstd").parquet(path)
    contexts = spark.read.parquet(path)
    covered = _covered(contexts).join(contexts.select("ck", "parent", "shift"), "ck")
    covered = covered.groupBy(F.col("parent").alias("digest")).agg(F.collect_set(F.struct((F.col("s") + F.col("shift")).alias("s"), (F.col("e") + F.col("shift")).alias("e"))).alias("found"))
    cut = texts.join(covered, "digest", "left").select("digest", "text", "copies", "found")
    cut = cut.mapInArrow(_cut, "digest binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<array<int>>")
    out = keyed.select("doc_id", "digest").join(cut, "digest").drop("digest")
    # The result reads the table's files, not its name.
    spark.sql(f"DROP TABLE {table}")
    return out


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
