"""Best-fit packing planned on the length histogram; pieces take planned slots by rank within their length."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwright.llm.common import checkpoint, documents, encoder, give_back, slices, tokenizer_path

CONTEXT = 4096
END_ID = 1
#: A plan of more runs than this isn't sent to the executors by closure but joined by length and rank, this many ranks a group.
MAX_RUNS = 1_000_000
RANKS = 4096
#: For ``pieces`` where other steps' workers stay beside its own: words and characters that take less memory and more time.
FRUGAL = {"words": 150_000, "chars": 1_000_000}


def plan(histogram: dict[int, int], context: int = CONTEXT) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs (length, first rank, count, first sequence, items in a sequence, offset).

    Sequences with the same room are kept as ranges, so the work depends on the number of distinct lengths and
    not on that of pieces. Rank r of a run goes to sequence ``first + r // items`` at ``offset + r % items * length``.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    runs, opened = [], 0

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append((first, n))

    for length in sorted((x for x in histogram if 0 < x <= context), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                space = rooms[at]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space]
                    rooms.pop(at)
            else:
                space, first = context, opened
                n = -(-left // (context // length))
                opened += n
            items = space // length
            full, rest = min(n, left // items), 0
            if full:
                runs.append((length, rank, full * items, first, items, context - space))
                put(space - items * length, first, full)
                rank += full * items
                left -= full * items
            if left and full < n:
                rest = left  # fewer than items: they go to one more sequence
                runs.append((length, rank, rest, first + full, items, context - space))
                put(space - rest * length, first + full, 1)
                rank += rest
                left = 0
            put(space, first + full + bool(rest), n - full - bool(rest))
    return runs


def pieces(docs: DataFrame, path: str, context: int = CONTEXT, end_id: int = END_ID, words: int = 300_000, chars: int = 4_000_000) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, nth): token pieces of whole texts, ``nth`` of their length in their task.

    ``ids`` holds the piece's token ids in as many bytes each as the vocabulary needs (``unpacked``). ``words`` that an
    encoder keeps and ``chars`` that it takes at once bound a worker's memory, no result.
    """

    out = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in ("doc_id", "piece", "start", "length", "ids", "part", "nth")])

    def cut(batches):
        give_back()  # what other steps left in this worker
        enc, nth, part = encoder(path, words), {}, TaskContext.get().partitionId()
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts, chars):
                rows = []
                for doc_id, ids in zip(doc_ids[lo:hi], enc.encode(texts[lo:hi]), strict=True):
                    ids = np.append(ids, enc.dtype(end_id))
                    for k, start in enumerate(range(0, len(ids), context)):
                        piece = ids[start : start + context]
                        n = nth[len(piece)] = nth.get(len(piece), -1) + 1
                        rows.append((doc_id, k, start, len(piece), piece.tobytes(), part, n))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)
        batch = texts = rows = None
        give_back()

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece long, start long, length long, ids binary, part long, nth long")
    return found.withColumn("piece", F.col("piece").cast("int"))


def unpacked(ids: bytes, n: int) -> np.ndarray:
    """The ``n`` token ids in the bytes of a piece or a sequence."""
    return np.frombuffer(ids, f"<u{len(ids) // n}")


def pack(found: DataFrame, context: int = CONTEXT) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of ``pieces``; every row gets one slot, slots of a sequence leave no gap.

    The ids stay with their piece. A hot length is no hot key: ranks come from each task's own counts plus a running sum over tasks. What the driver
    holds is the histogram (at most ``context`` lengths) and the plan. Null ids and repeated rows are packed like
    others; an empty input gives no rows.
    """
    found = checkpoint(found)
    counts = checkpoint(found.groupBy("part", "length").count())
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}
    runs = np.array(plan(histogram, context), dtype=np.int64).reshape(-1, 6)
    order = np.lexsort((runs[:, 1], runs[:, 0]))
    runs = runs[order]
    base = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranked = found.join(counts.select("part", "length", F.coalesce(base, F.lit(0)).alias("base")), ["part", "length"])
    kept = ["doc_id", "piece", "start", "length", "ids"]
    if len(runs) > MAX_RUNS:
        return _joined(ranked, runs, kept)
    # (length, rank) as one number: ranks stay below 2^48
    keys = (runs[:, 0] << 48) | runs[:, 1]

    def place(batches):
        for batch in batches:
            length, nth, base = (batch.column(c).to_numpy() for c in ("length", "nth", "base"))
            seq, offset = _slots(runs, keys, length, base + nth)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in kept} | {"sequence_id": pa.array(seq), "offset": pa.array(offset)})

    return ranked.mapInArrow(place, PACKED)


PACKED = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


def _slots(runs: np.ndarray, keys: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of these lengths and ranks."""
    run = runs[np.searchsorted(keys, (length << 48) | rank, side="right") - 1]
    r = rank - run[:, 1]
    return run[:, 3] + r // run[:, 4], run[:, 5] + r % run[:, 4] * length


def _joined(ranked: DataFrame, runs: np.ndarray, kept: list[str]) -> DataFrame:
    """Pieces and runs meet by length and ``RANKS`` ranks: a group has that many pieces at most, and one run for each or fewer."""
    names = ["length", "first", "n", "seq", "items", "room"]
    plan_ = ranked.sparkSession.createDataFrame(pd.DataFrame(runs, columns=names))
    blocks = F.sequence(F.floor(F.col("first") / RANKS), F.floor((F.col("first") + F.col("n") - 1) / RANKS))
    plan_ = plan_.withColumn("block", F.explode(blocks))
    rows = ranked.withColumn("rank", F.col("base") + F.col("nth")).withColumn("block", F.floor(F.col("rank") / RANKS)).select(*kept, "rank", "block")

    def place(pieces_: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("first")[names].to_numpy(np.int64)
        seq, offset = _slots(own, (own[:, 0] << 48) | own[:, 1], pieces_["length"].to_numpy(np.int64), pieces_["rank"].to_numpy(np.int64))
        return pieces_[kept].assign(doc_id=pieces_["doc_id"].astype("Int64"), sequence_id=seq, offset=offset)

    keys = ["length", "block"]
    return rows.groupBy(*keys).cogroup(plan_.groupBy(*keys)).applyInPandas(place, PACKED)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, pieces, ids): the packed sequences; ``pieces`` says in order what lies where, ``ids`` are as in ``pieces()``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.transform("parts", lambda p: p.dropFields("ids")).alias("pieces"), joined.alias("ids"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of every document in sequences of at most 4096; null texts are a lone end id.

    Checksums are those of the ids found in the packed sequences at each piece's place.
    """
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    out = pa.schema([(n, pa.int32() if n == "piece" else pa.int64()) for n in names])

    def digest(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids = unpacked(r["ids"], sum(p["length"] for p in r["pieces"])).astype("<u4")
                for p in r["pieces"]:
                    crc = zlib.crc32(ids[p["offset"] : p["offset"] + p["length"]])
                    rows.append((p["doc_id"], p["piece"], p["start"], p["length"], crc, r["sequence_id"], p["offset"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    found = sequences(pack(pieces(documents(spark, sf_dir), tokenizer_path())))
    return found.mapInArrow(digest, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
