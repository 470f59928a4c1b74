"""Token-id files: static range asymmetric numeral coding with shared tables, interleaved lanes, checkpoints and checksums.

File format. A dataset is a folder ``blocks`` of Parquet rows, one for each block, and a folder ``table`` with the one
frequency table that all blocks share; blocks are coded independently of each other. ``table``: zlib of little-endian u32 (symbols used, then their ids, then their
frequencies, which sum to 2^18). ``payload``: header of seven little-endian u32 (magic, ids, lanes, checkpoints, steps
between checkpoints, CRC-32 of the ids as u32, CRC-32 of all that follows), then for each checkpoint a u64 word offset
and the lanes' u64 states, then the u32 words. Symbol ``t * lanes + k`` is the t-th of lane k. Decoding may begin at
any checkpoint.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import checkpoint, documents, encoder, fresh_path, remove, running_bases, slices, tokenizer_path

BITS = 18
LOW = np.uint64(1 << 31)
LANES = 4096
CHECKPOINT_STEPS = 64
BLOCK_IDS = 1 << 20
MAGIC = 0x31534E52
HEAD = struct.Struct("<7I")
END_ID = 1


def frequency_table(counts: np.ndarray) -> bytes:
    """Counts by id, scaled to sum to 2^18 with at least 1 for each used id."""
    used = np.flatnonzero(counts)
    c = counts[used].astype(np.float64)
    total = 1 << BITS
    if len(used) > total // 2:
        raise ValueError("too many distinct ids for this table")
    freq = np.maximum(1, np.floor(c * ((total - len(used)) / max(c.sum(), 1)))).astype(np.int64)
    if len(freq):
        freq[np.argmax(freq)] += total - freq.sum()
    return zlib.compress(np.concatenate([[len(used)], used, freq]).astype("<u4").tobytes(), 1)


def read_table(table: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Used ids, their frequencies, their cumulative starts."""
    raw = np.frombuffer(zlib.decompress(table), dtype="<u4")
    n = int(raw[0])
    freq = raw[1 + n :].astype(np.uint64)
    return raw[1 : 1 + n], freq, (np.cumsum(freq) - freq).astype(np.uint64)


class Codec:
    def __init__(self, table: bytes):
        self.ids, self.freq, self.start = read_table(table)
        self.place = np.full(1 << 8 * (2 if not len(self.ids) or self.ids[-1] < 1 << 16 else 3), len(self.ids), dtype=np.intp)
        self.place[self.ids] = np.arange(len(self.ids))
        self.slots = np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.freq.astype(np.int64))

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
        n = len(ids)
        lanes = max(1, min(lanes, n // 128))
        steps = -(-n // lanes)
        sym = self.place[ids]
        if n and int(sym.max()) == len(self.ids):
            raise ValueError("an id isn't in the table")
        x = np.full(lanes, LOW, dtype=np.uint64)
        out, marks, written, bits = [], [], 0, np.uint64(BITS)
        shift, limit = np.uint64(32), np.uint64(63 - BITS)
        for t in range(steps - 1, -1, -1):
            s = sym[t * lanes : (t + 1) * lanes]
            k = len(s)
            f = self.freq[s]
            y = x[:k]
            over = y >= (f << limit)
            words = y[over]
            if len(words):
                out.append(words.astype(np.uint32))
                written += len(words)
                y = np.where(over, y >> shift, y)
            q = y // f
            x[:k] = (q << bits) + (y - q * f) + self.start[s]
            if t % every == 0:
                marks.append((written, x.copy()))
        body = b"".join(struct.pack("<Q", written - w) + st.astype("<u8").tobytes() for w, st in reversed(marks))
        body += np.concatenate(out[::-1]).astype("<u4").tobytes() if out else b""
        return HEAD.pack(MAGIC, n, lanes, len(marks), every, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body

    def decode(self, payload: bytes, from_checkpoint: int = 0) -> np.ndarray:
        """The block's ids from a checkpoint on; checksums are verified (that of the ids where all are decoded)."""
        magic, n, lanes, marks, every, ids_crc, body_crc = HEAD.unpack_from(payload)
        body = memoryview(payload)[HEAD.size :]
        if magic != MAGIC or zlib.crc32(body) != body_crc:
            raise ValueError("damaged block")
        size = 8 + 8 * lanes
        words = np.frombuffer(body, dtype="<u4", offset=marks * size).astype(np.uint64)
        out = np.empty(n, dtype=np.uint32)
        first = from_checkpoint * every
        if from_checkpoint < marks:
            (pos,) = struct.unpack_from("<Q", body, from_checkpoint * size)
            x = np.frombuffer(body, dtype="<u8", count=lanes, offset=from_checkpoint * size + 8).astype(np.uint64)
            mask, bits, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
            for t in range(first, -(-n // lanes)):
                k = min(lanes, n - t * lanes)
                y = x[:k]
                slot = y & mask
                s = self.slots[slot.astype(np.intp)]
                y = self.freq[s] * (y >> bits) + slot - self.start[s]
                out[t * lanes : t * lanes + k] = self.ids[s]
                need = np.flatnonzero(y < LOW)
                if len(need):
                    y[need] = (y[need] << shift) | words[pos : pos + len(need)]
                    pos += len(need)
                x[:k] = y
        if from_checkpoint == 0 and zlib.crc32(out.astype("<u4").tobytes()) != ids_crc:
            raise ValueError("damaged block")
        return out[first * lanes :]


BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
BLOCK_DDL = "shard int, block int, ids long, doc_ids array<long>, lengths array<long>, payload binary"
#: Blocks up to this number have their starts broadcast (24 bytes each); those of more are joined.
BROADCAST_BLOCKS = 200_000


def _column_ids(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch's binary column as one array, and how many each row has."""
    width = np.dtype(dtype).itemsize
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return raw.view(dtype), np.diff(offsets) // width


#: Ids repeat too little for a dictionary; a fast codec takes a third of them off the disk.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}


def tokenized(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> np.dtype:
    """Writes (doc_id, h, rid, ids) of each document to ``path``, ids packed in the type that is returned."""
    dtype = encoder(tokenizer).dtype
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("rid", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column(3).to_pylist()]
            for lo, hi in slices(texts):
                ids = pa.array([x.tobytes() + end for x in enc.encode(texts[lo:hi])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(3)), ids], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("rid"), "text")
    rows.mapInArrow(run, "doc_id long, h long, rid long, ids binary").write.mode("overwrite").options(**PACKED).parquet(path)
    return np.dtype(dtype)


def id_counts(tokens: DataFrame, dtype: np.dtype) -> np.ndarray:
    """How often each id occurs in all of ``tokens``: one row per id and task is shuffled, one per id comes to the driver."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            n = np.bincount(_column_ids(batch.column(0), dtype)[0])
            if len(n) > len(total):
                n[: len(total)] += total
                total = n
            else:
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    found = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids = found.column(0).to_numpy()
    out = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    out[ids] = found.column(1).to_numpy()
    return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Ids of all documents in ascending order of doc_id (nulls first; repeated ids by a hash of the text, then by row).

    Documents are tokenized once, to files; their ids' counts over all documents make one table, which all blocks share
    (``path``/table). Then the ids are dealt over ranges of doc_id, whose numbers are the shards' (``path``/blocks). A
    task holds one block, whatever the shard's size; equal rows don't keep a range together. A document is never split
    over blocks. Null texts are a lone end id.
    """
    spark = docs.sparkSession
    held = fresh_path(spark, "tokens")
    dtype = tokenized(docs, held, tokenizer, end_id)
    tokens = spark.read.schema("doc_id long, h long, rid long, ids binary").parquet(held)
    table = frequency_table(id_counts(tokens, dtype))

    def code(batches):
        codec, shard, block = Codec(table), TaskContext.get().partitionId(), 0
        doc_ids, lengths, parts, n = [], [], [], 0

        def close():
            row = [shard, block, n, doc_ids, lengths, codec.encode(np.concatenate(parts))]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCK, strict=True)], schema=BLOCK)

        for batch in batches:
            ids, many = _column_ids(batch.column(1), dtype)
            own, ends, lo = batch.column(0).to_pylist(), np.cumsum(many), 0
            while lo < len(own):
                before = int(ends[lo] - many[lo])
                hi = int(np.searchsorted(ends, before + block_ids - n, side="right"))
                if hi <= lo and not n:
                    hi = lo + 1  # longer than a block: alone in one
                if hi > lo:
                    doc_ids += own[lo:hi]
                    lengths += many[lo:hi].tolist()
                    parts.append(ids[before : int(ends[hi - 1])].copy())
                    n += int(ends[hi - 1]) - before
                    lo = hi
                if lo < len(own):
                    yield close()
                    doc_ids, lengths, parts, n, block = [], [], [], 0, block + 1
        if parts:
            yield close()

    ordered = tokens.repartitionByRange("doc_id", "h", "rid").sortWithinPartitions("doc_id", "h", "rid").select("doc_id", "ids")
    ordered.mapInArrow(code, BLOCK_DDL).write.mode("overwrite").parquet(f"{path}/blocks")
    spark.createDataFrame([(bytearray(table),)], "table binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/table")
    remove(spark, held)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the decoded blocks; blocks decode in parallel."""
    blocks = spark.read.schema(BLOCK_DDL).parquet(f"{path}/blocks")
    table = bytes(spark.read.parquet(f"{path}/table").first()["table"])
    bases = checkpoint(running_bases(blocks.select("shard", "block", "ids"), "shard", "block", "ids").drop("ids"))
    bases = F.broadcast(bases) if bases.count() <= BROADCAST_BLOCKS else bases
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches):
        codec = Codec(table)
        for batch in batches:
            for payload, doc_ids, many, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = memoryview(codec.decode(payload).astype("<u4").tobytes())
                lengths = np.array(many, dtype=np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), many, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(base + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], schema=out)

    return blocks.join(bases, ["shard", "block"]).select("payload", "doc_ids", "lengths", "base").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents' ids to files in the shared folder and returns what reading them back gives."""
    path = fresh_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, tokenizer_path())
    return read_token_files(spark, path)
