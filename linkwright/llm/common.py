"""Shared helpers: shared-folder checkpoints and cached tokenisation."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a local one serves a local session
    only (tests); on a cluster the setting is missed loudly, as executors don't see each other's folders."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        path = "file://" + tempfile.mkdtemp(prefix="linkwright-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_WRITTEN: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; ``release`` deletes it."""
    _WRITTEN.append(path := f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing will read again."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Deletes what operators wrote below the shared folder in this session; results that weren't stored can't be read then."""
    for path in _WRITTEN:
        remove(spark, path)
    _WRITTEN.clear()


def running_bases(counts: DataFrame, group: str, order: str, n: str) -> DataFrame:
    """``counts`` plus ``base``: the sum of ``n`` over all rows before, by (group, order).

    Sums run inside each group; only one row a group meets in one task, for the sums over groups.
    """
    within = F.sum(n).over(Window.partitionBy(group).orderBy(order)) - F.col(n)
    groups = counts.groupBy(F.col(group).alias("_group")).agg(F.sum(n).alias("_n"))
    before = groups.select("_group", (F.sum("_n").over(Window.orderBy("_group")) - F.col("_n")).alias("_before"))
    out = counts.withColumn("_within", within).join(before, F.col(group) == F.col("_group"))
    return out.select(*counts.columns, (F.col("_before") + F.col("_within")).alias("base"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder; Spark's cleaner removes it with its last reader."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def reclaim(spark: SparkSession) -> None:
    """Has Spark delete shuffles and checkpoints that nothing reads any more: they stay until the driver collects its
    garbage, and a driver with little to do never does, so that a stage of many steps would hold all their files at once."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bytes of rows that go to a Python worker at once; a longer text goes alone.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches bounded in bytes, whatever the length of texts (Spark's bound is 64 MB, which a task
    holds several times over: in buffers on both sides and as objects). Set for the session, as lazy results run later."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(_key, _row): each row as a struct with a key that every later scan gives it again, on any number of executors.

    The key is the row's place in its Parquet file. What isn't a plain scan of files is numbered in a checkpoint.
    Numbers that Spark counts by partition wouldn't do alone: small inputs are split by the cores present.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    try:
        place = docs.metadataColumn("_metadata")
        return docs.select(F.concat_ws("#", place["file_path"], place["row_index"].cast("string")).alias("_key"), whole)
    except AnalysisException:
        return checkpoint(docs.select(F.monotonically_increasing_id().cast("string").alias("_key"), whole))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


class WordCachedEncoder:
    """Encodes whole texts with a ``tokenizers`` file whose pre-tokeniser never joins across white space.

    The library encodes each distinct white-space-delimited word; texts are then put together from the words' ids.
    Where the tokenizer lower-cases and cuts words at letters and digits (``word_bpe``), words are lower-cased and
    a comma or full stop that ends one is cut off first, in texts of plain Latin letters, for fewer distinct words.
    Texts where words could differ from the whole (special-token markers, control separators that Python takes for
    white space and the tokenizer doesn't) go to the library whole. The cache is bounded: full, its older half goes.
    """

    WHOLE = re.compile("[\x1c-\x1f]|<\\|")
    PLAIN = re.compile("[^\x00-\u012f\u0131-\u023f]")
    STOP = re.compile("[.,](?<=[^\\W_].)(?=\\s)")
    LONGEST = 64
    MARK = "|"

    def __init__(self, path: str, entries: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.entries = entries
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        probe = "Ab, cd."
        self.cuts = self._ids(probe) == self._ids("ab , cd .")
        mark = self._ids(self.MARK)
        self.mark = mark[0] if len(mark) == 1 and self._ids(f"ab {self.MARK} cd") == self._ids("ab") + mark + self._ids("cd") else None

        self.letters = self._letters() if self.cuts and self.mark is not None else None

    def _letters(self):
        """The same vocabulary without the normaliser and patterns, which leave words of small Latin letters as they are."""
        from tokenizers import Tokenizer

        own = json.loads(self.tokenizer.to_str())
        own["normalizer"] = None
        split = [p for p in own["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "ByteLevel"]
        own["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *split]}
        plain = Tokenizer.from_str(json.dumps(own))
        probe = f"zebra {self.MARK} éclair {self.MARK} ñandú"
        return plain if split and plain.encode(probe, add_special_tokens=False).ids == self._ids(probe) else None

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _one(self, text: str) -> bytes:
        return np.array(self._ids(text), dtype=self.dtype).tobytes()

    def words(self, text: str, checked: bool = False) -> list[str] | None:
        """The text's words as they are encoded; None where it must be encoded whole. checked: it is known to be plain."""
        if not checked and self.WHOLE.search(text):
            return None
        if self.cuts and (checked or text.isascii() or not self.PLAIN.search(text)):
            text = self.STOP.sub(r" \g<0>", text.lower())
        return text.split()

    @staticmethod
    def plain(texts: list[str]) -> bool:
        """Whether no text has what WHOLE or PLAIN look for, seen at once (U+0240 and above begin with byte C9 or more)."""
        joined = "".join(texts)
        raw = np.frombuffer(joined.encode(), dtype=np.uint8)
        return "<|" not in joined and "\u0130" not in joined and not ((raw >= 0xC9) | ((raw >= 0x1C) & (raw < 0x20))).any()

    def _learn(self, words: list[str], into: dict[str, bytes]) -> None:
        """Encodes distinct words many at a time, a mark between them, and cuts the ids at the marks."""
        joined, letters = [], []
        for w in words:
            if self.mark is None or self.MARK in w:
                into[w] = self._one(w)
            elif self.letters and w.isalpha() and w.islower() and (w.isascii() or not self.PLAIN.search(w)):
                letters.append(w)
            else:
                joined.append(w)
        self._learn_by(self.tokenizer, joined, into)
        self._learn_by(self.letters, letters, into)

    def _learn_by(self, tokenizer, joined: list[str], into: dict[str, bytes]) -> None:
        sep, width = f" {self.MARK} ", np.dtype(self.dtype).itemsize
        for at in range(0, len(joined), 4000):
            part = joined[at : at + 4000]
            groups = [part[i : i + 100] for i in range(0, len(part), 100)]
            for group, e in zip(groups, tokenizer.encode_batch_fast([sep.join(g) for g in groups], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, dtype=self.dtype)
                raw, start = ids.tobytes(), 0
                for w, end in zip(group, [*(np.flatnonzero(ids == self.mark) * width).tolist(), len(raw)], strict=True):
                    into[w] = raw[start:end]
                    start = end + width

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as a numpy array."""
        checked = self.plain(texts)
        split = [self.words(t, checked) for t in texts]
        seen: set[str] = set()
        for words in split:
            if words:
                seen.update(words)
        if len(self.young) > self.entries:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = seen.difference(young)
        del seen
        if old:
            known = new.intersection(old)
            young.update(zip(known, map(old.__getitem__, known), strict=True))
            new -= known
        long_ = {w: self._one(w) for w in new if len(w) > self.LONGEST}
        self._learn([w for w in new if w not in long_] if long_ else list(new), young)
        get = young.__getitem__
        out = []
        for t, words in zip(texts, split, strict=True):
            if words is None:
                ids = self._one(t)
            elif long_:
                ids = b"".join([young[w] if w in young else long_[w] for w in words])
            else:
                ids = b"".join(map(get, words))
            out.append(np.frombuffer(ids, dtype=self.dtype))
        return out


_ENCODERS: dict[tuple[str, int], WordCachedEncoder] = {}


def encoder(path: str, entries: int = 300_000) -> WordCachedEncoder:
    """One encoder per Python worker, file and size of cache; it lives as long as the worker."""
    if (path, entries) not in _ENCODERS:
        _ENCODERS[path, entries] = WordCachedEncoder(path, entries)
    return _ENCODERS[path, entries]


def give_back() -> None:
    """Returns freed memory of a Python worker to the system. Spark keeps workers between tasks and takes them in turn, more of
    them than tasks run at once where a stage had two Python steps, so each would hold the most it ever used."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(texts: list[str], chars: int = 4_000_000):
    """Index ranges of at most about ``chars`` characters, so that a batch's ids stay small."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)
