"""The rule solver: blocking keys, trigram similarities, acceptance rules, lists."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwright.functions import extract as ex
from linkwright.functions.text import simple_clean
from linkwright.operators.blocking import ORDER

#: References of one key that are compared in one place; more are dealt over copies of the key's list.
GROUP = 20_000
#: References compared with a list at once.
CHUNK = 1024
#: Characters of cleaned texts as digits of a trigram's number; others part texts.
_DIGIT = np.full(256, -1, np.int32)
_DIGIT[np.frombuffer(b" 0123456789abcdefghijklmnopqrstuvwxyz", np.uint8)] = np.arange(37)


def _profile() -> list:
    """Of ``name`` and ``addr``: cleaned texts, whose trigrams are compared, and the house number."""
    name, addr = F.coalesce("name", F.lit("")), F.coalesce("addr", F.lit(""))
    return [simple_clean(name).alias("name_t"), simple_clean(F.concat_ws(" ", name, addr)).alias("all_t"), ex.first_house(addr).alias("house")]


def leading_keys(entities: DataFrame) -> DataFrame:
    """(src, id, name, addr, keys): blocking keys without those of four letters and of house and name.

    Whoever shares one of these shares the key of country and three letters as well, and that key's first k records come
    before all others that have it. So without them the first k of all keys are the same.
    """
    keys = F.array_distinct(ex.blocking_keys(F.col("name"), F.col("addr"), F.col("country")))
    return entities.select(*ORDER, "name", "addr", F.filter(keys, lambda x: ~x.rlike("_n4_[a-z0-9]*$") & ~x.rlike("_h_[0-9]+_[a-z0-9]+$")).alias("keys"))


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and trigram numbers of each text's different trigrams, and how many each has."""
    raw = np.frombuffer("\n".join(texts).encode(), np.uint8)
    d = _DIGIT[raw]
    ok = (d[:-2] >= 0) & (d[1:-1] >= 0) & (d[2:] >= 0)
    both = np.cumsum(raw == 10)[:-2][ok] * 37**3 + ((d[:-2] * 37 + d[1:-1]) * 37 + d[2:])[ok]
    row, code = np.divmod(np.unique(both), 37**3)
    return row, code, np.bincount(row, minlength=len(texts)).astype(np.float64)


class _List:
    """A key's records in order, ready to be compared with many references."""

    def __init__(self, rows: pd.DataFrame):
        self.ids = rows["id"].to_numpy(object)
        self.order = list(zip(rows["src"].tolist(), rows["id"].tolist(), strict=True))
        self.sets = {x: self._set(rows, x) for x in ("name", "all")}
        self.number = {h: i for i, h in enumerate(dict.fromkeys(h for h in rows["house"] if h))}
        self.house = self._houses(rows, -1)

    def _set(self, rows, x):
        row, code, n = _trigrams(rows[f"{x}_t"].tolist())
        values, at = np.unique(code, return_inverse=True)
        place, has = np.full(37**3, -1, np.int32), np.zeros((len(values), len(rows)), np.float32)
        place[values], has[at, row] = np.arange(len(values)), 1
        return place, has, n

    def _houses(self, rows, none):
        return np.array([self.number.get(h, none) for h in rows["house"]])

    def _jaccard(self, refs, x):
        place, has, n = self.sets[x]
        row, code, m = _trigrams(refs[f"{x}_t"].tolist())
        at = place[code]
        own = np.zeros((len(refs), len(has)), np.float32)
        own[row[at >= 0], at[at >= 0]] = 1
        both = (own @ has).astype(np.float64)
        return both / np.maximum(m[:, None] + n - both, 1)  # no trigram on a side: 0 in common

    def accepted(self, refs: pd.DataFrame, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of references and records of the pairs that ``rule_accepts`` takes, records up to the reference's last."""
        name, all_ = self._jaccard(refs, "name"), self._jaccard(refs, "all")
        same = self._houses(refs, -2)[:, None] == self.house
        last = [bisect_right(self.order, (s, i)) if isinstance(i, str) else len(self.order) for s, i in zip(refs["src"].tolist(), refs["id"].tolist(), strict=True)]
        ok = (all_ >= threshold) | (same & (name >= 0.35)) | ((name >= 0.65) & (all_ >= 0.28))
        return np.nonzero(ok & (np.arange(len(self.order)) < np.array(last)[:, None]))


def accepted_pairs(refs: DataFrame, records: DataFrame, threshold: float = 0.38, k: int = 150) -> DataFrame:
    """(s1, id): pairs that ``rule_accepts`` takes among each reference's first ``k`` records that share a blocking key.

    No table of pairs is moved: references go to their keys' lists of ``k`` records and are compared there by matrix
    products of trigrams. How far a list goes for a reference, the last of its first ``k`` over all its keys, is found once
    for each distinct set of keys. Only accepted pairs leave.
    """
    parts = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a small file is few tasks' input, and keys and texts take much longer than reading it
    dealt = lambda df: leading_keys(df.repartition(parts, "id")).where(F.size("keys") > 0)
    mine = dealt(refs)
    sets = mine.groupBy("keys").agg(F.count(F.lit(1)).alias("n")).withColumn("key", F.explode("keys"))
    many = sets.groupBy("key").agg(F.ceil(F.sum("n") / GROUP).cast("int").alias("n"))
    theirs = dealt(records).select(*ORDER, F.explode("keys").alias("key")).join(many, "key", "left_semi")
    first = F.dense_rank().over(Window.partitionBy("key").orderBy(*ORDER))
    theirs = theirs.withColumn("rn", first).where(F.col("rn") <= k).select("key", *ORDER).distinct()
    lists = theirs.groupBy("key").agg(F.collect_list(F.struct(*ORDER)).alias("list"))
    pools = sets.select("keys", "key").join(lists, "key").groupBy("keys").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("list")))).alias("pool"))
    lasts = pools.select("keys", F.get("pool", F.lit(k - 1)).alias("last"))

    s = mine.withColumnRenamed("id", "s1").join(lasts, "keys").select("s1", "keys", "last", *_profile()).withColumn("key", F.explode("keys"))
    s = s.join(many, "key").withColumn("salt", F.pmod(F.xxhash64("s1"), F.col("n")).cast("int"))
    c = theirs.join(records.select("id", "name", "addr"), "id").select("key", *ORDER, *_profile())
    c = c.join(many, "key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    cols = ["name_t", "all_t", "house"]
    c = c.select("key", "salt", F.lit(False).alias("ref"), F.lit(None).cast("string").alias("s1"), *ORDER, *cols)
    s = s.select("key", "salt", F.lit(True).alias("ref"), "s1", "last.src", "last.id", *cols)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, own = None, [], None
        for pdf in batches:
            group = list(zip(pdf["key"].tolist(), pdf["salt"].tolist(), strict=True))
            starts = [i for i, g in enumerate(group) if i == 0 or g != group[i - 1]]
            for lo, hi in zip(starts, [*starts[1:], len(group)], strict=True):
                part, is_ref = pdf.iloc[lo:hi], pdf["ref"].iloc[lo:hi].to_numpy(bool)
                if group[lo] != at:
                    at, held, own = group[lo], [], None
                if not is_ref.all():
                    held.append(part[~is_ref])
                rest = part[is_ref]
                if len(rest) and own is None:
                    if not held:
                        continue  # no record has the key
                    own, held = _List(pd.concat(held)), []
                for i in range(0, len(rest), CHUNK):
                    some = rest.iloc[i : i + CHUNK]
                    a, b = own.accepted(some, threshold)
                    if len(a):
                        yield pd.DataFrame({"s1": some["s1"].to_numpy(object)[a], "id": own.ids[b]})

    rows = c.union(s).repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "ref", *ORDER)
    return rows.mapInPandas(compare, "s1 string, id string").distinct()


def solve(refs: DataFrame, records: DataFrame, threshold: float = 0.38, k: int = 150) -> DataFrame:
    """(s1, ids): accepted records of every reference, in order."""
    lists = accepted_pairs(refs, records, threshold, k).groupBy("s1").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return refs.select(F.col("id").alias("s1")).join(lists, "s1", "left").select("s1", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))
