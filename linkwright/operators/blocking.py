"""Blocking: token index, budgeted passes, ranked passes, key joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwright.functions import extract as ex
from linkwright.functions import lexicon as lex
from linkwright.functions import text as tx

#: Record columns: id, src (2 or 3), name, addr, country. Reference columns: the same with ``src`` 1.
ORDER = ("src", "id")


def prepare(records: DataFrame) -> DataFrame:
    """Cleaned name and address and their words, once per record and before any join; nulls are ''.

    Equal ids keep the first of (src, name, addr), as an insert that ignores later duplicates would.
    """
    r = records.select("id", "src", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("name", "addr", "country")])
    r = r.withColumn("name_n", tx.remove_accents("name")).withColumn("addr_n", tx.remove_accents("addr"))
    r = r.withColumn("name_c", tx.clean_ascii(F.col("name_n"))).withColumn("addr_c", tx.clean_ascii(F.col("addr_n")))
    return r.drop("name_n", "addr_n")


def token_index(prepared: DataFrame) -> DataFrame:
    """(token, src, id): distinct tokens of each record."""
    return prepared.select(F.explode(ex.tokens(F.col("name_c"), F.col("addr_c"))).alias("token"), "src", "id")


def document_frequency(index: DataFrame, more_than: int = 0) -> DataFrame:
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)


def lookups(prepared_refs: DataFrame, *more: Column) -> DataFrame:
    """The six lookups of each reference: p1 and p2 as token pairs, p3 and p4 as the longest name and address words; then ``more``."""
    name = F.filter(tx.words(F.col("name_c")), lambda w: F.length(w) >= 3)
    addr = F.filter(tx.words(F.col("addr_c")), lambda w: (F.length(w) >= 3) & ~w.isin(lex.STOP_WORDS))
    r = prepared_refs.select(F.col("id").alias("s1"), name.alias("nw"), addr.alias("aw"), ex.house_numbers(F.col("addr")).alias("house"), F.struct(F.lit(1), *more).alias("more"))
    n0, n1, h0 = F.get("nw", F.lit(0)), F.get("nw", F.lit(1)), F.get("house", F.lit(0))
    ln, la = ex.longest_two(F.col("nw")), ex.longest_two(F.col("aw"))
    pair = lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("a"), b.alias("b")))
    return r.select("s1", pair(n0, n1).alias("p1"), pair(n0, h0).alias("p2"), F.get(ln, F.lit(0)).alias("p3a"), F.get(ln, F.lit(1)).alias("p3b"), F.get(la, F.lit(0)).alias("p4a"), F.get(la, F.lit(1)).alias("p4b"), "more")


def _first_k(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).drop("rn")


def posting_lists(index: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(token, src, id) of the first ``k`` records of each token in ``wanted`` (s1, step, token): no lookup can take more."""
    return _first_k(index.join(wanted.select("token").distinct(), "token", "left_semi"), ["token"], k)


def posting_hits(index: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(s1, step, src, id) of each lookup's list."""
    return wanted.join(posting_lists(index, wanted, k), "token").select("s1", "step", *ORDER)


def conjunction_lists(index: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(a, b, src, id) of the first ``k`` records with both tokens of ``wanted`` (s1, step, a, b).

    Each distinct pair is met once, by the records of its rarer token, so a hot token multiplies nothing.
    """
    n = index.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    pairs = wanted.select("a", "b").distinct()
    pairs = pairs.join(n.select(F.col("token").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("token").alias("b"), F.col("n").alias("nb")), "b")
    first = F.col("na") <= F.col("nb")
    pairs = pairs.select("a", "b", F.when(first, F.col("a")).otherwise(F.col("b")).alias("token"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("other"))
    both = pairs.join(index, "token").drop("token").withColumnRenamed("other", "token").join(index.select("token", "id"), ["token", "id"], "left_semi")
    return _first_k(both.select("a", "b", *ORDER), ["a", "b"], k)


def conjunction_hits(index: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(s1, step, src, id) of each lookup's list."""
    return wanted.join(conjunction_lists(index, wanted, k), ["a", "b"]).select("s1", "step", *ORDER)


SINGLES = ("p3a", "p3b", "p4a", "p4b")
PAIRS = ("p1", "p2")
STEPS = PAIRS + SINGLES


def wanted_tokens(look: DataFrame, steps=SINGLES) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(STEPS.index(c)).alias("step"), F.col(c).alias("token")) for c in steps])
    return look.select("s1", F.explode(rows).alias("x")).select("s1", "x.*").where(F.col("token").isNotNull())


def wanted_pairs(look: DataFrame, steps=PAIRS) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(STEPS.index(c)).alias("step"), F.col(f"{c}.a").alias("a"), F.col(f"{c}.b").alias("b")) for c in steps])
    return look.select("s1", F.explode(rows).alias("x")).select("s1", "x.*").where(F.col("a").isNotNull())


def _of_step(i: int) -> Column:
    return F.filter("h", lambda x: x["step"] == i)


def candidates(refs: DataFrame, records: DataFrame, k: int = 40) -> DataFrame:
    """(s1, src, id): at most ``k`` candidates by six lookups, each limited to what the ones before left of the budget.

    A lookup takes the first remaining rows by (src, id), those found already included. ``refs`` and ``records`` are
    prepared. References without candidates have no row here.
    """
    index, look = token_index(records), lookups(refs)
    hits = conjunction_hits(index, wanted_pairs(look), k).union(posting_hits(index, wanted_tokens(look), k))
    # At most k hits for each of six steps: a reference's hits fit one row, where the budget is spent step by step.
    out = hits.groupBy("s1").agg(F.sort_array(F.collect_list(F.struct("step", *ORDER))).alias("h"))
    pool = F.array().cast("array<struct<src:int,id:string>>")
    out = out.withColumn("pool", pool)
    for i in range(len(STEPS)):
        mine = F.transform(_of_step(i), lambda x: F.struct(x["src"].alias("src"), x["id"].alias("id")))
        out = out.withColumn("pool", F.array_union("pool", F.slice(mine, F.lit(1), F.lit(k) - F.size("pool"))))
    return out.select("s1", F.explode("pool").alias("p")).select("s1", "p.src", "p.id")


#: References of one lookup that are scored in one place; more are dealt over copies of the lookup's list.
GROUP = 20_000
#: References scored at once, and records of short lists that are put together for it.
CHUNK, TOGETHER = 2048, 400
_BEST = "array<struct<below:int,src:int,id:string>>"


class _Words:
    """A column of word lists as codes: equal words have equal codes."""

    def __init__(self, column: pa.Array):
        codes = column.flatten().dictionary_encode()
        self.words, self.codes = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
        self.ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        self.size = np.diff(self.ends, prepend=0)

    def first(self) -> tuple[np.ndarray, np.ndarray]:
        """Each list's first word and that word's first four letters as codes; negative where there is none."""
        number: dict[str, int] = {}
        four = np.array([number.setdefault(w[:4], len(number)) if len(w) >= 4 else -1 for w in self.words] + [-1])
        at = np.full(len(self.size), -1, np.int64)
        at[self.size > 0] = self.codes[(self.ends - self.size)[self.size > 0]]
        return at, four[at]

    def _of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[rows]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(np.arange(len(rows)), size), self.codes[np.repeat(self.ends[rows] - size, size) + inside]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words each of lists ``a`` has in common with each of ``b``; no list has one twice."""
        (i, x), (j, y) = self._of(a), self._of(b)
        both = np.intersect1d(x, y)
        place = np.full(len(self.words), -1, np.int64)
        place[both] = np.arange(len(both))
        own, has = np.zeros((len(a), len(both)), np.float32), np.zeros((len(both), len(b)), np.float32)
        x, y = place[x], place[y]
        own[i[x >= 0], x[x >= 0]] = 1
        has[y[y >= 0], j[y >= 0]] = 1
        return (own @ has).astype(np.int32)


class _Lookups:
    """Rows of lists and references, sorted by lookup, lists first."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.rows = rows
        plain = lambda c: rows[c].combine_chunks()
        codes = lambda c: plain(c).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        key, salt = codes("key"), plain("salt").to_numpy(zero_copy_only=False)
        self.group = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
        self.ref = plain("ref").to_numpy(zero_copy_only=False).astype(bool)
        self.nw, self.aw, self.house = (_Words(plain(c)) for c in ("nw", "aw", "house"))
        land = plain("land").dictionary_encode()
        self.land = land.indices.to_numpy(zero_copy_only=False)
        self.any = np.array([x == "" for x in land.dictionary.to_pylist()], bool)[self.land]
        self.first, self.four = self.nw.first()

    def packs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of references and of the records of their lists, several short lists together."""
        starts = np.flatnonzero(np.diff(self.group, prepend=-1))
        listed = np.add.reduceat(~self.ref, starts, dtype=np.int64)
        lo, n = 0, 0
        for g, size in enumerate(listed.tolist()):
            n += size
            if n >= TOGETHER or g + 1 == len(starts):
                rows = np.arange(starts[lo], starts[g + 1] if g + 1 < len(starts) else len(self.ref))
                refs, records = rows[self.ref[rows]], rows[~self.ref[rows]]
                for at in range(0, len(refs) if len(records) else 0, CHUNK):
                    yield refs[at : at + CHUNK], records
                lo, n = g + 1, 0

    def scores(self, s: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The lexical score of each pair from word sets, first words and house numbers."""
        n, a, h = (x.common(s, c) for x in (self.nw, self.aw, self.house))
        out = n * np.int32(4) + (n >= 2) * np.int32(5) + a * np.int32(2) + (a >= 2) * np.int32(4)
        out += ((self.first[s] >= 0)[:, None] & (self.first[s][:, None] == self.first[c])) * np.int32(3)
        out += ((self.four[s] >= 0)[:, None] & (self.four[s][:, None] == self.four[c])) * np.int32(2)
        hs, hc = self.house.size[s][:, None], self.house.size[c]
        out += ((h > 0) & (h == hs) & (h == hc)) * np.int32(3)
        return out - ((hs > 0) & (hc > 0) & (h == 0))

    def best(self, s: np.ndarray, c: np.ndarray, k: int) -> pa.RecordBatch:
        """(s1, best): the first ``k`` of each reference's list by falling score, then as the list has them."""
        fits = self.any[s][:, None] | self.any[c] | (self.land[s][:, None] == self.land[c])
        fits &= self.group[s][:, None] == self.group[c]
        none = np.iinfo(np.int32).max
        value = np.where(fits, -self.scores(s, c) * len(c) + np.arange(len(c), dtype=np.int32), np.int32(none))
        if k < len(c):
            value = np.partition(value, k - 1, axis=1)[:, :k]
        value.sort(axis=1)
        ok = value < none
        below, at = np.divmod(value[ok], len(c))
        rows = pa.array(c[at])
        x = pa.StructArray.from_arrays([pa.array(below, pa.int32()), self.rows["src"].combine_chunks().take(rows), self.rows["id"].combine_chunks().take(rows)], ["below", "src", "id"])
        ends = pa.array(np.r_[0, np.cumsum(ok.sum(axis=1))].astype(np.int32))
        return pa.RecordBatch.from_arrays([self.rows["s1"].combine_chunks().take(pa.array(s)), pa.ListArray.from_arrays(ends, x)], ["s1", "best"])


def ranked_candidates(refs: DataFrame, records: DataFrame, k: int = 40, pool: int = 400) -> DataFrame:
    """(s1, src, id, score, rank): hits of all passes, each limited to ``pool``, ranked by score; other countries don't count.

    References go to their lookups' lists, are scored there by matrix products of words, and take their ``k`` best of each
    along: a score depends on the pair alone, so the best of all lists are among these, and no pair is moved.
    """
    name = F.filter(tx.words(F.col("name_c")), lambda w: F.length(w) >= 3)
    addr = F.filter(tx.words(F.col("addr_c")), lambda w: (F.length(w) >= 3) & ~w.isin(lex.STOP_WORDS))
    raw = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.col(c)), r"\s+"), lambda w: w != ""))
    house, land = ex.house_numbers(F.col("addr")).alias("house"), tx.country(F.col("country")).alias("land")
    parts = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index, look = token_index(records), lookups(refs, F.array_distinct(name).alias("nw"), F.array_distinct(addr).alias("aw"), house, land)
    cols = ["nw", "aw", "house", "land"]
    c = records.select("id", raw("name").alias("nw"), raw("addr").alias("aw"), house, land)
    # no token has a space, so a pair's key is no other's
    both = lambda a, b: F.concat_ws(" ", a, b)
    lists = conjunction_lists(index, wanted_pairs(look), pool).select(both("a", "b").alias("key"), *ORDER)
    lists = lists.union(posting_lists(index, wanted_tokens(look), pool).select("token", *ORDER)).join(c, "id")
    keys = F.array(*[F.when(F.col(p).isNotNull(), both(F.col(f"{p}.a"), F.col(f"{p}.b"))) for p in PAIRS], *SINGLES)
    s = look.select("s1", "more", F.explode(F.array_distinct(F.filter(keys, lambda x: x.isNotNull()))).alias("key"))
    many = s.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("n"))
    s = s.join(many, "key").withColumn("salt", F.pmod(F.xxhash64("s1"), F.col("n")).cast("int"))
    lists = lists.join(many, "key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    lists = lists.select("key", "salt", F.lit(False).alias("ref"), F.lit(None).cast("string").alias("s1"), *ORDER, *cols)
    s = s.select("key", "salt", F.lit(True).alias("ref"), "s1", F.lit(None).cast("int").alias("src"), F.lit(None).cast("string").alias("id"), *[F.col("more")[x].alias(x) for x in cols])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            # the last lookup's list comes again before references that follow
            at = _Lookups(pa.concat_tables([held, rows]) if held is not None else rows)
            for refs, records in at.packs():
                yield at.best(refs, records, k)
            held = at.rows.take(pa.array(np.flatnonzero((at.group == at.group[-1]) & ~at.ref)))

    rows = lists.union(s).repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "ref", *ORDER)
    best = rows.mapInArrow(score, f"s1 string, best {_BEST}").groupBy("s1").agg(F.array_sort(F.flatten(F.collect_list("best"))).alias("best"))
    # found by several lookups, a record stands next to itself
    once = best.select("s1", F.filter("best", lambda x, i: (i == 0) | (x != F.get("best", i - 1))).alias("best"))
    out = once.select("s1", F.posexplode(F.slice("best", 1, k)).alias("at", "x"))
    return out.select("s1", "x.src", "x.id", (-F.col("x.below")).alias("score"), (F.col("at") + 1).alias("rank"))


def country_allows(a: Column, b: Column) -> Column:
    return (a == "") | (b == "") | (a == b)


def key_candidates(refs: DataFrame, records: DataFrame, k: int = 150) -> DataFrame:
    """(s1, src, id): records that share a blocking key, the first ``k`` by (src, id).

    A record beyond the first ``k`` of every key it shares can't be among a reference's first ``k``, so each key's
    list is cut to ``k`` before the join: a hot key gives k rows for each reference, not all pairs.
    """
    keys = lambda df: df.select(*ORDER, F.explode(F.array_distinct(ex.blocking_keys(F.col("name"), F.col("addr"), F.col("country")))).alias("key"))
    mine = keys(refs).select(F.col("id").alias("s1"), "key")
    theirs = _first_k(keys(records).join(mine.select("key").distinct(), "key", "left_semi"), ["key"], k)
    return _first_k(mine.join(theirs, "key").select("s1", *ORDER).distinct(), ["s1"], k)


def attributes(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with their record's columns; unknown ids drop out."""
    return pairs.join(records.drop("src"), "id")


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds ``label`` 1 where (s1, id) is in ``truth``."""
    hit = truth.select("s1", "id").distinct().withColumn("hit", F.lit(1))
    return pairs.join(hit, ["s1", "id"], "left").withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")


def split_holdout(refs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(training, holdout): the last ``n`` references by id are held out, the others don't contain them."""
    held = refs.orderBy(F.desc("id")).limit(n)
    return refs.join(held.select("id"), "id", "left_anti"), held


def save_index(index: DataFrame, table: str, buckets: int = 200) -> None:
    """The token index as a table bucketed and sorted by token: later lookups join without moving it."""
    index.write.mode("overwrite").bucketBy(buckets, "token").sortBy("token", *ORDER).saveAsTable(table)


def load_index(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
