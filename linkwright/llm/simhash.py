"""SimHash near-duplicates: generalised pigeonhole search over correlated bit groups with unequal thresholds."""

from __future__ import annotations

import math
import zlib
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import bounded_batches, checkpoint, documents, give_back, keyed_rows, reclaim
from linkwright.llm.graph import components

BITS = 64
WORDS = 4
RADIUS = 4
#: Owners of one key that one task compares at once; larger buckets are split into pairs of blocks.
BLOCK = 4096
#: Hot keys up to this number go to the executors by broadcast (24 bytes each); more are joined.
HOT_KEYS = 100_000


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of the ``words``-word shingles (repeats count); 0 where there is no word or text is null."""
    import xxhash

    w = (text or "").encode().lower().split()  # on bytes: A-Z only, and splits on x20 and x09 to x0D only
    if not w:
        return 0
    joined, h = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) < words:
        return h(joined, 42)
    size = np.fromiter(map(len, w), np.int64, len(w)) + 1
    ends = np.cumsum(size) - 1
    starts = (ends - size + 1)[: len(w) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 15):
        part = np.array([h(joined[s:e], 42) for s, e in zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)], strict=True)], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts)).view(">u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) of each row's whole text; ``fp`` is the fingerprint as a signed long."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for pdf in batches:
            fp = np.array([fingerprint(t, words) for t in pdf["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "fp": fp})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, fp long")


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, over all of them, how often bits i and j are both 1 (64 x 64)."""

    def run(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for pdf in batches:
            x = np.unpackbits(pdf["fp"].to_numpy(np.int64).astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
            n += len(x)
            both += x.T @ x
        yield pd.DataFrame({"i": np.arange(BITS * BITS + 1), "n": np.append(both.ravel(), n).astype(np.int64)})

    rows = dict(prints.select("fp").mapInPandas(run, "i int, n long").groupBy("i").agg(F.sum("n")).collect())
    return rows.get(BITS * BITS, 0), np.array([rows.get(i, 0) for i in range(BITS * BITS)], dtype=float).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits (0 is the highest) in ``parts`` groups of nearly equal size; each group gathers correlated bits greedily."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (corr[b, rest].max(initial=0), -b))]
        while len(group) < width:
            group.append(max((b for b in rest if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        groups.append(group)
        left -= set(group)
    return groups


def within(n: int, both: np.ndarray, group: list[int], radius: int) -> np.ndarray:
    """Share of pairs that differ in at most 0, 1 ... ``radius`` bits of a group, from how often bits are 1 together.

    Two fingerprints differ in bits b and c with a probability that the four joint shares give, so mean and variance of
    the number of differing bits are known with the group's correlations; a beta-binomial law with both gives the tail.
    """
    m = len(group)
    p11 = both[np.ix_(group, group)] / max(n, 1)
    p = np.diag(p11)
    p10, p01 = p[:, None] - p11, p[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    each = 2 * p * (1 - p)
    mean = float(each.sum())
    joint = 2 * (p11 * p00 + p10 * p01)
    np.fill_diagonal(joint, each)
    share = min(max(mean / m, 1e-9), 1 - 1e-9)
    spread = (float(joint.sum()) - mean * mean) / (m * share * (1 - share))
    rho = min(max((spread - 1) / max(m - 1, 1), 1e-6), 1 - 1e-6)
    al, be = share * (1 / rho - 1), (1 - share) * (1 / rho - 1)
    log_beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    law = [math.comb(m, k) * math.exp(log_beta(k + al, m - k + be) - log_beta(al, be)) if k <= m else 0.0 for k in range(radius + 1)]
    return np.minimum(np.cumsum(law), 1.0)


def allocate(n: int, both: np.ndarray, groups: list[list[int]], radius: int) -> tuple[float, list[int]]:
    """Estimated cost and thresholds (-1: not probed) that sum to radius - parts + 1, by dynamic programming.

    A group's candidates at threshold t are estimated as the pairs that differ in at most t of its bits (``within``);
    each probed key counts as four candidates.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        close = within(n, both, group, radius)
        nxt: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, ts) in best.items():
            for t in range(-1, radius + 1):
                probes = sum(math.comb(len(group), i) for i in range(t + 1))
                c = cost + n * n * float(close[t]) * (t >= 0) + 4.0 * n * probes
                if c < nxt.get(total + t, (math.inf, []))[0]:
                    nxt[total + t] = (c, [*ts, t])
        best = nxt
    return best[radius - len(groups) + 1]


def plan(n: int, both: np.ndarray, radius: int, most_parts: int | None = None) -> list[tuple[int, list[int]]]:
    """The cheapest of several groupings: (mask of the group's bits, masks to flip when probing) for each probed group.

    At most ``most_parts`` groups are tried, (radius + 2) / 2 by default: with more, groups get so narrow that
    candidates grow with the square of the input.
    """
    options = []
    for parts in range(2, (most_parts or max(2, (radius + 2) // 2)) + 1):
        groups = group_bits(n, both, parts)
        cost, ts = allocate(n, both, groups, radius)
        options.append((cost, parts, groups, ts))
    _, _, groups, ts = min(options)
    out = []
    for group, t in zip(groups, ts, strict=True):
        if t >= 0:
            bits = [1 << (BITS - 1 - b) for b in group]
            out.append((sum(bits), [sum(c) for i in range(t + 1) for c in combinations(bits, i)]))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, own: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join what links of at most ``radius`` bits between an owner and any other join in one bucket.

    Owners are compared with owners not reached yet and with all others; of links inside what is joined already,
    none is given.
    """
    bits = fps.view(np.uint64)  # counts of signed numbers are those of their absolute value
    todo, others = np.flatnonzero(own), np.flatnonzero(~own)
    group = np.full(len(fps), -1)
    edges, k = [], 0
    while len(todo):
        queue, todo, k = [int(todo[0])], todo[1:], k + 1
        while queue:
            i = queue.pop()
            near = np.bitwise_count(bits[todo] ^ bits[i]) <= radius
            if near.any():
                hit = todo[near]
                edges += [(fps[i], fps[j]) for j in hit]
                queue += hit.tolist()
                todo = todo[~near]
            for j in others[(np.bitwise_count(bits[others] ^ bits[i]) <= radius) & (group[others] != k)].tolist():
                if group[j] != k:
                    edges.append((fps[i], fps[j]))
                    if group[j] >= 0:
                        group[group == group[j]] = k
                    group[j] = k
    return edges


def _hot_keys(nodes: DataFrame, probe_plan: list, block: int) -> DataFrame:
    """(g, key, so, sp): keys with over one block of owners or probers, and how many blocks these make.

    Probers of a key own its neighbours. Only neighbours with enough owners to matter are spread; all others of a key
    have a quarter of a block at most.
    """
    owners = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(_signed(m)).alias("m")) for g, (m, _) in enumerate(probe_plan)])
    owned = nodes.select("fp", F.explode(owners).alias("x")).groupBy(F.col("x.g").alias("g"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    heavy, flips = F.lit(False), F.array().cast("array<bigint>")
    for g, (_, fs) in enumerate(probe_plan):
        heavy = heavy | ((F.col("g") == g) & (F.col("n") * 4 * len(fs) > block))
        flips = F.when(F.col("g") == g, F.array(*[F.lit(_signed(f)) for f in fs if f]).cast("array<bigint>")).otherwise(flips)
    owned = checkpoint(owned.where(heavy))
    probed = owned.select("g", F.explode(flips).alias("f"), "key", "n").groupBy("g", F.col("key").bitwiseXOR(F.col("f")).alias("key")).agg(F.sum("n").alias("p"))
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.coalesce(F.col(c), F.lit(0)) / block)).cast("int")
    return checkpoint(owned.join(probed, ["g", "key"], "full").select("g", "key", blocks("n").alias("so"), blocks("p").alias("sp")).where("so > 1 OR sp > 1"))


def link(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK, probe_plan: list | None = None, most_parts: int | None = None) -> DataFrame:
    """Verified edges (a, b) between distinct fingerprints in ``nodes.fp``: the closure is that of all links.

    Each fingerprint owns one key in each group of bits and probes the keys within the group's threshold. Buckets
    stream through sorted tasks; a bucket gives links, or for more than 32 members a spanning forest of its links,
    which joins what they join. Where a key has over ``block`` owners or probers, owners' blocks are dealt over pairs of
    each other and over the probers' blocks: a task holds about two blocks of a bucket, and nothing is left out.
    """
    if probe_plan is None:
        n, both = bit_statistics(nodes)
        if n < 2:
            return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
        probe_plan = plan(n, both, radius, most_parts)
    flips = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(_signed(m)).alias("m"), F.lit(_signed(f)).alias("f")) for g, (m, fs) in enumerate(probe_plan) for f in fs])
    hot = _hot_keys(nodes, probe_plan, block)
    n_hot = hot.count()
    rows = nodes.select("fp", F.explode(flips).alias("x")).select("fp", "x.g", F.col("fp").bitwiseAND(F.col("x.m")).bitwiseXOR(F.col("x.f")).alias("key"), (F.col("x.f") == 0).alias("own"))
    if n_hot:
        so, sp, h = F.col("so"), F.col("sp"), F.xxhash64("fp")
        mine, base = F.pmod(h, F.when(F.col("own"), so).otherwise(sp)), F.when(so > 1, so * so).otherwise(F.lit(0))
        upto = lambda n: F.sequence(F.lit(0), n - 1)
        with_probers = F.transform(upto(sp), lambda j: base + mine * sp + j)
        with_owners = F.when(so > 1, F.transform(upto(so), lambda o: F.least(mine, o) * so + F.greatest(mine, o))).otherwise(F.array().cast("array<bigint>"))
        probing = F.transform(upto(so), lambda i: base + i * sp + mine)
        salts = F.when(so.isNull(), F.array(F.lit(0).cast("long"))).when(F.col("own"), F.concat(with_owners, with_probers)).otherwise(probing)
        rows = rows.join(F.broadcast(hot) if n_hot <= HOT_KEYS else hot, ["g", "key"], "left").select("g", "key", F.explode(salts).alias("salt"), "fp", "own")
    else:
        rows = rows.select("g", "key", F.lit(0).cast("long").alias("salt"), "fp", "own")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # sorted to the last column: a task run again after a loss must give the same forest, as others may hold half of it
    rows = rows.repartition(parts, "g", "key", "salt").sortWithinPartitions("g", "key", "salt", "fp")

    def found(pdf, starts, ends):
        fps, own = pdf["fp"].to_numpy(np.int64), pdf["own"].to_numpy(bool)
        bits = fps.view(np.uint64)
        size = ends - starts
        edges = [np.empty((0, 2), np.int64)]
        for s, e in zip(starts[size > 32].tolist(), ends[size > 32].tolist(), strict=True):
            if len(f := _forest(fps[s:e], own[s:e], radius)):
                edges.append(np.array(f, dtype=np.int64))
        end = np.repeat(ends, size)
        idx = np.flatnonzero(np.repeat(size <= 32, size) & (np.repeat(size, size) > 1))
        for d in range(1, 32):
            idx = idx[idx + d < end[idx]]
            if not len(idx):
                break
            ok = idx[(own[idx] | own[idx + d]) & (np.bitwise_count(bits[idx] ^ bits[idx + d]) <= radius)]
            if len(ok):
                edges.append(np.column_stack([fps[ok], fps[ok + d]]))
        e = np.concatenate(edges)
        e = np.unique(np.sort(e[e[:, 0] != e[:, 1]], axis=1), axis=0)
        return pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})

    return rows.mapInPandas(lambda batches: _bucketed(batches, ["g", "key", "salt"], found), "a long, b long").distinct()


def near_groups(prints: DataFrame, radius: int = RADIUS, most_parts: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id): components of links at ``radius`` bits or fewer; equal fingerprints are one node.

    ``component_id`` is the smallest doc_id in the component (null ids count only where there is no other). Repeated
    rows stay. An empty input gives no rows.
    """
    prints = checkpoint(prints)
    nodes = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(link(nodes, radius, most_parts=most_parts))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    rooted = checkpoint(rooted)
    # Stored, so that the join with a root that many share stands alone and can be split.
    low = checkpoint(rooted.groupBy("root").agg(F.min("low").alias("component_id")))
    return prints.join(rooted.join(low, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


#: Near copies are texts whose sets of five-word shingles have a Jaccard similarity of at least 4/5.
FILTER_WORDS = 5
#: Buckets of up to this many sets may give pairs; larger ones are joined inside a task that holds the sets.
SMALL = 32
#: Shingles in the sets of one block of a large bucket, and how many sets; a task holds two blocks.
BLOCK_SHINGLES, BLOCK_SETS = 2_000_000, 8192
#: Texts whose shingles are counted for the order, and how many of the most frequent shingles the order knows.
SAMPLE, FREQUENT = 20_000, 100_000
#: One round of comparing moves a share ROUND of all sets at most, and of few sets (ROUND_LEAST) any: this bounds the disk.
ROUND, ROUND_LEAST = 0.5, 50_000
#: Least bits of a set's sketch.
SKETCH_BITS = 1024
#: Shingles and sets in a block of sketches: these take up to two bits a shingle, texts about 40.
SKETCHED_SHINGLES, SKETCHED_SETS = 32 * BLOCK_SHINGLES, 2 * BLOCK_SETS
#: Ids up to this number go to the executors by broadcast; more are joined.
BROADCAST_IDS = 500_000


def shingles(text: str | None, words: int = FILTER_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a text of fewer words is one shingle, no word gives none."""
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return np.empty(0, np.int64)
    joined, h = b" ".join(w), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][: max(1, len(w) - words + 1)].tolist()
    ends = ends[min(words, len(w)) - 1 :].tolist()
    return np.unique(np.array([h(joined[s:e], 7) for s, e in zip(starts, ends, strict=True)], dtype=np.uint64).view(np.int64))


def similar(common, a, b):
    """Whether sets of ``a`` and ``b`` shingles with ``common`` in both have a Jaccard similarity of 4/5 or more."""
    return 9 * common >= 4 * (a + b)


def sketch(keys: np.ndarray) -> bytes:
    """Whether an odd number of ``keys`` falls into each class, a bit each.

    Classes are a power of two and no fewer than ``keys``: in a narrower sketch unlike sets don't differ in enough bits.
    """
    bits = max(SKETCH_BITS, 1 << (len(keys) - 1).bit_length())
    return np.packbits(np.bincount(keys & (bits - 1), minlength=bits) & 1).tobytes()


class _Sketches:
    """A column of sketches. Both halves of one, bit by bit, give that of half the bits: pairs differ at the shorter one's."""

    def __init__(self, column):
        self.own = [np.frombuffer(x, np.uint64) for x in column]
        self.words = np.array([len(x) for x in self.own], np.int64)
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _level(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The sketches of at least so many words at this width, and where each one's row is."""
        if words not in self.levels:
            has = self.words >= words
            rows = [np.bitwise_xor.reduce(x.reshape(-1, words), axis=0) for x, ok in zip(self.own, has.tolist(), strict=True) if ok]
            self.levels[words] = np.array(rows, np.uint64).reshape(-1, words), np.cumsum(has) - 1
        return self.levels[words]

    def differing(self, i: np.ndarray, other: _Sketches, j: np.ndarray) -> np.ndarray:
        """In how many bits sketches ``i`` differ from ``j`` of ``other``."""
        words, out = np.minimum(self.words[i], other.words[j]), np.empty(len(j), np.int64)
        for w in np.unique(words).tolist():
            (x, at), (y, to), some = self._level(w), other._level(w), np.flatnonzero(words == w)
            out[some] = np.bitwise_count(x[at[i[some]]] ^ y[to[j[some]]]).sum(axis=1, dtype=np.int64)
        return out

    def may_be_similar(self, i: int, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether set ``i`` may be similar to each of ``j``; ``size``: how many shingles each has."""
        return 9 * self.differing(np.full(len(j), i), self, j) <= size[i] + size[j]


def _sketches(column) -> _Sketches:
    return _Sketches(column)


def may_be_similar(x: _Sketches, y: _Sketches, a, b) -> np.ndarray:
    """Whether sets of ``a`` and ``b`` shingles with sketches ``x`` and ``y`` may be similar; False is certain.

    Similar sets differ in (a + b) / 9 shingles at most, and each of these changes one bit.
    """
    every = np.arange(len(x.words))
    return 9 * x.differing(every, y, every) <= a + b


def _sets(column) -> list[np.ndarray]:
    """Sets of packed texts: these take a third of the hashes' bytes, and hashing them again is cheap."""
    return [_unpacked(x) for x in column]


@lru_cache(2048)
def _unpacked(packed: bytes) -> np.ndarray:
    return shingles(zlib.decompress(packed).decode())


def frequent_shingles(nodes: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample of ``nodes``, sorted, and their counts. They decide an order, no result."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"key": np.concatenate([np.empty(0, np.int64), *_sets(pdf["packed"])])})

    few = nodes.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // SAMPLE))) == 0).select("packed")
    top = few.mapInPandas(run, "key long").groupBy("key").count().where("count > 3").orderBy(F.desc("count"), "key").limit(FREQUENT).collect()
    top = np.array(sorted((r[0], r[1]) for r in top), dtype=np.int64).reshape(-1, 2)
    return top[:, 0], top[:, 1]


def prefix(keys: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first n - ceil(4n/5) + 1 shingles in an order common to all sets (frequent ones last).

    Sets that are similar share at least ceil(4n/5) shingles, hence one of these: no similar pair is missed.
    """
    n = len(keys)
    if len(frequent) and n:
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        keys = keys[np.lexsort((keys, np.where(frequent[at] == keys, counts[at], 0)))]
    return keys[: n - (4 * n + 4) // 5 + 1] if n else keys


def _bucketed(batches, keys, found):
    """Calls ``found`` with whole buckets of a stream sorted by ``keys``: the frame and the buckets' starts and ends."""
    held = None
    for pdf in batches:
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        k = held[keys].to_numpy(np.int64)
        new = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if len(new):
            cut = int(new[-1])
            yield found(held.iloc[:cut], np.r_[0, new[:-1]], new)
            held = held.iloc[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield found(held, np.array([0]), np.array([len(held)]))
    held = None
    _unpacked.cache_clear()
    give_back()


def has_partner(left: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which sets of a bucket may be similar to another by their sizes and what is ``left`` of both: exact, without all pairs."""
    order = np.argsort(left, kind="stable")
    x, z = left[order], size[order]
    least = np.minimum.accumulate(z[:0:-1])[::-1]  # of those with more left
    room = np.maximum.accumulate(9 * x[:-1] - 4 * z[:-1])  # of those with less left
    ok = np.zeros(len(x), bool)
    ok[:-1] |= similar(x[:-1], z[:-1], least)
    ok[1:] |= room >= 4 * z[1:]
    out = np.empty(len(ok), bool)
    out[order] = ok
    return out


def candidates(nodes: DataFrame, n: int) -> DataFrame:
    """(a, b, key, size) of ``nodes`` (id, packed): pairs a < b that may be similar, or members a (b null) of a bucket.

    A bucket holds the sets with one shingle in their prefix. Of the shared shingles, one is the first in both orders;
    what is left of both sets from it on bounds the number shared. A bucket with more pairs left than members that are
    in one gives these members instead, as do large buckets, so no bucket gives more rows than it has. ``key`` is the
    least id of the members that sizes don't part: buckets of one family, each without a few of its sets, mostly have
    the same, and give each set once, not once a bucket.
    """
    frequent, counts = frequent_shingles(nodes, n)

    def spread(batches):
        for pdf in batches:
            sets = _sets(pdf["packed"])
            heads = [prefix(x, frequent, counts) for x in sets]
            many = np.array([len(x) for x in heads])
            size = np.repeat(np.array([len(x) for x in sets]), many)
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            yield pd.DataFrame({"key": np.concatenate([np.empty(0, np.int64), *heads]), "id": np.repeat(pdf["id"].to_numpy(np.int64), many), "size": size.astype(np.int32), "left": (size - place).astype(np.int32)})

    def found(pdf, starts, ends):
        key, ids, size, left = (pdf[c].to_numpy(np.int64) for c in ("key", "id", "size", "left"))
        many = ends - starts
        bucket, end = np.repeat(np.arange(len(many)), many), np.repeat(ends, many)
        idx = np.flatnonzero(np.repeat((many > 1) & (many <= SMALL), many))
        pairs = [np.empty((0, 2), np.int64)]
        for d in range(1, SMALL):
            idx = idx[idx + d < end[idx]]
            if not len(idx):
                break
            ok = idx[similar(np.minimum(left[idx], left[idx + d]), size[idx], size[idx + d])]
            pairs.append(np.column_stack([ok, ok + d]))
        pairs = np.concatenate(pairs)
        partner = np.zeros(len(key), bool)
        partner[pairs.ravel()] = True
        of = bucket[pairs[:, 0]]
        dense = np.bincount(of, minlength=len(many)) > np.bincount(bucket[partner], minlength=len(many))
        pairs = np.unique(np.sort(ids[pairs[~dense[of]]], axis=1), axis=0)
        for s, e in zip(starts[many > SMALL].tolist(), ends[many > SMALL].tolist(), strict=True):
            partner[s:e] = has_partner(left[s:e], size[s:e])
        member = np.flatnonzero(np.where(many > SMALL, True, dense)[bucket] & partner)
        member = member[np.lexsort((size[member], bucket[member]))]
        of, z = bucket[member], size[member]
        new = np.flatnonzero(np.r_[len(of) > 0, (of[1:] != of[:-1]) | (4 * z[1:] > 5 * z[:-1])])
        low = np.repeat(np.minimum.reduceat(ids[member], new), np.diff(np.r_[new, len(of)])) if len(new) else ids[:0]
        stars = np.unique(np.column_stack([low, ids[member], z]), axis=0)
        return pd.concat(
            [
                pd.DataFrame({"a": pairs[:, 0], "b": pd.array(pairs[:, 1], "Int64"), "key": pd.array([None] * len(pairs), "Int64"), "size": 0}),
                pd.DataFrame({"a": stars[:, 1], "b": pd.array([None] * len(stars), "Int64"), "key": pd.array(stars[:, 0], "Int64"), "size": stars[:, 2]}),
            ]
        )

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.mapInPandas(spread, "key long, id long, size int, left int").repartition(parts, "key").sortWithinPartitions("key", "id")
    return rows.mapInPandas(lambda batches: _bucketed(batches, ["key"], found), "a long, b long, key long, size long")


def _needed(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``nodes`` with one of ``ids``, so that no other set is shuffled."""
    ids = checkpoint(ids.distinct())
    return nodes.select("id", "packed").join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _rounds(rows: DataFrame, keys: list[str], moved: float, whole: float) -> list[DataFrame]:
    """``rows`` dealt by ``keys`` over as many rounds as it takes for each to move a share ROUND of ``whole`` at most."""
    n = max(1, math.ceil(moved / max(ROUND * whole, ROUND_LEAST)))
    return [rows.where(F.pmod(F.xxhash64(*keys), F.lit(n)) == r) for r in range(n)] if n > 1 else [rows]


def _sketched(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that may be similar by their sketches, so that few texts are moved for what isn't."""

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.loc[may_be_similar(_sketches(pdf["x"]), _sketches(pdf["y"]), pdf["m"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)), ["a", "b"]]

    ends = [nodes.select(F.col("id").alias(c), F.col("sketch").alias(v), F.col("size").alias(k)) for c, v, k in (("a", "x", "m"), ("b", "y", "n"))]
    return pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "x", "y", "m", "n").mapInPandas(run, "a long, b long")


def similar_pairs(nodes: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar, by all their shingles. ``n``: the number of ``nodes``."""

    def run(batches):
        for pdf in batches:
            ok = [similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in zip(_sets(pdf["x"]), _sets(pdf["y"]), strict=True)]
            yield pdf.loc[ok, ["a", "b"]]
        _unpacked.cache_clear()
        give_back()

    out, pairs = None, checkpoint(_sketched(nodes, pairs))
    reclaim(nodes.sparkSession)
    for part in _rounds(pairs, ["a", "b"], 2 * pairs.count(), n):
        sets = _needed(nodes, part.select(F.col("a").alias("id")).union(part.select("b")))
        ends = [sets.select(F.col("id").alias(c), F.col("packed").alias(v)) for c, v in (("a", "x"), ("b", "y"))]
        found = checkpoint(part.join(ends[0], "a").join(ends[1], "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long"))
        out = found if out is None else out.union(found)
        del sets, ends, found
        reclaim(nodes.sparkSession)
    return out


def forest(ids: np.ndarray, roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Similar pairs that join all that any similar pairs of one bucket join; each was compared by all its shingles.

    Only pairs not joined yet (by ``roots`` or an edge given before) are compared.
    """
    size = np.array([len(x) for x in sets])
    starts = np.cumsum(size) - size
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    group, edges = np.unique(roots, return_inverse=True)[1], []
    mark, x = np.zeros(len(values), bool), _sketches([sketch(x) for x in sets])
    for i in range(len(sets)):
        other = np.flatnonzero((group[i + 1 :] != group[i]) & similar(np.minimum(size[i], size[i + 1 :]), size[i], size[i + 1 :])) + i + 1
        other = other[x.may_be_similar(i, other, size)]
        if not len(other):
            continue
        own = flat[starts[i] : starts[i] + size[i]]
        mark[own] = True
        if 8 * len(other) > len(sets):
            common = np.add.reduceat(mark[flat], starts, dtype=np.int64)[other]
        else:
            common = np.array([np.count_nonzero(mark[flat[starts[j] : starts[j] + size[j]]]) for j in other.tolist()])
        mark[own] = False
        hit = other[similar(common, size[i], size[other])]
        edges += [(ids[i], ids[j]) for j in hit]
        group[np.isin(group, group[hit])] = group[i]
    return edges


def partnered(roots: np.ndarray, size: np.ndarray, sketches: _Sketches) -> np.ndarray:
    """Which sets of a bucket may be similar, by their sketches, to one that has another root."""
    order = np.argsort(size, kind="stable")
    roots, size, x, ok = roots[order], size[order], _Sketches([sketches.own[i] for i in order.tolist()]), np.zeros(len(order), bool)
    for i, end in enumerate(np.searchsorted(4 * size, 5 * size, "right").tolist()):
        j = np.arange(i + 1, end)[roots[i + 1 : end] != roots[i]]
        j = j[~ok[j]] if ok[i] else j
        if len(j):
            hit = j[x.may_be_similar(i, j, size)]
            ok[hit] = True
            ok[i] |= len(hit) > 0
    out = np.empty(len(ok), bool)
    out[order] = ok
    return out


def _dealt(members: DataFrame, shingles: int, sets: int) -> DataFrame:
    """(key, salt, id, size, root): ``members`` (key, id, size, root), those of buckets of over ``shingles`` or ``sets`` dealt over pairs of blocks."""
    split = members.groupBy("key").agg(F.ceil(F.greatest(F.sum("size") / shingles, F.count(F.lit(1)) / sets)).cast("int").alias("s"))
    mine, other, s = F.pmod(F.xxhash64("id"), F.col("s")), F.col("o"), F.col("s")
    rows = members.join(split, "key").withColumn("o", F.explode(F.sequence(F.lit(0), s - 1)))
    return rows.select("key", (F.least(mine, other) * s + F.greatest(mine, other)).alias("salt"), "id", "size", "root")


def _partnered(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Those of ``members`` (key, id, size, root) that may have a similar set of another root in their bucket.

    Sketches are moved, not texts: a bucket of a frequent shingle holds many sets that are like no other.
    """

    def found(pdf, starts, ends):
        root, size = pdf["root"].to_numpy(np.int64), pdf["size"].to_numpy(np.int64)
        ok = np.concatenate([partnered(root[s:e], size[s:e], _sketches(pdf["sketch"].iloc[s:e])) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
        return pdf.loc[ok, ["key", "id", "size", "root"]]

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _dealt(members, SKETCHED_SHINGLES, SKETCHED_SETS).join(nodes.select("id", "sketch"), "id").select("key", "salt", "id", "size", "root", "sketch")
    rows = rows.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "id")
    return rows.mapInPandas(lambda batches: _bucketed(batches, ["key", "salt"], found), "key long, id long, size long, root long").distinct()


def _joined(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Edges of each bucket's ``forest``. ``members``: (key, id, size, root). Large buckets are dealt over pairs of blocks."""
    rows = _dealt(members, BLOCK_SHINGLES, BLOCK_SETS).join(_needed(nodes, members.select("id")), "id").select("key", "salt", "id", "root", "packed")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def found(pdf, starts, ends):
        ids, roots, sets = pdf["id"].to_numpy(np.int64), pdf["root"].to_numpy(np.int64), _sets(pdf["packed"])
        e = [x for s, e in zip(starts.tolist(), ends.tolist(), strict=True) for x in forest(ids[s:e], roots[s:e], sets[s:e])]
        e = np.array(e, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})

    rows = rows.repartition(parts, "key", "salt").sortWithinPartitions("key", "salt", "id")
    return rows.mapInPandas(lambda batches: _bucketed(batches, ["key", "salt"], found), "a long, b long")


def _joined_in_rounds(nodes: DataFrame, members: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    """``edges`` and those of ``members``' buckets."""
    members = checkpoint(_partnered(nodes, members))
    for part in _rounds(members, ["key"], members.count(), n):
        reclaim(nodes.sparkSession)
        edges = checkpoint(edges.union(_joined(nodes, part)))
    reclaim(nodes.sparkSession)
    return edges


def fingerprint_edges(nodes: DataFrame, n: int) -> DataFrame:
    """Edges (a, b) between similar sets of ``nodes`` (id, fp, size, sketch, packed) that the search over fingerprints finds.

    Fingerprints are linked as in op3 (correlated groups of bits, thresholds, probes, verified at RADIUS); the first set
    of each stands for it and is paired with its others. Each pair is then decided by all its shingles.
    """
    firsts = checkpoint(nodes.groupBy("fp").agg(F.min("id").alias("first")))
    end = lambda c: firsts.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_id"))
    pairs = link(firsts.select("fp")).join(end("a"), "a").join(end("b"), "b").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    same = nodes.select("id", "fp").join(firsts, "fp").where("id != first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    pairs = checkpoint(pairs.union(same))
    reclaim(nodes.sparkSession)
    return checkpoint(similar_pairs(nodes, pairs, n))


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ends aren't in one of ``groups`` (node, root)."""
    root = lambda c: groups.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    out = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left")
    return out.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


def similar_links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between similar sets of ``nodes`` (id, fp, size, sketch, packed); their closure is that of all similar pairs.

    Near fingerprints are looked up first; what is similar and has fingerprints further apart is found by prefixes, which
    miss no similar pair. Pairs and sets in one group by then aren't compared again.

    Buckets that gave members are joined as clusters: those with a set in common are one, so that each set is in one cluster
    only, and not in as many rows as its family has buckets. What a step left on disk goes before the next, and steps that would
    move more than a share ROUND of all sets are dealt over rounds. Only sets whose sketches leave it open that they are similar
    to another are moved with their texts.
    """
    spark, n = nodes.sparkSession, nodes.count()
    near = fingerprint_edges(nodes, n)
    groups = checkpoint(components(near))
    nodes = nodes.select("id", "size", "sketch", "packed")
    found = checkpoint(candidates(nodes, n))
    reclaim(spark)
    pairs = checkpoint(_apart(found.where("b IS NOT NULL").select("a", "b").distinct(), groups))
    members = checkpoint(found.where("b IS NULL").select("key", F.col("a").alias("id"), "size").distinct())
    del found
    reclaim(spark)
    edges = checkpoint(near.union(similar_pairs(nodes, pairs, n)))
    del pairs
    if members.isEmpty():
        return edges
    clusters = components(members, "id", "key").select(F.col("node").alias("id"), F.col("root").alias("key"))
    home = members.select("id", "size").distinct().join(clusters, "id").join(components(edges), F.col("id") == F.col("node"), "left")
    home = checkpoint(home.select("key", "id", "size", F.coalesce("root", "id").alias("root")))
    del members, clusters
    return _joined_in_rounds(nodes, home, edges, n)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest doc_id (null last, then the first row).

    SimHash fingerprints are searched as in op3 and their pairs decided by all shingles; an exact search takes the pairs
    whose fingerprints are further apart. So groups are the components of all pairs of rows whose sets of five-word
    shingles have a Jaccard similarity of 0.8 or more; rows of equal sets are one node. Rows are told apart by place, so repeated rows and
    null ids are fine. Empty and null texts are copies of each other.
    """
    bounded_batches(docs.sparkSession)
    rows = keyed_rows(docs)

    def run(batches):
        import xxhash

        for pdf in batches:
            sets = [shingles(t) for t in pdf["text"]]
            digest = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
            fp = np.array([fingerprint(t) for t in pdf["text"]], dtype=np.uint64).view(np.int64)
            packed = [zlib.compress((t or "").encode(), 1) for t in pdf["text"]]
            yield pd.DataFrame({"rid": pdf["rid"], "doc_id": pdf["doc_id"].astype("Int64"), "_key": pdf["_key"], "digest": digest, "fp": fp, "size": [len(x) for x in sets], "sketch": [sketch(x) for x in sets], "packed": packed})

    numbered = rows.select(F.monotonically_increasing_id().alias("rid"), F.col("_row.doc_id").cast("long").alias("doc_id"), "_key", "_row.text")
    whole = checkpoint(numbered.mapInPandas(run, "rid long, doc_id long, _key string, digest binary, fp long, size int, sketch binary, packed binary"))
    prints = whole.select("rid", "doc_id", "_key", "digest")

    def least(row: str):
        return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row")))["row"]

    reclaim(docs.sparkSession)
    firsts = prints.groupBy("digest").agg(least("rid").alias("id"))
    same = checkpoint(prints.join(firsts, "digest").where("rid != id").select("rid"))
    copies = F.broadcast(same) if same.count() <= BROADCAST_IDS else same
    nodes = whole.join(copies, "rid", "left_anti").select(F.col("rid").alias("id"), "fp", "size", "sketch", "packed")
    groups = components(similar_links(nodes))
    groups = checkpoint(groups.join(prints.select(F.col("rid").alias("node"), "doc_id"), "node"))
    kept = groups.groupBy("root").agg(least("node").alias("kept"))
    gone = same.union(groups.join(kept, "root").where("node != kept").select("node"))
    gone = checkpoint(prints.select("rid", "_key").join(gone, "rid", "left_semi").select("_key"))
    return rows.join(gone, "_key", "left_anti").select("_row.*")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_groups(fingerprints(documents(spark, sf_dir)))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
