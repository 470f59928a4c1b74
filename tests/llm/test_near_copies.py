"""The near-duplicate filter against exact shingle similarity: contiguous edits, the border of 0.8, large families."""

import random
import time
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkwright.llm import simhash
from linkwright.llm.graph import components


def shingle_sets(texts):
    return [{" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in map(str.split, texts)]


def groups(sets):
    """Smallest index of each one's group by brute force over all pairs."""
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if label[i] != label[j] and 5 * common >= 4 * (len(a) + len(sets[j]) - common):
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    return label


def kept(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()}


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def test_appended_and_cut_copies_are_found(spark):
    rng, texts = random.Random(5), []
    for _ in range(40):
        base = words(rng, 150)  # 146 shingles
        texts += [base, base + words(rng, 35)] if len(texts) % 4 else [base, base[:122]]
    assert kept(spark, [" ".join(t) for t in texts]) == set(range(0, 80, 2))


def test_the_border_is_exact(spark):
    rng, texts, want = random.Random(6), [], set()
    for k in range(60):
        base, more = words(rng, 150), 35 + k % 4
        want |= {2 * k, 2 * k + 1} if more > 36 else {2 * k}  # 146 / (146 + more) falls below 0.8 at 37
        texts += [base, base + words(rng, more)]
    assert kept(spark, [" ".join(t) for t in texts]) == want


def family(rng, cousins):
    """A template's variants, each unlike the others (about 0.7), with copies above and below 0.8 of each."""
    base, texts = words(rng, 300), []
    for _ in range(cousins):
        w = list(base)
        for at in rng.sample(range(300), 6):
            w[at] = f"x{rng.randrange(10**6)}"
        for edits in (0, 2, 5, 8):
            c = list(w)
            for at in rng.sample(range(300), edits):
                c[at] = f"y{rng.randrange(10**6)}"
            texts.append(" ".join(c))
    return texts


@pytest.mark.parametrize("block", [simhash.BLOCK_SHINGLES, 3000])
def test_families_in_large_buckets(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", block)
    texts = family(random.Random(7), 40)
    label = groups(shingle_sets(texts))
    assert len(texts) > 4 * simhash.SMALL and 5 < len(set(label)) < len(texts) - 5
    assert kept(spark, texts) == set(label)


@pytest.mark.parametrize("cousins", [1, 3, 7])
def test_families_in_middling_buckets(spark, cousins):
    """Buckets of up to 32 sets: pairs where few are left, members where there would be more pairs than members."""
    texts = [t for seed in range(3) for t in family(random.Random(seed), cousins)]
    assert kept(spark, texts) == set(groups(shingle_sets(texts)))


def test_no_bucket_gives_more_rows_than_it_has(spark):
    rng = random.Random(9)
    base, rows = words(rng, 200), []
    for at in range(30):
        rows.append((at, zlib.compress(" ".join([*base[: 6 * at], f"z{at}", *base[6 * at + 1 :]]).encode())))
    found = simhash.candidates(spark.createDataFrame(rows, "id long, packed binary"), len(rows)).toPandas()
    prefixes = sum(len(x) - (4 * len(x) + 4) // 5 + 1 for x in simhash._sets([r[1] for r in rows]))
    assert 0 < len(found) <= prefixes and set(found[found["b"].isna()]["a"]) == set(range(30))


def test_forest_joins_what_all_pairs_join():
    texts = family(random.Random(8), 15)
    sets = shingle_sets(texts)
    edges = simhash.forest(np.arange(len(texts)), np.arange(len(texts)), [simhash.shingles(t) for t in texts])
    label = list(range(len(texts)))
    for a, b in edges:
        assert groups([sets[a], sets[b]]) == [0, 0]
        lo, hi = sorted((label[a], label[b]))
        label = [lo if x == hi else x for x in label]
    assert label == groups(sets)


@pytest.mark.parametrize("block", [4, 64])
def test_probers_of_a_hot_neighbour_are_split(spark, monkeypatch, block):
    """One key with 600 owners, and keys beside it that those probe and a few own."""
    r = np.random.default_rng(2)
    low = r.integers(0, 1 << 40, 600, dtype=np.uint64)
    hot = low | np.uint64(0xABCDEF << 40)
    beside = [x ^ np.uint64(1 << b) ^ np.uint64(1 << c) for b, c in [(41, 3), (63, 60), (50, 0)] for x in hot[:5]]
    fps = np.unique(np.concatenate([hot, np.array(beside, np.uint64), hot[:40] ^ np.uint64(5)]))
    nodes = spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)}))
    pairs = [(1 << b) | (1 << c) for b in range(40, 64) for c in range(40, b)]
    plan = [(0xFFFFFF << 40, [0, *[1 << b for b in range(40, 64)], *pairs]), (0xFFFFF, [0]), (0xFFFFF << 20, [0])]
    edges = simhash.link(nodes, 4, block, plan)
    roots = {x["node"]: x["root"] for x in components(edges).collect()}
    got = {}
    for f in fps.view(np.int64).tolist():
        got.setdefault(roots.get(f, f), set()).add(f)
    d = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while True:
        new = np.array([label[row].min() for row in d])
        if (new == label).all():
            break
        label = new
    want = {}
    for f, k in zip(fps.view(np.int64).tolist(), label.tolist(), strict=True):
        want.setdefault(k, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    sizes = simhash._hot_keys(nodes, plan, block).collect()
    assert any(x["so"] == 1 and x["sp"] >= 600 // block for x in sizes) and any(x["so"] > 1 for x in sizes)


def test_steps_leave_no_files_behind_and_rounds_change_nothing(spark, monkeypatch):
    """Shuffles of finished steps go while the stage runs; a share of sets that makes many rounds gives the same rows."""
    texts = [t for seed in range(2) for t in family(random.Random(seed), 12)]
    seen, held, store = set(), [], simhash.checkpoint
    folders = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def watched(df):
        out = store(df)
        now = {p.name.split("_")[1] for f in folders for p in Path(f).rglob("shuffle_*.data")}
        seen.update(now)
        held.append(len(now))
        return out

    simhash.reclaim(spark)
    time.sleep(2)
    monkeypatch.setattr(simhash, "checkpoint", watched)
    monkeypatch.setattr(simhash, "ROUND_LEAST", 400)
    assert kept(spark, texts) == set(groups(shingle_sets(texts)))
    assert max(held) < 0.6 * len(seen)


def test_the_filter_searches_fingerprints_first(spark, monkeypatch):
    """Copies with near fingerprints are joined by that search, those far apart by the exact one, and no others."""
    rng, texts, edges = random.Random(11), [], []
    for k in range(12):
        base = words(rng, 400)
        texts += [base, base[:399] + ["end"], base + words(rng, 90 if k % 2 else 130)]
    texts = [" ".join(t) for t in texts]
    fps = [simhash.fingerprint(t) for t in texts]
    close = {(i, j) for i in range(36) for j in range(i + 1, 36) if (fps[i] ^ fps[j]).bit_count() <= simhash.RADIUS}
    assert len(close) > 8 and any((3 * k, 3 * k + 2) not in close for k in range(1, 12, 2))
    store = simhash.fingerprint_edges
    monkeypatch.setattr(simhash, "fingerprint_edges", lambda *a: edges.append(store(*a)) or edges[-1])
    assert kept(spark, texts) == set(groups(shingle_sets(texts)))
    assert edges[0].count() >= len({i // 3 for i, j in close}) and all(r.a != r.b for r in edges[0].collect())


def test_sketches_hide_no_similar_pair():
    """Bits bound the difference from below: sets at or above 0.8 always pass, most others don't."""
    rng, close, far = np.random.default_rng(3), [], []
    for n in (1, 5, 100, 700, 40_000):  # too many for the bits at last
        for common in (n, (8 * n + 8) // 9, n // 2, 0):
            keys = rng.integers(-(1 << 62), 1 << 62, 2 * n - common)
            a, b = keys[:n], keys[n - common :]
            (close if simhash.similar(common, n, n) else far).append((a, b))

    def passes(pairs):
        sizes = [np.array([len(p[k]) for p in pairs]) for k in (0, 1)]
        return simhash.may_be_similar(*[simhash._sketches([simhash.sketch(p[k]) for p in pairs]) for k in (0, 1)], *sizes)

    assert passes(close).all() and len(close) > 5
    assert not passes([p for p in far if 50 < len(p[0]) < 1000]).any()


def test_long_sets_like_no_other_have_no_partner():
    """Sketches are as wide as sets are large: of 40 long sets of different sizes only two similar ones may be similar."""
    rng = np.random.default_rng(4)
    sets = [rng.integers(-(1 << 62), 1 << 62, 4500 + 30 * i) for i in range(40)]  # one width ends at 4096, one at 8192
    sets[30] = np.r_[sets[3], sets[30][: len(sets[3]) // 6]]
    sets += [rng.integers(-(1 << 62), 1 << 62, 4000), rng.integers(-(1 << 62), 1 << 62, 8400)]
    sets[-1] = np.r_[sets[-1][:1500], sets[39], sets[-1][1500:1600]]
    size = np.array([len(x) for x in sets])
    near = simhash.partnered(np.arange(len(sets)), size, simhash._sketches([simhash.sketch(x) for x in sets]))
    assert np.flatnonzero(near).tolist() == [3, 30]


def test_sets_like_no_other_are_not_moved(spark, monkeypatch):
    """A line that many unlike texts share makes a large bucket; only the two copies in it are compared by their texts."""
    rng, moved, needed = random.Random(12), [], simhash._needed
    line = words(rng, 5)
    texts = [line + [f"u{k}x{i}" for i in range(60)] for k in range(80)]
    texts.append([*texts[7][:-1], "end"])
    monkeypatch.setattr(simhash, "_needed", lambda nodes, ids: moved.append(ids.distinct().count()) or needed(nodes, ids))
    monkeypatch.setattr(simhash, "prefix", lambda keys, *_: keys)
    assert kept(spark, [" ".join(t) for t in texts]) == set(range(80))
    assert moved and max(moved) <= 2


def test_components_leave_few_partitions(spark, monkeypatch):
    """Rounds over few edges write few files, however many partitions the edges came in."""
    from linkwright.llm import graph

    seen, store = [], graph.checkpoint
    monkeypatch.setattr(graph, "checkpoint", lambda df: seen.append((out := store(df)).rdd.getNumPartitions()) or out)
    edges = spark.range(0, 40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(30)
    assert {r["root"] for r in components(edges).collect()} == {0}
    assert len(seen) > 2 and max(seen[1:]) == 1


def test_a_familys_buckets_give_each_set_about_once(spark):
    """Each variant lacks a few of the family's shingles, so that hardly two buckets have the same members."""
    texts = family(random.Random(7), 40)
    rows = [(i, zlib.compress(t.encode())) for i, t in enumerate(texts)]
    found = simhash.candidates(spark.createDataFrame(rows, "id long, packed binary"), len(rows)).toPandas()
    members = found[found["b"].isna()][["key", "a"]].drop_duplicates()
    assert members["a"].nunique() > 20 and len(members) <= 5 * len(texts)


def test_partners_in_large_buckets_are_exact():
    rng = np.random.default_rng(4)
    for _ in range(50):
        size = rng.integers(1, 60, 40)
        left = np.maximum(1, size - rng.integers(0, 12, 40) * size // 50)
        pair = simhash.similar(np.minimum(left[:, None], left), size[:, None], size)
        np.fill_diagonal(pair, False)
        assert (simhash.has_partner(left, size) == pair.any(axis=1)).all()
