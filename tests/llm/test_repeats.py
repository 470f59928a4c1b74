"""Repeated substrings where Spark re-plans: groups must meet whole however the joins before them are run."""

import random

import pytest

from linkwright.llm import substring_dedup


def brute(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(sum(gone))
    return out


@pytest.fixture
def uneven(spark):
    """Many small splits, no merging of partitions, joins broadcast when run."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1", "spark.sql.shuffle.partitions": "7"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("group", "salted"), [(substring_dedup.GROUP, False), (5, False), (5, True)])
def test_groups_meet_whole_when_joins_are_planned_anew(spark, uneven, tmp_path, monkeypatch, group, salted):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    if salted:
        monkeypatch.setattr(substring_dedup, "HOT_ANCHORS", 0)
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages = [text(100) for _ in range(30)]
    line = "one line over and over "
    texts = [text(40) + " " + passages[i % 30] + " " + text(40) for i in range(90)] + [text(5) + line * 30 + text(5) for _ in range(40)]
    path = str(tmp_path / "d")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12).write.parquet(path)
    tables = {t.name for t in spark.catalog.listTables()}
    got = {x["doc_id"]: x["n_removed"] for x in substring_dedup.remove_repeats(spark.read.parquet(path)).collect()}
    assert [got[i] for i in range(len(texts))] == brute([t.encode() for t in texts], 400)
    assert {t.name for t in spark.catalog.listTables()} == tables
