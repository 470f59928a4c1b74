"""Shards and packed sequences hold whole documents and all their tokens."""

import random
from collections import Counter

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from linkwright.llm import common, packing, sharding, token_files
from linkwright.llm.common import encoder, tokenizer_path


def texts():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(1, 9)))
    return [(None, "no id"), (7, None), (8, ""), (9, "é x" * 40_000), *[(i, " ".join(word() for _ in range(r.choice([1, 30, 3000])))) for i in range(10, 90)]]


def test_op8_writes_whole_documents_in_slot_order(spark, tmp_path, monkeypatch):
    rows = [(i, t, "x", 5) for i, t in texts()]
    spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(sharding, "fresh_path", lambda *_: f"file://{tmp_path}/shards")
    got = sharding.op8_sharding(spark, str(tmp_path)).collect()
    files = sorted(tmp_path.glob("shards/shard=*/*.parquet"))
    held, slots = [], {}
    for f in files:
        table = pq.read_table(f, partitioning=None).to_pylist()
        assert [r["slot"] for r in table] == sorted(r["slot"] for r in table)
        held += [(r["doc_id"], r["text"], r["source"], r["size"]) for r in table]
        slots.setdefault(int(f.parent.name[6:]), []).extend(r["slot"] for r in table)
    assert Counter(held) == Counter(rows)
    assert {(k, n) for k, v in slots.items() for n in v} == {(r["shard"], r["slot"]) for r in got} and len(got) == len(rows)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(slots) == 16


def test_sequences_hold_every_token(spark):
    df = spark.createDataFrame(texts(), "doc_id long, text string")
    got = packing.sequences(packing.pack(packing.pieces(df, tokenizer_path()))).collect()
    back = {}
    for r in got:
        ids, at = packing.unpacked(r["ids"], sum(p["length"] for p in r["pieces"])), 0
        assert 0 < len(ids) <= packing.CONTEXT
        for p in r["pieces"]:
            assert p["offset"] == at
            at += p["length"]
            back.setdefault(p["doc_id"], {})[p["start"]] = ids[p["offset"] : at].tolist()
        assert at == len(ids)
    enc = encoder(tokenizer_path())
    want = {i: [*enc._ids(t or ""), packing.END_ID] for i, t in texts()}
    assert {i: [x for _, part in sorted(v.items()) for x in part] for i, v in back.items()} == want


def test_op8_gives_the_same_order_on_any_number_of_partitions(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, t, 5) for i, t in texts()], "doc_id long, text string, size int").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(sharding.two_pass_shuffle, "__defaults__", (17, 20_000))
    old, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for parts in ("4", "8", "31"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append(sorted(map(str, sharding.op8_sharding(spark, str(tmp_path)).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1] == found[2] and len(found[0]) == len(texts())


def test_plans_of_many_runs_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame(texts(), "doc_id long, text string").repartition(3)
    found = packing.pieces(docs, tokenizer_path()).cache()
    take = lambda: Counter((r["doc_id"], r["piece"], bytes(r["ids"]), r["sequence_id"], r["offset"]) for r in packing.pack(found).collect())
    whole = take()
    monkeypatch.setattr(packing, "MAX_RUNS", 0)
    monkeypatch.setattr(packing, "RANKS", 3)
    assert take() == whole


def test_token_files_stream_blocks(spark, tmp_path):
    rows = [*texts(), *[(5, "the same row")] * 300]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    enc = encoder(tokenizer_path())
    lengths = Counter((i, len(enc.encode([t or ""])[0]) + 1) for i, t in rows)
    for size in (1, 50, 1 << 20):
        path = f"file://{tmp_path}/{size}"
        token_files.write_token_files(docs, path, tokenizer_path(), block_ids=size)
        got = token_files.read_token_files(spark, path).collect()
        assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == lengths
        got.sort(key=lambda r: r["start"])
        assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:i]) for i in range(len(got))]
        assert [r["doc_id"] or -1 for r in got] == sorted(r["doc_id"] or -1 for r in got)
        blocks = spark.read.parquet(f"{path}/blocks").collect()
        assert all(r["ids"] <= size or len(r["doc_ids"]) == 1 for r in blocks) and (size > 50 or len(blocks) > 80)


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        common.shared_dir(Session)


def test_packing_stage_bounds_what_workers_keep(spark):
    """Of 480,000 different words in 3.4 million characters, an encoder that stays with its worker keeps a part at a time."""
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(6))
    docs = spark.createDataFrame([(d, " ".join(word(d * 60_000 + i) for i in range(60_000))) for d in range(8)], "doc_id long, text string").coalesce(1)
    assert corpus_pipeline.packing(spark, docs, "").where("start = 0").count() == 8

    def held(batches):
        from linkwright.llm import common

        for batch in batches:
            yield batch.assign(id=max((len(e.young) for e in common._ENCODERS.values()), default=0))

    most = max(r[0] for _ in range(3) for r in spark.range(0, 8, 1, 8).mapInPandas(held, "id long").collect())
    assert 0 < most <= 300_000
