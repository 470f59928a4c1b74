"""Blocking, metrics, contract and composed plans."""

import glob
import os
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from linkwright import oracle, queries
from linkwright.operators import blocking, metrics, model, validate
from linkwright.plans import entities, resolver, solver
from linkwright.sources import tables
from linkwright.streaming.resolve import resolve_stream

SF = "/root/testdata/sf0.001"
REC = "id string, src int, name string, addr string, country string"


def records(spark, rows):
    return spark.createDataFrame(rows, REC)


def test_budget_counts_repeated_hits(spark):
    r = blocking.prepare(records(spark, [("S2-1", 2, "alpha beta", "", ""), ("S2-2", 2, "alpha gamma", "", ""), ("S3-1", 3, "alpha beta delta", None, None), ("S3-2", 3, "alpha", "", "")]))
    s = blocking.prepare(records(spark, [("S1-1", 1, "alpha beta", "", None), ("S1-2", 1, None, None, None)]))
    got = lambda k: {x["id"] for x in blocking.candidates(s, r, k).collect()}
    assert got(2) == {"S2-1", "S3-1"}
    assert got(3) == {"S2-1", "S3-1"}
    assert {x["id"] for x in blocking.ranked_candidates(s, r, 3).collect()} == {"S2-1", "S3-1", "S2-2"}
    assert blocking.candidates(s, r.limit(0), 3).count() == 0


def test_ranking_moves_no_pairs(spark):
    """Each of 300 references meets 300 records by one word; ranking them moves references and lists, not 90,000 pairs."""

    def moved():
        sc = spark.sparkContext
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    r = blocking.prepare(records(spark, [(f"S2-{i:03}", 2, f"alpha{i % 7} common", "", "US" if i % 2 else "FR") for i in range(300)]))
    s = blocking.prepare(records(spark, [(f"S1-{i:03}", 1, f"alpha{i % 7} common", "", "US") for i in range(300)]))
    at = moved()
    rows = blocking.ranked_candidates(s, r, 5).collect()
    assert moved() - at < 20_000
    got = sorted((x["rank"], x["id"], x["score"]) for x in rows if x["s1"] == "S1-003")
    assert got == [(n + 1, f"S2-{i:03}", 18) for n, i in enumerate([3, 17, 31, 45, 59])] and len(rows) == 1500


def test_ranking_is_exact_over_batches(spark):
    """Every reference meets every record by one long word; lists and references come in batches of 7 rows, some lists are short."""
    rng = random.Random(8)
    some = lambda n, of: " ".join(rng.choice(of) for _ in range(rng.randrange(n)))
    names, streets, lands = ["alpha", "alphabet", "bete", "beta", "gamma", "ny"], ["elm 5", "oak 5 7", "9", "pine", "77 elm"], ["", "US", "FR", " fr"]
    make = lambda src, n: [(f"S{src}-{i}", src, f"{some(4, names)} commonlongword", some(3, streets), rng.choice(lands)) for i in range(n)]
    mine, theirs = make(1, 40), make(2, 50) + make(3, 30)
    words = lambda x: [w for w in dict.fromkeys(x.split()) if len(w) >= 3]

    def score(a, b):
        n, m, h, g = words(a[2]), b[2].split(), *({w for w in x[3].split() if w.isdigit()} for x in (a, b))
        over_n, over_a = len(set(n) & set(m)), len(set(words(a[3])) & set(b[3].split()))
        same, prefix = n[0] == m[0], min(len(n[0]), len(m[0])) >= 4 and n[0][:4] == m[0][:4]
        house = 0 if not (h and g) else 3 if h == g else -1 if not h & g else 0
        return 4 * over_n + 5 * (over_n > 1) + 2 * over_a + 4 * (over_a > 1) + 3 * same + 2 * prefix + house

    land = lambda x: x[4].strip().lower()
    # cleaning drops a word that repeats the one before it; sets don't change by that
    want = {a[0]: sorted((-score(a, b), b[1], b[0]) for b in theirs if not land(a) or not land(b) or land(a) == land(b))[:6] for a in mine}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = blocking.ranked_candidates(*[blocking.prepare(records(spark, x)) for x in (mine, theirs)], 6).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {}
    for x in sorted(rows, key=lambda x: x["rank"]):
        got.setdefault(x["s1"], []).append((-x["score"], x["src"], x["id"]))
    assert got == want


def test_ranking_scores_many_pairs_at_once(spark):
    """24,000 references meet 400 records by two words each: 20 million scores, too many to take one by one."""
    r = blocking.prepare(records(spark, [(f"S2-{i:03}", 2, f"alphaword{i % 5} betaword", f"{i % 9} elm", "") for i in range(400)]))
    s = blocking.prepare(spark.range(24_000).selectExpr("'S1-' || id AS id", "1 AS src", "'alphaword' || id % 5 || ' betaword' AS name", "id % 9 || ' elm' AS addr", "'' AS country"))
    start = time.monotonic()
    assert blocking.ranked_candidates(s, r, 5).count() == 120_000
    assert time.monotonic() - start < 25


def test_solver_moves_no_pairs(spark):
    """Each of 300 references meets the first 150 of 300 records by one word; accepted records beyond these don't count."""

    def moved():
        sc = spark.sparkContext
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    r = records(spark, [(f"S2-{i:03}", 2, f"common word {chr(97 + i % 20) * 9}", "", "US") for i in range(300)])
    s = records(spark, [(f"S1-{i:03}", 1, f"common {chr(97 + i % 20) * 9}", "", "US") for i in range(300)])
    at = moved()
    rows = {x["s1"]: x["ids"] for x in solver.solve(s, r, 0.45).collect()}
    assert moved() - at < 10_000
    assert len(rows) == 300 and rows["S1-003"] == [f"S2-{i:03}" for i in range(3, 150, 20)]


def test_metrics_rules(spark):
    ents = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    truth = spark.createDataFrame([("a", "x"), ("a", "y")], "s1 string, id string")
    scored = spark.createDataFrame([("a", "x", 0.9, 1), ("b", "z", 0.7, 0)], "s1 string, id string, prob double, label int")
    at = {r["s1"]: r for r in metrics.entity_counts(ents, scored, truth, 0.5).withColumn("f", metrics.entity_f05(F.col("tp"), F.col("fp"), F.col("gt"))).collect()}
    assert at["a"]["f"] == pytest.approx(0.8333333) and at["b"]["f"] == 0.0 and at["c"]["f"] == 1.0
    best = metrics.best_threshold(metrics.threshold_curve(ents, scored, truth)).first()
    assert best["threshold"] == pytest.approx(0.705) and best["macro_f05"] == pytest.approx((0.8333333 + 2) / 3)
    none = metrics.best_threshold(metrics.threshold_curve(ents, scored.limit(0), truth)).first()
    assert none["threshold"] == 0.5
    assert spark.range(1).select(model.blend([F.lit(0.8), F.lit(0.6), None])).first()[0] == pytest.approx(0.725)


def write(path, text):
    path.write_text(text)
    return str(path)


HEAD = "source1_entity_id\tmatched_entity_ids\n"


@pytest.mark.parametrize(
    "body, rule",
    [
        ("", "V2"),
        ("source1_entity_id,matched_entity_ids\n", "V3"),
        ("a\tb\n", "V4"),
        (HEAD + "S1-1\tS2-1\nS1-2\nS1-2\t\n", "V5"),
        (HEAD + "S1-1\t\nS1-1\t\nS1-2\t\n", "V6"),
        (HEAD + "S1-1\tS2-1,S2-1\nS1-2\t\n", "V7"),
        (HEAD + "S1-1\tS1-2\nS1-2\t\n", "V8"),
        (HEAD + "S1-1\tX9-1\nS1-2\t\n", "V9"),
        (HEAD + 'S1-1\t""\nS1-2\t\n', "V9"),
        (HEAD + "S1-1\tS2-404\nS1-2\t\n", "V10"),
        (HEAD + "S1-1\t\n", "V11"),
        (HEAD + "S1-1\t\nS1-2\t\nS1-3\t\n", "V12"),
        (HEAD + "S1-1\tS2-1\nS1-2\t\n", None),
    ],
)
def test_contract_rules(spark, tmp_path, body, rule):
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "id string")
    valid = spark.createDataFrame([("S2-1",)], "id string")
    errors, _ = validate.validate(spark, write(tmp_path / "m.tsv", body), required, valid=valid)
    assert [e[: e.index(":")] for e in errors] == ([rule] if rule else [])


def test_contract_files(spark, tmp_path):
    required = spark.createDataFrame([("S1-1",)], "id string")
    assert validate.validate(spark, str(tmp_path / "none.tsv"), required)[0][0].startswith("V1:")
    m = write(tmp_path / "m.tsv", HEAD + "S1-1\tS2-1\n")
    c = write(tmp_path / "c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\t\n")
    errors, warnings = validate.validate(spark, m, required, c)
    assert not errors and any(w.startswith("V13") for w in warnings)


def test_lists_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", ["S2-1", "S3-1"], 0), ("S1-2", [], 1)], "s1 string, ids array<string>, n int")
    tables.write_lists(df, str(tmp_path / "out"), "matched_entity_ids", "n")
    (part,) = glob.glob(f"{tmp_path}/out/*.csv")
    assert open(part).read() == HEAD + "S1-1\tS2-1,S3-1\nS1-2\t\n"
    assert {(r["s1"], tuple(r["ids"])) for r in tables.read_results(spark, part).collect()} == {("S1-1", ("S2-1", "S3-1")), ("S1-2", ())}


def test_sources_by_name_and_place(spark, tmp_path):
    p = write(tmp_path / "s.tsv", 'k\tbusiness_name\tz\tcountry\nS1-1\t"a ""b"""\t\tUS\nS1-2\tc\td\t\n')
    rows = tables.read_source(spark, p, 1).orderBy("ordinal").collect()
    assert [(r["id"], r["name"], r["addr"], r["country"]) for r in rows] == [("S1-1", 'a "b"', "", "US"), ("S1-2", "c", "d", "")]
    assert [r["id"] for r in tables.read_source(spark, p, 1, limit=1, offset=1).collect()] == ["S1-2"]


def test_resolver_and_stream(spark, tmp_path):
    e = entities.from_parts(spark, SF).where("k < 60").persist()
    refs, recs, truth = e.where("src = 1"), e.where("src > 1"), entities.truth(e)
    m, audit = resolver.train(refs, recs, truth, 15, chunks=1, k=10, trees=3)
    assert audit.first()["macro_f05"] > 0.5
    m.save(f"file://{tmp_path}/model")
    again = model.Ensemble.load(spark, f"file://{tmp_path}/model")
    cands, lists = resolver.infer(refs, recs, again, 10)
    assert lists.count() == cands.count() == refs.count()
    both = cands.join(lists.withColumnRenamed("ids", "m"), "s1").where(F.size(F.array_except("m", "ids")) > 0)
    assert both.count() == 0
    refs.drop("k").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(refs.drop("k").schema).parquet(f"{tmp_path}/in")
    resolve_stream(stream, recs, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    assert spark.read.csv(f"{tmp_path}/out/batch=0", sep="\t", header=True).count() == refs.count()


SHORT = ["tx7_clean_text", "ex9_blocking_keys", "bl2_conjunction", "bl8_candidates", "bl12_key_candidates", "solver_rules", "f30_pair_features", "ag8_threshold_curve", "ag14_report", "v5_v12_findings", "bl17_complete"]


@pytest.mark.parametrize("name", SHORT)
def test_against_sql(spark, name):
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got, want = queries.queries()[name](spark, SF), c.sql(oracle.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    norm = lambda rows: sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert norm(got.select(*cols).collect()) == norm(want.select(", ".join(f'"{c}"' for c in cols)).fetchall())


def test_every_query_is_known():
    assert set(oracle.oracle_sql()) <= set(queries.queries())


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True)
