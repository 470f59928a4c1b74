"""Registered queries of the resolution operators; names begin with the operator's id. Their SQL is in ``oracle``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.functions import extract as ex
from linkwright.functions import similarity as sm
from linkwright.functions import text as tx
from linkwright.operators import blocking, features, metrics, model, validate
from linkwright.plans import entities as en
from linkwright.plans import resolver, solver
from linkwright.sources import tables

K = 40
THRESHOLD = 0.6


def _e1(spark: SparkSession, sf: str) -> DataFrame:
    return en.from_documents(spark, sf)


def _e2(spark: SparkSession, sf: str) -> DataFrame:
    return en.from_parts(spark, sf)


def _refs(e: DataFrame) -> DataFrame:
    return e.where("src = 1")


def _records(e: DataFrame) -> DataFrame:
    return e.where("src > 1")


def _r6(c):
    return F.round(c, 6)


def _text(entities, expr):
    """A query that shows one text expression of prepared entities."""

    def query(spark, sf):
        return entities(spark, sf).select("id", *expr())

    return query


def _joined(c):
    return F.array_join(F.array_sort(c), "|")


def _named():
    """Functions for the entities' text columns, nulls as ''; they need a session only when called."""
    c = lambda name: lambda: F.coalesce(F.col(name), F.lit(""))
    return c("name"), c("addr"), c("country")


def _prepared(entities):
    return lambda spark, sf: blocking.prepare(entities(spark, sf))


def _prep_text(entities, expr):
    return lambda spark, sf: blocking.prepare(entities(spark, sf)).select("id", *expr())


def _pairs(spark, sf):
    """Test pairs with both sides' prepared columns."""
    e = _e2(spark, sf)
    p = blocking.prepare(e)
    side = lambda x: p.select(*[F.col(c).alias(f"{x}_{c}") for c in ("id", "name_c", "addr_c", "name", "addr", "country")])
    return en.test_pairs(e).join(side("s"), F.col("s1") == F.col("s_id")).join(side("c"), F.col("id") == F.col("c_id"))


def _pair_query(expr):
    return lambda spark, sf: _pairs(spark, sf).select("s1", "id", _r6(expr()).alias("value"))


def _candidates(spark, sf, which=_e1, k=K):
    p = blocking.prepare(which(spark, sf))
    return blocking.candidates(_refs(p), _records(p), k)


def _step(step, which=_e1, k=K):
    def query(spark, sf):
        p = blocking.prepare(which(spark, sf))
        index, look = blocking.token_index(_records(p)), blocking.lookups(_refs(p))
        if step in blocking.PAIRS:
            return blocking.conjunction_hits(index, blocking.wanted_pairs(look, [step]), k).select("s1", "src", "id")
        return blocking.posting_hits(index, blocking.wanted_tokens(look, [step]), k).select("s1", "src", "id")

    return query


def _features(jaro):
    def query(spark, sf):
        e = _e2(spark, sf)
        p = features.profile(blocking.prepare(e))
        out = features.pair_features(en.test_pairs(e), _refs(p), _records(p), jaro)
        return out.select("s1", "id", *[_r6(c).alias(c) for c in out.columns if c not in ("s1", "id")])

    return query


def _scored(spark, sf):
    e = _e2(spark, sf)
    return _refs(e), en.test_pairs(e), en.truth(e)


def _lines(spark, sf, kind):
    """Output lines with faults put in by position; line 1 is the header."""
    e = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("k")).where("k > 0")
    k, mod = F.col("k").cast("string"), lambda m: F.pmod("k", F.lit(m))
    s1 = F.when(mod(50) == 7, F.concat(F.lit("S1-"), (F.col("k") - 1).cast("string"))).when(mod(61) == 5, F.concat(F.lit("S1-9"), k)).otherwise(F.concat(F.lit("S1-"), k))
    ids = F.when(mod(4) == 0, "").when(mod(20) == 1, F.concat(F.lit("S2-"), k, F.lit(",S2-"), k)).when(mod(20) == 2, F.concat(F.lit("S1-"), k)).when(mod(20) == 3, F.concat(F.lit("X9-"), k))
    ids = ids.otherwise(F.concat(F.lit("S2-"), k, F.lit(",S3-"), k) if kind == "candidate" else F.concat(F.lit("S3-"), k, F.when(mod(9) == 0, F.lit(",S2-0")).otherwise("")))
    value = F.when(mod(97) == 11, F.concat(F.lit("no tab "), k)).otherwise(F.concat(s1, F.lit("\t"), ids))
    head = spark.createDataFrame([(1, "source1_entity_id\tids")], "line_no long, value string")
    return head.union(e.select((F.col("k") + 1).cast("long"), value))


def _required(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet").select(F.concat(F.lit("S1-"), "p_partkey").alias("id"))


def _findings(spark, sf, kind="matching"):
    valid = _records(_e2(spark, sf)).select("id")
    return validate.list_findings(_lines(spark, sf, kind), _required(spark, sf), valid)


def _curve(make):
    def query(spark, sf):
        e, scored, gt = _scored(spark, sf)
        return make(e, scored, gt).select(_r6("threshold").alias("threshold"), _r6("macro_f05").alias("macro_f05"))

    return query


def _votes(spark, sf):
    """Test pairs with three learners' votes, the third missing for some."""
    p = en.test_pairs(_e2(spark, sf))
    n = F.round(F.col("prob") * 1000).cast("int")
    votes = [F.col("prob"), F.pmod(n * 7, F.lit(1000)) / 1000.0, F.when(F.pmod(n, F.lit(3)) != 0, F.pmod(n * 11, F.lit(1000)) / 1000.0)]
    return p.select("s1", "id", model.blend(votes).alias("p"))


def _train(spark, sf):
    e = _e2(spark, sf)
    p = features.profile(blocking.prepare(e))
    data = blocking.label(features.pair_features(en.test_pairs(e), _refs(p), _records(p)), en.truth(e))
    return model.Ensemble.fit(data, trees=5).score(data).select("s1", "id", "label", _r6("prob").alias("prob"))


def _solve(which):
    def query(spark, sf):
        e = which(spark, sf)
        return solver.solve(_refs(e), _records(e)).select("s1", F.array_join("ids", ",").alias("ids"))

    return query


def _resolved(spark, sf):
    """The resolver's whole path on the parts: block, compare, vote, threshold, both lists."""
    e = _e2(spark, sf)
    cands, found = resolver.infer(_refs(e), _records(e), model.FixedVotes(), K)
    text = lambda df, name: df.select("s1", F.array_join("ids", ",").alias(name))
    return text(cands, "candidates").join(text(found, "matched"), "s1")


def _completed(spark, sf):
    m, c = (validate.parse(_lines(spark, sf, kind)).groupBy("s1").agg(F.max_by("ids", "line_no").alias("ids")) for kind in ("matching", "candidate"))
    out = validate.complete(_required(spark, sf), m, c)
    return out.select("s1", F.array_join("matched", ",").alias("matched"), _joined("candidates").alias("candidates"))


def queries() -> dict:
    n, a, c = _named()
    ids = lambda df: df.select("id")
    pc = lambda x: F.col(x)
    sets = lambda x: F.array_distinct(tx.words(F.col(x)))
    out = {
        # scans
        "sc1_head": lambda s, d: _refs(_e2(s, d)).orderBy("id").limit(50).select("id", "name", "addr", "country"),
        "sc3_slice": lambda s, d: _refs(_e2(s, d)).orderBy("k").offset(20).limit(50).select("id", "name"),
        "sc5_null_to_empty": lambda s, d: _e2(s, d).select("id", F.coalesce(F.nullif("country", F.lit("US")), F.lit("")).alias("country")),
        "sc6_union_tagged": lambda s, d: _records(_e2(s, d)).select("id", F.concat(F.lit("source"), "src").alias("dataset")),
        "sc7_ids": lambda s, d: _e1(s, d).select(F.trim("id").alias("id")),
        "sc8_tolerant_results": lambda s, d: tables.parse_results(_lines(s, d, "matching").where("line_no > 1")).select("s1", F.array_join("ids", ",").alias("ids")),
        "sc9_preview": lambda s, d: _records(_e2(s, d)).orderBy("id").limit(10).select("id", "name"),
        "sc12_truth": lambda s, d: tables.truth_pairs(_lines(s, d, "matching").where("line_no > 1 AND value LIKE '%\t%'").select(F.substring_index("value", "\t", 1).alias("a"), F.expr("substring(value, instr(value, '\t') + 1)").alias("b"))),
        # text
        "tx1_remove_accents": _text(_e1, lambda: [tx.remove_accents(n()).alias("value")]),
        "tx2_lower": _text(_e1, lambda: [F.lower(tx.remove_accents(n())).alias("value")]),
        "tx3_strip_urls": _text(_e2, lambda: [tx.strip_urls(F.lower(n())).alias("value")]),
        "tx4_strip_legal": _text(_e2, lambda: [tx.strip_legal(F.lower(n())).alias("value")]),
        "tx5_strip_symbols": _text(_e2, lambda: [tx.strip_symbols(F.lower(a())).alias("value")]),
        "tx6_drop_repeats": _text(_e1, lambda: [tx.drop_repeats(tx.strip_symbols(F.lower(tx.remove_accents(a())))).alias("value")]),
        "tx7_clean_text": _text(lambda s, d: _e1(s, d).unionByName(_e2(s, d).withColumn("k", F.col("k").cast("string"))), lambda: [tx.clean_text(n()).alias("name"), tx.clean_text(a()).alias("addr")]),
        "tx9_digits": _text(_e2, lambda: [tx.digits(a()).alias("value")]),
        "tx10_country": _text(_e2, lambda: [tx.country(F.concat(F.lit(" "), c())).alias("value")]),
        "tx11_simple_clean": _text(_e1, lambda: [tx.simple_clean(n()).alias("value")]),
        # extraction
        "ex1_tokens": _prep_text(_e1, lambda: [_joined(ex.tokens(pc("name_c"), pc("addr_c"))).alias("value")]),
        "ex2_house_numbers": _text(_e2, lambda: [_joined(ex.house_numbers(F.concat(a(), F.lit("-"), a()))).alias("value")]),
        "ex3_postal_code": _text(_e2, lambda: [ex.postal_code(a(), c()).alias("value"), ex.postal_code(a(), F.lit("")).alias("unknown")]),
        "ex4_domain": _prep_text(_e2, lambda: [ex.domain(pc("name_c"), pc("addr_c")).alias("value")]),
        "ex5_acronym_match": _pair_query(lambda: ex.acronym_match(pc("s_name_c"), pc("c_name_c"))),
        "ex6_char_ngrams": _prep_text(_e2, lambda: [_joined(ex.char_ngrams(pc("name_c"))).alias("value")]),
        "ex7_simple_grams": _text(_e2, lambda: [_joined(ex.simple_grams(n())).alias("value")]),
        "ex8_first_house": _text(_e2, lambda: [ex.first_house(a()).alias("value")]),
        "ex9_blocking_keys": _text(_e2, lambda: [F.array_join(ex.blocking_keys(n(), a(), c()), "|").alias("value")]),
        "ex10_first_last_word": _prep_text(_e1, lambda: [ex.first_word(tx.words(pc("name_c"))).alias("first"), ex.last_word(tx.words(pc("name_c"))).alias("last")]),
        "ex11_longest_two": _prep_text(_e1, lambda: [F.array_join(ex.longest_two(tx.words(pc("addr_c"))), "|").alias("value")]),
        "ex12_profile": lambda s, d: features.profile(blocking.prepare(_e2(s, d))).select("id", "name_c", "addr_c", F.size("nt").alias("nt"), F.size("ng").alias("ng"), F.size("ag").alias("ag"), "fw", "lw", F.array_join("house", "|").alias("house"), "land", "postal", "dom"),
        "ex13_token_index": lambda s, d: blocking.token_index(_records(blocking.prepare(_e1(s, d)))),
        # blocking
        "bl1_postings": _step("p3a"),
        "bl2_conjunction": _step("p1"),
        "bl4_name_house": _step("p2", _e2),
        "bl6_address_tokens": _step("p4a"),
        "bl5_second_name_token": _step("p3b"),
        "bl6_second_address_token": _step("p4b"),
        "bl8_candidates": lambda s, d: _candidates(s, d),
        "bl8_candidates_parts": lambda s, d: _candidates(s, d, _e2),
        "bl9_ranked": lambda s, d: blocking.ranked_candidates(_refs(p := blocking.prepare(_e2(s, d))), _records(p), 10).select("s1", "id", "score", "rank"),
        "bl10_attributes": lambda s, d: blocking.attributes(_candidates(s, d), _e1(s, d).drop("k")).select("s1", "id", "name", "country"),
        "bl12_key_candidates": lambda s, d: blocking.key_candidates(_refs(e := _e2(s, d)), _records(e)),
        "bl13_country_filter": lambda s, d: _pairs(s, d).where(blocking.country_allows(tx.country(pc("s_country")), tx.country(pc("c_country")))).select("s1", "id"),
        "bl14_labels": lambda s, d: blocking.label(_candidates(s, d), en.truth(_e1(s, d))).select("s1", "id", "label"),
        "bl15_truth_of_chunk": lambda s, d: en.truth(e := _e2(s, d)).join(blocking.split_holdout(_refs(e), 50)[0].select(F.col("id").alias("s1")), "s1", "left_semi"),
        "bl16_holdout": lambda s, d: ids(blocking.split_holdout(_refs(_e2(s, d)), 50)[0]),
        "bl17_complete": _completed,
        # similarity
        "sm1_jaccard": _pair_query(lambda: sm.jaccard(sets("s_name_c"), sets("c_name_c"))),
        "sm2_string_ratio": _pair_query(lambda: sm.string_ratio(pc("s_name_c"), pc("c_name_c"))),
        "sm3_token_sort_ratio": _pair_query(lambda: sm.token_sort_ratio(pc("s_addr_c"), pc("c_addr_c"))),
        "sm4_jaro_winkler": _pair_query(lambda: sm.jaro_winkler(pc("s_name_c"), pc("c_name_c"))),
        "sm5_containment": _pair_query(lambda: sm.ratio(sm.overlap(sets("s_addr_c"), sets("c_addr_c")), F.least(F.size(sets("s_addr_c")), F.size(sets("c_addr_c"))))),
        "sm6_gram_jaccard": _pair_query(lambda: sm.jaccard(ex.simple_grams(pc("s_name")), ex.simple_grams(pc("c_name")))),
        "sm7_rule_accepts": lambda s, d: solver.accepted_pairs(_refs(e := _e2(s, d)), _records(e)),
        "sm8_f_beta": lambda s, d: en.test_pairs(_e2(s, d)).select("s1", "id", _r6(sm.f_beta(pc("prob"), 1 - pc("prob"))).alias("value")),
        "f30_pair_features": _features(False),
        "f32_pair_features": _features(True),
        "solver_rules": _solve(_e2),
        "resolve_parts": _resolved,
        "solver_rules_documents": _solve(_e1),
        # models
        "ml1_ml3_fit_score": _train,
        "ml5_blend": lambda s, d: _votes(s, d).select("s1", "id", _r6("p").alias("p")),
        "ml6_decide": lambda s, d: _votes(s, d).select("s1", "id", model.decide(F.round("p", 6), THRESHOLD).alias("yes")),
        # metrics
        "ag1_ag2_confusion": lambda s, d: (x := metrics.confusion(_scored(s, d)[1], THRESHOLD)).select(*[_r6(i).alias(i) if i.startswith("cand") else i for i in x.columns]),
        "ag15_confusion_matrix": lambda s, d: metrics.confusion_matrix(_scored(s, d)[1], THRESHOLD).select("actual", "predicted_no", "predicted_yes", _r6("rate_no").alias("rate_no"), _r6("rate_yes").alias("rate_yes")),
        "ag3_entity_counts": lambda s, d: metrics.entity_counts(*_scored(s, d), THRESHOLD),
        "ag4_entity_f05": lambda s, d: metrics.entity_counts(*_scored(s, d), THRESHOLD).select("s1", _r6(metrics.entity_f05(pc("tp"), pc("fp"), pc("gt"))).alias("f05")),
        "ag5_ag7_macro": lambda s, d: metrics.macro_f05(metrics.entity_counts(*_scored(s, d), THRESHOLD)).select(_r6("macro_f05").alias("macro_f05"), "correct_singletons", "false_singletons"),
        "ag6_blocking_recall": lambda s, d: metrics.blocking_recall(*_scored(s, d)[1:]).select(_r6("blocking_recall").alias("blocking_recall")),
        "ag8_threshold_curve": _curve(metrics.threshold_curve),
        "ag8_best_threshold": _curve(lambda e, x, g: metrics.best_threshold(metrics.threshold_curve(e, x, g))),
        "ag9_micro_curve": _curve(lambda e, x, g: metrics.micro_curve(x)),
        "ag9_retrieved_curve": _curve(lambda e, x, g: metrics.retrieved_curve(x)),
        "ag10_matches": lambda s, d: metrics.matches(*_scored(s, d)[:2], THRESHOLD).select("s1", F.array_join("ids", ",").alias("ids")),
        "ag11_ag16_token_frequency": lambda s, d: blocking.document_frequency(blocking.token_index(_records(blocking.prepare(_e1(s, d)))), 20),
        "ag12_groups": lambda s, d: en.test_pairs(_e2(s, d)).select("s1").distinct(),
        "ag13_counters": lambda s, d: metrics.matches(*_scored(s, d)[:2], THRESHOLD).agg(F.count_if(F.size("ids") > 0).alias("non_empty"), F.count(F.lit(1)).alias("n")),
        "ag14_report": lambda s, d: (x := metrics.report(*_scored(s, d))).select(*[i if x.schema[i].dataType.typeName() == "long" else _r6(i).alias(i) for i in x.columns]),
        # sets, sorts, limits
        "so1_intersect": lambda s, d: (i := blocking.token_index(_records(blocking.prepare(_e1(s, d))))).where("token = 'the'").select("id").intersect(i.where("token = 'and'").select("id")),
        "so2_union": lambda s, d: _candidates(s, d).select("id").union(en.truth(_e1(s, d)).select("id")).distinct(),
        "so4_difference": lambda s, d: ids(_records(_e1(s, d))).exceptAll(_candidates(s, d).select("id").distinct()),
        "so5_first_of_each": lambda s, d: _records(_e1(s, d)).groupBy("name").agg(F.min(F.struct("src", "id")).alias("m")).select("name", "m.id"),
        "so7_examples": lambda s, d: validate.examples(_findings(s, d)),
        # output contract
        "v5_v12_findings": lambda s, d: _findings(s, d),
        "v13_outside_candidates": lambda s, d: validate.outside_candidates(*[validate.parse(_lines(s, d, kind)) for kind in ("matching", "candidate")]),
        "v16_statistics": lambda s, d: validate.statistics(_lines(s, d, "matching")),
        "sk1_candidate_lines": lambda s, d: _candidates(s, d).groupBy("s1").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.concat("s1", F.lit("\t"), F.array_join("ids", ",")).alias("line")),
    }
    return out
